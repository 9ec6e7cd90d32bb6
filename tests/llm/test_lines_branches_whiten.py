"""Line dedup, branch merge and whitening against brute-force versions."""

import hashlib
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import branches, common, lines, whiten

SPACES = " \t\n\x0b\x0c\r"
COMMON, OTHER = "This very line stands in many documents", "another line of some length, seen often"
CLASH = ["row", "doc", "gone", "lines", "h", "n_lines", "id", "origin", "leaves", "q", "n"]
ROWS = [
    (0, None, None, None), (1, "", "en", "s"), (2, "\n\n", None, "s"), (3, f"{COMMON}\nown\n{COMMON}", "en", None), (4, f"  {COMMON.upper()}\t\nx\n{OTHER}", "en", "s"), (5, f"{OTHER}\r\n{COMMON}\n", "en", "s"),
    (6, OTHER, "de", "s"), (7, f"{OTHER}\nshort", "en", "s"), (8, "line\n" * 300, "fr", "t"), (9, "Ünïcode 日本語 🙂 of twenty points\nb", "en", "s"), (10, "Ünïcode 日本語 🙂 of twenty points", "en", "s"),
    (11, "ünïcode 日本語 🙂 of twenty points", "en", "s"), (12, "Ünïcode 日本語 🙂 OF twenty points", "", ""), (None, f"{COMMON}\nkept", "en", "s"), (13, f"twice\n{COMMON}", "en", "s"), (13, f"twice\n{COMMON}", "en", "s"),
    (14, "a", "en", "s"), (14, "b\nc", "de", "s"),
]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string").repartition(3)
    return df.withColumns({c: F.lit(None).cast("string") for c in CLASH} | {"extra": F.create_map(F.lit("a"), F.lit(1))})


@pytest.fixture(scope="module")
def docs(spark, sf):
    return common.table(spark, sf, "documents")


def rows_of(df):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.select("doc_id", "text", "lang", "source").collect()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_lines(rows):
    held = defaultdict(set)
    split = [(d, [(x, lower(x.strip(SPACES))) for x in (t or "").split("\n")]) for d, t, _, _ in rows]
    for d, ls in split:
        for _, k in ls:
            if len(k) >= 20:
                held[k].add(d)
    out = []
    for d, ls in split:
        gone = [len(k) >= 20 and len(held[k] - {None}) >= 3 and d != max(held[k] - {None}) for _, k in ls]
        out.append((d, len(ls), sum(gone), sha("\n".join(x for (x, _), g in zip(ls, gone) if not g))))
    return out


def test_lines_equal_brute_force(odd, docs):
    for df in (odd, docs, odd.limit(0)):
        assert sorted(map(tuple, lines.report(df).collect()), key=str) == sorted(brute_lines(rows_of(df)), key=str)
    out = lines.dedup(odd, batches=1)
    assert out.columns == odd.columns + ["_n_lines", "n_dropped"]
    assert {r["doc_id"]: r["text"] for r in out.where("doc_id < 4").collect()} == {0: None, 1: "", 2: "\n\n", 3: "own"}


def test_runs_hold_each_key_once_and_are_compacted(spark, docs):
    hashes = lines.line_hashes(docs).cache()
    top = hashes.agg(F.max("doc")).first()[0]
    store, seen = lines.LineRuns(spark, 4, fan=2), set()
    for i in range(5):
        part = hashes.where((F.col("doc") <= top * (5 - i) // 5) & (F.col("doc") > (top * (4 - i) // 5 if i < 4 else -1)))
        keys = {tuple(r) for r in part.select("h", "g").collect()}
        own = {tuple(r) for r in store.add(part).select("h", "g").collect()}
        assert own == keys - seen
        seen |= keys
    assert [len(x) for x in store.levels] == [1, 0, 1]
    held = [tuple(r) for name in store.names() for r in store.run(name).select("h", "g").collect()]
    assert len(held) == len(set(held)) and set(held) == seen
    plan = store.run(store.names()[0]).join(store.run(store.names()[1]), ["h", "g"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan  # runs meet where they lie
    store.close()


def code(branch, doc, name):
    return zlib.crc32(f"{branch}:{'' if doc is None else doc}:{name}".encode()) % 11


def settle(b, x, y):
    if x != b and y != b and x != y:
        return b, "ii" if b is None else "ed" if x is None or y is None else "ee"
    return (x, "clean") if x != b else (y, "clean") if y != b else (b, None)


def brute_merge(rows):
    out, added = [], {"L": defaultdict(list), "R": defaultdict(list)}
    for doc, *cells in sorted({(d, t or "", g or "", s or "") for d, t, g, s in rows}, key=str):
        text, cells, n, sides = cells[0], cells[1:], defaultdict(int), {}
        for k, b in enumerate("LR"):
            row = code(b, doc, "row")
            if row in (3, 4) and doc is not None:
                added[b][-1 - k - doc].append((*cells, "!" if row == 3 else "?"))
            edit = lambda v, c, none: none if c == 0 else v + {1: "!", 2: "?"}.get(c, "")
            parts = [(edit(v, code(b, doc, x), ""), None) for v, x in zip(cells, ("lang", "source"))]
            parts += [(edit(v, code(b, doc, str(i)), None), {3: "!", 4: "?"}.get(code(b, doc, str(i)))) for i, v in enumerate(text.split("\n"))]
            sides[b] = parts if row else None
        base = [(v, None) for v in (*cells, *text.split("\n"))]
        if sides["L"] is None or sides["R"] is None:
            other = sides["L"] or sides["R"]
            kind = "ed" if other and other != base else "clean"
            n[kind] += 1
            result = (*cells, text) if kind == "ed" else None
        else:
            merged = []
            for b, x, y in zip(base, sides["L"], sides["R"]):
                pair = [settle(*z) for z in zip(b, x, y)]
                merged.append([v for v, _ in pair])
                for _, kind in pair:
                    n[kind] += 1
            result = (merged[0][0], merged[1][0], "\n".join(v for m in merged[2:] for v in m if v is not None))
        out.append((doc, result, n))
    for i in {*added["L"], *added["R"]}:
        values = {min(added[b][i]) for b in "LR" if added[b][i]}
        out.append((i, values.pop(), {"clean": 1}) if len(values) == 1 else (i, None, {"ii": 1}))
    full = [(i, *(r[:2] if r else (None, None)), sha(r[2]) if r else None, *(n.get(k, 0) for k in ("clean", "ee", "ed", "ii"))) for i, r, n in out]
    return sorted(full, key=str)


def test_merge_equals_brute_force(odd, docs):
    for df in (odd, docs, odd.limit(0)):
        assert sorted(map(tuple, branches.report(df).collect()), key=str) == brute_merge(rows_of(df))


def test_descent_skips_what_is_equal(spark, docs):
    base = branches.base_version(docs, 8)
    one = base.orderBy("id").first()["id"]
    left = base.withColumn("leaves", F.when(F.col("id") == one, F.transform("leaves", lambda x, i: F.when(i == 0, F.struct(F.concat(x["line"], F.lit("+")).alias("line"), x["after"].alias("after"))).otherwise(x))).otherwise(F.col("leaves")))
    versions = {"base": base, "left": left, "right": base}
    trees = None
    for s, v in versions.items():
        t = branches.tree(v, branches.KEY, branches.COLUMNS).withColumn("side", F.lit(s))
        trees = t if trees is None else trees.unionByName(t)
    need = branches.needs(trees, branches.KEY).collect()
    assert len(need) == 1 and need[0]["id"] == one and need[0]["changed_left"] and not need[0]["changed_right"]
    assert sum(need[0]["lines_left"]) == 1 and need[0]["lines_right"] is None and not any(need[0]["cols_left"])
    got = branches.merge(base, left, base, branches.KEY, branches.COLUMNS)
    counts = got.agg(*[F.sum(c) for c in branches.COUNTS]).first()
    assert tuple(counts) == (1, 0, 0, 0) and got.where("present").count() == base.count()


def test_versions_of_one_base_are_not_shuffled_again(docs):
    base = branches.base_version(docs, 8)
    plan = branches.branch(base, "L").hint("merge").join(base.hint("merge"), branches.KEY)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


VECTORS = [(1, [0.5, -1.0, 2.0]), (1, [0.5, -1.0, 2.0]), (2, [0.501, -1.0, 2.0]), (3, [3.25, 0.0, -0.0]), (4, None), (5, []), (6, [float("nan"), 1.0, 1.0]), (7, [None, 1.0, 1.0]), (8, [float("inf"), 1.0, 1.0]), (9, [1.0]), (None, [7.0, 7.5, -8.015625]), (10, [1.0, 1.5, 0.25])]


def exact(vectors):
    """n, deviations and the covariance of the distinct vectors, in whole numbers and fractions."""
    xs = [tuple((Fraction(c) * 64).__floor__() + 1_000_000 for c in v) for v in vectors]
    rows = sorted(set(xs))
    n, d = len(rows), len(xs[0])
    sums = [sum(r[i] for r in rows) for i in range(d)]
    cov = [[Fraction(sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in rows), n**3) for j in range(d)] for i in range(d)]
    return xs, n, sums, [sum((n * x - s) ** 2 for x, s in zip(r, sums)) for r in xs], np.array([[float(c) for c in r] for r in cov])


def check_whitening(df, rows):
    xs, n, sums, deviations, cov = exact([v for _, v in rows])
    got = defaultdict(list)
    for r in df.orderBy("component").collect():
        got[r["vec_id"]].append(r)
    eigen = np.linalg.eigvalsh(cov)[::-1][:16]
    flat = {}
    for (i, _), x, dev in zip(rows, xs, deviations):
        mine = [r for r in got[i] if r["deviation"] == dev]
        assert mine and {r["n"] for r in mine} == {n} and {int(r["deviation_text"]) for r in mine} == {dev}
        assert np.allclose([r["explained"] for r in mine[: len(eigen)]], eigen / np.trace(cov), rtol=1e-9) or len(mine) > len(eigen)
        flat[x] = [r["whitened"] for r in sorted(mine, key=lambda r: r["component"])][: len(eigen)] if len(mine) == len(eigen) else None
        assert {r["identity_error"] < 1e-9 for r in mine} == {True}
    w = np.array([v for v in flat.values() if v is not None])
    if len(w) == n:
        assert np.abs(np.cov(w.T, bias=True) - np.eye(w.shape[1])).max() < 1e-9


def test_whitening_is_exact(spark, sf):
    df = spark.createDataFrame(VECTORS, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in CLASH})
    done = whiten.whiten(df)
    assert {r["vec_id"] for r in done.collect()} == {1, 2, 3, 9, 10, None}
    check_whitening(done.where("vec_id <> 9 OR vec_id IS NULL"), [(i, v) for i, v in VECTORS if v and len(v) == 3 and all(c is not None and np.isfinite(c) for c in v)])
    alone = done.where("vec_id = 9").first()
    assert (alone["n"], alone["deviation"], alone["whitened"], alone["explained"], alone["identity_error"]) == (1, 0, None, 0.0, None)
    assert whiten.whiten(df.limit(0)).count() == 0
    real = common.table(spark, sf, "embeddings")
    check_whitening(whiten.whiten(real), [(r["vec_id"], r["embedding"]) for r in real.collect()])


def test_scatter_of_any_size():
    r = np.random.default_rng(1)
    small = r.integers(-(2**17), 2**17, (300, 4))
    for x in (small, small * 2**40, small.astype(object) * 10**60 + 1, np.zeros((0, 3), np.int64)):
        sums, cross = whiten.exact_scatter(x)
        rows = [[int(v) for v in row] for row in x]
        assert sums.tolist() == [sum(c) for c in zip(*rows)] or not rows
        assert all(cross[i, j] == sum(row[i] * row[j] for row in rows) for i in range(x.shape[1]) for j in range(x.shape[1]))
        assert all(sum(d << (32 * k) for k, d in enumerate(whiten.digits(int(v)))) == v for v in cross.reshape(-1))
    q = np.array([[3e38, -1e300, 0.015625, -0.015625]])
    assert [v - 0 for v in whiten.integers(q)[0]] == [int(3e38) * 64, int(-1e300) * 64, 1, -1]
