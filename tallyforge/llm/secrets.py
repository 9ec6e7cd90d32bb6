"""Secret scans (native): base patterns plus character Markov models.

Two first-order character models, one of random strings and one of ordinary identifiers and words,
are counted from labelled samples; a long token, or the part of it that no base pattern covers, is a
secret when its mean log-likelihood ratio is above a cut that held-out labelled strings set. Nothing
but DataFrame functions runs here.

Defined cases: null text counts as empty; empty texts and tables give no spans; ties at one start
are ordered by kind; extra columns pass through find() and redact().
"""

from __future__ import annotations

import math
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_sample
from .sqlkit import let, match_spans

# The base patterns, their kinds in listed order and their least lengths.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST, ACCESS, ACCESS_LEAST, HEX, HEX_LEAST = 12, "AKIA[A-Z0-9]+", 18, "[0-9a-f]+", 16
#: A greedy run that is long enough equals a run of at least that length: shorter runs are dropped either way.
ACCESS_LONG, HEX_LONG = "AKIA[A-Z0-9]{14,}", "[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")

#: Tokens that the models judge, the least length of a part that base patterns leave, and the documents and made strings that train them at most.
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-"
PART_LEAST = 12
SAMPLE_DOCS = 4000
MADE_STRINGS = 4000
#: Letters of the made random strings, besides base64 and lower-case hex; letters that ruled lines repeat.
_UPPER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
FAMILIES = (_DIGITS + "ABCDEF", _UPPER + _DIGITS, _UPPER + "234567", _UPPER, _UPPER.lower(), _UPPER.lower() + _DIGITS, _UPPER + _UPPER.lower() + _DIGITS + "-_")
RULES = "-_=+/."
#: Words of a document that make identifiers, words of an identifier, every how many strings one is held out, and held-out strings of a kind at most.
NAME_WORDS, NAME_PARTS, HOLD_OUT, HELD = 200, 4, 5, 10_000
SMOOTH = 0.5
#: The share of a transition that the second letter alone gives, so that pairs that a sample lacks do not decide.
MIX = 0.1


def _kind(spans: Column, kind: str) -> Column:
    k = KINDS.index(kind)
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e")))


def base_spans(text: Column) -> dict[str, Column]:
    """array<struct<s,k,e>> of each base kind, failing matches dropped."""
    assign = F.filter(match_spans(text, ASSIGN), lambda x: F.char_length(F.regexp_extract(x["m"], ASSIGN, 2)) >= ASSIGN_LEAST)
    return {"assign": _kind(assign, "assign"), "access": _kind(match_spans(text, ACCESS_LONG), "access"), "hex": _kind(match_spans(text, HEX_LONG), "hex")}


def labelled(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(random boolean, s): strings of about SAMPLE_DOCS documents, chosen by hash, that base rules or word shape label, and made random strings."""
    sample = hash_sample(docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("t")), SAMPLE_DOCS, "t")
    values = F.concat(
        F.filter(F.regexp_extract_all("t", F.lit(ASSIGN), F.lit(2)), lambda v: F.char_length(v) >= ASSIGN_LEAST),
        F.regexp_extract_all("t", F.lit(ACCESS_LONG), F.lit(0)), F.regexp_extract_all("t", F.lit(HEX_LONG), F.lit(0)),
    )
    plain = F.filter(F.regexp_extract_all("t", F.lit("[A-Za-z_-]{3,19}"), F.lit(0)), lambda v: ~v.rlike(ACCESS))
    both = sample.select(F.explode(F.concat(F.transform(values, lambda v: F.struct(F.lit(True).alias("random"), v.alias("s"))), F.transform(plain, lambda v: F.struct(F.lit(False).alias("random"), v.alias("s"))))).alias("x")).select("x.*")
    i, n = F.col("id"), (20 + F.col("id") % 21).cast("int")
    letter = lambda f, j: F.substring(F.lit(f), (F.pmod(F.xxhash64(i, j, F.lit(f)), F.lit(len(f))) + 1).cast("int"), F.lit(1))
    drawn = [F.array_join(F.transform(F.sequence(F.lit(1), n), partial(letter, f)), "") for f in FAMILIES]
    made = docs.sparkSession.range(MADE_STRINGS).select(F.lit(True).alias("random"), F.explode(F.array(F.base64(F.unhex(F.sha2(i.cast("string"), 256))), F.substring(F.sha2(F.concat(F.lit("x"), i.cast("string")), 256), 1, 40), *drawn)).alias("s"))
    # identifiers in code join words with digits rarely: names with a short number teach the ordinary model digits
    few = both.where(~F.col("random")).select("s").distinct().orderBy(F.xxhash64("s"), "s").limit(MADE_STRINGS)
    names = few.select(F.lit(False).alias("random"), F.concat("s", F.lit("_"), F.pmod(F.xxhash64("s"), F.lit(100)).cast("string")).alias("s"))
    # consecutive words joined as code, constants and paths join them
    short = sample.select(F.slice(F.filter(F.regexp_extract_all("t", F.lit("[A-Za-z]{3,19}"), F.lit(0)), lambda v: ~v.rlike(ACCESS)), 1, NAME_WORDS).alias("w")).where(F.size("w") >= NAME_PARTS)
    parts = short.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - NAME_PARTS + 1, F.lit(NAME_PARTS)), lambda j: F.slice("w", j, NAME_PARTS))).alias("w"))
    camel = F.array_join(F.transform("w", lambda v: F.concat(F.upper(F.substring(v, 1, 1)), F.lower(F.substring(v, 2, 19)))), "")
    forms = F.array(camel, F.upper(F.array_join("w", "_")), F.upper(F.array_join("w", "")), *(F.lower(F.array_join("w", c)) for c in ("_", "-", "/", "")))
    joined = parts.select(F.lit(False).alias("random"), F.explode(forms).alias("s"))
    rules = docs.sparkSession.range(MADE_STRINGS // 10).select(F.lit(False).alias("random"), F.explode(F.array(*(F.expr(f"repeat('{c}', 20 + id % 21)") for c in RULES))).alias("s"))
    return both.unionByName(made).unionByName(names).unionByName(joined).unionByName(rules)


def _cut(random: list[float], plain: list[float]) -> float:
    """The middle of the values that part the two kinds with the least sum of both error rates; 0 where a kind is missing."""
    if not random or not plain:
        return 0.0
    rank = sorted([(x, 1 / len(random)) for x in random] + [(x, -1 / len(plain)) for x in plain])
    wrong = least = 1.0  # everything above the cut: all of the plain strings are wrong
    at = rank[0][0]
    for (x, w), (y, _) in zip(rank, rank[1:]):
        wrong += w
        if wrong < least:
            least, at = wrong, (x + y) / 2
    return at


def train(samples: DataFrame) -> list[float]:
    """Log2 ratios of both models' transition probabilities, by row letter and column letter of ALPHABET, less the cut.

    One string in HOLD_OUT trains nothing; those that are as long as a candidate set the cut. What comes to the driver
    is at most two counts for each pair of letters and HELD strings of each kind.
    """
    n, h = F.char_length("s"), F.xxhash64(F.col("s"), F.lit("held"))
    held = F.pmod(h, F.lit(HOLD_OUT)) == 0
    pairs = samples.where((n > 1) & ~held).select("random", F.explode(F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring(F.col("s"), i, F.lit(2)))).alias("p"))
    k = len(ALPHABET)
    counts = {r: [[SMOOTH] * k for _ in range(k)] for r in (True, False)}
    at = {c: i for i, c in enumerate(ALPHABET)}
    for row in pairs.where(F.col("p").rlike(r"^[A-Za-z0-9+/_=.-]{2}$")).groupBy("random", "p").count().collect():
        counts[row["random"]][at[row["p"][0]]][at[row["p"][1]]] += row["count"]
    sums = {r: [sum(x) for x in counts[r]] for r in counts}
    alone = {r: [sum(x[b] for x in counts[r]) / sum(sums[r]) for b in range(k)] for r in counts}
    chance = lambda r, a, b: (1 - MIX) * counts[r][a][b] / sums[r][a] + MIX * alone[r][b]
    table = [math.log2(chance(True, a, b) / chance(False, a, b)) for a in range(k) for b in range(k)]
    long = samples.where(held & F.col("s").rlike(f"^{CANDIDATE}$"))
    mean = lambda s: sum(table[at[x] * k + at[y]] for x, y in zip(s, s[1:])) / (len(s) - 1)
    means = [[mean(r["s"]) for r in long.where(F.col("random") == kind).select("s", h.alias("h")).distinct().orderBy("h", "s").limit(HELD).collect()] for kind in (True, False)]
    cut = _cut(*means)
    return [x - cut for x in table]


def mean_ratio(token: Column, table: list[float]) -> Column:
    """The mean log-likelihood ratio of a token's transitions."""
    k = len(ALPHABET)
    codes = [str(ALPHABET.find(chr(i))) for i in range(128)]
    code_of = F.split(F.lit(",".join(codes)), ",").cast("array<int>")
    ratios = F.split(F.lit(",".join(f"{x:.6f}" for x in table)), ",").cast("array<double>")
    at = lambda t, i: F.get(code_of, F.ascii(F.substring(t, i, F.lit(1))))
    total = let(token, lambda t: F.aggregate(F.sequence(F.lit(1), F.char_length(t) - 1), F.lit(0.0), lambda acc, i: acc + F.get(ratios, at(t, i) * k + at(t, i + 1))))
    return total / (F.char_length(token) - 1)


def find(docs: DataFrame, table: list[float] | None = None, text_col: str = "text") -> DataFrame:
    """docs with struct column _s: assign, access, hex (base spans) and every (all spans in order)."""
    table = table if table is not None else train(labelled(docs, text_col))
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = base_spans(text)
    out = docs.withColumn("_s", F.struct(*(v.alias(k) for k, v in base.items()), match_spans(text, CANDIDATE).alias("long")))
    known = F.concat("_s.assign", "_s.access", "_s.hex")

    def fresh(spans: Column) -> Column:
        free = F.flatten(F.transform(F.col("_s.long"), lambda x: _uncovered(x, spans)))
        random = F.filter(free, lambda x: mean_ratio(x["m"], table) > 0)
        return F.array_sort(F.concat(spans, _kind(random, "random")))

    every = F.when((F.size("_s.long") == 0) & (F.size(known) == 0), F.array().cast("array<struct<s:int,k:int,e:int>>")).otherwise(let(known, fresh))
    return out.withColumn("_s", F.struct("_s.assign", "_s.access", "_s.hex", every.alias("every")))


def _uncovered(x: Column, spans: Column) -> Column:
    """What no span covers of a candidate: itself where none touches it, else its parts of PART_LEAST letters or more."""

    def part(s: Column, e: Column) -> Column:
        return F.struct(s.alias("s"), e.alias("e"), F.substring(x["m"], s - x["s"] + 1, e - s).alias("m"))

    def cut(touch: Column) -> Column:
        begins = F.concat(F.array(x["s"]), F.transform(touch, lambda b: b["e"]))
        some = F.transform(begins, lambda s: part(s, F.least(x["e"], F.coalesce(F.array_min(F.transform(F.filter(touch, lambda b: b["e"] > s), lambda b: b["s"])), x["e"]))))
        return F.when(F.size(touch) == 0, F.array(part(x["s"], x["e"]))).otherwise(F.array_distinct(F.filter(some, lambda p: p["e"] - p["s"] >= PART_LEAST)))

    return let(F.filter(spans, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])), cut)


def spelled(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def report(docs: DataFrame, table: list[float] | None = None) -> DataFrame:
    """The contract's columns for each document."""
    found = find(docs.select("doc_id", "text"), table)
    base = F.array_sort(F.concat("_s.assign", "_s.access", "_s.hex"))
    return found.select(
        "doc_id", *(F.size(f"_s.{k}").cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(spelled(base).cast("binary"), 256).alias("base_sha256"), spelled(F.col("_s.every")).alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]", text_col: str = "text", table: list[float] | None = None) -> DataFrame:
    """docs with each secret (overlapping spans as one) replaced by mark; a present n_chars follows the new text."""
    found = find(docs, table, text_col)
    text = F.col(text_col)

    def step(acc: Column, x: Column) -> Column:
        joined = x["s"] < acc["e"]
        piece = F.when(joined, F.lit("")).otherwise(F.concat(F.substring(text, acc["e"] + 1, x["s"] - acc["e"]), F.lit(mark)))
        return F.struct(F.greatest(acc["e"], x["e"]).alias("e"), F.concat(acc["out"], piece).alias("out"))

    clean = F.aggregate("_s.every", F.struct(F.lit(0).alias("e"), F.lit("").alias("out")), step, lambda a: F.concat(a["out"], F.substring(text, a["e"] + 1, F.char_length(text))))
    found = found.withColumn(text_col, F.when(F.size("_s.every") == 0, text).otherwise(clean))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.size("_s.every") == 0, F.col("n_chars")).otherwise(F.char_length(text_col).cast(docs.schema["n_chars"].dataType)))
    return found.select(*docs.columns)
