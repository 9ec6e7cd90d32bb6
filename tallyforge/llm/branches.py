"""Three-way merge of versions of a table of texts by Merkle descent.

A version is a DataFrame of key columns, value columns (strings) and `leaves`, an array with one entry for each line that the row of
the base has: struct<line, after>. A dropped line is null, a line put in behind it stands in `after`; a line's place in the array is
its stable identifier. Each version gets a tree of hashes: a bucket of rows, a row, its columns and its blocks of lines, a
line. The descent looks at buckets first, then at rows of buckets that differ, then at columns and blocks of rows that differ,
then at lines of blocks that differ; only columns and lines whose hashes differ are fetched from a branch and merged.

All joins are by key. Versions that are partitioned by the key (bucketed tables, or one exchange that all three come from) are not
shuffled again; else each is shuffled once, and nothing else moves but hashes.

Rules of the merge: columns, lines and the gaps behind lines merge by themselves. A change of one branch, or the same change of
both, is taken and counts in n_clean. Else the base stays, and it counts in n_edit_edit, n_edit_delete (one branch dropped it) or
n_insert_insert. A row that one branch drops goes (n_clean) unless the other changed it (n_edit_delete, the base's row
stays). A row that the base lacks is merged as one value. Keys must be unique in each version and not null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks_for, bucketed, checkpointed, stored, text_bytes

#: Rows are dealt to this many buckets of the tree at most, so a list of buckets has a bounded size.
BUCKETS = 4096
#: Lines of a block of the tree.
BLOCK = 32
SIDES = ("base", "left", "right")
COUNTS = ("n_clean", "n_edit_edit", "n_edit_delete", "n_insert_insert")
LEAF = "struct<line:string,after:string>"


def _leaf(line: Column, after: Column) -> Column:
    return F.struct(line.alias("line"), after.alias("after"))


def tree(version: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """key, bucket, row, cols, text, blocks, lines: hashes from the bucket's number down to each line (lines: an array a block)."""
    one = version.select(
        *key,
        F.array(*[F.xxhash64(F.col(c).isNull(), c) for c in columns]).cast("array<long>").alias("cols"),
        F.transform("leaves", lambda x: F.xxhash64(x["line"].isNull(), x["line"], x["after"].isNull(), x["after"])).alias("each"),
    )
    block = F.transform(F.sequence(F.lit(0), F.floor((F.size("each") - 1) / F.lit(BLOCK)).cast("int")), lambda b: F.slice("each", b * BLOCK + 1, F.lit(BLOCK)))
    two = one.select(*key, "cols", F.when(F.size("each") > 0, block).otherwise(F.array().cast("array<array<long>>")).alias("lines"))
    three = two.select("*", F.transform("lines", lambda x: F.xxhash64(x)).alias("blocks"))
    four = three.select("*", F.xxhash64("blocks", F.size("lines")).alias("text"))
    return four.select("*", F.xxhash64("cols", "text").alias("row"), F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int").alias("bucket"))


def differing_rows(trees: DataFrame, key: list[str]) -> DataFrame:
    """key, base, left, right: the row hashes (null: absent) of rows that are not the same in all three versions.

    Buckets are compared first; the rows of a bucket that is the same in all three are not looked at.
    """
    digests = trees.groupBy("bucket", "side").agg(F.bit_xor(F.xxhash64(*key, "row")).alias("x"), F.count(F.lit(1)).alias("n"))
    apart = digests.groupBy("bucket").agg(F.count(F.lit(1)).alias("sides"), F.min("x") != F.max("x"), F.min("n") != F.max("n")).toDF("bucket", "sides", "x", "n")
    apart = apart.where(F.col("x") | F.col("n") | (F.col("sides") < 3)).select("bucket")  # BUCKETS rows at most
    rows = trees.join(F.broadcast(apart), "bucket").groupBy(*key).agg(*[F.max(F.when(F.col("side") == s, F.col("row"))).alias(s) for s in SIDES])
    same = F.col("base").eqNullSafe(F.col("left")) & F.col("base").eqNullSafe(F.col("right"))
    return rows.where(~same)


def _apart(a: Column, b: Column) -> Column:
    """For each line of two trees' rows: whether its hash differs. Blocks with equal hashes are not descended."""
    deep = lambda k: F.zip_with(F.get(a["lines"], k), F.get(b["lines"], k), lambda x, y: ~x.eqNullSafe(y))
    flat = lambda k: F.transform(F.get(a["lines"], k), lambda x: F.lit(False))
    empty = F.array().cast("array<long>")
    step = lambda k: F.when(F.get(a["blocks"], k).eqNullSafe(F.get(b["blocks"], k)), flat(k)).otherwise(
        F.when(F.get(a["lines"], k).isNull(), F.transform(F.get(b["lines"], k), lambda x: F.lit(True)))
        .when(F.get(b["lines"], k).isNull(), F.transform(F.get(a["lines"], k), lambda x: F.lit(True)))
        .otherwise(deep(k))
    )
    n = F.greatest(F.size(a["blocks"]), F.size(b["blocks"]))
    some = F.flatten(F.transform(F.sequence(F.lit(0), n - 1), step))
    return F.when(a["text"] != b["text"], F.when(n > 0, some).otherwise(empty.cast("array<boolean>")))


def needs(trees: DataFrame, key: list[str]) -> DataFrame:
    """What is to be fetched for each differing row: in_base, in_left, in_right, changed_left, changed_right, same (left equals right)
    and, where all three have the row, the differing columns (cols_left, cols_right) and lines (lines_left, lines_right) as flags."""
    rows = differing_rows(trees, key)
    full = trees.join(rows.select(*key).hint("merge"), key, "left_semi")
    sides = full.groupBy(*key).agg(*[F.first(F.when(F.col("side") == s, F.struct("row", "cols", "text", "blocks", "lines")), ignorenulls=True).alias(s) for s in SIDES])
    b = F.col("base")
    out = [F.col(s).isNotNull().alias(f"in_{s}") for s in SIDES]
    for s in SIDES[1:]:
        x = F.col(s)
        all_three = F.col("base").isNotNull() & F.col("left").isNotNull() & F.col("right").isNotNull()
        out.append((~x["row"].eqNullSafe(b["row"])).alias(f"changed_{s}"))
        out.append(F.when(all_three, F.zip_with(b["cols"], x["cols"], lambda p, q: p != q)).alias(f"cols_{s}"))
        out.append(F.when(all_three, _apart(b, x)).alias(f"lines_{s}"))
    return sides.select(*key, *out, F.col("left")["row"].eqNullSafe(F.col("right")["row"]).alias("same"))


def _fetch(version: DataFrame, need: DataFrame, side: str, key: list[str], columns: list[str]) -> DataFrame:
    """key, side: struct of the differing columns and lines (null elsewhere) of the branch's rows that base and both branches have."""
    mine = need.where(f"in_base AND in_left AND in_right AND changed_{side}").select(*key, F.col(f"cols_{side}").alias("_cols"), F.col(f"lines_{side}").alias("_lines"))
    met = version.join(mine.hint("merge"), key)
    values = [F.when(F.get("_cols", F.lit(i)), F.col(c)).alias(c) for i, c in enumerate(columns)]
    lines = F.zip_with("leaves", "_lines", lambda x, on: F.when(on, x))
    return met.select(*key, F.struct(*values, F.when(F.col("_lines").isNotNull(), lines).alias("leaves")).alias(side))


def _settle(b: Column, x: Column, y: Column, x_on: Column, y_on: Column) -> tuple[Column, Column]:
    """The merged value and its kind (0 unchanged, else 1 + the place in COUNTS)."""
    x_new, y_new = x_on & ~x.eqNullSafe(b), y_on & ~y.eqNullSafe(b)
    clash = x_new & y_new & ~x.eqNullSafe(y)
    value = F.when(clash, b).when(x_new, x).when(y_new, y).otherwise(b)
    kind = F.when(clash, F.when(b.isNull(), 4).when(x.isNull() | y.isNull(), 3).otherwise(2)).when(x_new | y_new, 1).otherwise(0)
    return value, kind


def _merged_leaf(pair: Column, y: Column) -> Column:
    b, x = pair["b"], pair["x"]
    line, line_kind = _settle(b["line"], x["line"], y["line"], x.isNotNull(), y.isNotNull())
    after, after_kind = _settle(b["after"], x["after"], y["after"], x.isNotNull(), y.isNotNull())
    return F.struct(line.alias("line"), after.alias("after"), line_kind.alias("k"), after_kind.alias("j"))


def merge(base: DataFrame, left: DataFrame, right: DataFrame, key: list[str], columns: list[str], new: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Each key that any version has: key, present, the columns, lines (array<string>; both null where the merged row is absent), COUNTS.

    `new` may hold the rows of left and right that the base lacks, so that putting them in does not cost left and right their
    partitioning; left and right then have none of their own.
    """
    versions = {s: v.select(*key, *columns, "leaves") for s, v in zip(SIDES, (base, left, right))}
    added = dict(zip(SIDES[1:], [v.select(*key, *columns, "leaves") for v in new or (left, right)]))
    parts = [*versions.items(), *(added.items() if new else ())]
    trees = stored(reduce(DataFrame.unionByName, [tree(v, key, columns).withColumn("side", F.lit(s)) for s, v in parts]), "trees")
    need = checkpointed(needs(trees, key))
    zero = F.lit(0).cast("long")
    of_kind = lambda kinds, i: F.size(F.filter(kinds, lambda k: k == i)).cast("long")
    count = lambda kinds: [of_kind(kinds, i + 1).alias(c) for i, c in enumerate(COUNTS)]
    only = lambda which: [(F.lit(1).cast("long") if c == which else zero).alias(c) for c in COUNTS]

    # rows that the base has
    met = versions["base"].join(need.where("in_base").drop("in_base", "same").hint("merge"), key, "left")
    for s in SIDES[1:]:
        met = met.join(_fetch(versions[s], need, s, key, columns).hint("merge"), key, "left")
    empty = F.array().cast(f"array<{LEAF}>")
    x, y = (F.coalesce(F.col(s)["leaves"], empty) for s in SIDES[1:])
    pairs = F.zip_with("leaves", x, lambda b, x: F.struct(b.alias("b"), x.alias("x")))
    touched = F.col("left")["leaves"].isNotNull() | F.col("right")["leaves"].isNotNull()
    same = lambda v: F.transform(v, lambda b: F.struct(b["line"].alias("line"), b["after"].alias("after"), F.lit(0).alias("k"), F.lit(0).alias("j")))
    met = met.withColumn("out", F.when(touched, F.zip_with(pairs, y, _merged_leaf)).otherwise(same(F.col("leaves"))))
    cells = []
    for i, c in enumerate(columns):
        on = lambda s, i=i: F.coalesce(F.get(F.col(f"cols_{s}"), F.lit(i)), F.lit(False))
        cells.append(_settle(F.col(c), F.col("left")[c], F.col("right")[c], on("left"), on("right")))
    in_l, in_r = F.coalesce("in_left", F.lit(True)), F.coalesce("in_right", F.lit(True))
    saved = (in_l & ~in_r & F.col("changed_left")) | (in_r & ~in_l & F.col("changed_right"))
    fate = F.when(in_l & in_r, F.lit("merged")).when(saved, F.lit("saved")).otherwise(F.lit("gone"))
    kinds = F.concat(F.array(*[k for _, k in cells]).cast("array<int>"), F.transform("out", lambda z: z["k"]), F.transform("out", lambda z: z["j"]))
    met = met.select(*key, *[v.alias(c) for c, (v, _) in zip(columns, cells)], *[F.col(c).alias(f"_{c}") for c in columns], "leaves", "out", fate.alias("fate"), kinds.alias("kinds"))
    flat = lambda v: F.filter(F.flatten(F.transform(v, lambda z: F.array(z["line"], z["after"]))), lambda z: z.isNotNull())
    pick = lambda merged, kept: F.when(F.col("fate") == "merged", merged).when(F.col("fate") == "saved", kept)
    alone = {"n_clean": F.when(F.col("fate") == "gone", 1), "n_edit_delete": F.when(F.col("fate") == "saved", 1)}
    old = met.select(
        *key, (F.col("fate") != "gone").alias("present"), *[pick(F.col(c), F.col(f"_{c}")).alias(c) for c in columns], pick(flat(F.col("out")), flat(F.col("leaves"))).alias("lines"),
        *[F.when(F.col("fate") == "merged", n).otherwise(F.coalesce(alone.get(c, zero), zero)).cast("long").alias(c) for c, n in zip(COUNTS, count(F.col("kinds")))],
    )

    # rows that the base lacks: the one branch's, or what both agree on
    fresh = need.where("NOT in_base")
    whole = lambda s, which: added[s].join(fresh.where(which).select(*key).hint("merge"), key).select(*key, F.lit(True).alias("present"), *columns, flat(F.col("leaves")).alias("lines"), *only("n_clean"))
    clash = fresh.where("in_left AND in_right AND NOT same").select(*key, F.lit(False).alias("present"), *[F.lit(None).cast("string").alias(c) for c in columns], F.lit(None).cast("array<string>").alias("lines"), *only("n_insert_insert"))
    return reduce(DataFrame.unionByName, [old, whole("left", "in_left AND (same OR NOT in_right)"), whole("right", "in_right AND NOT in_left"), clash])


# The branches of documents that the registered query merges.

KEY, COLUMNS = ["id", "origin"], ["lang", "source"]


def _code(branch: str, name: Column) -> Column:
    return F.crc32(F.concat(F.lit(f"{branch}:"), F.col("id"), F.lit(":"), name).cast("binary")) % 11


def base_version(docs: DataFrame, parts: int) -> DataFrame:
    """documents as a version, in buckets of the key. Nulls become empty. The key is the id as text and a hash of the row, so that rows
    which share an id but differ are merged one by one; equal rows are one."""
    text, lang, source = (F.coalesce(c, F.lit("")) for c in ("text", "lang", "source"))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.xxhash64(text, F.lit(0), lang, F.lit(0), source).alias("origin"), lang.alias("lang"), source.alias("source"), text.alias("text"))
    one = bucketed(rows.repartition(parts, *KEY).dropDuplicates(KEY), "base_version", parts, *KEY)
    return one.select(*KEY, *COLUMNS, F.transform(F.split("text", "\n", -1), lambda x: _leaf(x, F.lit(None).cast("string"))).alias("leaves"))


def branch(base: DataFrame, name: str) -> DataFrame:
    """A branch of base_version(): its rows, columns and lines dropped and changed by code."""
    codes = F.transform("leaves", lambda x, i: _code(name, i.cast("string")))
    edit = lambda v, c: F.when(c == 1, F.concat(v, F.lit("!"))).when(c == 2, F.concat(v, F.lit("?")))
    change = lambda x, c: _leaf(F.when(c == 0, None).otherwise(F.coalesce(edit(x["line"], c), x["line"])), F.when(c == 3, "!").when(c == 4, "?"))
    cell = lambda c: F.when(_code(name, F.lit(c)) == 0, "").otherwise(F.coalesce(edit(F.col(c), _code(name, F.lit(c))), F.col(c)))
    return base.where(_code(name, F.lit("row")) != 0).select(*KEY, *[cell(c).alias(c) for c in COLUMNS], F.zip_with("leaves", codes, change).alias("leaves"))


def added_rows(base: DataFrame, name: str, shift: int) -> DataFrame:
    """The rows that a branch of base_version() adds, under the id `shift` - id. A row without id adds none; rows of one id add one row
    (the least lang and source)."""
    row = _code(name, F.lit("row"))
    rows = base.where((F.col("id") != "") & row.isin(3, 4)).select((F.lit(shift) - F.col("id").cast("long")).cast("string").alias("id"), F.struct(*COLUMNS, F.when(row == 3, "!").otherwise("?").alias("line")).alias("v"))
    one = rows.groupBy("id").agg(F.min("v").alias("v"))
    return one.select("id", F.lit(0).cast("long").alias("origin"), *[F.col("v")[c].alias(c) for c in COLUMNS], F.array(_leaf(F.col("v")["line"], F.lit(None).cast("string"))).alias("leaves"))


def merge_documents(docs: DataFrame) -> DataFrame:
    """The branches L and R of documents merged: doc_id, lang, source, text and the counts of each id ever present (absent rows: nulls).

    The base is shuffled and written once; the branches are derived from its buckets where they lie.
    """
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), blocks_for(text_bytes(docs)))
    base = base_version(docs, parts)
    new = (added_rows(base, "L", -1), added_rows(base, "R", -2))
    done = merge(base, branch(base, "L"), branch(base, "R"), KEY, COLUMNS, new)
    text = F.when(F.col("present"), F.array_join("lines", "\n"))
    return done.select(F.nullif("id", F.lit("")).cast("long").alias("doc_id"), *COLUMNS, text.alias("text"), *COUNTS)


def report(docs: DataFrame) -> DataFrame:
    """merge_documents() with the text's SHA-256 in its place."""
    done = merge_documents(docs)
    return done.select("doc_id", *COLUMNS, F.sha2("text", 256).alias("text_sha256"), *COUNTS)
