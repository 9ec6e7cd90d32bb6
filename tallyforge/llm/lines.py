"""Line dedup by levelled sorted runs of line hashes; DataFrame functions only.

A line's key is the line without white space at its ends, A-Z lower-cased; its hash has 128 bits. Batches of
documents come in falling order of doc_id. Each batch is merge-joined with the runs: keys that no run holds
are the batch's own run (their first holder is the largest doc_id of all), keys that a run holds are noted
beside it with the holder. Runs are bucketed and sorted by hash, so that a batch moves to the runs and the
runs never move; a level of `fan` runs is compacted into one run of the next level.

Defined results: a text that is null or empty is one empty line. A row without doc_id counts as no document, and
its lines go where a key is common. Rows that repeat a doc_id count as one document; each gives a row of its own.
No documents, no rows. Other columns, whatever their names, are carried along by dedup() untouched.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, ensure_checkpoint_dir
from .sqlkit import SPACE_CHARS

#: Fixed values of the contract: ASCII letters.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A key with more than one in HOT of all lines is looked up by broadcast; there are fewer than HOT such keys.
HOT = 4000
KEY = ["h", "g"]


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE_CHARS)), UPPER, LOWER)


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, least_chars: int = 20) -> DataFrame:
    """(doc, row, pos, h, g): a row for each line whose key has least_chars code points or more; row tells rows of one doc_id apart."""
    each = docs.select(F.col("doc_id").alias("doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"), F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    keyed = each.select("doc", "row", "pos", line_key(F.col("line")).alias("k")).where(F.char_length("k") >= least_chars)
    return keyed.select("doc", "row", "pos", F.xxhash64("k").alias("h"), F.xxhash64(F.lit(7), "k").alias("g"))


class LineRuns:
    """Levels of sorted runs below the shared checkpoint folder; levels[i] lists the tables of level i, oldest first.

    A table holds the keys (h, g) of a batch with holder (the largest doc_id), docs (how many hold it) and n (lines);
    for a key that an older run holds, held_by and held_docs repeat that run's holder and docs, and the row is no part of the run.
    """

    def __init__(self, spark: SparkSession, buckets: int, fan: int = 2):
        ensure_checkpoint_dir(spark)
        self.spark, self.buckets, self.fan = spark, buckets, fan
        self.levels: list[list[str]] = [[]]
        self.again: list[str] = []  # the tables that rows with held_by are read from
        self.name = f"line_runs_{uuid.uuid4().hex}"
        self.folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{self.name}"
        self.made: list[str] = []

    def _write(self, rows: DataFrame) -> str:
        name = f"{self.name}_{len(self.made)}"
        self.made.append(name)
        rows.write.format("parquet").option("path", f"{self.folder}/{name}").bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(name)
        return name

    def run(self, name: str) -> DataFrame:
        """The keys that a table adds to what older runs hold."""
        return self.spark.table(name).where("held_docs IS NULL").select(*KEY, "holder", "docs", "n")

    def names(self) -> list[str]:
        return [x for level in self.levels for x in level]

    def compact(self) -> None:
        """Merge each full level into one run of the next; runs share no key, so nothing is summed."""
        for i, level in enumerate(self.levels):
            if len(level) >= self.fan:
                if i + 1 == len(self.levels):
                    self.levels.append([])
                merged = reduce(DataFrame.unionByName, [self.run(x) for x in level]).repartition(self.buckets, *KEY)
                empty = self.spark.table(level[0]).schema["holder"].dataType
                self.levels[i + 1].append(self._write(merged.withColumns({"held_by": F.lit(None).cast(empty), "held_docs": F.lit(None).cast("long")})))
                self.levels[i] = []

    def add(self, lines: DataFrame) -> DataFrame:
        """Merge-anti-join a batch's lines with the runs, write what they lack as the batch's own run, return that run.

        Batches are to come in falling order of doc; a doc is in one batch.
        """
        self.compact()
        marked = lines.groupBy(*KEY).agg(F.max("doc").alias("holder"), F.count_distinct("doc").alias("docs"), F.count(F.lit(1)).alias("n"))
        held = []
        for i, name in enumerate(self.names()):
            run = self.run(name).select(*KEY, F.col("holder").alias(f"holder{i}"), F.col("docs").alias(f"docs{i}"))
            marked = marked.join(run, KEY, "left")
            held.append(i)
        found = lambda c: F.coalesce(*[F.col(f"{c}{i}") for i in held]) if held else F.lit(None).cast(marked.schema[c].dataType)
        name = self._write(marked.select(*KEY, "holder", "docs", "n", found("holder").alias("held_by"), found("docs").alias("held_docs")))
        self.levels[0].append(name)
        self.again.append(name)
        return self.run(name)

    def common(self, least: int) -> DataFrame:
        """(h, g, holder, n): the keys of at least `least` documents with the largest doc that holds them and their lines."""
        parts = [self.run(x) for x in self.names()]
        parts += [self.spark.table(x).where("held_docs IS NOT NULL").select(*KEY, F.lit(None).cast(parts[0].schema["holder"].dataType).alias("holder"), "docs", "n") for x in self.again]
        return reduce(DataFrame.unionByName, parts).groupBy(*KEY).agg(F.max("holder").alias("holder"), F.sum("docs").alias("docs"), F.sum("n").alias("n")).where(F.col("docs") >= least).drop("docs")

    def close(self) -> None:
        """Forget the tables; their files stay in the shared folder."""
        for name in self.made:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def dropped_lines(docs: DataFrame, least: int = 3, least_chars: int = 20, batches: int = 4, fan: int = 2) -> DataFrame:
    """(doc, row, gone): the positions of the lines that go, for each row that loses any.

    The table is read once for its line hashes, which are stored by batch: `batches` ranges of doc_id of about equal
    size, largest first.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    cuts = docs.select(F.percentile_approx("doc_id", F.array(*[F.lit(i / batches) for i in range(1, batches)]), 10000)).first()[0] or []
    batch = reduce(lambda a, c: a + F.when(F.col("doc") > c, 0).otherwise(1), cuts, F.lit(0))
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/line-hashes-{uuid.uuid4().hex}"
    line_hashes(docs, least_chars).withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    schema = f"doc {docs.schema['doc_id'].dataType.simpleString()}, row long, pos int, h long, g long, batch int"
    lines = spark.read.schema(schema).parquet(path)
    runs = LineRuns(spark, int(spark.conf.get("spark.sql.shuffle.partitions")), fan)
    for i in range(batches):
        runs.add(lines.where(F.col("batch") == i))
    common = checkpointed(runs.common(least))
    runs.close()
    hot = common.where(F.col("n") * HOT > lines.count()).drop("n")
    cold = common.join(F.broadcast(hot.select(*KEY)), KEY, "left_anti").drop("n")
    of_hot = lines.join(F.broadcast(hot), KEY)
    of_cold = lines.join(F.broadcast(hot.select(*KEY)), KEY, "left_anti").join(cold, KEY)
    return of_hot.unionByName(of_cold).where(~F.col("doc").eqNullSafe(F.col("holder"))).groupBy("doc", "row").agg(F.collect_set("pos").alias("gone"))


def dedup(docs: DataFrame, least: int = 3, least_chars: int = 20, batches: int = 4, fan: int = 2) -> DataFrame:
    """docs, whose texts lose each line with a key of least_chars code points or more that at least `least` documents hold, except in
    the largest doc_id that holds it. n_lines (before) and n_dropped are put after the columns of docs, with underscores before a taken name."""
    names = list(docs.columns)
    free = lambda x: x if x not in names else free("_" + x)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("whole"), "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"))
    gone = dropped_lines(docs.select("doc_id", "text"), least, least_chars, batches, fan)
    met = whole.join(gone, F.col("doc_id").eqNullSafe(F.col("doc")) & (whole["row"] == gone["row"]), "left").select("whole", "gone")
    lines = met.select("whole", "gone", split_lines(F.col("whole.text")).alias("lines"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("whole.text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get(F.col("lines"), i)), "\n"))
    return lines.select(
        *[(kept if c == "text" else F.col(f"whole.`{c}`")).alias(c) for c in names],
        F.size("lines").cast("long").alias(free("n_lines")),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias(free("n_dropped")),
    )


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of each row."""
    done = dedup(docs.select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
