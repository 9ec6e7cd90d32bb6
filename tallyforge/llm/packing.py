"""Packing into optimal length buckets.

The histogram of all lengths (a bounded number of bins, each with its count, sum and largest length)
goes to the driver; dynamic programming finds the bucket boundaries with the least total padding.
Inside each bucket, documents are numbered and cut into batches that a token budget fills.

Defined cases: null and empty texts have length 0 and are packed like any other; ties of length are
ordered by doc_id; repeated rows take a slot each; an empty table gives an empty result; a document
longer than the budget fills a batch alone.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed

BUCKETS = 16
TOKEN_BUDGET = 65_536
#: Bins of an octave of lengths: lengths up to twice this have bins of their own.
PER_OCTAVE = 128
#: Documents that one numbering task should hold.
PER_SALT = 200_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def bin_of(length: Column) -> Column:
    """The histogram bin of a length: the length itself, or its leading bits."""
    shift = F.greatest(F.floor(F.log2(F.greatest(length, F.lit(1)).cast("double"))) - F.lit(PER_OCTAVE.bit_length() - 1), F.lit(0))
    step = F.pow(F.lit(2.0), shift)
    return (F.ceil(length / step) * step).cast("long")


def best_boundaries(top: np.ndarray, count: np.ndarray, total: np.ndarray, k: int) -> list[int]:
    """Boundaries of at most k buckets over bins (ascending) with the least padding: sum of boundary - length.

    top, count, total: the largest length, the number and the sum of lengths of each bin.
    """
    n = len(top)
    c, s = np.concatenate([[0], np.cumsum(count)]), np.concatenate([[0], np.cumsum(total)])
    best = np.full(n + 1, np.inf)
    best[0] = 0
    cuts = []
    for _ in range(min(k, n)):
        nxt, cut = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        for j in range(1, n + 1):
            cost = best[:j] + float(top[j - 1]) * (c[j] - c[:j]) - (s[j] - s[:j])
            cut[j] = int(np.argmin(cost))
            nxt[j] = cost[cut[j]]
        nxt[0] = 0
        cuts.append(cut)
        best = nxt
    out, j = [], n
    for cut in reversed(cuts):
        if j == 0:
            break
        out.append(int(top[j - 1]))
        j = int(cut[j])
    return sorted(set(out))


def pack_lengths(lengths: DataFrame, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET) -> DataFrame:
    """(doc_id, n_tokens) with bucket, bucket_len, batch and slot. lengths is read twice."""
    hist = lengths.groupBy(bin_of(F.col("n_tokens")).alias("bin")).agg(F.max("n_tokens").alias("top"), F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("s")).orderBy("bin").collect()
    schema = T.StructType([*lengths.select("doc_id", "n_tokens").schema.fields, T.StructField("bucket", T.IntegerType()), T.StructField("bucket_len", T.LongType()), T.StructField("batch", T.LongType()), T.StructField("slot", T.LongType())])
    if not hist:
        return lengths.sparkSession.createDataFrame([], schema)
    ends = best_boundaries(*(np.array([r[f] for r in hist], np.int64) for f in ("top", "n", "s")), buckets)
    rows = sum(r["n"] for r in hist)
    bucket, fits = F.lit(len(ends) - 1), F.lit(max(1, budget // max(1, ends[-1])))
    for i in range(len(ends) - 2, -1, -1):
        bucket = F.when(F.col("n_tokens") <= ends[i], i).otherwise(bucket)
        fits = F.when(F.col("n_tokens") <= ends[i], max(1, budget // max(1, ends[i]))).otherwise(fits)
    length_of = F.element_at(F.array(*(F.lit(e).cast("long") for e in ends)), F.col("bucket") + 1)
    # numbers inside a bucket: row numbers inside salted parts, moved by the sizes of the parts before
    salts = max(1, -(-rows // PER_SALT))
    salted = lengths.select("doc_id", "n_tokens", bucket.cast("int").alias("bucket"), fits.cast("long").alias("_fits"), F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("_salt"))
    sizes = salted.groupBy("bucket", "_salt").count().withColumnsRenamed({"bucket": "_b", "_salt": "_s"})
    from pyspark.sql import Window as W

    before = sizes.select("_b", "_s", (F.sum("count").over(W.partitionBy("_b").orderBy("_s")) - F.col("count")).alias("_before"))
    within = F.row_number().over(W.partitionBy("bucket", "_salt").orderBy("n_tokens", "doc_id")) - 1
    numbered = salted.withColumn("_n", within).join(before, (F.col("bucket") == F.col("_b")) & (F.col("_salt") == F.col("_s")))
    at = F.col("_n") + F.col("_before")
    return numbered.select("doc_id", "n_tokens", "bucket", length_of.alias("bucket_len"), F.floor(at / F.col("_fits")).cast("long").alias("batch"), (at % F.col("_fits")).cast("long").alias("slot"))


def pack(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS, budget: int = TOKEN_BUDGET) -> DataFrame:
    """The bucket, batch and slot of each document, with words as tokens."""
    return pack_lengths(checkpointed(docs.select("doc_id", word_count(F.col(text_col)).alias("n_tokens"))), buckets, budget)
