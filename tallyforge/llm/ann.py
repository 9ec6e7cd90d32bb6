"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are projected by several random rotations, scaled to ranks, shifted, and ordered along a
Hilbert curve. Each ordering is range-partitioned in Spark and cut into blocks of consecutive keys; a
query is compared with its own block and the neighbouring blocks within reach, exactly, in double
precision. The reach grows so that each ordering shows a query the same share of the table at any
size. The best of all orderings are merged and ranked. Every vector is in every ordering; nothing is
capped or dropped.

Equal vectors lie together on the curve: of each distinct vector only the k + 1 smallest ids can be
in an answer, so only those stand for it (a hot vector cannot fill the windows).

Defined cases: vectors that are null, all zero, or hold null or non-finite components take no part, nor do
rows without an id or with another length than the most common one; rows with one id count once;
ties go to the smaller id; fewer candidates than k give them all; empty tables give empty results.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import checkpointed, hash_sample, mix64

ORDERINGS, DIMS, KEY_BITS = 20, 8, 62
#: Rows of a block: BLOCK_ROOT times the square root of the number of vectors, at least LEAST_BLOCK.
BLOCK_ROOT, LEAST_BLOCK = 8, 500
#: The share of all vectors that the blocks within a query's reach hold at least, in each ordering.
LEAST_SHARE = 0.04
SAMPLE = 5000
SPREAD = 0.5
#: Points of the rank scale of an axis: where many vectors lie close together, cells are as much finer.
SCALE = 257


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions along the Hilbert curve of integer points (rows; bits x columns at most 63).

    The public transpose form: fold out the rotations from the top bit down, then Gray-decode and interleave.
    """
    x = cells.astype(np.uint64).T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):
        q, low = np.uint64(1 << b), np.uint64((1 << b) - 1)
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        t ^= np.where((x[n - 1] >> np.uint64(b)) & np.uint64(1), np.uint64((1 << b) - 1), np.uint64(0))
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << np.uint64(1) | x[i] >> np.uint64(b) & np.uint64(1)
    return key


class Curves:
    """Random rotations, shifts and rank scales of all orderings; the scales come from a bounded sample."""

    def __init__(self, sample: np.ndarray, orderings: int = ORDERINGS, seed: int = 11):
        r = np.random.default_rng(seed)
        d = sample.shape[1]
        self.dims = min(DIMS, d)
        self.bits = min(16, KEY_BITS // self.dims)
        self.rot = [np.linalg.qr(r.standard_normal((d, d)))[0][:, : self.dims] for _ in range(orderings)]
        self.scale, self.shift = [], []
        for m in self.rot:
            self.scale.append(np.quantile(sample @ m, np.linspace(0, 1, SCALE), axis=0))
            self.shift.append(r.random(self.dims) * SPREAD)

    def keys(self, x: np.ndarray, i: int) -> np.ndarray:
        p, ranks, top = x @ self.rot[i], np.linspace(0, 1, SCALE), 1 << self.bits
        z = np.stack([np.interp(p[:, j], self.scale[i][:, j], ranks) for j in range(self.dims)], 1)
        z = (z + self.shift[i]) / (1 + SPREAD) * top
        return hilbert_keys(np.clip(z, 0, top - 1).astype(np.uint64), self.bits).astype(np.int64)


def windows(total: int, k: int, block: int | None = None) -> tuple[int, int]:
    """Rows of a block, and how many blocks on either side a query reaches."""
    block = max(2 * k + 2, block or max(LEAST_BLOCK, math.ceil(BLOCK_ROOT * math.sqrt(total))))
    return block, max(1, math.ceil((LEAST_SHARE * total / block - 1) / 2))


def usable(v: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(batch: pa.RecordBatch, col: str = "v") -> np.ndarray:
    flat = batch.column(col).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1).astype(np.float64) if batch.num_rows else np.zeros((0, 1))


def search(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", orderings: int = ORDERINGS, block: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: of each row whose id is divisible by `every`, the k nearest found."""
    schema = "query_id long, rank int, vec_id long, score double"
    spark = vectors.sparkSession
    rows = vectors.where(usable(F.col(vec_col)) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("v") == common["d"])
    # candidates: the smallest ids of each distinct vector, limited before they are shuffled; then the other queries
    ask = F.col("id") % every == 0
    first = rows.withColumn("n", F.row_number().over(W.partitionBy("v").orderBy("id"))).where(F.col("n") <= k + 1).select("id", "v", F.lit(True).alias("cand"), ask.alias("ask"))
    first = checkpointed(first)
    kept = first.unionByName(rows.where(ask).join(first.select("id"), "id", "left_anti").select("id", "v", F.lit(False).alias("cand"), F.lit(True).alias("ask")).dropDuplicates(["id"]))
    total = first.count()
    sample = hash_sample(first, SAMPLE, "id").select("v").collect()
    curves = spark.sparkContext.broadcast(Curves(np.array([r["v"] for r in sample] or [first.first()["v"]], np.float64), orderings))
    block, reach = windows(total, k, block)
    parts = max(1, min(4096, -(-total // (4 * block))))

    def keyed(batches):
        for b in batches:
            x, n = _matrix(b), b.num_rows
            for i in range(orderings):
                tie = mix64(b.column("id").to_numpy().astype(np.uint64) + np.uint64(i * 0x9E3779B97F4A7C15 % 2**64)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, i, np.int32)), pa.array(curves.value.keys(x, i)), pa.array(tie), b.column("id"), b.column("cand"), b.column("ask")], names=["o", "key", "tie", "id", "cand", "ask"])

    # rows of one key lie in another order each time
    keys = kept.mapInArrow(keyed, "o int, key long, tie long, id long, cand boolean, ask boolean")
    # each ordering in range partitions; a row's place is the number of candidates before it, so that queries
    # with one key, however many, stay beside the candidates of that key
    def place(batches):
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), {}
        for b in batches:
            o, cand = b.column("o").to_numpy(), b.column("cand").to_numpy(zero_copy_only=False)
            at = np.zeros(len(o), np.int64)
            for i in np.unique(o):
                own = o == i
                run = np.cumsum(cand[own])
                at[own] = run - cand[own] + before.get(i, 0)
                before[i] = before.get(i, 0) + int(run[-1])
            yield pa.RecordBatch.from_arrays([b.column("o"), pa.array(np.full(len(o), part, np.int32)), pa.array(at), b.column("id"), b.column("cand"), b.column("ask")], names=["o", "p", "m", "id", "cand", "ask"])

    ordered = keys.repartitionByRange(parts * orderings, "o", "key", "tie").sortWithinPartitions("o", "key", F.desc("cand"), "tie")
    ranged = checkpointed(ordered.mapInArrow(place, "o int, p int, m long, id long, cand boolean, ask boolean"))
    sizes = ranged.groupBy(F.col("o").alias("_o"), F.col("p").alias("_p")).agg(F.count_if(F.col("cand")).alias("c"))
    starts = sizes.select("_o", "_p", (F.sum("c").over(W.partitionBy("_o").orderBy("_p")) - F.col("c")).alias("start"))
    placed = ranged.join(starts, (F.col("o") == F.col("_o")) & (F.col("p") == F.col("_p"))).select("o", "id", "cand", "ask", F.floor((F.col("start") + F.col("m")) / block).cast("long").alias("b"))
    # a candidate stays in its block; a query, of which there are fewer, goes to all blocks within reach
    near = F.when(F.col("ask"), F.transform(F.sequence(F.col("b") - reach, F.col("b") + reach), lambda x: F.struct(x.alias("at"), F.lit(True).alias("ask"))))
    own = F.when(F.col("cand"), F.array(F.struct(F.col("b").alias("at"), F.lit(False).alias("ask"))))
    none = F.array().cast("array<struct<at:bigint,ask:boolean>>")
    spread = placed.select("o", "id", F.explode(F.concat(F.coalesce(own, none), F.coalesce(near, none))).alias("x")).select("o", "id", "x.at", "x.ask")
    spread = spread.where(F.col("at") >= 0).join(kept.select("id", "v"), "id")

    def nearest(key, group):
        ids, x = group.column("id").to_numpy(), _matrix(group.combine_chunks().to_batches()[0])
        ask = group.column("ask").to_numpy(zero_copy_only=False)
        q, c = np.nonzero(ask)[0], np.nonzero(~ask)[0]
        out_q, out_c, out_s = [], [], []
        for lo in range(0, len(q), 256):
            s = x[q[lo : lo + 256]] @ x[c].T
            for row, i in zip(s, q[lo : lo + 256]):
                row[ids[c] == ids[i]] = -np.inf
                m = min(k, len(c))
                if not m:
                    continue
                edge = np.partition(row, len(row) - m)[len(row) - m]
                edge -= 1e-12 * max(1.0, abs(edge)) if np.isfinite(edge) else 0.0
                near = np.nonzero((row >= edge) & (row > -np.inf))[0]
                near = near[np.lexsort((ids[c[near]], -row[near]))]
                out_q.append(np.full(len(near), ids[i]))
                out_c.append(ids[c[near]])
                out_s.append(np.einsum("ij,j->i", x[c[near]], x[i]))
        cat = lambda a, t: pa.array(np.concatenate(a).astype(t) if a else np.zeros(0, t))
        return pa.table({"query_id": cat(out_q, np.int64), "vec_id": cat(out_c, np.int64), "score": cat(out_s, np.float64)})

    found = spread.groupBy("o", "at").applyInArrow(nearest, "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int")
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
