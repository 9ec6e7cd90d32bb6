"""Connected components by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _least(edges: DataFrame) -> DataFrame:
    """Each node's least neighbour or itself; counted map-side first, so a hub is no large group."""
    return edges.groupBy(F.col("u").alias("w")).agg(F.least(F.min("v"), F.first("u")).alias("m"))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): the least node of each component, for every node that an edge (u, v) names.

    Each round costs two aggregates and two joins by node; rounds grow with the logarithm of the longest
    chain. The edges are checkpointed between rounds.
    """
    edges = checkpointed(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: larger neighbours move to the least neighbour
        large = both.join(_least(both), F.col("u") == F.col("w")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: smaller neighbours and the node itself move to the least one
        small = large.join(_least(large), F.col("u") == F.col("w"))
        moved = small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = checkpointed(moved.where("u <> v").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
