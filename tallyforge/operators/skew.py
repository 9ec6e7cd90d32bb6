"""Looking rows up in a keyed set when one key may hold a third of the rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than one in HEAVY of all rows is heavy; there are fewer than HEAVY such keys, whatever the input.
HEAVY = 2000


def flag_rows(rows: DataFrame, key: list[str], pick: Callable[[DataFrame], DataFrame], flag: str, spread: str) -> DataFrame:
    """rows with a boolean `flag`: whether pick() keeps the row's key.

    pick is given each distinct key once (key columns, no nulls, and `_n`, the key's rows) and returns those that hold, with
    the same columns. Rows whose key has a null are not flagged. Heavy keys, of which there are a bounded number, are broadcast;
    their rows are dealt by the column `spread` instead of the key, so that no task gets a heavy key's rows.
    """
    known = rows
    for c in key:
        known = known.where(F.col(c).isNotNull())
    points = known.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    total = points.agg(F.sum("_n").alias("_total"))
    names = [f"_k{i}" for i in range(len(key))]
    renamed = [F.col(c).alias(n) for c, n in zip(key, names)]
    holds = pick(points).select(*key, "_n")
    # only the few heavy keys are joined with what holds; each key's count comes along with it
    many = lambda keys: keys.join(F.broadcast(total)).where(F.col("_n") * HEAVY > F.col("_total"))
    heavy = many(points).select(*renamed).join(F.broadcast(many(holds).select(*renamed, F.lit(True).alias("_holds"))), names, "left").select(*names, F.coalesce("_holds", F.lit(False)).alias("_heavy"))
    light = holds.select(*renamed, F.lit(True).alias("_light"), F.lit(0).cast("long").alias("_part"))
    met = lambda n: [F.col(c) == F.col(k) for c, k in zip(key, n)]
    both = lambda conditions: conditions[0] if len(conditions) == 1 else conditions[0] & both(conditions[1:])
    out = rows.join(F.broadcast(heavy), both(met(names)), "left").drop(*names)
    away = F.col("_heavy").isNotNull()
    for c in key:
        away = away | F.col(c).isNull()
    # rows that need no look-up are dealt by `spread`: their key is one that no light key has
    deal = F.when(away, F.xxhash64(spread).bitwiseOR(F.lit(1))).otherwise(F.lit(0).cast("long"))
    out = out.withColumn("_deal", deal)
    on = F.col("_deal") == F.col("_part")
    for i, n in enumerate(names):
        on = on & F.col(key[i]).eqNullSafe(F.col(n))
    out = out.join(light, on, "left")
    return out.withColumn(flag, F.coalesce("_heavy", "_light", F.lit(False))).select(*rows.columns, flag)
