"""Keyed merges on immutable tables: ordered update arms, an insert arm, deletes.

A merge is one outer join by key and one chain of conditions. merge() gives the whole table, changes() only the rows
that the merge touches, for a store that keeps changes as deltas. In conditions and values, t.x and s.x name the columns of both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class CardinalityError(ValueError):
    """Two source rows would change one target row."""


@dataclass
class Arm:
    """When `when` holds (null: no) for a matched row, set the columns; t.x and s.x name both sides. delete drops the row."""

    when: Column
    set: dict[str, Column] | None = None
    delete: bool = False


def check_unique(source: DataFrame, key: str) -> None:
    """Refuse a source with two rows of one key."""
    if source.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").limit(1).count():
        raise CardinalityError(f"several source rows have one {key}")


def _joined(target: DataFrame, source: DataFrame, key: str, arms: list[Arm], insert: dict[str, Column] | None, check: bool, prepare: Callable[[DataFrame], DataFrame] | None, how: str) -> DataFrame:
    """Columns t and s (structs, null where a side has no row) and _arm: an arm's number, -1 untouched, -2 new."""
    if check:
        check_unique(source, key)
    t = target.select(F.struct(*[F.col(f"`{c}`") for c in target.columns]).alias("t"), F.col(key).alias("_tk"))
    s = source.select(F.struct(*[F.col(f"`{c}`") for c in source.columns]).alias("s"), F.col(key).alias("_sk"))
    joined = t.join(s, F.col("_tk") == F.col("_sk"), how)
    if prepare:
        joined = prepare(joined)
    in_t, in_s = F.col("t").isNotNull(), F.col("s").isNotNull()
    arm = F.lit(-1)
    for i in range(len(arms) - 1, -1, -1):
        arm = F.when(F.coalesce(arms[i].when, F.lit(False)), i).otherwise(arm)
    return joined.withColumn("_arm", F.when(in_t & in_s, arm).when(in_t, -1).otherwise(-2 if insert is not None else -1))


def _values(target: DataFrame, arms: list[Arm], insert: dict[str, Column] | None) -> list[Column]:
    out = []
    for f in target.schema.fields:
        value = F.col(f"t.`{f.name}`")
        for i, a in enumerate(arms):
            if a.set and f.name in a.set:
                value = F.when(F.col("_arm") == i, a.set[f.name].cast(f.dataType)).otherwise(value)
        if insert is not None:
            value = F.when(F.col("_arm") == -2, insert.get(f.name, F.lit(None)).cast(f.dataType)).otherwise(value)
        out.append(value.alias(f.name))
    return out


def merge(target: DataFrame, source: DataFrame, key: str, arms: list[Arm], insert: dict[str, Column] | None = None, check: bool = False, prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The target after the merge: first arm wins, unmatched target rows stay as they are, unmatched source rows are inserted.

    check counts source keys first, as one more job; leave it off for sources that are unique by construction. prepare may add
    columns to the joined rows (t and s are structs) for the arms to use.
    """
    joined = _joined(target, source, key, arms, insert, check, prepare, "full_outer" if insert is not None else "left")
    gone = [i for i, a in enumerate(arms) if a.delete]
    if gone:
        joined = joined.where(~F.col("_arm").isin(gone))
    return joined.select(*_values(target, arms, insert))


def changes(target: DataFrame, source: DataFrame, key: str, arms: list[Arm], insert: dict[str, Column] | None = None, check: bool = False, prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The rows that merge() would change, insert or delete: the target's columns as they become, and _deleted."""
    joined = _joined(target, source, key, arms, insert, check, prepare, "right_outer" if insert is not None else "inner").where("_arm <> -1")
    gone = [i for i, a in enumerate(arms) if a.delete]
    return joined.select(*_values(target, arms, insert), F.col("_arm").isin(gone).alias("_deleted") if gone else F.lit(False).alias("_deleted"))


def delete_keys(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The target without the rows whose key is in keys."""
    return target.join(keys.select(key).distinct(), key, "left_anti").select(*target.columns)


def insert_new(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The target with the source rows whose key it lacks, one for each key; missing columns are null."""
    return target.unionByName(new_rows(target, source, key), allowMissingColumns=True).select(*target.columns)


def new_rows(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The source rows whose key the target lacks, one for each key."""
    once = source.groupBy(key).agg(F.min(F.struct(*(c for c in source.columns if c != key))).alias("r")).select(key, "r.*")
    return once.join(target.select(key), key, "left_anti")
