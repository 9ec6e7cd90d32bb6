"""Event-time windows with state: tumbling and session windows under a watermark, in append mode, and a run over deliveries.

A window is emitted once, when the watermark has passed its end; rows that come for it later are dropped by the state operator.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def tumbling(events: DataFrame, time: str, every: str, delay: str, by: list[str], aggs: list[Column]) -> DataFrame:
    """start, end, by..., aggs of each window; rows without a time belong to none."""
    timed = events.where(F.col(time).isNotNull()).withWatermark(time, delay)
    return timed.groupBy(F.window(time, every).alias("w"), *by).agg(*aggs).select("w.start", "w.end", *by, *[F.col(_name(a)) for a in aggs])


def sessions(events: DataFrame, time: str, gap: str, delay: str, by: list[str], aggs: list[Column]) -> DataFrame:
    """start, end, by..., aggs of each session: rows of one `by` with pauses of no more than gap; end is gap after the last row."""
    timed = events.where(F.col(time).isNotNull()).withWatermark(time, delay)
    return timed.groupBy(F.session_window(time, gap).alias("w"), *by).agg(*aggs).select("w.start", "w.end", *by, *[F.col(_name(a)) for a in aggs])


def _name(c: Column) -> str:
    """The alias of an aggregate."""
    return c._jc.toString().rsplit(" AS ", 1)[1].strip("`")


def append(windows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Finished windows appended to Parquet files."""
    return windows.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


@dataclass
class Run:
    """What a run over deliveries has left: the windows, and the rows that it was given, that had no time and that came too late."""

    windows: DataFrame
    given: int
    untimed: int
    late: int


def over_deliveries(deliveries: Iterable[DataFrame], shape, root: str, time: str, count: str = "n", close_after: str = "400 days") -> Run:
    """Deliver rows one lot after the other to a stream that is stopped and started on one checkpoint each time.

    shape makes the windows of a streaming frame; its column `count` counts rows. At the end a row without anything but a time far ahead closes
    the windows that are still open; its own window is never emitted. Late rows are those given that no window has counted.
    """
    spark, schema, given, untimed, last = None, None, 0, 0, None
    folder, out, checkpoint = f"{root}/in", f"{root}/out", f"{root}/checkpoint"

    def deliver(rows: DataFrame) -> None:
        rows.write.mode("append").parquet(folder)
        append(shape(spark.readStream.schema(schema).parquet(folder)), out, checkpoint).awaitTermination()

    for rows in deliveries:
        spark, schema = rows.sparkSession, rows.schema
        n, no_time, latest = rows.agg(F.count(F.lit(1)), F.count_if(F.col(time).isNull()), F.max(time)).first()
        given, untimed = given + n, untimed + no_time
        last = latest if last is None or (latest is not None and latest > last) else last
        if n:
            deliver(rows)
    if spark is None:
        raise ValueError("no deliveries")
    if last is not None:
        ahead = spark.range(1).select(*[(F.lit(last).cast(f.dataType) + F.expr(f"INTERVAL {close_after}") if f.name == time else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
        deliver(ahead)
    windows = spark.read.parquet(out) if last is not None else shape(spark.createDataFrame([], schema))
    counted = windows.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    return Run(windows, given, untimed, given - untimed - counted)
