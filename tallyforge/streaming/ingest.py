"""Streaming ingest of gateway events into the ledger and the dead-letter table."""

from __future__ import annotations

import logging
import re
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from .. import schemas as S
from ..functions.dates import event_time
from ..functions.text import has_pan, payload_hash
from ..operators import dlq as D
from ..operators.ledger_store import LedgerStore, Version
from ..operators.merge import Arm, changes, merge, new_rows
from ..sources.wire import decode

log = logging.getLogger(__name__)
DELAY = re.compile(r"^\d+ (second|minute|hour|day)s?$")


class PermanentError(RuntimeError):
    """A failure that a retry cannot mend."""


@dataclass
class Settings:
    """What a stream needs to know. now is text, so that a run can be repeated exactly."""

    late_after: str = "1 day"
    expected_schema: str | None = None
    now: str | None = None
    refuse_pan: bool = True


def events(frames: DataFrame, delay: str = "1 day") -> DataFrame:
    """Decoded events with their time and watermark."""
    if not DELAY.match(delay):
        raise ValueError(f"not a delay: {delay!r}")
    out = decode(frames).withColumn("event_time", event_time(F.col("timestamp_utc")))
    return out.withWatermark("event_time", delay) if frames.isStreaming else out


def dedup_within_watermark(stream: DataFrame) -> DataFrame:
    """An addition: redeliveries dropped by stream state before they reach a batch."""
    return stream.dropDuplicatesWithinWatermark(["transaction_id"])


def gauges(batch: DataFrame, s: Settings) -> dict:
    """All counts of a batch in one pass."""
    now = F.lit(s.now).cast("timestamp") if s.now else F.current_timestamp()
    late = event_time(F.col("timestamp_utc")) < now - F.expr(f"INTERVAL {s.late_after}")
    text = [F.col(c) for c in ("transaction_id", "gateway_status", "merchant_id", "processing_run_id")]
    row = batch.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(late).alias("late"),
        F.count_if(F.col("timestamp_utc").isNotNull() & event_time(F.col("timestamp_utc")).isNull()).alias("unreadable_time"),
        F.count_if(has_pan(*text)).alias("pan"), F.count_if(D.reversal()).alias("reversals"), F.count_if(~D.accepted()).alias("rejected"),
        F.collect_set("schema_id").alias("schema_ids"),
    ).first()
    return row.asDict()


def check(g: dict, s: Settings) -> None:
    """Schema drift and card numbers stop the stream for good; late and unreadable times are only counted."""
    if s.expected_schema is not None and set(g["schema_ids"]) - {s.expected_schema}:
        raise PermanentError(f"events of schemas {sorted(g['schema_ids'])}, expected {s.expected_schema}")
    if s.refuse_pan and g["pan"]:
        raise PermanentError(f"{g['pan']} events hold card numbers")


def newest(batch: DataFrame) -> DataFrame:
    """One accepted event for each transaction: the newest, then the smallest payload hash."""
    rank = F.row_number().over(W.partitionBy("transaction_id").orderBy(F.desc_nulls_last(event_time(F.col("timestamp_utc"))), payload_hash(*(F.col(c) for c in D.PAYLOAD))))
    return batch.where(D.accepted()).withColumn("_n", rank).where("_n = 1").drop("_n")


def _upsert_plan(batch: DataFrame, now: str) -> tuple[DataFrame, str, list[Arm], dict]:
    t, s, at = (lambda c: F.col(f"t.{c}")), (lambda c: F.col(f"s.{c}")), F.lit(now).cast("timestamp")
    fields = ["amount_paise", "gateway_status", "timestamp_utc", "merchant_id", "processing_run_id"]
    waiting = t("reconciliation_status").isin(S.UNRESOLVED)
    refresh = {c: s(c) for c in fields} | {"reconciliation_status": F.lit(S.PENDING), "ingested_at": at}
    again = {"duplicate_mutation_count": F.coalesce(t("duplicate_mutation_count"), F.lit(0)) + 1, "last_duplicate_at": at}
    insert = {c: s(c) for c in ["transaction_id", *fields, "currency"]} | {"reconciliation_status": F.when(s("amount_paise") <= 0, S.REVERSAL).otherwise(S.PENDING), "ingested_at": at, "duplicate_mutation_count": F.lit(0)}
    return batch, "transaction_id", [Arm(waiting, refresh), Arm(~F.coalesce(waiting, F.lit(False)), again)], insert


def upsert(ledger: DataFrame, batch: DataFrame, now: str, check: bool = False) -> DataFrame:
    """The ledger after a batch of unique events: waiting rows are refreshed, finished ones count a duplicate, new ones are inserted."""
    return merge(ledger, *_upsert_plan(batch, now), check)


def upsert_changes(ledger: DataFrame, batch: DataFrame, now: str, check: bool = False) -> DataFrame:
    """Only the rows that upsert() changes or inserts; `ledger` need hold no other rows than the batch's."""
    return changes(ledger, *_upsert_plan(batch, now), check)


def create_tables(store: LedgerStore, ledger: str = "webhooks", dlq: str = "webhooks_dlq") -> None:
    store.create(ledger, S.LEDGER, key="transaction_id")
    store.create(dlq, S.DLQ, key="payload_hash")


def write_batch(store: LedgerStore, s: Settings, ledger: str = "webhooks", dlq: str = "webhooks_dlq", stream: str = "default") -> Callable[[DataFrame, int], None]:
    """The sink of one micro-batch of a stream, named by its checkpoint.

    The number of the last batch of each stream is noted in the same commit as its rows: a batch that was applied before a failure is
    not applied again, and a new checkpoint or another stream starts its own count. Two streams may write at once: the one that
    comes second reads again and repeats. Only the buckets of the batch's keys are read, only the batch's rows are written.
    Dead letters are written first; they are unique by content, so a repetition adds none.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        create_tables(store, ledger, dlq)
        if batch_id <= store.note(ledger).get(stream, -1):
            return
        batch.persist()
        try:
            g = gauges(batch, s)
            check(g, s)
            log.info("batch %s: %s", batch_id, {k: v for k, v in g.items() if k != "schema_ids"})
            now = s.now or time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime())
            if g["rejected"]:
                letters = D.dead_letters(batch.where(~D.accepted()))
                store.transact(dlq, lambda v: v.apply(new_rows(v.of_keys(letters), letters, "payload_hash")))
            if g["rejected"] < g["rows"]:
                once = newest(batch)

                def apply(v: Version) -> None:
                    if batch_id > v.notes.get(stream, -1):  # else a twin of this stream has applied it meanwhile
                        v.apply(upsert_changes(v.of_keys(once), once, now), notes={stream: batch_id})

                store.transact(ledger, apply)
        finally:
            batch.unpersist()

    return run


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The name of the stream that a checkpoint folder belongs to, kept in it; a renewed folder has a new one."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/tallyforge-stream")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        made = fs.create(path, False)
        made.write(bytearray(uuid.uuid4().hex.encode()))
        made.close()
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def start(frames: DataFrame, store: LedgerStore, checkpoint: str, s: Settings | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Start the stream: event frames to ledger and dead letters. Batch size is limited at the source."""
    s = s or Settings()
    sink = write_batch(store, s, stream=stream_name(frames.sparkSession, checkpoint))
    return events(frames).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "60 seconds"})).start()


def append_stream(frames: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Decodable events appended as they are, without upserts."""
    return events(frames).where(D.forward()).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def supervise(run: Callable[[], None], most: int = 5, sleep: Callable[[float], None] = time.sleep) -> None:
    """Run until it ends well; at most `most` failures with growing pauses; a permanent failure at once."""
    failures = 0
    while True:
        try:
            return run()
        except PermanentError:
            raise
        except Exception as e:
            if isinstance(getattr(e, "cause", None), PermanentError) or "PermanentError" in str(e):
                raise PermanentError(str(e)) from e
            failures += 1
            if failures >= most:
                raise
            sleep(min(5 * 2**failures, 300))


class Progress(StreamingQueryListener):
    """Logs the rows and duration of each batch."""

    def onQueryStarted(self, event):  # noqa: N802
        log.info("stream %s started", event.id)

    def onQueryProgress(self, event):  # noqa: N802
        log.info("batch %s: %s rows in %s ms", event.progress.batchId, event.progress.numInputRows, event.progress.batchDuration)

    def onQueryTerminated(self, event):  # noqa: N802
        log.info("stream %s ended: %s", event.id, event.exception)
