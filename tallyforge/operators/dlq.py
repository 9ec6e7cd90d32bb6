"""Accepted and rejected events, the dead-letter table, and its replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.text import payload_hash
from .merge import delete_keys, insert_new, new_rows

PAYLOAD = [f.name for f in S.DLQ.fields[:6]]


def _sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def is_reversal_word(status: Column) -> Column:
    return F.upper(F.trim(status)).isin(S.REVERSAL_WORDS)


def forward() -> Column:
    """A decodable payment."""
    return _sure(F.col("decodable") & (F.col("amount_paise") > 0) & F.col("transaction_id").isNotNull())


def reversal() -> Column:
    """A decodable movement back: no positive amount, and the gateway says so."""
    return _sure(F.col("decodable") & F.col("transaction_id").isNotNull() & (F.col("amount_paise") <= 0) & is_reversal_word(F.col("gateway_status")))


def accepted() -> Column:
    return forward() | reversal()


def ingest_status() -> Column:
    return F.when(F.col("amount_paise") <= 0, S.REVERSAL).otherwise(S.PENDING)


def dead_letters(rejected: DataFrame) -> DataFrame:
    """Rejected events as dead-letter rows, one for each payload."""
    rows = rejected.select(*PAYLOAD, payload_hash(*(F.col(c) for c in PAYLOAD)).alias("payload_hash"))
    return rows.dropDuplicates(["payload_hash"])


def append(dlq: DataFrame, rejected: DataFrame) -> DataFrame:
    return insert_new(dlq, dead_letters(rejected), "payload_hash")


def replayable() -> Column:
    """A null gateway status with no positive amount is not replayed."""
    return _sure(F.col("transaction_id").isNotNull() & ((F.col("amount_paise") > 0) | ~is_reversal_word(F.col("gateway_status"))))


def stranded() -> Column:
    return _sure(F.col("transaction_id").isNotNull() & (F.col("amount_paise") <= 0) & is_reversal_word(F.col("gateway_status")))


def replay_rows(ledger: DataFrame, dlq: DataFrame, now: str) -> DataFrame:
    """The replayable rows that the ledger lacks, pending and without currency; one row for each transaction."""
    rows = dlq.where(replayable()).select(*PAYLOAD, F.lit(S.PENDING).alias("reconciliation_status"), F.lit(now).cast("timestamp").alias("ingested_at"))
    return new_rows(ledger, rows, "transaction_id")


def replay(ledger: DataFrame, dlq: DataFrame, now: str) -> DataFrame:
    """The ledger with replay_rows()."""
    return ledger.unionByName(replay_rows(ledger, dlq, now), allowMissingColumns=True).select(*ledger.columns)


def replay_counts(ledger: DataFrame, dlq: DataFrame) -> DataFrame:
    """One row: replayable rows, those already in the ledger, stranded reversals."""
    present = ledger.select(F.col("transaction_id").alias("_id"), F.lit(1).alias("_here"))
    return dlq.join(present, F.col("transaction_id") == F.col("_id"), "left").agg(F.count_if(replayable()).alias("replayable"), F.count_if(replayable() & F.col("_here").isNotNull()).alias("already"), F.count_if(stranded()).alias("stranded"))


def replayed(dlq: DataFrame) -> DataFrame:
    """The dead letters that a replay takes out: all of a transaction that has a replayable one."""
    return dlq.join(dlq.where(replayable()).select("transaction_id").distinct(), "transaction_id", "left_semi").select(*dlq.columns)


def purge(dlq: DataFrame) -> DataFrame:
    """The dead letters that a replay leaves behind."""
    return delete_keys(dlq, dlq.where(replayable()), "transaction_id")
