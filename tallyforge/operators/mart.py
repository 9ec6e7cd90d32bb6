"""The reporting mart and its eleven questions. Ledger columns in, result rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.dates import event_time
from ..functions.money import pct2, rupees


def fact_reconciliation(ledger: DataFrame) -> DataFrame:
    return ledger.select(
        "transaction_id", "amount_paise", "merchant_id", "instrument_type", "gateway_status", F.col("reconciliation_status").alias("status"), "bank_ref_id",
        event_time(F.col("timestamp_utc")).alias("transacted_at"), F.when(F.col("reconciliation_status") == S.MATCHED, F.col("amount_paise")).alias("matched_amount_paise"),
    )


_n = lambda: F.count(F.lit(1))


def _is(status: str) -> Column:
    return F.col("reconciliation_status") == status


def _day() -> Column:
    return F.to_date(event_time(F.col("timestamp_utc")))


def kpi_match_rate(ledger: DataFrame) -> DataFrame:
    return ledger.agg(pct2(F.count_if(_is(S.MATCHED)), _n()).alias("match_rate_pct"))


def kpi_volume_rupees(ledger: DataFrame) -> DataFrame:
    return ledger.agg(rupees(F.sum("amount_paise")).alias("volume_rupees"))


def kpi_at_risk_rupees(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("reconciliation_status") != S.MATCHED).agg(rupees(F.sum("amount_paise")).alias("at_risk_rupees"))


def dlq_depth(dlq: DataFrame) -> DataFrame:
    return dlq.agg(_n().alias("dlq_rows"))


def match_rate(ledger: DataFrame) -> DataFrame:
    """Counts by status and their share; the window runs over the few grouped rows."""
    by = ledger.groupBy(F.col("reconciliation_status").alias("status")).agg(_n().alias("n"))
    return by.withColumn("pct", pct2(F.col("n"), F.sum("n").over(W.partitionBy()))).orderBy(F.desc("n"), "status")


def daily_match_rate(ledger: DataFrame) -> DataFrame:
    by = ledger.groupBy(_day().alias("day")).agg(_n().alias("total"), F.count_if(_is(S.MATCHED)).alias("matched"))
    return by.withColumn("match_rate_pct", pct2(F.col("matched"), F.col("total"))).orderBy("day")


def daily_trend(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy(_day().alias("day"), F.col("reconciliation_status").alias("status")).agg(_n().alias("n")).orderBy("day", "status")


def volume_by_instrument(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("instrument_type").isNotNull()).groupBy("instrument_type").agg(_n().alias("n"), rupees(F.sum("amount_paise")).alias("volume_rupees")).orderBy(F.desc("volume_rupees"), "instrument_type")


def mismatch_by_instrument(ledger: DataFrame) -> DataFrame:
    rows = ledger.where(_is(S.FEE_MISMATCH) & F.col("instrument_type").isNotNull())
    return rows.groupBy("instrument_type").agg(_n().alias("mismatches"), rupees(F.sum("amount_paise")).alias("rupees_at_risk")).orderBy(F.desc("mismatches"), "instrument_type")


def exceptions_by_merchant(ledger: DataFrame) -> DataFrame:
    rows = ledger.where(_is(S.FEE_MISMATCH))
    return rows.groupBy("merchant_id").agg(_n().alias("mismatches"), rupees(F.sum("amount_paise")).alias("rupees_at_risk")).orderBy(F.desc("mismatches"), "merchant_id")


def top_mismatches(ledger: DataFrame, k: int = 10) -> DataFrame:
    """The k largest mismatches; equal amounts are ordered by transaction."""
    rows = ledger.where(_is(S.FEE_MISMATCH)).orderBy(F.desc("amount_paise"), "transaction_id").limit(k)
    return rows.select("transaction_id", "merchant_id", "instrument_type", rupees(F.col("amount_paise")).alias("amount_rupees"), "bank_ref_id")
