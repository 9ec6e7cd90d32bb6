"""Settlement folding: redelivered rows collapse, instalments add up, one row per transaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that agree in these were delivered twice.
DELIVERY = ["transaction_id", "settled_amount_paise", "settlement_date", "bank_ref_id"]
LATEST = ["bank_ref_id", "settlement_id", "utr", "gross_amount_paise"]
KNOWN = ["instrument_type", "merchant_id", "currency", "provider"]


def one_partitioning(settlements: DataFrame) -> DataFrame:
    """Rows of a transaction brought together once; folding and later joins by transaction reuse it."""
    return settlements.where(F.col("transaction_id").isNotNull()).repartition("transaction_id")


def collapse_redeliveries(settlements: DataFrame) -> DataFrame:
    """Of rows that agree in DELIVERY (nulls agree with nulls), the one with the smallest settlement id."""
    rest = [c for c in settlements.columns if c not in DELIVERY]
    first = ["settlement_id"] + [c for c in rest if c != "settlement_id"]
    kept = settlements.groupBy(*DELIVERY).agg(F.min(F.struct(*first)).alias("r"))
    return kept.select(*(F.col(c) if c in DELIVERY else F.col(f"r.{c}").alias(c) for c in settlements.columns))


def _order() -> Column:
    return F.struct("settlement_date", "bank_ref_id", "settlement_id")


def fold(settlements: DataFrame) -> DataFrame:
    """One row per transaction, with `instalments`, the number of rows that were added up.

    Amounts are sums over the non-null values; the date is the latest; references come from the latest row;
    descriptive columns come from the latest row that declares them.
    """
    rows = collapse_redeliveries(one_partitioning(settlements))
    latest = [F.max_by(c, _order()).alias(c) for c in LATEST]
    known = [F.max_by(c, F.when(F.col(c).isNotNull(), _order())).alias(c) for c in KNOWN]
    sums = [F.sum(c).alias(c) for c in ("settled_amount_paise", "fee_paise", "gst_paise")]
    return rows.groupBy("transaction_id").agg(*sums, F.max("settlement_date").alias("settlement_date"), *latest, *known, F.count(F.lit(1)).alias("instalments"))
