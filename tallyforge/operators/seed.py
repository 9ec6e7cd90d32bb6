"""Seeding a ledger from staged events, and slices of it for benchmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from .merge import delete_keys


class SeedError(RuntimeError):
    """A seed that was not allowed."""


def seed(ledger: DataFrame, staged: DataFrame, allow: bool = False) -> DataFrame:
    """The ledger with the staged events as pending rows; rows of the same transactions are replaced, which must be allowed."""
    if not allow:
        raise SeedError("seeding replaces ledger rows and must be allowed")
    rows = staged.select(
        "transaction_id", "amount_paise", F.lit("CAPTURED").alias("gateway_status"), F.concat("day", F.lit("T00:00:00Z")).alias("timestamp_utc"), "merchant_id",
        F.lit(S.PENDING).alias("reconciliation_status"), F.lit("INR").alias("currency"), F.lit(0).cast("long").alias("duplicate_mutation_count"),
    ).dropDuplicates(["transaction_id"])
    return delete_keys(ledger, rows, "transaction_id").unionByName(rows, allowMissingColumns=True).select(*ledger.columns)


def slice_of(ledger: DataFrame, settlements: DataFrame, n: int) -> DataFrame:
    """The settlements of the first n ledger transactions by id, one for each."""
    first = ledger.select("transaction_id").orderBy("transaction_id").limit(n)
    return settlements.join(first, "transaction_id").dropDuplicates(["transaction_id"])
