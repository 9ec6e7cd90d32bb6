"""The bank leg: which settlements have evidence in bank statements, and which statements have no settlement.

A statement is evidence for a settlement when it names the transaction, or names none and agrees in
amount (within the rate's tolerance) and in date (within the lag). Both questions ask whether a partner exists, so
no pairs are formed: each side is reduced to its distinct (day, amount), the distinct ones are semi-joined by
day and amount bin, and the rows look their own (day, amount) up. A bin holds at most BIN distinct amounts, so a million equal
prices of one day cost one look-up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.dates import iso
from ..functions.rates import MOST_TOLERANCE, RateBook
from .merge import Arm, changes, merge
from .skew import flag_rows

#: As wide as the widest range of amounts, so that a range touches at most two bins.
BIN = 2 * MOST_TOLERANCE + 1


def _bin(amount: Column) -> Column:
    return F.floor(amount / F.lit(BIN)).cast("long")


def _reach(points: DataFrame, lag_days: int) -> DataFrame:
    """The days and bins that a settlement's (d, amount, tol) reaches: columns day, bin beside them."""
    low, high = _bin(F.col("amount") - F.col("tol")), _bin(F.col("amount") + F.col("tol"))
    bins = points.select("*", F.explode(F.when(low == high, F.array(low)).otherwise(F.array(low, high))).alias("bin"))
    return bins.select("*", F.explode(F.array(*(F.date_add("d", i) for i in range(-lag_days, lag_days + 1)))).alias("day"))


def settlement_points(settlements: DataFrame) -> DataFrame:
    return settlements.select(iso(F.col("settlement_date")).alias("d"), F.col("settled_amount_paise").alias("amount"), F.col("tolerance").alias("tol")).where("d IS NOT NULL AND amount IS NOT NULL AND tol IS NOT NULL").distinct()


def statement_points(statements: DataFrame) -> DataFrame:
    loose = statements.where(F.col("link_tx").isNull())
    return loose.select(iso(F.col("value_date")).alias("bd"), F.col("amount_paise").alias("b")).where("bd IS NOT NULL AND b IS NOT NULL").distinct()


def _near() -> Column:
    return (F.col("day") == F.col("bd")) & (F.col("bin") == F.col("b_bin")) & (F.abs(F.col("amount") - F.col("b")) <= F.col("tol"))


def with_evidence(settlements: DataFrame, statements: DataFrame, lag_days: int) -> DataFrame:
    """settlements (transaction_id, settled_amount_paise, settlement_date, tolerance) with a boolean `evidence`."""
    named = statements.select(F.col("link_tx").alias("transaction_id")).where(F.col("transaction_id").isNotNull()).distinct()
    rows = settlements.join(named.withColumn("_named", F.lit(True)), "transaction_id", "left")
    rows = rows.withColumns({"d": iso(F.col("settlement_date")), "amount": F.col("settled_amount_paise"), "tol": F.col("tolerance")})
    loose = statement_points(statements).withColumn("b_bin", _bin(F.col("b")))
    pick = lambda points: _reach(points, lag_days).join(loose, _near(), "left_semi").select("d", "amount", "tol", "_n").distinct()
    out = flag_rows(rows, ["d", "amount", "tol"], pick, "_near", "transaction_id")
    return out.withColumn("evidence", F.coalesce("_named", F.lit(False)) | F.col("_near")).select(*settlements.columns, "evidence")


def with_use(statements: DataFrame, settlements: DataFrame, lag_days: int) -> DataFrame:
    """statements (statement_id, amount_paise, value_date, link_tx) with a boolean `used`: whether they are evidence for any settlement."""
    ids = settlements.select(F.col("transaction_id").alias("_tx")).distinct()
    linked = lambda points: points.join(ids, F.col("link_tx") == F.col("_tx"), "left_semi")
    rows = flag_rows(statements, ["link_tx"], linked, "_linked", "statement_id")
    rows = rows.withColumns({"bd": F.when(F.col("link_tx").isNull(), iso(F.col("value_date"))), "b": F.col("amount_paise")})
    reached = _reach(settlement_points(settlements), lag_days)
    pick = lambda points: points.withColumn("b_bin", _bin(F.col("b"))).join(reached, _near(), "left_semi")
    out = flag_rows(rows, ["bd", "b"], pick, "_near", "statement_id")
    return out.withColumn("used", F.col("_linked") | F.col("_near")).select(*statements.columns, "used")


def with_tolerance(folded: DataFrame, book: RateBook) -> DataFrame:
    return book.with_rates(folded, "instrument_type", "merchant_id", "settlement_date").withColumnRenamed("rate_tol", "tolerance").drop("rate_mdr", "rate_gst")


def missing(settlements: DataFrame, statements: DataFrame, lag_days: int) -> DataFrame:
    """Settlements without evidence."""
    return with_evidence(settlements, statements, lag_days).where("NOT evidence").drop("evidence")


def orphans(statements: DataFrame, settlements: DataFrame, lag_days: int) -> DataFrame:
    """Statements that are evidence for nothing."""
    return with_use(statements, settlements, lag_days).where("NOT used").drop("used")


def _demote_plan(unproven: DataFrame) -> tuple[DataFrame, str, list[Arm]]:
    return unproven.select("transaction_id"), "transaction_id", [Arm(F.col("t.reconciliation_status") == S.MATCHED, {"reconciliation_status": F.lit(S.MISSING_BANK_STATEMENT)})]


def demote(ledger: DataFrame, unproven: DataFrame, check: bool = False) -> DataFrame:
    """Matched ledger rows among the unproven settlements lose their status; nothing is inserted."""
    return merge(ledger, *_demote_plan(unproven), check=check)


def demotions(ledger: DataFrame, unproven: DataFrame, check: bool = False) -> DataFrame:
    """Only the rows that demote() changes."""
    return changes(ledger, *_demote_plan(unproven), check=check)


def leg_counters(before: DataFrame, unproven: DataFrame, orphan_rows: DataFrame) -> DataFrame:
    """(counter, n): matched with evidence, matched without, statements without a settlement. One look at the ledger, one at each list."""
    row = F.col("reconciliation_status") == S.MATCHED
    gone = unproven.select("transaction_id").distinct().withColumn("_gone", F.lit(True))
    tally = before.where(row).select("transaction_id").join(gone, "transaction_id", "left").agg(F.count_if(F.col("_gone").isNull()).alias("evidence"), F.count_if(F.col("_gone").isNotNull()).alias("missing"))
    named = F.array(*[F.struct(F.lit(c).alias("counter"), F.col(c).alias("n")) for c in ("evidence", "missing")])
    lost = orphan_rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit("orphans").alias("counter"), "n")
    return tally.select(F.explode(named).alias("c")).select("c.*").unionByName(lost)
