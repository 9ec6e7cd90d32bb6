"""The settlement decision, its merge into the ledger, counters, sweeps and gates."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.dates import event_time, iso
from ..functions.rates import REASONS, Providers, RateBook
from ..functions.tables import local_table
from .merge import Arm, changes, merge

log = logging.getLogger(__name__)


def merge_source(folded: DataFrame) -> DataFrame:
    """The columns that the merge reads, of rows with a key and an amount."""
    cols = ["transaction_id", "settled_amount_paise", "settlement_date", "instrument_type", F.coalesce("merchant_id", F.lit("UNKNOWN")).alias("merchant_id"), "bank_ref_id", "currency"]
    return folded.where(F.col("transaction_id").isNotNull() & F.col("settled_amount_paise").isNotNull()).select(*cols)


def not_terminal(status: Column) -> Column:
    """False or null for finished rows: a null status takes part in no arm."""
    return ~status.isin(S.TERMINAL)


def currency_differs(status: Column, a: Column, b: Column) -> Column:
    return not_terminal(status) & a.isNotNull() & b.isNotNull() & (a != b)


def priced(source: DataFrame, ledger: DataFrame, book: RateBook, how: str = "left") -> DataFrame:
    """Settlements joined to their ledger rows (t_ columns) with the net of the gateway's amount at the settlement's rate."""
    target = ledger.select(*(F.col(c).alias(f"t_{c}") for c in ("transaction_id", "amount_paise", "reconciliation_status", "currency")))
    joined = source.join(target, source["transaction_id"] == target["t_transaction_id"], how)
    return book.with_net(joined, "t_amount_paise", "instrument_type", "merchant_id", "settlement_date")


def decide(source: DataFrame, ledger: DataFrame, book: RateBook) -> DataFrame:
    """transaction_id and the status that each settlement gives its row, without changing a table."""
    status, amount = F.col("t_reconciliation_status"), F.col("t_amount_paise")
    within = F.abs(F.col("rate_net") - F.col("settled_amount_paise")) <= F.col("rate_tol")
    verdict = (
        F.when(F.col("t_transaction_id").isNull(), S.MISSING_WEBHOOK)
        .when(status.isin(S.PLACEHOLDERS), status)
        .when(amount.isNull(), S.FEE_MISMATCH)
        .when(currency_differs(status, F.col("t_currency"), F.col("currency")), S.CURRENCY_MISMATCH)
        .when(not_terminal(status), F.when(within, S.MATCHED).otherwise(S.FEE_MISMATCH))
        .otherwise(status)
    )
    return priced(source, ledger, book).select("transaction_id", "settled_amount_paise", "settlement_date", "instrument_type", "t_amount_paise", verdict.alias("status"))


def _settlement_plan(folded: DataFrame, book: RateBook) -> tuple[DataFrame, list[Arm], dict[str, Column], Callable]:
    """What merge() and changes() need: source, four ordered update arms, the insert arm, and the pricing of the joined rows."""
    t, s = (lambda c: F.col(f"t.{c}")), (lambda c: F.col(f"s.{c}"))
    stamp = {"bank_ref_id": s("bank_ref_id"), "instrument_type": s("instrument_type")}
    status = t("reconciliation_status")
    # rows are priced after the one join, when both sides of each are there
    price = lambda joined: book.with_net(joined, "t.amount_paise", "s.instrument_type", "s.merchant_id", "s.settlement_date")
    within = F.abs(F.col("rate_net") - s("settled_amount_paise")) <= F.col("rate_tol")
    arms = [
        Arm(status.isin(S.PLACEHOLDERS), stamp),
        Arm(t("amount_paise").isNull(), {**stamp, "reconciliation_status": F.lit(S.FEE_MISMATCH)}),
        Arm(currency_differs(status, t("currency"), s("currency")), {**stamp, "reconciliation_status": F.lit(S.CURRENCY_MISMATCH)}),
        Arm(not_terminal(status), {**stamp, "reconciliation_status": F.when(within, S.MATCHED).otherwise(S.FEE_MISMATCH)}),
    ]
    insert = {
        "transaction_id": s("transaction_id"), "amount_paise": s("settled_amount_paise"), "gateway_status": F.lit("UNKNOWN"), "timestamp_utc": s("settlement_date"),
        "merchant_id": s("merchant_id"), "reconciliation_status": F.lit(S.MISSING_WEBHOOK), "bank_ref_id": s("bank_ref_id"), "instrument_type": s("instrument_type"), "currency": s("currency"),
    }
    return merge_source(folded), arms, insert, price


def settlement_merge(ledger: DataFrame, folded: DataFrame, book: RateBook, check: bool = False) -> DataFrame:
    """The ledger after all settlements. check refuses settlements with two rows of one transaction; folded ones have none."""
    source, arms, insert, price = _settlement_plan(folded, book)
    return merge(ledger, source, "transaction_id", arms, insert, check, price)


def settlement_changes(ledger: DataFrame, folded: DataFrame, book: RateBook, check: bool = False) -> DataFrame:
    """Only the ledger rows that settlement_merge() changes or inserts, with _deleted (never)."""
    source, arms, insert, price = _settlement_plan(folded, book)
    return changes(ledger, source, "transaction_id", arms, insert, check, price)


# counters


def batch_counters(settlements: DataFrame) -> DataFrame:
    """One row: all rows, rows without redeliveries, transactions, evaluated ones, redelivered rows, split transactions, undeclared currencies.

    One pass by transaction, then one by nothing: partial sums, never all rows in one task.
    """
    from .fold import collapse_redeliveries, one_partitioning

    rows = one_partitioning(settlements)
    total = rows.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("n"))
    once = collapse_redeliveries(rows).groupBy("transaction_id").agg(F.count(F.lit(1)).alias("parts"), F.sum("settled_amount_paise").alias("settled"), F.max("currency").alias("currency"))
    both = total.join(once, "transaction_id")
    num = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return both.agg(
        num(F.sum("n")).alias("total_rows"), num(F.sum("parts")).alias("distinct_rows"), F.count(F.lit(1)).alias("deduped_rows"),
        F.count_if(F.col("settled").isNotNull()).alias("evaluated"), num(F.sum("n") - F.sum("parts")).alias("duplicate_rows"),
        F.count_if(F.col("parts") > 1).alias("partial_transactions"), F.count_if(F.col("currency").isNull()).alias("currency_missing"),
    )


def fallback_census(folded: DataFrame, book: RateBook) -> DataFrame:
    """(reason, n): rows priced by a fallback, every reason present."""
    rows = folded.where(F.col("settled_amount_paise").isNotNull()).select("merchant_id", "instrument_type", "settlement_date")
    counts = book.with_reason(rows, "merchant_id", "instrument_type", "settlement_date").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    every = local_table(folded.sparkSession, [(r,) for r in REASONS], "reason string")
    return every.join(counts, "reason", "left").select("reason", F.coalesce("n", F.lit(0)).alias("n"))


def status_tile(ledger: DataFrame, batch_ids: DataFrame) -> DataFrame:
    """(scope, status, n): the table by status, the batch by status, and the sum of duplicate mutations. One look at the ledger."""
    flagged = ledger.join(batch_ids.select("transaction_id").distinct().withColumn("_in", F.lit(True)), "transaction_id", "left")
    by = flagged.groupBy(F.col("reconciliation_status").alias("status"), F.col("_in")).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("duplicate_mutation_count"), F.lit(0)).cast("long").alias("d"))
    row = lambda scope, status, n: F.struct(F.lit(scope).alias("scope"), status.alias("status"), n.alias("n"))
    parts = F.array(row("table", F.col("status"), F.col("n")), F.when(F.col("_in"), row("batch", F.col("status"), F.col("n"))), row("duplicates", F.lit(S.DUPLICATE_WEBHOOK), F.col("d")))
    none = local_table(ledger.sparkSession, [("duplicates", S.DUPLICATE_WEBHOOK, 0)], "scope string, status string, n long")
    return by.select(F.explode(parts).alias("p")).where("p IS NOT NULL").select("p.*").unionByName(none).groupBy("scope", "status").agg(F.sum("n").alias("n"))


def rate_counts(ledger: DataFrame, folded: DataFrame, providers: Providers) -> DataFrame:
    """One row: matched, evaluated, within_lag of a batch. One join of the batch with the ledger."""
    rows = ledger.select("transaction_id", F.col("reconciliation_status").alias("_status"), F.col("timestamp_utc").alias("_time"))
    both = folded.select("transaction_id", "settlement_date", "provider", "settled_amount_paise").join(rows, "transaction_id", "left")
    gap = F.datediff(iso(F.col("settlement_date")), F.to_date(event_time(F.col("_time"))))
    waits = (F.col("_status") == S.MISSING_WEBHOOK) & gap.between(F.lit(0), providers.lag(F.col("provider")))
    return both.agg(F.count_if(F.col("_status") == S.MATCHED).alias("matched"), F.count("settled_amount_paise").alias("evaluated"), F.count_if(waits).alias("within_lag"))


def late_predicate(as_of: str, days: int) -> Column:
    """Unresolved rows older than the limit; a time that cannot be read never ages."""
    when = F.to_date(event_time(F.col("timestamp_utc")))
    return F.coalesce(F.col("reconciliation_status").isin(S.UNRESOLVED) & (when < F.date_sub(F.lit(as_of).cast("date"), days)), F.lit(False))


def late_sweep(ledger: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """The ledger with aged rows marked late."""
    return ledger.withColumn("reconciliation_status", F.when(late_predicate(as_of, days), S.LATE_UNRESOLVED).otherwise(F.col("reconciliation_status")))


def late_changes(ledger: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Only the rows that late_sweep() changes."""
    return ledger.where(late_predicate(as_of, days) & (F.col("reconciliation_status") != S.LATE_UNRESOLVED)).withColumn("reconciliation_status", F.lit(S.LATE_UNRESOLVED))


def missing_within_lag(ledger: DataFrame, folded: DataFrame, providers: Providers) -> DataFrame:
    """Batch rows whose webhook is missing but may still come: the settlement is 0 to lag days after the row's time."""
    row_day, day = F.to_date(event_time(F.col("timestamp_utc"))), iso(F.col("settlement_date"))
    gap = F.datediff(day, row_day)
    missing = ledger.where(F.col("reconciliation_status") == S.MISSING_WEBHOOK).select("transaction_id", "timestamp_utc")
    return missing.join(folded.select("transaction_id", "settlement_date", "provider"), "transaction_id").where(gap.between(F.lit(0), providers.lag(F.col("provider")))).select("transaction_id", "provider", "settlement_date")


def depth_gauges(ledger: DataFrame, dlq: DataFrame) -> DataFrame:
    late = ledger.where(F.col("reconciliation_status") == S.LATE_UNRESOLVED).agg(F.count(F.lit(1)).alias("n")).select(F.lit("late_unresolved_total").alias("gauge"), "n")
    return dlq.agg(F.count(F.lit(1)).alias("n")).select(F.lit("dlq_depth").alias("gauge"), "n").unionByName(late)


def match_rate(matched: int, evaluated: int, within_lag: int) -> float | None:
    """Unrounded; nothing to judge gives None."""
    base = max(0, evaluated - within_lag)
    return matched / base if base else None


def provider_batches(settlements: DataFrame) -> DataFrame:
    """The distinct providers with the id of each of their batches."""
    return settlements.select("provider", Providers.batch_id(F.col("provider"), F.col("settlement_date")).alias("batch_id")).distinct()


# gates


class GateError(RuntimeError):
    """A batch that must not be published."""


def check_drift(counts: dict[str, int], evaluated: int | None, deduped: int | None = None) -> bool:
    """The batch's statuses must add up to what was evaluated (where that was not counted: to the transactions). A batch in which
    nothing was evaluated cannot be judged: a warning, and False."""
    total = sum(n for s, n in counts.items() if s != S.DUPLICATE_SETTLEMENT)
    base = evaluated if evaluated is not None else deduped or 0
    if not base:
        log.warning("nothing was evaluated in this batch, its statuses and match rate cannot be checked")
        return False
    if total != base:
        raise GateError(f"the batch has {total} rows by status but {base} were evaluated")
    return True


def check_slo(rate: float | None, slo: float = 0.95) -> None:
    """The unrounded rate decides; no rate passes."""
    if rate is not None and rate < slo:
        raise GateError(f"match rate {rate} is below {slo}")


def fold_residual(counts: dict[str, int], demoted: int) -> dict[str, int]:
    """Counts after demotions moved from matched to mismatch."""
    out = dict(counts)
    out[S.MATCHED] = out.get(S.MATCHED, 0) - demoted
    out[S.FEE_MISMATCH] = out.get(S.FEE_MISMATCH, 0) + demoted
    return out


#: Bits of a value that one pass of the selection settles; a pass brings at most 2**DIGIT counts a rank to the driver.
DIGIT = 10


def at_ranks(values: DataFrame, column: str, ranks: list[int], largest: int) -> list[int]:
    """The values (whole, not negative) at the given ranks, counted from 1, of all rows in order.

    A histogram of the leading bits says in which cell a rank lies; the cell is refined until it holds one value. No row is
    sorted, and no task or driver gets more than the cells.
    """
    bits = max(1, largest.bit_length())
    found = [(0, r) for r in ranks]  # the leading bits so far, and the rank inside of that cell
    while bits > 0:
        step = min(DIGIT, bits)
        cells = sorted({p for p, _ in found})
        prefix = F.shiftright(F.col(column), bits)
        digit = F.shiftright(F.col(column), bits - step)
        hist = values.where(prefix.isin(cells)).groupBy(digit.alias("cell")).agg(F.sum("c").alias("c")).collect()
        counts = sorted((r["cell"], r["c"]) for r in hist)
        refined = []
        for p, rank in found:
            for cell, c in counts:
                if cell >> step == p:
                    if rank <= c:
                        refined.append((cell, rank))
                        break
                    rank -= c
        found, bits = refined, bits - step
    return [p for p, _ in found]


def mismatch_spread(decided: DataFrame) -> DataFrame:
    """(p50, p90, largest) of the absolute differences of mismatched rows, picked by position; zeros when there are none."""
    spark = decided.sparkSession
    hist = decided.where(F.col("difference").isNotNull()).groupBy("difference").agg(F.count(F.lit(1)).alias("c")).persist()
    try:
        n, largest = hist.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.max("difference"), F.lit(0))).first()
        p50, p90 = at_ranks(hist, "difference", [n // 2 + 1, max(n * 9 // 10, 1)], largest) if n else (0, 0)
    finally:
        hist.unpersist()
    return local_table(spark, [(p50, p90, largest)], "p50 long, p90 long, largest long")
