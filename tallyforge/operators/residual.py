"""Residual scores: how suspicious a match is, and demotion of the worst."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.rates import RateBook
from .merge import Arm, changes, merge

#: The score's shape and the limit of demotion.
TAU = 0.9
PLAIN_RATE = 0.95
INSIDE, OUTSIDE = (0.05, 0.1, 0.0, 10.0), (0.2, 0.75, 10.0, 20.0)


def _curve(x: Column, base: float, height: float, middle: float, width: float) -> Column:
    return F.lit(base) + F.lit(height) / (F.lit(1.0) + F.exp(-((x.cast("double") - F.lit(middle)) / F.lit(width))))


def score(default_gap: Column, default_tol: Column, merchant_gap: Column, merchant_tol: Column) -> Column:
    """From 0 to 1: a fixed high score when only the rate without merchants fits, else a curve of the larger excess."""
    excess = F.greatest(default_gap - default_tol, merchant_gap - merchant_tol)
    return F.when((default_gap <= default_tol) & (merchant_gap > merchant_tol), F.lit(PLAIN_RATE)).when(excess <= 0, _curve(excess, *INSIDE)).otherwise(_curve(excess, *OUTSIDE))


def score_scalar(book: RateBook, amount: int, settled: int, instrument: str, merchant: str | None, day: str | None) -> float:
    """The same score of one payment."""
    gap = lambda m: abs(book.expected_settled(amount, instrument, m, day) - settled)
    tol = lambda m: book.rate(instrument, m, day).tolerance
    plain, own = gap(None) - tol(None), gap(merchant) - tol(merchant)
    if plain <= 0 < own:
        return PLAIN_RATE
    base, height, middle, width = INSIDE if max(plain, own) <= 0 else OUTSIDE
    return base + height / (1 + math.exp(-(max(plain, own) - middle) / width))


def scored(ledger: DataFrame, folded: DataFrame, book: RateBook) -> DataFrame:
    """(transaction_id, score) of matched rows with both amounts."""
    rows = ledger.where((F.col("reconciliation_status") == S.MATCHED) & F.col("amount_paise").isNotNull()).select("transaction_id", "amount_paise")
    both = folded.where(F.col("settled_amount_paise").isNotNull()).select("transaction_id", "settled_amount_paise", "instrument_type", F.coalesce("merchant_id", F.lit("UNKNOWN")).alias("merchant_id"), "settlement_date").join(rows, "transaction_id")
    both = book.with_net(book.with_net(both, "amount_paise", "instrument_type", None, "settlement_date", "d_"), "amount_paise", "instrument_type", "merchant_id", "settlement_date", "m_")
    gap = lambda p: F.abs(F.col(f"{p}net") - F.col("settled_amount_paise"))
    return both.select("transaction_id", score(gap("d_"), F.col("d_tol"), gap("m_"), F.col("m_tol")).alias("score"))


def _demote_plan(scores: DataFrame, tau: float, only: DataFrame | None) -> tuple[DataFrame, str, list[Arm]]:
    worst = scores.where(F.col("score") >= tau).select("transaction_id")
    if only is not None:
        worst = worst.join(only.select("transaction_id"), "transaction_id", "left_semi")
    return worst, "transaction_id", [Arm(F.col("s.transaction_id").isNotNull(), {"reconciliation_status": F.lit(S.FEE_MISMATCH)})]


def demote(ledger: DataFrame, scores: DataFrame, tau: float = TAU, only: DataFrame | None = None, check: bool = False) -> DataFrame:
    """Rows with a score of tau or more become fee mismatches; `only` narrows the rows that may be demoted.

    As specified, a match at a negotiated rate scores high and is demoted; pass as `only` the rows without a
    negotiated rate to spare them.
    """
    return merge(ledger, *_demote_plan(scores, tau, only), check=check)


def demotions(ledger: DataFrame, scores: DataFrame, tau: float = TAU, only: DataFrame | None = None, check: bool = False) -> DataFrame:
    """Only the rows that demote() changes."""
    return changes(ledger, *_demote_plan(scores, tau, only), check=check)
