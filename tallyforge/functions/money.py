"""Integer money: everything is paise in 64-bit integers, rates are basis points."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

BPS = 10_000


def bps_amount(amount: Column, bps: Column) -> Column:
    """bps/10000 of amount, half a paisa rounded away from zero."""
    part = lambda x: F.call_function("div", x * bps + F.lit(BPS // 2), F.lit(BPS).cast("long"))
    return F.when(bps == 0, F.lit(0).cast("long")).when(amount < 0, -part(-amount)).otherwise(part(amount))


def bps_amount_scalar(amount: int, bps: int) -> int:
    """The same rule for one Python integer."""
    size = (abs(amount) * bps + BPS // 2) // BPS
    return -size if amount < 0 else size


def gst_pct_to_bps(pct) -> int:
    """18.0 percent is 1800 basis points."""
    return int((Decimal(str(pct)) * 100).quantize(Decimal(1), ROUND_HALF_UP))


def minor_units(text: Column) -> Column:
    """Paise from decimal rupee text: sign, commas, spaces and the rupee sign allowed; ties go away from zero; junk is null."""
    clean = F.regexp_replace(text, r"[₹,\s]", "")
    return F.round(clean.try_cast("decimal(38,10)") * 100, 0).cast("long")


def rupees(paise: Column) -> Column:
    return paise.cast("double") / F.lit(100.0)


def pct2(part: Column, whole: Column) -> Column:
    """100 * part / whole rounded to two decimals by integers, so that every engine rounds alike."""
    return F.call_function("div", F.lit(20_000).cast("long") * part + whole, F.lit(2).cast("long") * whole).cast("double") / F.lit(100.0)
