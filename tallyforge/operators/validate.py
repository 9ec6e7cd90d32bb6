"""Settlement validation: rules by row, quarantine, and the gates of a file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import impossible_date
from ..functions.text import pans
from ..schemas import INSTRUMENTS


class ValidationError(RuntimeError):
    """A file that must not be curated."""


def violations() -> Column:
    """The names of the rules that a row breaks, in a fixed order."""
    c = F.col
    bad = lambda ok: ~F.coalesce(ok, F.lit(False))
    rules = {
        "transaction_id": bad(c("transaction_id").rlike("^[A-Za-z0-9_]{4,64}$")),
        "settled_amount_paise": bad(c("settled_amount_paise") > 0),
        "bank_ref_id": c("bank_ref_id").isNull(),
        "settlement_date": bad(c("settlement_date").rlike(r"^\d{4}-\d{2}-\d{2}$")),
        "calendar": impossible_date(c("settlement_date")),
        "instrument_type": bad(c("instrument_type").isin(INSTRUMENTS)),
        "fee_paise": F.coalesce(c("fee_paise") < 0, F.lit(False)),
        "gst_paise": F.coalesce(c("gst_paise") < 0, F.lit(False)),
        "gross_amount_paise": F.coalesce(c("gross_amount_paise") < 0, F.lit(False)),
        "currency": F.coalesce(c("currency") != "INR", F.lit(False)),
    }
    return F.array_compact(F.array(*(F.when(v, F.lit(k)) for k, v in rules.items())))


def split(canonical: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their violations): any broken rule quarantines the row."""
    judged = canonical.withColumn("violations", violations())
    ok = F.size("violations") == 0
    return judged.where(ok).drop("violations"), judged.where(~ok)


def quarantine_rate(canonical: DataFrame) -> tuple[int, int]:
    """(rows, quarantined rows), counted in one pass."""
    r = canonical.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size(violations()) > 0).alias("q")).first()
    return r["n"], r["q"]


def check_quarantine(rows: int, quarantined: int, most_pct: float = 0.0) -> None:
    if rows and 100.0 * quarantined / rows > most_pct:
        raise ValidationError(f"{quarantined} of {rows} rows are quarantined; at most {most_pct} % may be")


def check_volume(rows: int, before: int | None, strict: bool = True, low: float = 0.5, high: float = 2.0) -> bool:
    """Whether the number of rows is within [low, high] times the last one; strict raises."""
    ok = not before or low * before <= rows <= high * before
    if not ok and strict:
        raise ValidationError(f"{rows} rows after {before} last time")
    return ok


def pan_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, n): values of each text column that hold a card number."""
    columns = columns or [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    counts = df.agg(*(F.count_if(F.size(pans(F.col(c))) > 0).alias(c) for c in columns))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in columns))).alias("x")).select("x.*")


def refuse_pans(df: DataFrame, columns: list[str] | None = None) -> None:
    hits = {r["column"]: r["n"] for r in pan_counts(df, columns).where("n > 0").collect()}
    if hits:
        raise ValidationError(f"card numbers found: {hits}")
