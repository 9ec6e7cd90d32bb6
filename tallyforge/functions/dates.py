"""Dates stay ISO text; parsing never throws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = "yyyy-MM-dd"


def iso(text: Column) -> Column:
    """The date of ISO text, null when it is none."""
    return F.try_to_date(text, ISO)


def event_time(text: Column) -> Column:
    """The time of free-form timestamp text, null when it cannot be read."""
    return F.try_to_timestamp(text)


def iso_text(text: Column) -> Column:
    """ISO date text from common spellings: ISO, day-first d/m/yyyy or d-m-yyyy, ISO with a time, else a readable timestamp; junk is null.

    A day-first date is not checked against the calendar here; validation does that.
    """
    t = F.trim(text)
    day_first = r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})$"
    part = lambda i: F.regexp_extract(t, day_first, i)
    return (
        F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), t)
        .when(t.rlike(day_first), F.concat_ws("-", part(3), F.lpad(part(2), 2, "0"), F.lpad(part(1), 2, "0")))
        .when(t.rlike(r"^\d{4}-\d{2}-\d{2}[T ]"), F.substring(t, 1, 10))
        .otherwise(F.date_format(F.try_to_timestamp(t), ISO))
    )


def impossible_date(text: Column) -> Column:
    """Text shaped like a date that is on no calendar."""
    return F.coalesce(text.rlike(r"^\d{4}-\d{2}-\d{2}$") & iso(text).isNull(), F.lit(False))
