"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_time(seconds: Column) -> Column:
    """Zone-less UTC timestamp of seconds since 1970, whatever the session time zone."""
    return F.timestamp_add("SECOND", seconds, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def epoch_text(seconds: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in UTC."""
    return F.date_format(epoch_time(seconds), "yyyy-MM-dd HH:mm:ss")


def epoch_day(seconds: Column) -> Column:
    """The UTC date, by integer arithmetic."""
    return F.date_from_unix_date(F.floor(seconds / 86400).cast("int"))


def two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def text_parts(datetime_text: Column) -> dict[str, Column]:
    """year, month and day of a date-time text, as strings."""
    parts = F.split(datetime_text, "-")
    return {
        "year": parts.getItem(0),
        "month": parts.getItem(1),
        "day": F.split(parts.getItem(2), " ").getItem(0),
    }


def fractional_year(year: Column, month: Column) -> Column:
    """``year + (month - 1) / 12`` from text columns."""
    return year.cast("int") + (month.cast("int") - 1) / F.lit(12.0)


def year_gap(later: Column, earlier: Column) -> Column:
    """Difference of two years (texts or numbers); null when either is not a number."""
    return later.try_cast("int") - earlier.try_cast("int")


def utc_epoch(ts: Column) -> Column:
    """Seconds since 1970 of a zone-less timestamp or date, read as UTC."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", start, ts.cast("timestamp_ntz"))
