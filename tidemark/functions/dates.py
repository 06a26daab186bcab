"""Dates without a wall clock: every plan takes an explicit as-of date."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def latest_closed_date(as_of: date) -> date:
    """The last day that had ended at midnight (UTC) of as_of."""
    return as_of - timedelta(days=1)


def closed_as_of(as_of: date) -> datetime:
    return datetime(as_of.year, as_of.month, as_of.day)


def closed_day(ts: Column, as_of: date) -> Column:
    """Rows of days that had ended: a plain comparison with a literal, which reaches the Parquet scan."""
    return ts < F.lit(closed_as_of(as_of)).cast("timestamp_ntz")


def day(ts: Column) -> Column:
    return F.to_date(ts)


def unix_day(value: Column) -> Column:
    """A date from days since 1970."""
    return F.date_from_unix_date(value.cast("int"))


def epoch_day(value: Column) -> Column:
    """A date from seconds since 1970 (or milliseconds, when larger than 10 ** 11)."""
    seconds = F.when(F.abs(value) >= 10**11, (value / 1000).cast("long")).otherwise(value.cast("long"))
    return F.date_from_unix_date(F.floor(seconds / 86400).cast("int"))


def strict_date(text: Column) -> Column:
    """YYYY-MM-DD at the start of a text, else null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"))


def loose_date(text: Column) -> Column:
    """ISO dates, m/d/y and d.m.y, spreadsheet serials (days since 1899-12-30) and epochs in seconds or milliseconds."""
    number = text.try_cast("double")
    serial = F.date_add(F.lit(date(1899, 12, 30)), number.cast("int"))
    return F.coalesce(
        strict_date(text),
        F.try_to_date(text, "M/d/yyyy"),
        F.try_to_date(text, "d.M.yyyy"),
        F.when((number > 0) & (number < 100_000), serial),
        F.when(number >= 10**8, epoch_day(number)),
    )


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole 24-hour periods between two timestamps (not calendar days), towards zero."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return (micros / F.lit(86_400_000_000)).cast("long")
