"""Dates and times without a zone."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(value: datetime) -> Column:
    """Literal timestamp that no session time zone can shift."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def day(value: date) -> Column:
    return F.lit(value.strftime("%Y-%m-%d")).cast("date")


def to_moment(c: Column) -> Column:
    """Timestamp, or NULL for text that is none (30 February included)."""
    return c.try_cast("timestamp_ntz")


def to_day(c: Column) -> Column:
    return to_moment(c).cast("date")


def date_key(c: Column) -> Column:
    """The day as the integer yyyymmdd."""
    d = c.cast("date")
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def _time_of_day(c: Column) -> Column:
    return c - c.cast("date").cast("timestamp_ntz")


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole days of 24 hours between two moments, rounded down also below zero.

    Counted in calendar days, less one if the end is earlier in its day: a difference in microseconds
    would go through the session's time zone.
    """
    started, ended = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    short = F.when(_time_of_day(ended) < _time_of_day(started), 1).otherwise(0)
    return F.datediff(ended.cast("date"), started.cast("date")) - short
