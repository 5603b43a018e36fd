"""Timestamp parsing, boundary-counting differences and fiscal attributes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's cast also takes words such as 'yesterday' and bare times; only ISO dates may reach it.
_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.]\d+)?)?\s?(Z|[+-]\d{2}(:?\d{2})?)?)?$"


def utc_timestamp(text: Column) -> Column:
    """Text to UTC wall clock; offsets are applied, anything but an ISO date is NULL."""
    return F.when(text.rlike(_ISO), text.try_cast("timestamp").cast("timestamp_ntz"))


def local_timestamp(text: Column) -> Column:
    """Zone-less text to a floating wall clock; anything but an ISO date is NULL."""
    return F.when(text.rlike(_ISO), text.try_cast("timestamp_ntz"))


def seconds_between(start: Column, end: Column) -> Column:
    """Number of whole-second boundaries from start to end (both ends are floored first)."""
    return F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))


def millis_between(start: Column, end: Column) -> Column:
    return F.unix_millis(end.cast("timestamp")) - F.unix_millis(start.cast("timestamp"))


def hours_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / F.lit(3600.0)


def fiscal_year_bounds(year: int) -> tuple[date, date]:
    """A fiscal year is named for the calendar year in which it ends on 30 September."""
    return date(year - 1, 10, 1), date(year, 9, 30)


def fiscal_year(day: Column) -> Column:
    return F.year(F.add_months(day, 3))


def fiscal_month(day: Column) -> Column:
    return F.month(F.add_months(day, 3))


def fiscal_quarter(day: Column) -> Column:
    return F.quarter(F.add_months(day, 3))


def week_start(day: Column) -> Column:
    """The Monday on or before the day."""
    return F.to_date(F.trunc(day, "week"))


def week_end(day: Column) -> Column:
    return F.date_add(week_start(day), 6)
