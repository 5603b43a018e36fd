"""The calendar dimension and the day-by-day partition plan, both generated on executors."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.functions import times


def fiscal_attributes(day: Column) -> list[Column]:
    """The attribute columns of one calendar day, in contract order."""
    return [
        times.fiscal_year(day).alias("fiscal_year"),
        times.fiscal_quarter(day).alias("fiscal_quarter"),
        times.fiscal_month(day).alias("fiscal_month"),
        F.to_date(F.trunc(day, "month")).alias("month_start"),
        times.week_start(day).alias("week_start"),
        times.week_end(day).alias("week_end"),
        (F.weekday(day) + 1).alias("day_of_week"),
    ]


def days(spark: SparkSession, first: date, last: date, name: str = "calendar_date") -> DataFrame:
    """One row per day, both ends included. A span of N days is N rows, so it stays small."""
    span = F.sequence(F.lit(first), F.lit(last))
    return spark.range(1, numPartitions=1).select(F.explode(span).alias(name))


def fiscal_calendar(spark: SparkSession, first_fy: int, last_fy: int) -> DataFrame:
    first, _ = times.fiscal_year_bounds(first_fy)
    _, last = times.fiscal_year_bounds(last_fy)
    day = F.col("calendar_date")
    return days(spark, first, last).select(day, *fiscal_attributes(day))


def resolve_window(
    fiscal_year: int | None = None,
    start: date | None = None,
    end: date | None = None,
    last_days: int | None = None,
    label: str | None = None,
) -> tuple[str, date, date]:
    """Window label and inclusive bounds for a fiscal year or a custom range."""
    if fiscal_year is not None:
        first, last = times.fiscal_year_bounds(fiscal_year)
        name = label or f"fy{fiscal_year}"
    elif start is not None:
        first, last, name = start, end or start, label or "custom"
    else:
        raise ValueError("give a fiscal year or a start date")
    if last_days:
        first = max(first, last - timedelta(days=last_days - 1))
        name = label or f"{name}-last{last_days}d"
    return name, first, last


def day_predicate(day: Column) -> Column:
    """The half-open created_date predicate of one day's partition, as text. Its form is fixed."""
    return F.format_string(
        "created_date >= '%sT00:00:00' AND created_date < '%sT00:00:00'",
        day.cast("string"), F.date_add(day, 1).cast("string"),
    )


def partition_plan(spark: SparkSession, **window) -> DataFrame:
    """One row per day of the window: label, day and its predicate."""
    name, first, last = resolve_window(**window)
    day = F.col("partition_date")
    return days(spark, first, last, "partition_date").select(
        F.lit(name).alias("window_label"), day, day_predicate(day).alias("where_clause")
    )
