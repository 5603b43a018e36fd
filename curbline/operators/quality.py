"""Data-quality checks. Each returns the violating rows; an empty result passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.config import DEFAULT, Settings
from curbline.functions import times, values
from curbline.plans.extract import verified_versions


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Key values held by more than one row (NULL keys do not count as equal)."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return (
        rows.filter(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count"))
        .filter(F.col("duplicate_count") > 1)
    )


def grain_duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Repeated grains, NULLs grouped together."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count")).filter(
        F.col("duplicate_count") > 1)


def is_null(column: str) -> Column:
    return F.col(column).isNull()


def not_accepted(column: str, accepted: tuple[str, ...]) -> Column:
    """True for a value outside the list; NULL passes."""
    return F.coalesce(~F.col(column).isin(*accepted), F.lit(False))


def outside_unit(column: str) -> Column:
    return F.coalesce((F.col(column) < 0) | (F.col(column) > 1), F.lit(False))


def count_bad_rows(rows: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Violations of many row predicates in one pass: one column per check."""
    return rows.agg(*[F.count_if(bad).alias(name) for name, bad in checks.items()])


def closed_without_close_time(stg: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """One row when too large a share of closed requests has no readable close time."""
    updated = times.utc_timestamp(values.json_text(F.col("raw_payload"), "updated_datetime"))
    summary = stg.filter(F.col("status") == "closed").agg(
        F.count(F.lit(1)).alias("closed_rows"),
        F.count_if(updated.isNull()).alias("unparseable_rows"),
    )
    share = values.ratio(F.col("unparseable_rows"), F.col("closed_rows"))
    return summary.withColumn("unparseable_pct", share).filter(
        F.col("unparseable_pct") > settings.max_unparseable_close_time_pct)


def unreconciled_partitions(portal_pulls: DataFrame) -> DataFrame:
    off = (
        F.col("landed_count").isNull()
        | (F.col("landed_count") != F.col("expected_count"))
        | (F.col("expected_count") != F.col("expected_count_after"))
    )
    return portal_pulls.filter((F.col("status") == "verified") & off).select(
        "pull_id", "partition_date", "expected_count", "expected_count_after", "landed_count")


def uncovered_days(
    calendar: DataFrame, portal_pulls: DataFrame, settings: Settings = DEFAULT
) -> DataFrame:
    """Days of the fiscal year without a verified partition."""
    covered = portal_pulls.filter(F.col("status") == "verified").select(
        F.col("partition_date").alias("calendar_date"))
    return (
        calendar.filter(F.col("fiscal_year") == settings.fiscal_year).select("calendar_date")
        .join(covered, "calendar_date", "left_anti")
    )


def denominator_breaks(
    monthly: DataFrame, stg: DataFrame, settings: Settings = DEFAULT
) -> DataFrame:
    """Buckets whose states do not add up to the created requests, and a differing year total."""
    states = F.col("excluded_requests") + F.col("met") + F.col("missed") + F.col("pending")
    buckets = monthly.filter(F.col("created_requests") != states).select(
        F.lit("bucket").alias("check_name"),
        F.concat_ws(" | ", "owner_department", "sr_type", F.col("month_start").cast("string"))
        .alias("detail"),
        F.col("created_requests").alias("expected"),
        states.alias("actual"),
    )
    first, last = times.fiscal_year_bounds(settings.fiscal_year)
    staged = stg.filter(F.to_date("created_date").between(F.lit(first), F.lit(last))).agg(
        F.count(F.lit(1)).alias("n"))
    total = (
        monthly.agg(F.sum("created_requests").alias("actual"))
        .withColumn("expected", staged.scalar())
        .filter(F.col("expected") != F.col("actual"))
        .select(F.lit("fy_total").alias("check_name"), F.lit("all").alias("detail"),
                "expected", "actual")
    )
    return buckets.unionByName(total)


def running_total_breaks(volume: DataFrame, cohort: DataFrame) -> DataFrame:
    """Months whose published running total differs from one recomputed without a window. The
    self-join pairs the months of a year, of which there are twelve."""
    monthly = cohort.groupBy("fiscal_year", "fiscal_month").agg(F.count(F.lit(1)).alias("created"))
    earlier = monthly.select(
        "fiscal_year", F.col("fiscal_month").alias("month_up_to"), F.col("created").alias("n"))
    recomputed = (
        monthly.join(earlier, "fiscal_year")
        .filter(F.col("month_up_to") <= F.col("fiscal_month"))
        .groupBy("fiscal_year", "fiscal_month").agg(F.sum("n").alias("running_total"))
        .withColumnsRenamed({"fiscal_year": "r_year", "fiscal_month": "r_month"})
    )
    published = volume.select("fiscal_year", "fiscal_month", "created_running_total")
    both = published.join(
        recomputed,
        (F.col("r_year") == F.col("fiscal_year")) & (F.col("r_month") == F.col("fiscal_month")),
        "full_outer",
    )
    return both.filter(~F.col("created_running_total").eqNullSafe(F.col("running_total"))).select(
        "fiscal_year", "fiscal_month", "created_running_total", "running_total")


_MEASURES = ("created", "met", "missed", "pending", "excluded")


def quarter_breaks(monthly: DataFrame, cohort: DataFrame) -> DataFrame:
    """Years whose quarters do not sum to totals taken straight from the cohort, or are not four."""
    quarterly = monthly.groupBy("fiscal_year", "fiscal_quarter").agg(
        F.sum("created_requests").alias("created"), F.sum("met").alias("met"),
        F.sum("missed").alias("missed"), F.sum("pending").alias("pending"),
        F.sum("excluded_requests").alias("excluded"),
    )
    from_quarters = quarterly.groupBy("fiscal_year").agg(
        F.count(F.lit(1)).alias("quarters"), *[F.sum(m).alias(f"q_{m}") for m in _MEASURES])
    direct = cohort.groupBy("fiscal_year").agg(
        F.count(F.lit(1)).alias("created"),
        *[F.count_if(F.col("sla_state") == m).alias(m) for m in _MEASURES[1:]],
    )
    differs = F.col("quarters").isNull() | (F.col("quarters") != 4)
    for m in _MEASURES:
        differs = differs | (F.col(m) != F.col(f"q_{m}"))
    return direct.join(from_quarters, "fiscal_year", "left").filter(differs).select(
        "fiscal_year", "quarters", "created", F.col("q_created").alias("created_from_quarters"))


def version_breaks(
    portal_requests: DataFrame, portal_pulls: DataFrame, stg: DataFrame
) -> DataFrame:
    """A wrong staged row count, and one row per verified version newer than the staged one. The
    join is on a key that is unique on the staged side; AQE splits a request with very many
    versions."""
    versions = verified_versions(portal_requests, portal_pulls).select(
        "sr_number", "last_modified_date")
    distinct = versions.agg(F.count_distinct("sr_number").alias("n"))
    counted = (
        stg.agg(F.count(F.lit(1)).alias("actual"))
        .withColumn("expected", distinct.scalar())
        .filter(F.col("expected") != F.col("actual"))
        .select(F.lit("row_count").alias("check_name"), "expected", "actual")
    )
    kept = stg.select("sr_number", F.col("last_modified_date").alias("kept"))
    newer = (F.col("last_modified_date") > F.col("kept")) | (
        F.col("kept").isNull() & F.col("last_modified_date").isNotNull())
    dropped = versions.join(kept, "sr_number").filter(newer).select(
        F.lit("newer_version_dropped").alias("check_name"),
        F.lit(1).cast("long").alias("expected"),
        F.lit(0).cast("long").alias("actual"),
    )
    return counted.unionByName(dropped)


def backlog_breaks(weekly: DataFrame) -> DataFrame:
    """Weeks whose backlog is not the previous one plus opened minus closed."""
    weeks = Window.partitionBy("owner_department").orderBy("week_end")
    before = weekly.select(
        "owner_department", "week_end", "open_at_week_end", "opened_in_week", "closed_in_week",
        F.lag("open_at_week_end").over(weeks).alias("prev_open"))
    expected = (
        F.coalesce("prev_open", F.lit(0)) + F.col("opened_in_week") - F.col("closed_in_week"))
    return before.filter(F.col("open_at_week_end") != expected)


def closed_before_created(stg: DataFrame) -> DataFrame:
    return stg.filter(F.col("closed_date") < F.col("created_date")).select(
        "sr_number", "sr_type", "created_date", "closed_date")
