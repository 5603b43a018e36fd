"""Models over the versioned extract: latest versions, cohort states, marts, parent links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbline import schemas
from curbline.config import DEFAULT, UNKNOWN, Settings
from curbline.functions import times, values
from curbline.operators.latest import latest_per_key
from curbline.operators.skew import spread_left_join
from curbline.session import materialise

LATEST_COLUMNS = (
    "sr_number", "sr_type", "sr_short_code", "owner_department", "status", "origin",
    "created_date", "last_modified_date", "closed_date", "duplicate", "legacy_record",
    "parent_sr_number", "ward", "community_area",
)


def verified_versions(portal_requests: DataFrame, portal_pulls: DataFrame) -> DataFrame:
    """Versions of partitions whose counts reconciled; the table is partitioned by the join keys,
    so the ledger also prunes what is read. A day that the ledger names twice counts once."""
    good = portal_pulls.filter(F.col("status") == "verified").select("pull_id", "partition_date")
    return portal_requests.join(good, ["pull_id", "partition_date"], "left_semi")


def marked_versions(portal_requests: DataFrame, portal_pulls: DataFrame) -> DataFrame:
    """Every version, and in ``verified`` whether :func:`verified_versions` takes it. Days decide, so the versions
    themselves aren't shuffled."""
    good = portal_pulls.filter(F.col("status") == "verified").select("pull_id", "partition_date").distinct()
    marked = portal_requests.join(good.withColumn("verified", F.lit(True)), ["pull_id", "partition_date"], "left")
    return marked.select(*portal_requests.columns, F.coalesce("verified", F.lit(False)).alias("verified"))


def stg_portal_requests(portal_requests: DataFrame, portal_pulls: DataFrame) -> DataFrame:
    """The latest verified version of each request: last change, then pull time, then pull id."""
    versions = verified_versions(portal_requests, portal_pulls).select(
        *LATEST_COLUMNS, "pull_id", "pulled_at"
    )
    latest = latest_per_key(
        versions,
        keys=["sr_number"],
        order=["last_modified_date", "pulled_at", "pull_id"],
        extra=[F.count(F.lit(1)).alias("versions_seen")],
        order_is_total=True,
    )
    parent = F.col("parent_sr_number")
    return latest.withColumn("parent_sr_number", F.when(parent != "", parent)).select(
        *LATEST_COLUMNS,
        F.col("pull_id").alias("latest_pull_id"),
        F.col("pulled_at").alias("latest_pulled_at"),
        "versions_seen",
    )


def as_of(versions: DataFrame) -> DataFrame:
    """The newest change stamp as one row. Each request keeps its newest version, so this gives
    the same value on the staged table and on all verified versions, where it needs no shuffle."""
    return versions.agg(F.max("last_modified_date").alias("as_of_ts"))


def int_portal_cohort(
    stg: DataFrame,
    calendar: DataFrame,
    sr_types: DataFrame,
    settings: Settings = DEFAULT,
    as_of_row: DataFrame | None = None,
) -> DataFrame:
    """Every request created in the fiscal year, with tier, limit, SLA state and exclusion reason."""
    as_of_row = as_of(stg) if as_of_row is None else as_of_row
    year = calendar.filter(F.col("fiscal_year") == settings.fiscal_year).select(
        F.col("calendar_date").alias("created_day"),
        "fiscal_year", "fiscal_quarter", "fiscal_month", "month_start", "week_start",
    )
    first, last = times.fiscal_year_bounds(settings.fiscal_year)
    day = F.to_date("created_date")
    tiers = sr_types.select("sr_type", "in_sla_scope", "urgency_label")
    cohort = (
        stg.filter(day.between(F.lit(first), F.lit(last)))
        .withColumn("created_day", day)
        .join(year, "created_day")
        .join(tiers, "sr_type", "left")
        .withColumn("as_of_ts", as_of_row.select("as_of_ts").scalar())
        .select(
            "sr_number", "sr_type", "owner_department", "status", "created_date", "closed_date",
            "duplicate", "parent_sr_number", "created_day", "fiscal_year", "fiscal_quarter",
            "fiscal_month", "month_start", "week_start",
            F.coalesce("in_sla_scope", F.lit(False)).alias("in_sla_scope"),
            "urgency_label",
            values.threshold_hours(F.col("urgency_label"), settings).alias("sla_threshold_hours"),
            times.hours_between(F.col("created_date"), F.col("closed_date")).alias("hours_to_close"),
            times.hours_between(F.col("created_date"), F.col("as_of_ts")).alias("hours_open_at_as_of"),
            "as_of_ts",
        )
    )
    # An unknown duplicate flag leaves the OR unknown, so such a row is not excluded.
    limit = F.col("sla_threshold_hours")
    no_sla = ~F.col("in_sla_scope") | limit.isNull()
    canceled = F.col("status") == "Canceled"
    excluded = no_sla | F.col("duplicate") | canceled
    closed = F.col("closed_date").isNotNull()
    in_time = F.col("hours_to_close") <= limit
    return cohort.withColumns({
        "exclusion_reason": F.when(no_sla, "out_of_scope")
        .when(F.col("duplicate"), "duplicate")
        .when(canceled, "canceled"),
        "sla_state": F.when(excluded, "excluded")
        .when(closed & in_time, "met")
        .when(closed, "missed")
        .when(F.col("hours_open_at_as_of") > limit, "missed")
        .otherwise("pending"),
        "closed_within_sla": F.when(excluded, F.lit(None)).when(closed, in_time),
    })


def _with_rates(counts: DataFrame) -> DataFrame:
    closed_only = values.ratio(F.col("closed_within_sla"), F.col("closed_requests"))
    whole = values.ratio(F.col("met"), F.col("met") + F.col("missed"))
    return counts.withColumns({
        "closed_only_sla_pct": closed_only,
        "cohort_sla_pct": whole,
        "bias_pct_points": F.lit(100.0) * (closed_only - whole),
    })


def fct_portal_sla_monthly(cohort: DataFrame) -> DataFrame:
    """Closed-only against whole-cohort compliance per department, type and fiscal month."""
    state, on_time = F.col("sla_state"), F.col("closed_within_sla")
    counts = cohort.groupBy(
        F.coalesce("owner_department", F.lit(UNKNOWN)).alias("owner_department"),
        "sr_type", "fiscal_year", "fiscal_quarter", "fiscal_month", "month_start",
    ).agg(
        F.count(F.lit(1)).alias("created_requests"),
        F.count_if(state == "excluded").alias("excluded_requests"),
        F.count_if(state == "met").alias("met"),
        F.count_if(state == "missed").alias("missed"),
        F.count_if(state == "pending").alias("pending"),
        F.count(on_time).alias("closed_requests"),
        F.count_if(on_time).alias("closed_within_sla"),
    )
    return _with_rates(counts)


_COUNTS = ("created_requests", "excluded_requests", "met", "missed", "pending",
           "closed_requests", "closed_within_sla")


def fct_portal_sla_by_category(monthly: DataFrame) -> DataFrame:
    """The year per type, re-aggregated from the monthly mart so that the two cannot disagree."""
    totals = monthly.groupBy("sr_type", "fiscal_year").agg(
        F.max("owner_department").alias("owner_department"),
        *[F.sum(c).alias(c) for c in _COUNTS],
    )
    in_cohort = totals.filter(F.col("met") + F.col("missed") + F.col("pending") > 0)
    return _with_rates(in_cohort.select("sr_type", "owner_department", "fiscal_year", *_COUNTS))


def fct_portal_volume_monthly(cohort: DataFrame) -> DataFrame:
    """Created requests per fiscal month with a running total; twelve rows per year reach the window."""
    monthly = cohort.groupBy("fiscal_year", "fiscal_quarter", "fiscal_month", "month_start").agg(
        F.count(F.lit(1)).alias("created_requests"),
        F.count_if(F.col("sla_state") != "excluded").alias("in_scope_requests"),
    )
    so_far = (
        Window.partitionBy("fiscal_year").orderBy("fiscal_month")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return monthly.withColumn("created_running_total", F.sum("created_requests").over(so_far))


def fct_portal_backlog_weekly(cohort: DataFrame, calendar: DataFrame) -> DataFrame:
    """Open, opened and closed requests per department and ended week.

    Joining each request to every week it stays open would multiply the cohort by the weeks. Here
    the cohort is read once and counted per (department, week created, week closed); each count
    adds to one week and leaves in another, and a running sum over a department's weeks gives the
    backlog. A request closed in a week before the one it was created in is never open, and that
    close is not counted.
    """
    counts = materialise(
        cohort.filter(F.col("sla_state") != "excluded")
        .groupBy(
            F.coalesce("owner_department", F.lit(UNKNOWN)).alias("owner_department"),
            times.week_end(F.col("created_day")).alias("created_week"),
            times.week_end(F.to_date("closed_date")).alias("closed_week"),
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max(F.to_date("as_of_ts")).alias("as_of_day"),
        ),
        "backlog-counts",
    )
    first = counts.agg(F.min("created_week").alias("first_week"))
    last = calendar.filter(
        F.col("week_end") <= counts.agg(F.max("as_of_day")).scalar()
    ).agg(F.max("week_end").alias("last_week"))

    arrives = F.struct(
        F.col("created_week").alias("week_end"),
        F.col("n").alias("opened"),
        F.lit(0).cast("long").alias("closed"),
        F.when(F.col("closed_week") < F.col("created_week"), 0).otherwise(F.col("n")).alias("change"),
    )
    leaves = F.struct(
        F.col("closed_week").alias("week_end"),
        F.lit(0).cast("long").alias("opened"),
        F.col("n").alias("closed"),
        (-F.col("n")).alias("change"),
    )
    moves = F.when(F.col("closed_week") >= F.col("created_week"), F.array(arrives, leaves)).otherwise(
        F.array(arrives))
    flows = (
        counts.select("owner_department", F.explode(moves).alias("m"))
        .groupBy("owner_department", F.col("m.week_end").alias("week_end"))
        .agg(
            F.sum("m.opened").alias("opened"),
            F.sum("m.closed").alias("closed"),
            F.sum("m.change").alias("change"),
        )
    )
    bounds = counts.select("owner_department").distinct().select(
        "owner_department", first.scalar().alias("lo"), last.scalar().alias("hi"))
    grid = bounds.filter(F.col("lo") <= F.col("hi")).select(
        "owner_department",
        F.explode(F.sequence("lo", "hi", F.make_dt_interval(days=F.lit(7)))).alias("week_end"))
    to_date = (
        Window.partitionBy("owner_department").orderBy("week_end")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    zero = F.lit(0).cast("long")
    return grid.join(flows, ["owner_department", "week_end"], "left").select(
        "owner_department",
        F.date_sub("week_end", 6).alias("week_start"),
        "week_end",
        F.sum(F.coalesce("change", zero)).over(to_date).alias("open_at_week_end"),
        F.coalesce("opened", zero).alias("opened_in_week"),
        F.coalesce("closed", zero).alias("closed_in_week"),
    )


def int_portal_parent_links(
    stg: DataFrame, parent_lookup: DataFrame, hot_rows: int = 2_000_000
) -> DataFrame:
    """Requests naming a parent, and where the parent was found.

    The distinct parents are resolved first, so both lookups join on a unique key; only then are
    the children attached, with a parent that many children share split over several tasks.
    """
    children = stg.filter(F.col("parent_sr_number").isNotNull()).select(
        "sr_number", "sr_type", "created_date", "duplicate", "parent_sr_number"
    )
    extract = stg.select(
        F.col("sr_number").alias("parent_sr_number"),
        F.lit(True).alias("in_extract"),
        F.col("created_date").alias("p_created"),
        F.col("sr_type").alias("p_type"),
    )
    looked_up = parent_lookup.select(
        F.col("sr_number").alias("parent_sr_number"),
        F.lit(True).alias("was_looked_up"),
        "found",
        F.col("created_date").alias("l_created"),
        F.col("sr_type").alias("l_type"),
    )
    resolved = (
        children.select("parent_sr_number").distinct()
        .join(extract, "parent_sr_number", "left")
        .join(looked_up, "parent_sr_number", "left")
        .select(
            "parent_sr_number",
            F.coalesce("p_created", "l_created").alias("parent_created_date"),
            F.coalesce("p_type", "l_type").alias("parent_sr_type"),
            F.when(F.col("in_extract"), "in_extract")
            .when(F.col("found"), "outside_window")
            .when(F.col("was_looked_up"), "not_found")
            .otherwise("not_looked_up").alias("parent_location"),
        )
    )
    linked = spread_left_join(children, resolved, "parent_sr_number", "sr_number", hot_rows)
    return linked.select(
        "sr_number", "sr_type", "created_date", "duplicate", "parent_sr_number",
        "parent_created_date", "parent_sr_type", "parent_location",
    )


def missing_parents(
    portal_requests: DataFrame, portal_pulls: DataFrame, parent_lookup: DataFrame
) -> DataFrame:
    """Parents named by any landed version that are neither in a verified pull nor looked up yet."""
    named = portal_requests.filter(F.col("parent_sr_number") != "").select(
        F.col("parent_sr_number").alias("sr_number")).distinct()
    landed = verified_versions(portal_requests, portal_pulls).select("sr_number").distinct()
    return named.join(landed, "sr_number", "left_anti").join(
        parent_lookup.select("sr_number"), "sr_number", "left_anti")


def resolve_parents(missing: DataFrame, external: DataFrame, at) -> DataFrame:
    """New lookup rows for the missing parents, from an external table of (sr_number, sr_type,
    created_date); an id it does not hold is recorded as not found."""
    known = external.select(
        "sr_number", "sr_type", "created_date", F.lit(True).alias("found"))
    return missing.join(known, "sr_number", "left").select(
        "sr_number",
        F.coalesce("found", F.lit(False)).alias("found"),
        "sr_type",
        F.col("created_date").cast("timestamp_ntz").alias("created_date"),
        at.cast("timestamp_ntz").alias("looked_up_at"),
    ).select(schemas.PARENT_LOOKUP.fieldNames())


def resolution_counts(resolved: DataFrame) -> DataFrame:
    return resolved.agg(
        F.count(F.lit(1)).alias("looked_up"), F.count_if("found").alias("found"))


def type_inventory(portal_requests: DataFrame) -> DataFrame:
    """The distinct types with one short code each, counted first so the reduction is map-side."""
    return (
        portal_requests.filter(F.col("sr_type").isNotNull())
        .groupBy("sr_type", "sr_short_code").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("sr_type").agg(F.min("sr_short_code").alias("sr_short_code"))
    )


def closed_at_intake(
    requests: DataFrame, limit_hours: float = 0.1, share: float = 0.9
) -> DataFrame:
    """Types whose ``share`` percentile of hours to close is at most ``limit_hours`` (exact).

    The percentile interpolates between two ranks, so it is decided by how many values are within
    the limit and, if the limit falls between those ranks, by the nearest value on either side.
    Four plain aggregates carry that; no type's values are gathered.
    """
    hours = times.hours_between(F.col("created_date"), F.col("closed_date"))
    stats = (
        requests.select("sr_type", hours.alias("h")).filter(F.col("h").isNotNull())
        .groupBy("sr_type")
        .agg(
            F.count(F.lit(1)).alias("closed_requests"),
            F.count_if(F.col("h") <= limit_hours).alias("within_limit"),
            F.max(F.when(F.col("h") <= limit_hours, F.col("h"))).alias("below"),
            F.min(F.when(F.col("h") > limit_hours, F.col("h"))).alias("above"),
        )
    )
    position = F.lit(share) * (F.col("closed_requests") - 1)
    rank = F.floor(position)
    between = F.col("below") + (position - rank) * (F.col("above") - F.col("below"))
    return stats.withColumn(
        "closed_at_intake",
        F.when(F.col("within_limit") >= rank + 2, True)
        .when(F.col("within_limit") == F.col("closed_requests"), True)
        .when(F.col("within_limit") <= rank, False)
        .otherwise(between <= limit_hours),
    ).select("sr_type", "closed_requests", "within_limit", "closed_at_intake")
