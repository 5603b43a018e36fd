"""Report queries over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.config import UNKNOWN
from curbline.functions import values
from curbline.operators.ordered import weighted_median
from curbline.operators.sampling import every_nth_and_last

_BY_FY = ("created_requests", "excluded_requests", "met", "missed", "pending",
          "closed_requests", "closed_within_sla")


def sla_headline(service_requests: DataFrame, compliance: DataFrame) -> DataFrame:
    """One row: raw and rated requests, buckets, buckets with an SLA, pooled compliance."""
    fact = compliance.agg(
        F.count(F.lit(1)).alias("buckets"),
        F.count("sla_pct").alias("buckets_with_sla"),
        values.ratio(F.sum("closed_within_sla"), F.sum("classified_requests")).alias("pooled_sla_pct"),
    ).select(F.struct("*").alias("f"))
    raw = service_requests.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(F.col("urgency_label") != UNKNOWN).alias("classified_rows"),
    )
    return raw.withColumn("f", fact.scalar()).select("raw_rows", "classified_rows", "f.*")


def sla_by_service(
    compliance: DataFrame, categories: DataFrame, min_classified: int = 3
) -> DataFrame:
    """Per service name and usual tier: compliance and the request-weighted mean days to close."""
    tiers = categories.select("service_code", "typical_urgency_label")
    total = F.sum("total_requests")
    return (
        compliance.join(tiers, "service_code")
        .groupBy("service_name", "typical_urgency_label")
        .agg(
            F.sum("classified_requests").alias("classified"),
            values.ratio(F.sum("closed_within_sla"), F.sum("classified_requests")).alias("sla_pct"),
            (F.sum(F.col("avg_days_to_close") * F.col("total_requests")) / total)
            .alias("avg_days_to_close"),
        )
        .filter(F.col("classified") >= min_classified)
        .orderBy(F.col("sla_pct").desc_nulls_last(), F.col("classified").desc(),
                 F.col("service_name").asc_nulls_last())
    )


def fy_summary(monthly: DataFrame) -> DataFrame:
    """One row of year totals with closed-only and cohort compliance and their difference."""
    totals = monthly.agg(
        F.min("fiscal_year").alias("fiscal_year"), *[F.sum(c).alias(c) for c in _BY_FY])
    closed_only = values.ratio(F.col("closed_within_sla"), F.col("closed_requests"))
    whole = values.ratio(F.col("met"), F.col("met") + F.col("missed"))
    return totals.withColumns({
        "in_cohort": F.col("met") + F.col("missed") + F.col("pending"),
        "closed_only_sla_pct": closed_only,
        "cohort_sla_pct": whole,
        "bias_pct_points": F.lit(100.0) * (closed_only - whole),
    })


def exclusion_reasons(cohort: DataFrame) -> DataFrame:
    return (
        cohort.filter(F.col("sla_state") == "excluded")
        .groupBy("exclusion_reason").agg(F.count(F.lit(1)).alias("requests"))
        .orderBy(F.col("requests").desc(), F.col("exclusion_reason").asc_nulls_last())
    )


def top_bias(by_category: DataFrame, min_requests: int = 500, top: int = 15) -> DataFrame:
    """The categories whose closed-only figure flatters most. ``top`` is the report's length."""
    in_cohort = F.col("met") + F.col("missed") + F.col("pending")
    return (
        by_category.select(
            "sr_type", in_cohort.alias("cohort"), "pending", "closed_only_sla_pct",
            "cohort_sla_pct", "bias_pct_points")
        .filter(F.col("cohort") >= min_requests)
        .orderBy(F.col("bias_pct_points").desc_nulls_last(), F.col("sr_type").asc_nulls_last())
        .limit(top)
    )


def backlog_city(weekly: DataFrame, every: int = 4) -> DataFrame:
    """Citywide backlog at every n-th week end and at the last one."""
    city = weekly.groupBy("week_end").agg(
        F.sum("open_at_week_end").alias("open_at_week_end"),
        F.sum("opened_in_week").alias("opened_in_week"),
        F.sum("closed_in_week").alias("closed_in_week"),
    )
    return every_nth_and_last(city, "week_end", every)


def label_drift(requests: DataFrame, prompt_version: str | None = None) -> DataFrame:
    """Per service code and month: label mix, median and lowest score of rated requests.

    Requests are counted per distinct score first. The exact median is found by running sums of those
    counts, so neither a task nor a value map holds a group with very many scores.
    """
    rated = requests.filter(F.col("urgency_label") != UNKNOWN)
    if prompt_version is not None:
        rated = rated.filter(F.col("prompt_version") == prompt_version)
    counts = rated.groupBy(
        "service_code", F.date_trunc("month", "classified_at").cast("date").alias("month"),
        "urgency_label", "urgency_score",
    ).agg(F.count(F.lit(1)).alias("n"))
    mix = counts.groupBy("service_code", "month").agg(
        F.sum("n").alias("classified"),
        *[
            values.ratio(F.sum(F.when(F.col("urgency_label") == t, F.col("n")).otherwise(0)), F.sum("n"))
            .alias(f"{t.lower()}_share")
            for t in ("Critical", "High", "Medium", "Low")
        ],
        F.min("urgency_score").alias("min_score"),
    )
    median = weighted_median(counts, ["service_code", "month"], "urgency_score", "n", "label-drift").select(
        F.col("service_code").alias("_code"), F.col("month").alias("_month"), F.col("median").alias("median_score"))
    same = F.col("service_code").eqNullSafe(F.col("_code")) & F.col("month").eqNullSafe(F.col("_month"))
    return mix.join(median, same, "left").select(
        *[c for c in mix.columns if c != "min_score"], "median_score", "min_score")
