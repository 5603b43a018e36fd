"""Models over the enriched request table: closed requests, category dimension, SLA fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline import schemas
from curbline.config import DEFAULT, UNKNOWN, Settings
from curbline.functions import times, values
from curbline.operators.once import evaluate_once


def stg_service_requests(service_requests: DataFrame) -> DataFrame:
    return service_requests.filter(F.col("service_request_id").isNotNull()).select(
        schemas.SERVICE_REQUESTS.fieldNames()
    )


def int_resolved_requests(stg: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Closed requests with their close time; rows without one, or closing before they opened, go."""
    updated = times.utc_timestamp(values.json_text(F.col("raw_payload"), "updated_datetime"))
    closed = evaluate_once(stg.filter(F.col("status") == "closed"), {"updated_datetime": updated})
    elapsed = times.millis_between(F.col("requested_datetime"), F.col("updated_datetime"))
    hours = elapsed / F.lit(3600000.0)
    limit = values.threshold_hours(F.col("urgency_label"), settings)
    return closed.filter(F.col("updated_datetime") >= F.col("requested_datetime")).select(
        "service_request_id",
        "service_code",
        "service_name",
        "address",
        "lat",
        "lon",
        "city",
        "requested_datetime",
        "updated_datetime",
        hours.alias("hours_to_close"),
        (elapsed / F.lit(86400000.0)).alias("days_to_close"),
        "urgency_label",
        "urgency_score",
        "classified_at",
        values.json_text(F.col("raw_payload"), "group").alias("department"),
        limit.alias("sla_threshold_hours"),
        F.when(limit.isNotNull(), hours <= limit).alias("met_sla"),
    )


def dim_request_category(stg: DataFrame) -> DataFrame:
    """One row per service code with its usual tier (most rows, then the alphabetically first).

    One pass: rows are first counted per distinct (code, name, department, label), which combines
    on the map side; names, totals and the usual tier then come from those few counts. ``min``
    stands for "any value" so that a retry gives the same answer.
    """
    counts = (
        stg.filter(F.col("service_code").isNotNull())
        .select(
            "service_code",
            "service_name",
            values.json_text(F.col("raw_payload"), "group").alias("department"),
            "urgency_label",
        )
        .groupBy("service_code", "service_name", "department", "urgency_label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_label = counts.groupBy("service_code", "urgency_label").agg(
        F.min("service_name").alias("service_name"),
        F.min("department").alias("department"),
        F.sum("n").alias("n"),
    )
    rated = F.col("urgency_label").isNotNull() & (F.col("urgency_label") != UNKNOWN)
    usual = F.min(
        F.when(rated, F.struct((-F.col("n")).alias("rank"), F.col("urgency_label").alias("label"))))
    return per_label.groupBy("service_code").agg(
        F.min("service_name").alias("service_name"),
        F.min("department").alias("department"),
        F.coalesce(usual["label"], F.lit(UNKNOWN)).alias("typical_urgency_label"),
        F.sum("n").alias("total_observed"),
    )


def fct_sla_compliance(resolved: DataFrame, categories: DataFrame) -> DataFrame:
    """SLA by department, service code and month.

    Department and name belong to the code, so requests are aggregated to (code, month) before the
    category join: the join sees one row per code and month, never the request table.
    """
    rated = F.col("urgency_label").isNotNull() & (F.col("urgency_label") != UNKNOWN)
    monthly = (
        resolved.groupBy(
            "service_code", F.date_trunc("month", "requested_datetime").alias("month"))
        .agg(
            F.count(F.lit(1)).alias("total_requests"),
            F.count_if(rated).alias("classified_requests"),
            F.count_if("met_sla").alias("closed_within_sla"),
            F.avg("days_to_close").alias("avg_days_to_close"),
        )
    )
    names = categories.select("service_code", "service_name", "department")
    return monthly.join(names, "service_code", "left").select(
        F.coalesce("department", F.lit(UNKNOWN)).alias("department"),
        "service_code",
        "service_name",
        F.col("month").cast("timestamp_ntz").alias("month"),
        "total_requests",
        "classified_requests",
        "closed_within_sla",
        values.ratio(F.col("closed_within_sla"), F.col("classified_requests")).alias("sla_pct"),
        "avg_days_to_close",
    )
