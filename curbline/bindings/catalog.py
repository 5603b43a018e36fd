"""The registered queries: one callable per model, report, check or stream."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline import schemas
from curbline.bindings import inputs, landings, streams
from curbline.bindings.inputs import REQUEST_SETTINGS, SETTINGS
from curbline.config import TIERS, Settings
from curbline.functions import times, values
from curbline.operators import alerts, classify, quality, sampling, validate
from curbline.plans import evaluation, extract, reports, requests
from curbline.plans.build import build
from curbline.session import materialise
from curbline.sinks import pulls as pull_sink
from curbline.sinks import requests as request_sink
from curbline.sources import calendar as cal
from curbline.sources import files

Query = Callable[[SparkSession, str], DataFrame]
ALERTS = Settings(alert_window_seconds=3600, alert_threshold=5)
INTAKE_HOURS = 24.0 * 1500
MIN_COHORT = 5


# -- models over the extract -----------------------------------------------------------------

def _stg(spark: SparkSession, d: str) -> DataFrame:
    return extract.stg_portal_requests(inputs.portal_requests(spark, d), inputs.portal_pulls(spark, d))


def _cohort(spark: SparkSession, d: str) -> DataFrame:
    versions = inputs.portal_requests(spark, d)
    ledger = inputs.portal_pulls(spark, d)
    return extract.int_portal_cohort(
        extract.stg_portal_requests(versions, ledger), inputs.calendar(spark),
        inputs.sr_types(spark, d), SETTINGS,
        as_of_row=extract.as_of(extract.verified_versions(versions, ledger)),
    )


def _monthly(spark: SparkSession, d: str) -> DataFrame:
    return extract.fct_portal_sla_monthly(_cohort(spark, d))


def _by_category(spark: SparkSession, d: str) -> DataFrame:
    return extract.fct_portal_sla_by_category(_monthly(spark, d))


def _volume(spark: SparkSession, d: str) -> DataFrame:
    return extract.fct_portal_volume_monthly(_cohort(spark, d))


def _backlog(spark: SparkSession, d: str) -> DataFrame:
    return extract.fct_portal_backlog_weekly(_cohort(spark, d), inputs.calendar(spark))


def _parent_links(spark: SparkSession, d: str) -> DataFrame:
    return extract.int_portal_parent_links(
        materialise(_stg(spark, d), "stg"), inputs.parent_lookup(spark, d))


def _missing_parents(spark: SparkSession, d: str) -> DataFrame:
    """Missing parents resolved against the orders as the external table."""
    found_later = inputs.table(spark, d, "orders").select(
        F.concat(F.lit("SRX"), F.col("o_orderkey") % 500).alias("sr_number"), "o_orderpriority",
        "o_orderdate",
    ).filter(F.col("o_orderkey") % 7 == 0).groupBy("sr_number").agg(
        F.min("o_orderpriority").alias("sr_type"), F.min("o_orderdate").alias("created_date"))
    missing = extract.missing_parents(
        inputs.portal_requests(spark, d), inputs.portal_pulls(spark, d), inputs.parent_lookup(spark, d))
    return extract.resolve_parents(
        missing, files.lookup_by_ids(found_later, missing), F.lit("2001-11-22").cast("timestamp_ntz"))


def _span(spark: SparkSession, d: str) -> tuple[int, int]:
    day = F.to_date("o_orderdate")
    row = inputs.table(spark, d, "orders").agg(
        F.min(times.fiscal_year(day)).alias("lo"), F.max(times.fiscal_year(day)).alias("hi")).head()
    return row["lo"], row["hi"]


def _orders_per_day(spark: SparkSession, d: str, name: str) -> DataFrame:
    return inputs.table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias(name)).agg(
        F.count(F.lit(1)).alias("requests"))


def _fiscal_calendar(spark: SparkSession, d: str) -> DataFrame:
    """The calendar of every fiscal year that has orders, with the orders of each day."""
    days = cal.fiscal_calendar(inputs.prepare(spark), *_span(spark, d))
    return days.join(_orders_per_day(spark, d, "calendar_date"), "calendar_date", "left").withColumn(
        "requests", F.coalesce("requests", F.lit(0).cast("long")))


def _partition_plan(spark: SparkSession, d: str) -> DataFrame:
    """The last 90 days of the newest fiscal year that has orders, with what each day would land."""
    plan = cal.partition_plan(inputs.prepare(spark), fiscal_year=_span(spark, d)[1], last_days=90)
    return plan.join(_orders_per_day(spark, d, "partition_date"), "partition_date", "left").withColumn(
        "requests", F.coalesce("requests", F.lit(0).cast("long")))


def _pull_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Landed versions counted against a manifest, for every day either of them knows."""
    given = inputs.portal_pulls(spark, d)
    plan = given.select(
        "pull_id", "window_label", "partition_date", "where_clause", "started_at", "finished_at")
    manifest = given.select(
        "pull_id", "partition_date", "expected_count", "expected_count_after")
    return pull_sink.ledger(plan, inputs.portal_requests(spark, d), manifest)


def _fixture(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    types = inputs.sr_types(spark, d).filter(F.col("urgency_label") == "Critical")
    return pull_sink.fixture_tables(
        inputs.portal_requests(spark, d), inputs.portal_pulls(spark, d),
        inputs.parent_lookup(spark, d), types)


def _type_labels(spark: SparkSession, d: str) -> DataFrame:
    kinds = inputs.sr_types(spark, d)
    out = kinds.filter(~F.col("in_sla_scope")).select("sr_type", "scope_note")
    at = F.lit("2001-12-01").cast("timestamp_ntz")
    return classify.label_types(
        extract.type_inventory(inputs.portal_requests(spark, d)), out, "by_type", at,
        sr_types=kinds)


def _closed_at_intake(spark: SparkSession, d: str) -> DataFrame:
    return extract.closed_at_intake(_stg(spark, d), limit_hours=INTAKE_HOURS, share=0.5)


# -- models over the requests ----------------------------------------------------------------

def _stg_requests(spark: SparkSession, d: str) -> DataFrame:
    return requests.stg_service_requests(inputs.service_requests(spark, d))


def _resolved(spark: SparkSession, d: str) -> DataFrame:
    return requests.int_resolved_requests(_stg_requests(spark, d), REQUEST_SETTINGS)


def _categories(spark: SparkSession, d: str) -> DataFrame:
    return requests.dim_request_category(_stg_requests(spark, d))


def _compliance(spark: SparkSession, d: str) -> DataFrame:
    return requests.fct_sla_compliance(_resolved(spark, d), _categories(spark, d))


def _by_service(spark: SparkSession, d: str) -> DataFrame:
    categories = materialise(_categories(spark, d), "categories")
    fact = requests.fct_sla_compliance(_resolved(spark, d), categories)
    return _rounded(reports.sla_by_service(fact, categories), "avg_days_to_close")


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Means depend on the order of addition in their last digits; compare nine decimals."""
    return df.withColumns({n: F.round(n, 9) for n in names})


def _json_text(spark: SparkSession, d: str) -> DataFrame:
    return inputs.table(spark, d, "events").select(
        "event_id", values.json_text(F.col("props"), "k").alias("k"),
        values.json_text(F.col("props"), "absent").alias("absent"))


def _two_batches(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """A stored table, and a batch that repeats ids: two newer copies of a third of it, plus new rows."""
    rows = inputs.service_requests(spark, d)
    number = F.substring("service_request_id", 2, 20).cast("long")
    target = rows.filter(number % 4 != 0)
    again = rows.filter(number % 3 == 0).withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2))))
    hour = F.make_dt_interval(hours=F.col("_copy"))
    source = again.withColumns({
        "classified_at": F.col("classified_at") + hour,
        "urgency_label": F.when(F.col("_copy") == 2, "High").otherwise("Low"),
        "urgency_score": F.when(F.col("_copy") == 2, 0.9).otherwise(0.1),
    }).select(schemas.ENRICHED.fieldNames())
    return target, source


def _upsert(spark: SparkSession, d: str) -> DataFrame:
    target, source = _two_batches(spark, d)
    return request_sink.merged(target, source, F.lit("2024-06-01").cast("timestamp_ntz"))


def _unclassified_sample(spark: SparkSession, d: str) -> DataFrame:
    return files.fetch_unclassified(inputs.service_requests(spark, d), limit=100, sample_seed=7)


def _unclassified_oldest(spark: SparkSession, d: str) -> DataFrame:
    return files.fetch_unclassified(inputs.service_requests(spark, d), limit=100)


def _label_sheet(spark: SparkSession, d: str) -> DataFrame:
    rated = inputs.service_requests(spark, d).filter(F.col("urgency_label") != "Unknown")
    return sampling.label_sheet(rated, n=50, seed=20260923)


def _records(spark: SparkSession, d: str) -> DataFrame:
    feed = inputs.pages(spark, d)
    tagged = feed.select(F.struct("feed", "page").alias("page"), "value")
    return validate.feed_records(tagged).withColumn("feed", F.col("page.feed"))


def _drift(spark: SparkSession, d: str) -> DataFrame:
    feed = inputs.pages(spark, d)
    return validate.drift_tally(feed.select(F.struct("feed", "page").alias("page"), "value"),
                                by=["page.feed"])


def _rejects(spark: SparkSession, d: str) -> DataFrame:
    return validate.reject_counts(_records(spark, d), by=["feed"])


def _accepted(spark: SparkSession, d: str) -> DataFrame:
    return validate.accepted(_records(spark, d)).drop("raw_payload")


def _backfill(spark: SparkSession, d: str) -> DataFrame:
    """A bounded period of closed requests, wrapped as unrated rows."""
    from datetime import datetime

    window = files.backfill_window(
        inputs.pages(spark, d), datetime(2024, 1, 10), datetime(2024, 1, 20), status="closed")
    return validate.as_unclassified(window, F.lit("2024-02-01").cast("timestamp_ntz")).drop("raw_payload")


def _replayed(spark: SparkSession, d: str) -> DataFrame:
    """Requests labelled from a recording that lacks every fourth id and all unrated ones."""
    rows = inputs.service_requests(spark, d)
    number = F.substring("service_request_id", 2, 20).cast("long")
    recorded = rows.filter((number % 4 != 1) & (F.col("urgency_label") != "Unknown"))
    return classify.classify(rows.select(schemas.REQUEST.fieldNames()), "recorded", labels=recorded)


def _replay_good(spark: SparkSession, d: str) -> DataFrame:
    good, _ = classify.split(_replayed(spark, d))
    return good.select("service_request_id", "urgency_label", "urgency_score", "classified_at")


def _replay_missed(spark: SparkSession, d: str) -> DataFrame:
    _, failed = classify.split(_replayed(spark, d))
    return failed.select("service_request_id", "error_type", "error_message")


def _by_function(spark: SparkSession, d: str) -> DataFrame:
    """Requests labelled by a function that refuses every 101st for good and fails once on every 19th, in pieces of 500
    rows, two at a time. Every 23rd gets a label that isn't one."""
    met: set[int] = set()

    def rate(rows):
        numbers = [int(i[1:]) for i in rows["service_request_id"]]
        if any(n % 101 == 0 for n in numbers):
            raise ValueError("refused")
        shaky = {n for n in numbers if n % 19 == 0}
        if not shaky <= met:
            met.update(shaky)
            raise ConnectionError("try again")
        labels = ["Odd" if n % 23 == 0 else TIERS[n % len(TIERS)] for n in numbers]
        return pd.DataFrame({"urgency_label": labels, "urgency_score": [n % 100 / 100 for n in numbers], "llm_reasoning": [str(len(p)) for p in rows["prompt"]]})

    rows = inputs.service_requests(spark, d).select(schemas.REQUEST.fieldNames())
    at = F.lit("2024-03-01").cast("timestamp_ntz")
    labelled = classify.classify(rows, "function", fn=rate, at=at, workers=2, rows_a_call=500, attempts=2, seconds=60.0)
    good = F.col("error_type").isNull()
    return labelled.select("service_request_id", "error_type", F.when(~good & (F.col("error_type") != "LabelContract"), F.col("error_message")).alias("error_message"),
                           *[F.when(good, F.col(c)).alias(c) for c in ("urgency_label", "urgency_score", "classified_at")])


def _alerts(spark: SparkSession, d: str) -> DataFrame:
    inputs.prepare(spark)
    errors = inputs.table(spark, d, "events").filter(F.col("event_type") == "error")
    return alerts.dead_letter_rate(errors, "ts", settings=ALERTS)


def _lag(spark: SparkSession, d: str) -> DataFrame:
    """High marks and read positions per (type, user modulo 3); a quarter has not been read yet."""
    number = F.col("event_id")
    offsets = inputs.table(spark, d, "events").groupBy(
        F.col("event_type").alias("topic"), (F.col("user_id") % 3).cast("int").alias("partition"),
    ).agg(
        (F.max(number) + 1).alias("high"),
        F.max(F.when(F.col("user_id") % 4 != 0, number)).alias("position"),
    )
    return alerts.consumer_lag(offsets)


def _label_drift(spark: SparkSession, d: str) -> DataFrame:
    drift = reports.label_drift(inputs.service_requests(spark, d))
    return _rounded(drift, "median_score")


# -- evaluation -------------------------------------------------------------------------------

def _two_class_pairs(spark: SparkSession, d: str) -> DataFrame:
    def tier(name: str):
        return F.when(F.col(name) == 1, "High").otherwise("Low")

    return inputs.table(spark, d, "labels").select(
        "doc_id", tier("quality").alias("human"), tier("toxic").alias("model"))


def _category_counts(spark: SparkSession, d: str) -> DataFrame:
    """Category labels drawn from the categories themselves against the labels of their requests."""
    rows = inputs.service_requests(spark, d)
    kinds = (
        rows.groupBy("service_name").agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.col("service_name").alias("sr_type"),
            F.when(F.col("service_name") == "error", "Critical")
            .when(F.col("service_name") == "click", "Medium")
            .when(F.col("service_name") == "signup", "Medium").otherwise("High")
            .alias("urgency_label"))
    )
    return evaluation.category_counts(rows, kinds)


# -- checks on data that breaks them ---------------------------------------------------------

def _dq_not_null(spark: SparkSession, d: str) -> DataFrame:
    return quality.count_bad_rows(inputs.service_requests(spark, d), {
        "null_service_code": quality.is_null("service_code"),
        "null_urgency_label": quality.is_null("urgency_label"),
        "null_lon": quality.is_null("lon"),
        "null_status": quality.is_null("status"),
    })


def _dq_accepted(spark: SparkSession, d: str) -> DataFrame:
    return inputs.service_requests(spark, d).filter(
        quality.not_accepted("urgency_label", TIERS)).select("service_request_id", "urgency_label")


def _dq_ratio(spark: SparkSession, d: str) -> DataFrame:
    inflated = _compliance(spark, d).withColumn("sla_pct", F.col("sla_pct") * 1.5)
    return inflated.filter(quality.outside_unit("sla_pct")).select(
        "department", "service_code", "month", "sla_pct")


def _dq_denominators(spark: SparkSession, d: str) -> DataFrame:
    stg = materialise(_stg(spark, d), "stg")
    m = materialise(
        extract.fct_portal_sla_monthly(extract.int_portal_cohort(
            stg, inputs.calendar(spark), inputs.sr_types(spark, d), SETTINGS)), "monthly")
    miscounted = m.filter(F.col("fiscal_month") != 5).withColumn(
        "met", F.when(F.col("fiscal_month") == 3, F.col("met") + 1).otherwise(F.col("met")))
    return quality.denominator_breaks(miscounted, stg, SETTINGS)


def _dq_running_total(spark: SparkSession, d: str) -> DataFrame:
    c = materialise(_cohort(spark, d), "cohort")
    off = extract.fct_portal_volume_monthly(c).withColumn(
        "created_running_total",
        F.when(F.col("fiscal_month") == 4, F.col("created_running_total") + 1)
        .otherwise(F.col("created_running_total")))
    return quality.running_total_breaks(off.filter(F.col("fiscal_month") != 2), c)


def _dq_quarters(spark: SparkSession, d: str) -> DataFrame:
    c = materialise(_cohort(spark, d), "cohort")
    short = extract.fct_portal_sla_monthly(c).filter(F.col("fiscal_quarter") != 4)
    return quality.quarter_breaks(short, c)


def _dq_versions(spark: SparkSession, d: str) -> DataFrame:
    """Staging that kept an older stamp for some requests and lost those of one department."""
    versions = materialise(inputs.portal_requests(spark, d), "portal-requests")
    ledger = inputs.portal_pulls(spark, d)
    stg = materialise(extract.stg_portal_requests(versions, ledger), "stg")
    stale = stg.filter(F.coalesce(F.col("owner_department") != "Dept 1", F.lit(True))).withColumn(
        "last_modified_date",
        F.when(F.col("ward") < 5, F.col("last_modified_date") - F.make_dt_interval(days=F.lit(1)))
        .otherwise(F.col("last_modified_date")))
    return quality.version_breaks(versions, ledger, stale)


def _sources(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The raw tables, landed first as a pipeline would."""
    return {
        "service_requests": materialise(inputs.service_requests(spark, d), "service-requests"),
        "portal_requests": materialise(inputs.portal_requests(spark, d), "portal-requests"),
        "portal_pulls": inputs.portal_pulls(spark, d),
        "portal_parent_lookup": inputs.parent_lookup(spark, d),
        "portal_sr_types": inputs.sr_types(spark, d),
        "fiscal_calendar": inputs.calendar(spark),
    }


def _build_report(spark: SparkSession, d: str) -> DataFrame:
    """All models and checks. Checks this data breaks by design only warn, so nothing is skipped."""
    from curbline.plans.build import project

    models = project(SETTINGS)
    for m in models:
        m.warn_only = frozenset((*m.row_checks, *m.checks))
    return build(spark, _sources(spark, d), SETTINGS, models).report(spark)


RAISING, FAILING, RAISING_CHECK = (
    "dim_request_category", ("fct_portal_sla_monthly", "monthly_is_empty"), ("fct_portal_volume_monthly", "volume_raises"))


def _build_report_failed(spark: SparkSession, d: str) -> DataFrame:
    """The same build with a model that raises, a check that every row breaks, and a check that raises."""
    from curbline.plans.build import project

    def refuse(tables: dict[str, DataFrame]) -> DataFrame:
        raise RuntimeError("not today")

    models = {m.name: m for m in project(SETTINGS)}
    for m in models.values():
        m.warn_only = frozenset((*m.row_checks, *m.checks))
    models[RAISING].make = refuse
    models[FAILING[0]].row_checks[FAILING[1]] = F.lit(True)
    models[RAISING_CHECK[0]].checks[RAISING_CHECK[1]] = refuse
    return build(spark, _sources(spark, d), SETTINGS, list(models.values())).report(spark)


QUERIES: dict[str, Query] = {
    "fiscal_calendar": _fiscal_calendar,
    "partition_plan": _partition_plan,
    "stg_latest_version": _stg,
    "cohort_states": _cohort,
    "sla_monthly": _monthly,
    "sla_by_category": _by_category,
    "volume_running": _volume,
    "backlog_weekly": _backlog,
    "parent_links": _parent_links,
    "missing_parents": _missing_parents,
    "pull_ledger": _pull_ledger,
    "fixture_requests": lambda s, d: _fixture(s, d)["portal_requests"],
    "fixture_ledger": lambda s, d: _fixture(s, d)["portal_pulls"],
    "fixture_parents": lambda s, d: _fixture(s, d)["portal_parent_lookup"],
    "type_labels": _type_labels,
    "closed_at_intake": _closed_at_intake,
    "stg_requests": _stg_requests,
    "resolved_requests": _resolved,
    "category_dim": _categories,
    "sla_compliance": lambda s, d: _rounded(_compliance(s, d), "avg_days_to_close"),
    "sla_headline": lambda s, d: reports.sla_headline(inputs.service_requests(s, d), _compliance(s, d)),
    "sla_by_service": _by_service,
    "fy_summary": lambda s, d: reports.fy_summary(_monthly(s, d)),
    "exclusion_reasons": lambda s, d: reports.exclusion_reasons(_cohort(s, d)),
    "top_bias": lambda s, d: reports.top_bias(_by_category(s, d), MIN_COHORT, 10),
    "backlog_city": lambda s, d: reports.backlog_city(_backlog(s, d)),
    "label_drift": _label_drift,
    "upsert_result": _upsert,
    "unclassified_sample": _unclassified_sample,
    "unclassified_oldest": _unclassified_oldest,
    "classified": lambda s, d: files.fetch_classified(inputs.service_requests(s, d)),
    "label_sheet": _label_sheet,
    "json_text": _json_text,
    "drift_tally": _drift,
    "reject_reasons": _rejects,
    "accepted_requests": _accepted,
    "backfill_window": _backfill,
    "replay_classify": _replay_good,
    "replay_dead_letter": _replay_missed,
    "function_classify": _by_function,
    "dlq_rate_alerts": _alerts,
    "consumer_lag": _lag,
    "consumer_lag_total": lambda s, d: alerts.total_lag(_lag(s, d)),
    "kappa": lambda s, d: evaluation.agreement(inputs.pairs(s, d)),
    "kappa_two_class": lambda s, d: evaluation.agreement(_two_class_pairs(s, d)),
    "confusion": lambda s, d: evaluation.confusion(inputs.pairs(s, d)),
    "per_tier": lambda s, d: evaluation.per_tier(inputs.pairs(s, d)),
    "disagreements": lambda s, d: evaluation.disagreements(inputs.pairs(s, d)),
    "label_vs_category": _category_counts,
    "label_vs_category_total": lambda s, d: evaluation.category_agreement(_category_counts(s, d)),
    "dq_unique": lambda s, d: quality.duplicates(inputs.portal_requests(s, d), ["sr_number"]),
    "dq_not_null": _dq_not_null,
    "dq_accepted_values": _dq_accepted,
    "dq_grain_unique": lambda s, d: quality.grain_duplicates(_compliance(s, d), ["department", "month"]),
    "dq_ratio_range": _dq_ratio,
    "dq_close_time_tripwire": lambda s, d: quality.closed_without_close_time(
        _stg_requests(s, d), replace(REQUEST_SETTINGS, max_unparseable_close_time_pct=0.001)),
    "dq_partitions_reconcile": lambda s, d: quality.unreconciled_partitions(
        inputs.portal_pulls(s, d).withColumn("status", F.lit("verified"))),
    "dq_year_covered": lambda s, d: quality.uncovered_days(
        inputs.calendar(s), inputs.portal_pulls(s, d), SETTINGS),
    "dq_denominators": _dq_denominators,
    "dq_running_total": _dq_running_total,
    "dq_quarters": _dq_quarters,
    "dq_latest_version": _dq_versions,
    "dq_backlog_flow": lambda s, d: quality.backlog_breaks(_backlog(s, d)),
    "dq_close_before_create": lambda s, d: quality.closed_before_created(_stg(s, d)),
    "build_report": _build_report,
    "build_report_failed": _build_report_failed,
    "stream_upsert": streams.upserted,
    "stream_dead_letter": streams.dead_lettered,
    "stream_dedup": streams.polled_twice,
    "pull_landed": landings.landed,
    "pull_landed_ledger": landings.landed_ledger,
    "extract_pages": landings.pages_read_back,
    "extract_page_report": landings.page_report,
    "stream_replayed": streams.replayed,
    "stream_write_errors": streams.write_errors,
    "stream_progress": streams.progress,
    "stream_dedup_batches": streams.deduplicated,
    "stream_rate_alerts": streams.rate_alerts,
}
