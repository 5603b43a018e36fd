from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from curbline.config import Settings
from curbline.operators import quality
from curbline.plans.build import build, project
from curbline.sources.calendar import fiscal_calendar
from test_extract import ledger, lookup, types, version, versions
from test_requests import request, table

CONF = Settings(fiscal_year=2026)
DOWNSTREAM = {
    "int_resolved_requests", "dim_request_category", "fct_sla_compliance",
    "accepted_values_dim_request_category_typical_urgency_label",
    "not_null_dim_request_category_service_code", "not_null_dim_request_category_service_name",
    "unique_dim_request_category_service_code", "not_null_fct_sla_compliance_department",
    "not_null_fct_sla_compliance_month", "not_null_fct_sla_compliance_service_code",
    "not_null_fct_sla_compliance_total_requests", "fct_sla_grain_unique", "sla_pct_between_0_and_1",
}


def sources(spark, renamed=False):
    key = "closed_datetime" if renamed else "updated_datetime"
    requests = table(spark, *[
        request(f"r{i}", raw_payload=f'{{"{key}":"2026-05-2{i}T22:00:00Z","group":"D"}}') for i in range(1, 5)])
    days = [date(2025, 10, 1) + timedelta(days=i) for i in range(365)]
    data = [version(f"s{i}", day=d, closed_date=datetime.combine(d, datetime.min.time()) + timedelta(hours=8 + i % 60),
                    last_modified_date=datetime(2026, 10, 1)) for i, d in enumerate(days[::9])]
    data.append(version("s0", "p2", day=days[0], pulled=datetime(2026, 11, 1), last_modified_date=datetime(2026, 10, 2)))
    return {
        "service_requests": requests,
        "portal_requests": versions(spark, *data),
        "portal_pulls": ledger(spark, *[("p1", d, "verified") for d in days], ("p2", days[0], "verified")),
        "portal_parent_lookup": lookup(spark, ("k", True, "x", None)),
        "portal_sr_types": types(spark),
        "fiscal_calendar": fiscal_calendar(spark, 2025, 2027),
    }


def test_there_are_45_checks(spark):
    models = project(CONF)
    names = [n for m in models for n in (*m.row_checks, *m.checks)]
    assert len(names) == len(set(names)) == 45


def test_clean_data_builds_green(spark):
    result = build(spark, sources(spark), CONF)
    assert result.named("fail") == set() and result.named("skipped") == set() and result.ok
    assert result.named("warn") == {"close_not_before_create"}
    report = result.report(spark)
    assert report.filter("kind = 'model'").count() == 12
    assert result.tables["fct_portal_sla_monthly"].count() == 12


def test_renamed_close_time_fails_and_skips_thirteen(spark):
    result = build(spark, sources(spark, renamed=True), CONF)
    assert not result.ok
    assert result.named("fail") == {"closed_requests_have_close_time"}
    assert result.named("skipped") == DOWNSTREAM and len(DOWNSTREAM) == 13


def test_published_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS marts_test")
    build(spark, sources(spark), CONF, database="marts_test")
    assert spark.table("marts_test.fct_sla_compliance").count() == 1
    assert spark.table("int_resolved_requests").count() == 4
    spark.sql("DROP DATABASE marts_test CASCADE")


def test_generic_checks(spark):
    df = spark.createDataFrame([("a", 0.5, "x"), ("a", 1.5, None), (None, None, "z"), (None, -0.1, "x")],
                               "k string, p double, v string")
    assert quality.duplicates(df, ["k"]).count() == 1
    assert quality.grain_duplicates(df, ["k"]).count() == 2
    counts = quality.count_bad_rows(df, {
        "null": quality.is_null("k"), "range": quality.outside_unit("p"),
        "values": quality.not_accepted("v", ("x",))}).head()
    assert tuple(counts) == (2, 2, 1)


def test_singular_checks_pass_and_fail(spark):
    tables = build(spark, sources(spark), CONF).tables
    monthly, cohort = tables["fct_portal_sla_monthly"], tables["int_portal_cohort"]
    stg, volume, weekly = (tables[n] for n in (
        "stg_portal_requests", "fct_portal_volume_monthly", "fct_portal_backlog_weekly"))
    off = monthly.withColumn("met", F.when(F.col("fiscal_month") == 1, F.col("met") + 1).otherwise(F.col("met")))
    assert quality.denominator_breaks(monthly, stg, CONF).count() == 0
    assert [r.check_name for r in quality.denominator_breaks(off, stg, CONF).collect()] == ["bucket"]
    assert [r.check_name for r in quality.denominator_breaks(monthly.filter("fiscal_month < 12"), stg, CONF).collect()] == ["fy_total"]
    assert quality.quarter_breaks(off, cohort).count() == 1
    assert quality.quarter_breaks(monthly.filter("fiscal_quarter < 4"), cohort).head().quarters == 3
    assert quality.running_total_breaks(volume.filter("fiscal_month <> 3"), cohort).count() == 1
    assert quality.running_total_breaks(volume, cohort.filter("fiscal_month <> 3")).count() == 10
    stale = stg.withColumn("last_modified_date", F.when(F.col("sr_number") != "s0", F.col("last_modified_date")))
    broken = quality.version_breaks(tables["portal_requests"], tables["portal_pulls"], stale.filter("sr_number <> 's1'"))
    kinds = [r.check_name for r in broken.collect()]
    assert kinds.count("row_count") == 1 and kinds.count("newer_version_dropped") == 2
    bumped = weekly.withColumn("open_at_week_end", F.when(
        F.col("week_end") == weekly.agg(F.max("week_end")).scalar(), 99).otherwise(F.col("open_at_week_end")))
    assert quality.backlog_breaks(weekly).count() == 0 and quality.backlog_breaks(bumped).count() == 1
    lost = tables["portal_pulls"].filter("partition_date <> date'2026-01-01'")
    assert [r.calendar_date for r in quality.uncovered_days(tables["fiscal_calendar"], lost, CONF).collect()] == [date(2026, 1, 1)]
    wrong = tables["portal_pulls"].withColumn("landed_count", F.when(F.col("pull_id") == "p1", 1).cast("long"))
    assert quality.unreconciled_partitions(tables["portal_pulls"]).count() == 0
    assert quality.unreconciled_partitions(wrong).count() == 1


@pytest.mark.parametrize("bad, fails", [(0, False), (1, False), (2, True)])
def test_tripwire_limit(spark, bad, fails):
    rows = [request(f"r{i}", raw_payload='{}' if i < bad else '{"updated_datetime":"2026-05-21T00:00:00Z"}') for i in range(100)]
    assert (quality.closed_without_close_time(table(spark, *rows)).count() == 1) is fails
    assert quality.closed_without_close_time(table(spark, request("o", status="open", raw_payload="{}"))).count() == 0


def test_a_model_that_raises_stops_only_what_depends_on_it(spark):
    models = {m.name: m for m in project(CONF)}

    def refuse(tables):
        raise RuntimeError("not today")

    models["dim_request_category"].make = refuse
    models["fct_portal_volume_monthly"].checks["raises"] = refuse
    models["fct_portal_backlog_weekly"].row_checks["breaks"] = F.col("absent") > 1
    result = build(spark, sources(spark), CONF, list(models.values()))
    assert not result.ok
    assert str(result.errors["dim_request_category"]) == "not today" and set(result.errors) >= {"raises", "breaks"}
    by_node = {n: (s, v) for n, _, _, v, s in result.outcome}
    assert by_node["dim_request_category"] == ("error", None) and by_node["raises"] == ("error", None)
    assert {n for n, (s, _) in by_node.items() if s == "skipped"} == DOWNSTREAM - {"int_resolved_requests", "dim_request_category"}
    assert by_node["fct_portal_sla_by_category"][0] == "built" and by_node["backlog_flow_identity"] == ("pass", 0)
    assert len(by_node) == 12 + 45 + 2
