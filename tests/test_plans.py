"""Properties of the physical plans that matter at scale."""

from curbline import schemas
from curbline.plans import extract, requests
from curbline.sources.calendar import fiscal_calendar
from test_extract import cohort, ledger, version, versions
from test_requests import request, table
from datetime import date


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_version_aggregates_before_the_shuffle(spark):
    text = plan(extract.stg_portal_requests(
        versions(spark, version("a")), ledger(spark, ("p1", date(2026, 3, 10), "verified"))))
    assert "partial_max_by" in text and "Window" not in text


def test_the_ledger_prunes_partitions(spark, tmp_path):
    path, book = str(tmp_path / "v"), str(tmp_path / "l")
    versions(spark, version("a"), version("b", "p2")).write.partitionBy("pull_id", "partition_date").parquet(path)
    ledger(spark, ("p1", date(2026, 3, 10), "verified")).write.parquet(book)
    text = plan(extract.verified_versions(spark.read.parquet(path), spark.read.parquet(book)).select("sr_number"))
    assert "dynamicpruning" in text
    assert "ReadSchema: struct<sr_number:string>" in text


def test_request_fact_reads_only_what_it_needs(spark, tmp_path):
    path = str(tmp_path / "r")
    table(spark, request("a")).write.parquet(path)
    stg = requests.stg_service_requests(spark.read.schema(schemas.SERVICE_REQUESTS).parquet(path))
    text = plan(requests.fct_sla_compliance(requests.int_resolved_requests(stg), requests.dim_request_category(stg)))
    for unused in ("address:", "lat:", "llm_reasoning:", "langfuse_trace_id:"):
        assert unused not in text
    assert "EqualTo(status,closed)" in text


def test_backlog_has_no_product_of_requests_and_weeks(spark):
    text = plan(extract.fct_portal_backlog_weekly(
        cohort(spark, version("a")), fiscal_calendar(spark, 2025, 2027)))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_models_hold_under_shuffle_joins_and_a_hot_key(spark, rows):
    """One parent, one type and one request hold most rows; nothing may be broadcast."""
    items = [version(f"c{i}", parent_sr_number="hot") for i in range(200)] + [version("hot")]
    items += [version("many", f"p{i:03d}", last_modified_date=None) for i in range(2, 150)]
    days = {(i["pull_id"], i["partition_date"]) for i in items}
    raw, book = versions(spark, *items), ledger(spark, *[(p, d, "verified") for p, d in days])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stg = extract.stg_portal_requests(raw, book)
        assert {r.sr_number: r.versions_seen for r in stg.collect()}["many"] == 148
        empty = spark.createDataFrame([], schemas.PARENT_LOOKUP)
        links = extract.int_portal_parent_links(stg, empty, hot_rows=50)
        assert rows(links.groupBy("parent_location").count()) == [("in_extract", 200)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
