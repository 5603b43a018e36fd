import threading
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from curbline import schemas
from curbline.bindings import inputs
from curbline.operators import classify, sampling
from curbline.plans import reports, requests
from curbline.sources import files

T0 = datetime(2026, 5, 20, 12)


def request(rid, **kw):
    base = dict.fromkeys(schemas.SERVICE_REQUESTS.fieldNames())
    base.update(service_request_id=rid, requested_datetime=T0, service_name="Pothole", service_code="c1",
                status="closed", address="1 Main", city="chicago", urgency_label="High", urgency_score=0.9,
                llm_reasoning="r", langfuse_trace_id="t", classified_at=T0, _inserted_at=T0,
                raw_payload='{"updated_datetime":"2026-05-20T22:00:00Z","group":"D1"}')
    base.update(kw)
    return base


def table(spark, *items):
    return spark.createDataFrame(list(items), schemas.SERVICE_REQUESTS)


def payload(text, group='"D1"'):
    return '{"updated_datetime":' + text + ',"group":' + group + "}"


def test_resolved_requests(spark):
    got = {r.service_request_id: r for r in requests.int_resolved_requests(table(
        spark, request("in"), request("late", raw_payload=payload('"2026-05-22T12:00:00Z"')),
        request("offset", raw_payload=payload('"2026-05-20T08:00:00-05:00"')),
        request("unknown", urgency_label="Unknown"), request("none", urgency_label=None),
        request("early", raw_payload=payload('"2026-05-20T11:59:59Z"')),
        request("word", raw_payload=payload('"yesterday"')), request("gone", raw_payload="{}"),
        request("broken", raw_payload="{"), request("open", status="open"),
        request("null-group", raw_payload=payload('"2026-05-20T12:00:00Z"', "null")))).collect()}
    assert set(got) == {"in", "late", "offset", "unknown", "none", "null-group"}
    assert (got["in"].hours_to_close, got["in"].met_sla, got["in"].department) == (10.0, True, "D1")
    assert (got["late"].days_to_close, got["late"].met_sla) == (2.0, False)
    assert got["offset"].hours_to_close == 1.0
    assert (got["unknown"].met_sla, got["none"].met_sla) == (None, None)
    assert got["null-group"].department is None


def test_category_takes_the_usual_label_and_breaks_ties_by_name(spark):
    stg = table(
        spark, *[request(f"a{i}", urgency_label=x) for i, x in enumerate(["Medium", "Low", "Medium", "Low", "Unknown", None])],
        request("b", service_code="c2", urgency_label="Unknown"), request("n", service_code=None),
        request("m", service_code="c3", service_name=None, raw_payload="{}"))
    got = {r.service_code: tuple(r)[1:] for r in requests.dim_request_category(stg).collect()}
    assert got == {"c1": ("Pothole", "D1", "Low", 6), "c2": ("Pothole", "D1", "Unknown", 1),
                   "c3": (None, None, "High", 1)}


def test_compliance_uses_the_department_of_the_code(spark):
    stg = table(
        spark, request("1"), request("2", raw_payload=payload('"2026-05-22T12:00:00Z"', '"D9"')),
        request("3", urgency_label="Unknown"), request("4", service_code="c2", raw_payload=payload('"2026-05-20T13:00:00Z"', "null"), urgency_label=None),
        request("5", service_code=None))
    fact = requests.fct_sla_compliance(
        requests.int_resolved_requests(stg), requests.dim_request_category(stg))
    got = {r.service_code: r for r in fact.collect()}
    assert (got["c1"].department, got["c1"].total_requests, got["c1"].classified_requests,
            got["c1"].closed_within_sla, got["c1"].sla_pct) == ("D1", 3, 2, 1, 0.5)
    assert got["c1"].month == datetime(2026, 5, 1)
    assert (got["c2"].department, got["c2"].sla_pct) == ("Unknown", None)
    assert (got[None].department, got[None].service_name) == ("Unknown", None)
    head = reports.sla_headline(stg, fact).head()
    assert (head.raw_rows, head.classified_rows, head.buckets, head.buckets_with_sla) == (5, 3, 3, 2)
    service = reports.sla_by_service(fact, requests.dim_request_category(stg), 2).collect()
    assert [(r.service_name, r.typical_urgency_label, r.classified) for r in service] == [("Pothole", "High", 2)]


def test_unclassified_orders_are_repeatable(spark):
    stored = table(spark, *[request(f"r{i}", urgency_label="Unknown", requested_datetime=datetime(2026, 1, 1 + (i * 7) % 20),
                                    service_name=None) for i in range(20)], request("done"))
    oldest = files.fetch_unclassified(stored, limit=3).collect()
    assert [r.requested_datetime.day for r in oldest] == [1, 2, 3] and oldest[0].service_name == ""
    a = [r[0] for r in files.fetch_unclassified(stored, limit=8, sample_seed=1).collect()]
    b = [r[0] for r in files.fetch_unclassified(stored.repartition(5), limit=8, sample_seed=1).collect()]
    c = [r[0] for r in files.fetch_unclassified(stored, limit=8, sample_seed=2).collect()]
    assert a == b and a != c
    assert files.fetch_unclassified(stored).count() == 20
    assert [r[0] for r in files.fetch_classified(stored).collect()] == ["done"]


def test_label_sheet_is_blind_and_seeded(spark):
    rated = table(spark, *[request(f"r{i}") for i in range(30)])
    sheet = sampling.label_sheet(rated, 10, 7).orderBy("item").collect()
    assert [r.item for r in sheet] == list(range(1, 11)) and sheet[0].human_label == ""
    assert "urgency_label" not in sheet[0].asDict()
    assert {r[1] for r in sheet} == {r[1] for r in sampling.label_sheet(rated.repartition(3), 10, 7).collect()}


def test_strategies(spark):
    rows = table(spark, request("1"), request("2", service_name="Tree"), request("3")).select(schemas.REQUEST.fieldNames())
    at = F.lit(T0)
    labels = table(spark, request("1", urgency_label="Low"), request("2", urgency_label="Bogus"))
    good, bad = classify.split(classify.classify(rows, "recorded", labels=labels))
    assert [(r.service_request_id, r.urgency_label) for r in good.collect()] == [("1", "Low")]
    assert {r.service_request_id: r.error_type for r in bad.collect()} == {"2": "LabelContract", "3": "ReplayMiss"}
    kinds = spark.createDataFrame([("Pothole", "P", True, "", "High", 0.8, "why", "v1", "")], schemas.SR_TYPES)
    good, bad = classify.split(classify.classify(rows, "by_type", sr_types=kinds, at=at))
    assert sorted(r.service_request_id for r in good.collect()) == ["1", "3"]
    assert [r.error_type for r in bad.collect()] == ["UnlabelledType"]
    ruled = classify.classify(
        rows, "rules", label=F.when(F.col("service_name") == "Tree", "Low"), score=F.lit(1.5) - 0.6,
        reasoning=F.lit("r"), at=at)
    assert {r.service_request_id: (r.urgency_label, r.error_type) for r in ruled.collect()} == {
        "1": (None, "LabelContract"), "2": ("Low", None), "3": (None, "LabelContract")}
    with pytest.raises(ValueError):
        classify.classify(rows, "psychic")


def test_function_strategy_isolates_failing_rows(spark):
    import pandas as pd

    def label(batch: pd.DataFrame) -> pd.DataFrame:
        if batch["prompt"].str.contains("Tree").any():
            raise RuntimeError("no trees")
        return pd.DataFrame({"urgency_label": "High", "urgency_score": 0.7, "llm_reasoning": "x"}, index=batch.index)

    rows = table(spark, request("1"), request("2", service_name="Tree"), request("3")).select(schemas.REQUEST.fieldNames())
    got = {r.service_request_id: r for r in classify.classify(rows.coalesce(1), "function", fn=label, at=F.lit(T0)).collect()}
    assert {k: (v.urgency_label, v.error_type) for k, v in got.items()} == {
        "1": ("High", None), "2": (None, "RuntimeError"), "3": ("High", None)}
    assert got["1"].classified_at == T0 and len(got["1"].langfuse_trace_id) == 32


def test_type_labels(spark):
    inventory = spark.createDataFrame([("Pothole", "P"), ("Info", "I"), ("New", None)], "sr_type string, sr_short_code string")
    out = spark.createDataFrame([("Info", "closed at intake")], "sr_type string, scope_note string")
    kinds = spark.createDataFrame([("Pothole", "P", True, "", "High", 0.853, "why", "v1", "")], schemas.SR_TYPES)
    got = {r.sr_type: r for r in classify.label_types(inventory, out, "by_type", F.lit(T0), sr_types=kinds).collect()}
    assert (got["Pothole"].urgency_label, got["Pothole"].urgency_score, got["Pothole"].classified_at) == ("High", 0.85, "2026-05-20T12:00:00Z")
    assert (got["Info"].in_sla_scope, got["Info"].urgency_label, got["Info"].scope_note) == (False, None, "closed at intake")
    assert (got["New"].in_sla_scope, got["New"].urgency_label, got["New"].sr_short_code) == (True, None, "")


def test_label_drift(spark):
    rated = table(spark, *[request(f"{i}", urgency_label=x, urgency_score=s) for i, (x, s) in enumerate(
        [("High", 0.9), ("High", 0.5), ("Low", 0.7), ("Low", 0.8), ("Unknown", 0.0)])])
    row = reports.label_drift(rated).head()
    assert (row.classified, row.high_share, row.low_share, row.critical_share) == (4, 0.5, 0.5, 0.0)
    assert row.median_score == pytest.approx(0.75) and row.min_score == 0.5


def test_label_drift_medians_equal_a_sort(spark):
    import random
    from statistics import median

    rng = random.Random(3)
    items = [(rng.choice(["a", "b", None]), rng.choice([0.1, 0.2, 0.35, 0.5, rng.random()])) for _ in range(400)] + [("z", 0.4), ("n", None)]
    rated = table(spark, *[request(f"{i}", service_code=c, urgency_score=s) for i, (c, s) in enumerate(items)])
    found = {r.service_code: r.median_score for r in reports.label_drift(rated.repartition(5)).collect()}
    by_code = {}
    for c, s in items:
        by_code.setdefault(c, []).append(s)
    assert found.keys() == by_code.keys()
    for c, scores in by_code.items():
        want = None if scores == [None] else median(scores)
        assert found[c] == (want if want is None else pytest.approx(want, abs=1e-12))


def test_median_of_a_group_of_a_million_values(spark):
    from curbline.operators.ordered import weighted_median

    counts = spark.range(1_000_000).selectExpr("'g' as g", "cast(id * 7919 % 1000003 as double) as x", "id % 3 + 1 as n")
    values = [(i * 7919 % 1_000_003, i % 3 + 1) for i in range(1_000_000)]
    total, seen, middle = sum(n for _, n in values), 0, []
    for x, n in sorted(values):
        if seen <= (total - 1) // 2 < seen + n or seen <= total // 2 < seen + n:
            middle.append(x)
        seen += n
    found = weighted_median(counts, ["g"], "x", "n", "big").collect()
    assert [(r.g, r.median) for r in found] == [("g", (middle[0] + middle[-1]) / 2)]


def test_function_strategy_retries_times_out_and_halves(spark):
    """One row answers at the second attempt only, one never in time, one answers too many rows."""
    import time

    import pandas as pd

    met = set()

    def label(batch: pd.DataFrame) -> pd.DataFrame:
        ids = set(batch["service_request_id"])
        if "3" in ids and "3" not in met:
            met.add("3")
            raise ConnectionError("once")
        if "5" in ids:
            time.sleep(3)
        times = 2 if "7" in ids else 1
        return pd.concat([pd.DataFrame({"urgency_label": "Low", "urgency_score": 0.5, "llm_reasoning": "x"}, index=batch.index)] * times)

    rows = table(spark, *[request(str(k)) for k in range(9)]).select(schemas.REQUEST.fieldNames()).coalesce(1)
    got = {r.service_request_id: r.error_type for r in classify.classify(
        rows, "function", fn=label, at=F.lit(T0), workers=3, rows_a_call=4, attempts=2, seconds=0.5).collect()}
    assert got == {str(k): {5: "TimeoutError", 7: "ValueError"}.get(k) for k in range(9)}
    assert classify.classify(rows.limit(0), "function", fn=label, at=F.lit(T0)).collect() == []


def test_calls_with_a_limit_share_a_thread_until_one_overruns():
    idents = [classify.within(5.0, threading.get_ident) for _ in range(20)]
    assert len(set(idents)) == 1 and idents[0] != threading.get_ident()
    with pytest.raises(ZeroDivisionError):
        classify.within(5.0, lambda: 1 / 0)
    with pytest.raises(TimeoutError):
        classify.within(0.05, time.sleep, 0.4)
    assert classify.within(5.0, lambda: "in time") == "in time"


def test_requests_and_pages_are_built_on_all_cores(spark, tmp_path):
    """The events are one file, which is one task."""
    rows = "id as event_id, timestamp_ntz '2024-01-01 00:00:00' as ts, id as user_id, 'error' as event_type, 1.0d as value, '' as props"
    spark.range(400).selectExpr(*rows.split(", ")).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    for made in (inputs.service_requests, inputs.pages):
        sizes = made(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) == spark.sparkContext.defaultParallelism > 1 and sum(r["count"] for r in sizes) == 400
