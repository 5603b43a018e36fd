import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbline import schemas
from curbline.bindings import landings
from curbline.config import Settings
from curbline.operators.latest import latest_per_key
from curbline.operators.skew import spread_left_join
from curbline.plans import extract, reports
from curbline.sources.calendar import fiscal_calendar

CONF = Settings(fiscal_year=2026)
AT = datetime(2026, 10, 1, 6)


def version(sr, pull="p1", day=date(2026, 3, 10), pulled=AT, **kw):
    base = dict.fromkeys(schemas.PORTAL_REQUESTS.fieldNames())
    created = datetime.combine(day, datetime.min.time()) + timedelta(hours=10)
    base.update(pull_id=pull, pulled_at=pulled, partition_date=day, sr_number=sr, sr_type="Pothole",
                owner_department="CDOT", status="Open", created_date=created,
                last_modified_date=created + timedelta(hours=1), duplicate=False, legacy_record=False,
                parent_sr_number="")
    base.update(kw)
    return base


def versions(spark, *items):
    return spark.createDataFrame(list(items), schemas.PORTAL_REQUESTS)


def ledger(spark, *items):
    data = [(p, "w", d, "x", 1, 1, 1, s, AT, AT) for p, d, s in items]
    return spark.createDataFrame(data, schemas.PORTAL_PULLS)


def types(spark):
    data = [("Pothole", "P", True, "", "High", 0.8, "", "v1", ""),
            ("Info", "I", False, "closed at intake", None, None, None, "v1", ""),
            ("Odd", "O", True, "", "Unknown", None, None, "v1", "")]
    return spark.createDataFrame(data, schemas.SR_TYPES)


def staged(spark, *items):
    days = {(i["pull_id"], i["partition_date"]) for i in items}
    return extract.stg_portal_requests(
        versions(spark, *items), ledger(spark, *[(p, d, "verified") for p, d in days]))


def cohort(spark, *items):
    return extract.int_portal_cohort(
        staged(spark, *items), fiscal_calendar(spark, 2025, 2027), types(spark), CONF)


def test_latest_version_order(spark):
    later = AT + timedelta(days=1)
    newer = datetime(2026, 4, 1)
    got = {r.sr_number: r for r in staged(
        spark,
        version("changed"), version("changed", "p2", pulled=later, last_modified_date=newer, status="Completed"),
        version("stale", last_modified_date=newer), version("stale", "p2", pulled=later),
        version("same"), version("same", "p2", pulled=later),
        version("tie"), version("tie", "p9"),
        version("unknown", "p2", pulled=later, last_modified_date=None), version("unknown"),
        version("only-null", last_modified_date=None, parent_sr_number="P"),
    ).collect()}
    assert {k: v.latest_pull_id for k, v in got.items()} == {
        "changed": "p2", "stale": "p1", "same": "p2", "tie": "p9", "unknown": "p1", "only-null": "p1"}
    assert got["changed"].status == "Completed" and got["changed"].versions_seen == 2
    assert got["same"].parent_sr_number is None and got["only-null"].parent_sr_number == "P"


def test_unverified_partitions_are_never_read(spark):
    day, other = date(2026, 3, 10), date(2026, 3, 11)
    got = extract.stg_portal_requests(
        versions(spark, version("a"), version("b", day=other), version("b", "p2", day=other)),
        ledger(spark, ("p1", day, "verified"), ("p1", other, "count_mismatch"), ("p2", other, "failed")))
    assert [r.sr_number for r in got.collect()] == ["a"]


def test_latest_per_key_equals_a_ranking(spark):
    rng = random.Random(5)
    data = [(rng.randrange(20), rng.choice([None, 1, 2, 3]), i) for i in range(400)]
    df = spark.createDataFrame(data, "k int, a int, b int").repartition(7)
    best = {}
    for k, a, b in data:
        rank = (-1 if a is None else a, b)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, a, b))
    got = latest_per_key(df, ["k"], ["a", "b"], order_is_total=True).collect()
    assert sorted(tuple(r) for r in got) == sorted(v for _, v in best.values())
    tied = latest_per_key(df, ["k"], ["a"])
    assert sorted(tied.collect()) == sorted(latest_per_key(df.repartition(3), ["k"], ["a"]).collect())


def test_cohort_states(spark):
    t0 = datetime(2026, 3, 10, 10)

    def closed(sr, hours, **kw):
        return version(sr, closed_date=t0 + timedelta(hours=hours), status="Completed", **kw)

    rows = {r.sr_number: r for r in cohort(
        spark,
        closed("met", 24), closed("missed", 24.001), closed("negative", -0.5),
        version("open-late"), closed("type", 1, sr_type="Info"), closed("odd", 1, sr_type="Odd"),
        closed("new-type", 1, sr_type="Never seen"), closed("dup", 1, duplicate=True),
        closed("dup-unknown", 1, duplicate=None), version("canceled", status="Canceled"),
        version("no-status", status=None, duplicate=None),
        version("young", day=date(2026, 3, 20)), version("last", day=date(2026, 3, 20), last_modified_date=datetime(2026, 3, 21, 9)),
        version("old", day=date(2025, 9, 30)), version("next", day=date(2026, 10, 1), last_modified_date=t0),
    ).collect()}
    assert {k: (v.sla_state, v.exclusion_reason, v.closed_within_sla) for k, v in rows.items()} == {
        "met": ("met", None, True), "missed": ("missed", None, False), "negative": ("met", None, True),
        "open-late": ("missed", None, None), "type": ("excluded", "out_of_scope", None),
        "odd": ("excluded", "out_of_scope", None), "new-type": ("excluded", "out_of_scope", None),
        "dup": ("excluded", "duplicate", None), "dup-unknown": ("met", None, True),
        "canceled": ("excluded", "canceled", None), "no-status": ("missed", None, None),
        "young": ("pending", None, None), "last": ("pending", None, None)}
    assert rows["young"].as_of_ts == datetime(2026, 3, 21, 9)
    assert rows["negative"].hours_to_close == -0.5
    assert rows["new-type"].in_sla_scope is False


def test_as_of_covers_requests_outside_the_year(spark):
    got = cohort(spark, version("a"), version("b", day=date(2024, 1, 1), last_modified_date=datetime(2027, 1, 1)))
    assert [r.as_of_ts for r in got.collect()] == [datetime(2027, 1, 1)]


def random_cohort(spark, seed, n=120):
    rng = random.Random(seed)
    items = []
    for i in range(n):
        day = date(2025, 10, 1) + timedelta(days=rng.randrange(0, 150))
        created = datetime.combine(day, datetime.min.time()) + timedelta(hours=rng.randrange(24))
        closed = created + timedelta(hours=rng.randrange(-400, 2000)) if rng.random() < 0.7 else None
        items.append(version(
            f"s{i}", day=day, created_date=created, closed_date=closed,
            owner_department=rng.choice(["A", "B", None]), duplicate=rng.random() < 0.1,
            sr_type=rng.choice(["Pothole", "Pothole", "Info"]),
            last_modified_date=created + timedelta(days=rng.randrange(30))))
    return cohort(spark, *items)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_backlog_equals_the_range_join(spark, rows, seed):
    frame = random_cohort(spark, seed)
    calendar = fiscal_calendar(spark, 2025, 2027)
    kept = [(r.owner_department or "Unknown", r.created_day, r.closed_date.date() if r.closed_date else None)
            for r in frame.filter("sla_state <> 'excluded'").collect()]
    as_of = frame.head().as_of_ts.date()
    weeks = sorted({(r.week_start, r.week_end) for r in calendar.collect()
                    if min(k[1] for k in kept) <= r.week_end <= as_of})
    expected = []
    for dept in sorted({k[0] for k in kept}):
        for start, end in weeks:
            mine = [k for k in kept if k[0] == dept and k[1] <= end]
            expected.append((
                dept, start, end, sum(c is None or c > end for _, _, c in mine),
                sum(start <= o <= end for _, o, _ in mine),
                sum(c is not None and start <= c <= end for _, _, c in mine)))
    got = extract.fct_portal_backlog_weekly(frame, calendar)
    assert rows(got) == sorted(expected, key=repr)


def test_backlog_of_nothing_is_empty(spark):
    empty = cohort(spark, version("a", sr_type="Info"))
    assert extract.fct_portal_backlog_weekly(empty, fiscal_calendar(spark, 2025, 2027)).count() == 0


@pytest.mark.parametrize("seed", [4, 5])
def test_marts_partition_the_cohort(spark, seed):
    frame = random_cohort(spark, seed)
    monthly = extract.fct_portal_sla_monthly(frame)
    total = monthly.agg(F.sum("created_requests"), F.sum(
        F.col("excluded_requests") + F.col("met") + F.col("missed") + F.col("pending"))).head()
    assert total[0] == total[1] == frame.count()
    by_type = extract.fct_portal_sla_by_category(monthly).collect()
    assert [r.sr_type for r in by_type] == ["Pothole"]
    volume = extract.fct_portal_volume_monthly(frame).orderBy("fiscal_month").collect()
    assert [r.created_running_total for r in volume] == list(np.cumsum([r.created_requests for r in volume]))
    summary = reports.fy_summary(monthly).head()
    assert summary.in_cohort == summary.met + summary.missed + summary.pending


def test_rates_are_null_without_a_base(spark):
    m = extract.fct_portal_sla_monthly(cohort(spark, version("a", sr_type="Info"), version("b", day=date(2026, 3, 10), last_modified_date=datetime(2026, 3, 10, 11))))
    got = {r.sr_type: (r.closed_only_sla_pct, r.cohort_sla_pct, r.bias_pct_points) for r in m.collect()}
    assert got == {"Info": (None, None, None), "Pothole": (None, None, None)}
    assert extract.fct_portal_sla_by_category(m).head().sr_type == "Pothole"


def lookup(spark, *data):
    return spark.createDataFrame([(*d, AT) for d in data], schemas.PARENT_LOOKUP)


@pytest.mark.parametrize("hot_rows", [2_000_000, 3])
def test_parent_locations(spark, hot_rows):
    children = [version(f"c{i}", parent_sr_number="hot") for i in range(10)]
    links = extract.int_portal_parent_links(
        staged(spark, version("hot", sr_type="Info"), *children,
               version("x", parent_sr_number="out"), version("y", parent_sr_number="gone"),
               version("z", parent_sr_number="never")),
        lookup(spark, ("out", True, "Pothole", AT), ("gone", False, None, None)), hot_rows)
    got = {r.sr_number: (r.parent_location, r.parent_sr_type) for r in links.collect()}
    assert got == {**{f"c{i}": ("in_extract", "Info") for i in range(10)},
                   "x": ("outside_window", "Pothole"), "y": ("not_found", None), "z": ("not_looked_up", None)}


def test_spread_join_equals_a_plain_join(spark, rows):
    left = spark.createDataFrame(
        [(i, "hot" if i % 3 else f"k{i}") for i in range(300)] + [(-1, None)], "id int, k string")
    right = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", 3)], "k string, v int")
    got = spread_left_join(left, right, "k", "id", hot_rows=20)
    assert rows(got, "id", "k", "v") == rows(left.join(right, "k", "left"), "id", "k", "v")


def test_missing_parents_and_resolution(spark, rows):
    day, bad = date(2026, 3, 10), date(2026, 3, 11)
    raw = versions(
        spark, version("a", parent_sr_number="b"), version("b", parent_sr_number="m1"),
        version("c", day=bad, parent_sr_number="m2"), version("d", parent_sr_number="c"),
        version("e", parent_sr_number="known"), version("f", parent_sr_number=""))
    pulls = ledger(spark, ("p1", day, "verified"), ("p1", bad, "count_mismatch"))
    missing = extract.missing_parents(raw, pulls, lookup(spark, ("known", False, None, None)))
    assert rows(missing) == [("c",), ("m1",), ("m2",)]
    external = spark.createDataFrame([("m1", "Pothole", AT), ("other", "x", AT)], "sr_number string, sr_type string, created_date timestamp_ntz")
    new = extract.resolve_parents(missing, external, F.lit(AT))
    assert rows(new, "sr_number", "found", "sr_type") == [("c", False, None), ("m1", True, "Pothole"), ("m2", False, None)]
    assert tuple(extract.resolution_counts(new).head()) == (3, 1)


@pytest.mark.parametrize("seed", range(4))
def test_closed_at_intake_equals_the_percentile(spark, seed):
    rng = np.random.default_rng(seed)
    data, expected = [], {}
    for kind in range(12):
        seconds = rng.integers(0, 900, size=int(rng.integers(1, 25)))
        seconds[: int(len(seconds) * 0.9)] //= rng.choice([1, 3])
        expected[f"t{kind}"] = bool(np.quantile(seconds / 3600.0, 0.9) <= 0.1)
        data += [(f"t{kind}", AT, AT + timedelta(seconds=int(s))) for s in seconds]
    data += [("open", AT, None)]
    df = spark.createDataFrame(data, "sr_type string, created_date timestamp_ntz, closed_date timestamp_ntz")
    got = {r.sr_type: r.closed_at_intake for r in extract.closed_at_intake(df).collect()}
    assert got == expected


def test_reports(spark):
    data = [("a", 600, 1.0), ("b", 700, None), ("c", 800, 5.0), ("d", 10, 99.0)]
    marts = spark.createDataFrame(data, "sr_type string, met long, bias_pct_points double").selectExpr(
        "*", "0L as missed", "0L as pending", "0.5D as closed_only_sla_pct", "0.4D as cohort_sla_pct")
    assert [r.sr_type for r in reports.top_bias(marts, 500, 2).collect()] == ["c", "a"]
    weeks = spark.range(10).selectExpr("date_add(date'2026-01-04', cast(id * 7 as int)) as week_end",
                                       "id as open_at_week_end", "0L as opened_in_week", "0L as closed_in_week")
    assert sorted(r.open_at_week_end for r in reports.backlog_city(weeks).collect()) == [0, 4, 8, 9]


def test_marking_versions_shuffles_days_only(spark, tmp_path):
    """Rows are marked by their days, as verified_versions takes them, without a shuffle of the rows."""
    rows = spark.createDataFrame(
        [("p1", d, f"s{d}{k}") for d in range(4) for k in range(3)] + [("p2", 0, "s00")], "pull_id string, partition_date int, sr_number string")
    rows.write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    states = [("p1", 0, "verified"), ("p1", 0, "verified"), ("p1", 1, "failed"), ("p1", 2, "verified"), ("p2", 1, "verified")]
    ledger = spark.createDataFrame(states, "pull_id string, partition_date int, status string")
    ledger.write.parquet(f"{tmp_path}/ledger")
    ledger = spark.read.parquet(f"{tmp_path}/ledger")
    marked = extract.marked_versions(rows, ledger)
    taken = {tuple(r) for r in extract.verified_versions(rows, ledger).select(rows.columns).collect()}
    found = [tuple(r) for r in marked.collect()]
    assert len(found) == 13 and {r[:3] for r in found if r[3]} == taken and len(taken) == 6
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Join" in line and "sr_number" in line]


def test_the_landed_query_marks_without_a_join_on_versions(spark):
    plan = landings.landed(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and not [line for line in joins if "sr_number" in line]
