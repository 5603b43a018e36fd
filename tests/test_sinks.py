import json
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from curbline import schemas
from curbline.operators import sampling
from curbline.plans import extract
from curbline.sinks import pulls, requests
from curbline.sources import calendar, files
from test_extract import lookup, types, version, versions, ledger
from test_requests import T0, request, table

DAY = date(2026, 3, 10)


def enriched(spark, *items):
    return table(spark, *items).select(schemas.ENRICHED.fieldNames())


def state(t):
    return {r.service_request_id: (r.urgency_label, r._inserted_at) for r in t.collect()}


def test_upsert_table(spark, tmp_path):
    t = requests.RequestTable(spark, str(tmp_path / "t"))
    one, two = (datetime(2026, 6, d, tzinfo=timezone.utc) for d in (1, 2))
    first, second = (datetime(2026, 6, d) for d in (1, 2))
    t.upsert(enriched(spark, request("a"), request("b")), "m1", merged_at=one)
    t.upsert(enriched(spark, request("b", urgency_label="Low"), request("c")), "m2", merged_at=two)
    want = {"a": ("High", first), "b": ("Low", first), "c": ("High", second)}
    assert state(t.current()) == want
    t.upsert(enriched(spark, request("b", urgency_label="Low"), request("c")), "m2", merged_at=two)
    assert state(t.current()) == want
    later = request("c", urgency_label="Critical", classified_at=T0 + timedelta(hours=1))
    t.upsert(enriched(spark, later, request("c", urgency_label="Medium")), "m3", merged_at=two)
    assert state(t.current())["c"] == ("Critical", second)
    compact = t.rewrite_to(str(tmp_path / "t2"))
    assert state(compact.current()) == state(t.current())
    assert t.current().columns == schemas.SERVICE_REQUESTS.fieldNames()


def test_merged_frames(spark):
    old = table(spark, request("a", _inserted_at=T0), request("b", _inserted_at=None))
    new = enriched(spark, request("b", urgency_label="Low"), request("c"),
                   request("c", urgency_label="Medium", classified_at=T0 + timedelta(hours=1)))
    at = datetime(2026, 7, 1)
    want = {"a": ("High", T0), "b": ("Low", None), "c": ("Medium", at)}
    once = requests.merged(old, new, F.lit(at))
    assert state(once) == want
    assert state(requests.merged(once, new.repartition(3), F.lit(at))) == want
    assert state(requests.merged(old, new.limit(0), F.lit(at))) == {"a": ("High", T0), "b": ("High", None)}


def test_publish_and_export_round_trip(spark, tmp_path):
    rows = table(spark, request("b", raw_payload='{"x": [1, 2]}', lat=41.5), request("a"), request("u", urgency_label="Unknown"))
    sent = {bytes(r.key).decode(): json.loads(bytes(r.value)) for r in requests.publish_messages(rows).collect()}
    assert sent["b"]["raw_payload"] == {"x": [1, 2]} and sent["b"]["lat"] == 41.5
    assert not any(k.startswith(("urgency", "llm")) for k in sent["b"])
    out = str(tmp_path / "recorded")
    requests.export_classified(rows, out)
    back = files.read_recorded_labels(spark, out).orderBy("service_request_id").collect()
    assert [(r.service_request_id, r.urgency_label, r.classified_at) for r in back] == [
        ("a", "High", T0), ("b", "High", T0)]
    assert json.loads(back[1].raw_payload) == {"x": [1, 2]}


def test_recorded_labels_skip_blank_lines_and_keep_the_newest(spark, tmp_path):
    path = tmp_path / "r.jsonl"
    line = '{"service_request_id":"a","urgency_label":"%s","classified_at":"%s"}'
    path.write_text(line % ("Low", "2026-05-02T00:00:00Z") + "\n\n" + line % ("High", "2026-05-01T00:00:00Z") + "\n")
    assert [r.urgency_label for r in files.read_recorded_labels(spark, str(path)).collect()] == ["Low"]


def test_label_sheet_refuses_to_overwrite(spark, tmp_path):
    sheet = sampling.label_sheet(table(spark, *[request(f"r{i}") for i in range(5)]), 3)
    out = str(tmp_path / "sheet")
    requests.write_label_sheet(sheet, out)
    with pytest.raises(Exception, match="(?i)already exists"):
        requests.write_label_sheet(sheet, out)
    requests.write_label_sheet(sheet, out, force=True)
    assert spark.read.option("header", True).csv(out).count() == 3


HEADER = ",".join(f'"{c}"' for c in schemas.EXTRACT_TYPES)


def page(root, day, *rows):
    folder = root / f"partition_date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    lines = [HEADER] + [",".join('"' + str(r.get(c, "")).replace('"', '""') + '"' for c in schemas.EXTRACT_TYPES) for r in rows]
    (folder / f"page{len(list(folder.iterdir()))}.csv").write_text("\n".join(lines) + "\n")


def csv_row(n, day, **kw):
    base = {"sr_number": f"SR{n}", "sr_type": 'Pothole "deep", wide', "status": "Open", "created_date": f"{day}T10:00:00.000",
            "last_modified_date": f"{day}T11:00:00.000", "duplicate": "false", "legacy_record": "true",
            "ward": "27.5", "latitude": "x", "community_area": ""}
    return {**base, **kw}


def pull(spark, root, target, expected, pull_id="p1"):
    plan = calendar.partition_plan(spark, start=DAY, end=DAY + timedelta(days=2), label="t")
    manifest = spark.createDataFrame(
        [(DAY + timedelta(days=i), a, b) for i, (a, b) in enumerate(expected)],
        "partition_date date, expected_count long, expected_count_after long")
    return pulls.portal_pull(spark, files.portal_days(spark, str(root)), plan, manifest, str(target), pull_id, T0)


def read(spark, target, name):
    return spark.read.parquet(f"{target}/{name}")


def test_pull_verifies_every_day(spark, tmp_path):
    page(tmp_path / "in", DAY, csv_row(1, DAY), csv_row(2, DAY))
    page(tmp_path / "in", DAY, csv_row(3, DAY))
    page(tmp_path / "in", DAY + timedelta(days=1), csv_row(4, DAY))
    page(tmp_path / "in", DAY + timedelta(days=9), csv_row(5, DAY))
    record = pull(spark, tmp_path / "in", tmp_path / "out", [(3, 3), (1, 1), (0, 0)])
    assert sorted((r.partition_date.day, r.landed_count, r.status) for r in record.collect()) == [
        (10, 3, "verified"), (11, 1, "verified"), (12, 0, "verified")]
    landed = read(spark, tmp_path / "out", "portal_requests")
    assert landed.count() == 4
    row = landed.filter("sr_number = 'SR1'").head()
    assert (row.ward, row.latitude, row.community_area, row.legacy_record, row.sr_type) == (
        28, None, None, True, 'Pothole "deep", wide')
    assert row.created_date == datetime(2026, 3, 10, 10)


def test_a_repeated_pull_replaces_its_days(spark, tmp_path):
    page(tmp_path / "in", DAY, csv_row(1, DAY), csv_row(2, DAY))
    for name in ("p1", "p1", "p2"):
        pull(spark, tmp_path / "in", tmp_path / "out", [(2, 2), (0, 0), (0, 0)], name)
    tables = [read(spark, tmp_path / "out", t) for t in ("portal_requests", "portal_pulls")]
    assert tables[0].count() == 4
    assert extract.verified_versions(*tables).count() == 4


def test_pull_mismatch_is_recorded_then_raised(spark, tmp_path):
    page(tmp_path / "in", DAY, csv_row(1, DAY))
    page(tmp_path / "in", DAY + timedelta(days=1), csv_row(2, DAY))
    with pytest.raises(pulls.CountMismatch, match="2026-03-10"):
        pull(spark, tmp_path / "in", tmp_path / "out", [(2, 2), (1, 1), (0, 0)])
    assert {r.partition_date.day: r.status for r in read(spark, tmp_path / "out", "portal_pulls").collect()} == {
        10: "count_mismatch", 11: "verified", 12: "verified"}


def test_pull_with_a_repeated_key_fails_that_day(spark, tmp_path):
    page(tmp_path / "in", DAY, csv_row(1, DAY), csv_row(1, DAY))
    page(tmp_path / "in", DAY + timedelta(days=1), csv_row(2, DAY))
    with pytest.raises(pulls.DuplicateKey):
        pull(spark, tmp_path / "in", tmp_path / "out", [(2, 2), (1, 1), (0, 0)])
    assert {r.partition_date.day: r.status for r in read(spark, tmp_path / "out", "portal_pulls").collect()} == {
        10: "failed", 11: "verified", 12: "verified"}


def test_lookup_upsert(spark, rows):
    old = lookup(spark, ("a", False, None, None), ("b", False, None, None))
    new = lookup(spark, ("b", True, "x", None), ("c", False, None, None))
    assert rows(pulls.upsert_parent_lookup(old, new), "sr_number", "found") == [("a", False), ("b", True), ("c", False)]


def test_fixture_round_trip(spark, tmp_path, rows):
    other = DAY + timedelta(days=1)
    raw = versions(spark, version("a", parent_sr_number="k"), version("b", sr_type="Info"), version("c", day=other))
    led = ledger(spark, ("p1", DAY, "verified"), ("p1", other, "failed"), ("p2", DAY, "verified"))
    found = lookup(spark, ("k", True, "x", T0), ("z", False, None, None))
    kept = types(spark).filter("sr_type = 'Pothole'")
    pulls.export_fixture(pulls.fixture_tables(raw, led, found, kept), str(tmp_path / "fx"))
    files.load_extract_fixture(spark, str(tmp_path / "fx"), str(tmp_path / "raw"))
    assert rows(read(spark, tmp_path / "raw", "portal_requests"), "sr_number", "created_date") == [
        ("a", datetime(2026, 3, 10, 10))]
    assert rows(read(spark, tmp_path / "raw", "portal_pulls"), "pull_id", "landed_count", "status") == [
        ("p1", 1, "verified"), ("p2", 0, "verified")]
    assert rows(read(spark, tmp_path / "raw", "portal_parent_lookup"), "sr_number") == [("k",)]


def test_catalog_tables(spark):
    requests.create_tables(spark, "raw_test")
    requests.create_tables(spark, "raw_test")
    assert spark.table("raw_test.service_requests").schema.fieldNames() == schemas.SERVICE_REQUESTS.fieldNames()
    spark.sql("DROP DATABASE raw_test CASCADE")


def test_classify_pending_does_what_is_left(spark, tmp_path):
    from curbline.plans.pending import classify_pending

    t = requests.RequestTable(spark, str(tmp_path / "t"))
    t.upsert(enriched(spark, request("a", urgency_label="Unknown"), request("b", urgency_label="Unknown", service_name="Tree"),
                      request("c")), "m1")
    rules = {"label": F.when(F.col("service_name") == "Pothole", "Low"), "score": F.lit(0.5),
             "reasoning": F.lit("rule"), "at": F.lit(T0)}
    assert classify_pending(t, "m2", "rules", **rules) == {"classified": 1, "failed": 1}
    assert {k: v[0] for k, v in state(t.current()).items()} == {"a": "Low", "b": "Unknown", "c": "High"}
    assert classify_pending(t, "m3", "rules", **rules) == {"classified": 0, "failed": 1}
    rules["label"] = F.lit("Medium")
    assert classify_pending(t, "m4", "rules", limit=5, sample_seed=1, **rules) == {"classified": 1, "failed": 0}
    assert state(t.current())["b"][0] == "Medium"


def landed(spark, target):
    """Versions per day, and the ledger per day."""
    rows, ledger_rows = pulls.landed_requests(spark, str(target)), pulls.landed_ledger(spark, str(target))
    days = {}
    for r in rows.collect():
        days.setdefault((r.pull_id, r.partition_date.day), []).append(r.sr_number)
    found = ledger_rows.collect()
    states = {(r.pull_id, r.partition_date.day): (r.status, r.expected_count, r.landed_count) for r in found}
    assert len(states) == len(found)
    taken = sorted(r.sr_number for r in extract.verified_versions(rows, ledger_rows).collect())
    return {k: sorted(v) for k, v in days.items()}, states, taken


def test_a_repeated_pull_empties_and_downgrades_days(spark, tmp_path):
    """Under an id of digits, and one that file systems escape, beside a pull that stays as it is."""
    two = DAY + timedelta(days=1)
    page(tmp_path / "one", DAY, csv_row(1, DAY), csv_row(2, DAY))
    page(tmp_path / "one", two, csv_row(3, DAY))
    page(tmp_path / "two", DAY, csv_row(1, DAY))
    pull(spark, tmp_path / "one", tmp_path / "out", [(2, 2), (1, 1), (0, 0)], "other")
    for name in ("20260310", "a:b c"):
        pull(spark, tmp_path / "one", tmp_path / "out", [(2, 2), (1, 1), (0, 0)], name)
        with pytest.raises(pulls.CountMismatch, match="2026-03-10"):
            pull(spark, tmp_path / "two", tmp_path / "out", [(2, 2), (0, 0), (0, 0)], name)
        days, states, taken = landed(spark, tmp_path / "out")
        assert {k: v for k, v in days.items() if k[0] == name} == {(name, 10): ["SR1"]}
        assert {k[1]: v for k, v in states.items() if k[0] == name} == {
            10: ("count_mismatch", 2, 1), 11: ("verified", 0, 0), 12: ("verified", 0, 0)}
        assert taken == ["SR1", "SR2", "SR3"]
    assert days[("other", 10)] == ["SR1", "SR2"] and states[("other", 11)] == ("verified", 1, 1)
    pull(spark, tmp_path / "one", tmp_path / "out", [(2, 2), (1, 1), (0, 0)], "a:b c")
    assert landed(spark, tmp_path / "out")[2] == sorted(["SR1", "SR2", "SR3"] * 2)


def test_a_failed_day_loses_its_rows_and_has_no_counts(spark, tmp_path):
    page(tmp_path / "one", DAY, csv_row(1, DAY))
    page(tmp_path / "two", DAY, csv_row(1, DAY), csv_row(1, DAY))
    pull(spark, tmp_path / "one", tmp_path / "out", [(1, 1), (0, 0), (0, 0)])
    with pytest.raises(pulls.DuplicateKey):
        pull(spark, tmp_path / "two", tmp_path / "out", [(2, 2), (0, 0), (0, 0)])
    days, states, taken = landed(spark, tmp_path / "out")
    assert days == {} and taken == [] and states[("p1", 10)] == ("failed", None, None)


def test_a_source_that_breaks_leaves_failed_days(spark, tmp_path):
    page(tmp_path / "one", DAY, csv_row(1, DAY))
    pull(spark, tmp_path / "one", tmp_path / "out", [(1, 1), (0, 0), (0, 0)])
    plan = calendar.partition_plan(spark, start=DAY, end=DAY, label="t")
    broken = files.portal_days(spark, str(tmp_path / "one")).withColumn("sr_type", F.raise_error(F.lit("gone")).cast("string"))
    manifest = spark.createDataFrame([(DAY, 1, 1)], "partition_date date, expected_count long, expected_count_after long")
    with pytest.raises(Exception, match="gone"):
        pulls.portal_pull(spark, broken, plan, manifest, str(tmp_path / "out"), "p1", T0)
    days, states, taken = landed(spark, tmp_path / "out")
    assert states[("p1", 10)] == ("failed", None, None) and states[("p1", 11)] == ("verified", 0, 0) and taken == []


def test_lookup_upsert_takes_the_latest_of_repeated_new_rows(spark, rows):
    old = lookup(spark, ("a", False, None, None))
    new = lookup(spark, ("b", True, "x", None), ("b", False, None, None)).withColumn(
        "looked_up_at", F.when(F.col("found"), F.lit(T0 + timedelta(days=1))).otherwise(F.lit(T0)))
    assert rows(pulls.upsert_parent_lookup(old, new), "sr_number", "found") == [("a", False), ("b", True)]


def test_merges_are_ordered_by_arrival_not_by_clock(spark, tmp_path):
    t = requests.RequestTable(spark, str(tmp_path / "t"))
    ahead, behind = datetime(2040, 1, 1, tzinfo=timezone.utc), datetime(1999, 1, 1, tzinfo=timezone.utc)
    assert t.upsert(enriched(spark, request("a"), request("b"), request("b")), "first/1", merged_at=ahead) == 2
    assert t.upsert(enriched(spark, request("a", urgency_label="Low")), "second", merged_at=behind) == 1
    assert t.upsert(enriched(spark), "nothing") == 0
    want = {"a": ("Low", datetime(2040, 1, 1)), "b": ("High", datetime(2040, 1, 1))}
    assert state(t.current()) == want
    assert t.upsert(enriched(spark, request("a"), request("b")), "first/1", merged_at=behind) == 2
    assert state(t.current()) == want and len(t._merges()) == 2


def test_compaction_keeps_the_state_and_remembers_merges(spark, tmp_path):
    path = str(tmp_path / "t")
    t = requests.RequestTable(spark, path, buckets=4)
    one = datetime(2026, 6, 1, tzinfo=timezone.utc)
    assert t.current().collect() == [] and not t.compact()
    for k in range(5):
        t.upsert(enriched(spark, request("same", urgency_label=["Low", "High"][k % 2]), request(f"r{k}")), f"m{k}", merged_at=one + timedelta(days=k))
    before = sorted(t.current().collect())
    assert t.compact() and not t.compact()
    assert sorted(t.current().collect()) == before and t._merges() == []
    # a merge that is folded already comes again; a new one wins over the base and keeps the first time
    assert t.upsert(enriched(spark, request("same", urgency_label="Critical"), request("r1")), "m1") == 2
    assert sorted(t.current().collect()) == before
    t.upsert(enriched(spark, request("same", urgency_label="Critical"), request("new")), "m9", merged_at=one + timedelta(days=9))
    after = state(t.current())
    assert after["same"] == ("Critical", datetime(2026, 6, 1)) and after["new"] == ("High", datetime(2026, 6, 10)) and len(after) == 7
    ids = spark.createDataFrame([("same",), ("r2",), ("absent",)], "service_request_id string")
    assert set(state(t.find(ids))) == {"same", "r2"}
    assert t.compact()
    assert state(t.current()) == after and set(state(t.find(ids))) == {"same", "r2"}
    # what the first base replaced is gone now, and one file per bucket at most is read
    assert len(list((tmp_path / "t" / "merges").iterdir())) == 1 and len(list((tmp_path / "t" / "base").iterdir())) == 2
    assert len(t.current().inputFiles()) <= 4
    assert t.upsert(enriched(spark, request("r1", urgency_label="Low")), "m0") == 2
    assert state(t.current()) == after


def test_an_unfinished_merge_or_base_does_not_count(spark, tmp_path):
    t = requests.RequestTable(spark, str(tmp_path / "t"))
    t.upsert(enriched(spark, request("a")), "m1")
    t.upsert(enriched(spark, request("a", urgency_label="Low")), "m2")
    folder = next(p for p in (tmp_path / "t" / "merges").iterdir() if p.name.endswith("m2"))
    (folder / "_SUCCESS").unlink()
    assert state(t.current())["a"][0] == "High"
    t.compact()
    (tmp_path / "t" / "base" / "000000000001" / "merges" / "_SUCCESS").unlink()
    assert state(t.current())["a"][0] == "High" and len(t._merges()) == 1


def test_reading_does_not_shuffle_the_base(spark, tmp_path):
    t = requests.RequestTable(spark, str(tmp_path / "t"))
    t.upsert(enriched(spark, *[request(f"r{k}") for k in range(50)]), "m1")
    t.compact()
    t.upsert(enriched(spark, request("r1", urgency_label="Low")), "m2")
    now = t.current()
    assert now.count() == 50
    plan = now._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "LeftAnti, BuildRight" in plan and "SortMergeJoin" not in plan


def test_pages_reconciled_with_their_manifest(spark, tmp_path):
    """A record with a line end in a field, one with too many fields, one cut short, and a quote that swallows the rest."""
    header = ",".join(schemas.EXTRACT_TYPES)

    def line(key, address="1 Oak"):
        return ",".join([key, "T", "T1", "", "Open", "web", "2026-05-01T08:00:00", "", "", "true", "false", "", address, "1", "x", "2.5", "41.5", "-87.5"])

    pages = {"a": [line("a1", '"1 ""Oak"",\nrear"'), line("a2")], "b": [line("b1"), "b2,T,T1", line("b3") + ",more"],
             "c": [line("c1", '"1 Oak'), line("c2")], "d": [], "e": [line("e1")], "f": [line("f1")]}
    for page, rows in pages.items():
        (tmp_path / f"page={page}").mkdir()
        (tmp_path / f"page={page}" / "1.csv").write_text("\n".join([header, *rows]) + "\n")
    records = files.extract_pages(spark, str(tmp_path))
    manifest = spark.createDataFrame([("a", 2), ("b", 3), ("c", 2), ("d", 0), ("e", 2), ("g", 1)], "page string, expected_count long")
    report = files.reconcile_pages(records, manifest)
    got = {r.page: (r.status, r.records, r.corrupt_records) for r in report.collect()}
    assert got.pop("c")[0] in ("corrupt", "count_mismatch")
    assert got == {"a": ("complete", 2, 0), "b": ("corrupt", 3, 2), "d": ("complete", 0, 0), "e": ("count_mismatch", 1, 0),
                   "f": ("unplanned", 1, 0), "g": ("count_mismatch", 0, 0)}
    assert {r.page: r.first_corrupt for r in report.collect()}["b"] == "b2,T,T1"
    rows = {r.sr_number: r for r in files.complete_pages(records, report).collect()}
    assert set(rows) == {"a1", "a2"} and rows["a1"].street_address == '1 "Oak",\nrear' and rows["a1"].ward is None
    assert rows["a2"].community_area == 3 and rows["a2"].duplicate and not rows["a2"].legacy_record
