import json
import os
import time
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from curbline import schemas
from curbline.config import Settings
from curbline.operators import alerts
from curbline.sinks.requests import RequestTable
from curbline.streaming import monitors, pipeline, sources
from test_requests import T0, request, table
from test_validate import body, record

T = datetime(2026, 5, 20, 12)


def put(spark, folder, *bodies, start=0):
    data = [(f"k{start + i}".encode(), b if isinstance(b, bytes) else json.dumps(b).encode(), "t", 0, start + i, T, None)
            for i, b in enumerate(bodies)]
    spark.createDataFrame(data, schemas.MESSAGE).coalesce(1).write.mode("append").parquet(str(folder))


def labels(spark, **by_id):
    return table(spark, *[request(k, urgency_label=v) for k, v in by_id.items()])


def run(spark, root, recorded, **kw):
    q = pipeline.start_enrichment(
        sources.file_messages(spark, str(root / "in")), pipeline.labeller("recorded", labels=recorded),
        str(root / "requests"), str(root / "dead"), str(root / "cp"), drain=True, **kw)
    q.awaitTermination()


def stored(spark, root):
    return {r.service_request_id: r.urgency_label for r in RequestTable(spark, str(root / "requests")).current().collect()}


def dead(spark, root):
    return {r.offset: r for r in pipeline.read_dead_letters(spark, str(root / "dead")).collect()}


def test_three_stage_routing_and_restart(spark, tmp_path):
    recorded = labels(spark, A="High", B="Low", C="Bogus")
    put(spark, tmp_path / "in", body(service_request_id="A"), b"{cut", b"\xff\xfe",
        body(service_request_id="X"), body(service_request_id="C"), body(service_request_id="A", status="closed"))
    counts = []
    run(spark, tmp_path, recorded, on_batch=counts.append)
    assert counts == [{"batch_id": 0, "processed": 2, "failed": 4}]
    assert stored(spark, tmp_path) == {"A": "High"}
    current = RequestTable(spark, str(tmp_path / "requests")).current().head()
    assert current.status == "closed"
    lost = dead(spark, tmp_path)
    assert {k: r.exception_type for k, r in lost.items()} == {
        1: "message_parse_error", 2: "message_parse_error", 3: "ReplayMiss", 4: "LabelContract"}
    assert bytes(lost[1].value) == b"{cut" and bytes(lost[2].value) == b"\xff\xfe" and bytes(lost[1].key) == b"k1"
    put(spark, tmp_path / "in", body(service_request_id="B"), start=6)
    run(spark, tmp_path, recorded)
    run(spark, tmp_path, recorded)
    assert stored(spark, tmp_path) == {"A": "High", "B": "Low"} and len(dead(spark, tmp_path)) == 4


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    recorded = labels(spark, A="High")
    put(spark, tmp_path / "in", body(service_request_id="A"), body(service_request_id="X"))
    run(spark, tmp_path, recorded)
    rows = RequestTable(spark, str(tmp_path / "requests")).current().collect()
    before = (stored(spark, tmp_path), set(dead(spark, tmp_path)))
    for commit in (tmp_path / "cp" / "commits").iterdir():
        commit.unlink()
    run(spark, tmp_path, recorded)
    assert (stored(spark, tmp_path), set(dead(spark, tmp_path))) == before
    assert RequestTable(spark, str(tmp_path / "requests")).current().collect() == rows
    assert spark.read.parquet(str(tmp_path / "dead")).count() == 1


def test_two_queries_share_a_table(spark, tmp_path):
    """A new checkpoint starts its batches at 0 again; earlier merges and dead letters stay."""
    recorded = labels(spark, A="High", B="Low")
    put(spark, tmp_path / "in", body(service_request_id="A"), b"{cut")
    run(spark, tmp_path, recorded)
    second = tmp_path / "second"
    put(spark, second / "in", body(service_request_id="B"), b"{cut", start=5)
    q = pipeline.start_enrichment(
        sources.file_messages(spark, str(second / "in")), pipeline.labeller("recorded", labels=recorded),
        str(tmp_path / "requests"), str(tmp_path / "dead"), str(second / "cp"), drain=True)
    q.awaitTermination()
    assert stored(spark, tmp_path) == {"A": "High", "B": "Low"} and set(dead(spark, tmp_path)) == {1, 6}


def test_write_failure_goes_to_dead_letters(spark, tmp_path):
    def broken(table, rows, merge_id):
        raise OSError("disk gone")

    put(spark, tmp_path / "in", body(service_request_id="A"), b"{cut")
    run(spark, tmp_path, labels(spark, A="High"), write=broken)
    lost = dead(spark, tmp_path)
    assert {k: r.exception_type for k, r in lost.items()} == {0: "OSError", 1: "message_parse_error"}
    assert "disk gone" in lost[0].exception_message


def test_dead_letters_replay_once_the_cause_is_fixed(spark, tmp_path):
    put(spark, tmp_path / "in", body(service_request_id="A"), b"{cut")
    run(spark, tmp_path, labels(spark, Z="High"))
    again = tmp_path / "again"
    letters = pipeline.read_dead_letters(spark, str(tmp_path / "dead")).filter("exception_type = 'ReplayMiss'")
    pipeline.replayable(letters).select(schemas.MESSAGE.fieldNames()).write.parquet(str(again / "in"))
    run(spark, again, labels(spark, A="High"))
    assert stored(spark, again) == {"A": "High"}


def test_unknown_strategy_fails_early():
    with pytest.raises(ValueError):
        pipeline.labeller("psychic")


def test_polling_lets_each_id_through_once(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()

    def poll():
        for q in pipeline.start_polling(
                sources.feed_pages(spark, str(landed)), str(tmp_path / "out"), str(tmp_path / "drift"),
                str(tmp_path / "cp"), drain=True):
            q.awaitTermination()

    (landed / "1.json").write_text(json.dumps([record("A"), record("BAD", lat="x"), record("A")]))
    (landed / "x.json").write_text("{oops")
    poll()
    (landed / "2.json").write_text(json.dumps([record("A"), record("B", priority=1), record("BAD")]))
    poll()
    got = sorted(r.service_request_id for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == ["A", "B", "BAD"]
    drift = spark.read.parquet(str(tmp_path / "drift")).collect()
    assert [(r.kind, r.key, r.records) for r in drift] == [("unexpected", "priority", 1)]


def test_polling_keeps_pages_with_an_old_modification_time(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    for k, (name, age_days) in enumerate([("A", 0), ("B", 0), ("C", 30), ("A", 30)]):
        page = landed / f"{k}.json"
        page.write_text(json.dumps([record(name)]))
        os.utime(page, (time.time() - age_days * 86_400,) * 2)
        for q in pipeline.start_polling(
                sources.feed_pages(spark, str(landed)), str(tmp_path / "out"), str(tmp_path / "drift"),
                str(tmp_path / "cp"), drain=True):
            q.awaitTermination()
    assert sorted(r.service_request_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["A", "B", "C"]


def failures(spark, seconds, topic="t"):
    return spark.createDataFrame([(topic, 0, T + timedelta(seconds=s)) for s in seconds],
                                 "topic string, partition int, failed_at timestamp_ntz")


def test_rate_alerts_at_six_not_at_five(spark):
    quiet = alerts.dead_letter_rate(failures(spark, [0, 1, 2, 3, 300, 601]), "failed_at")
    assert quiet.collect() == []
    loud = alerts.dead_letter_rate(failures(spark, [0, 1, 2, 3, 4, 300, 301, 9000]), "failed_at").collect()
    assert sorted((r.alert_at, r.messages_in_window) for r in loud) == [
        (T + timedelta(seconds=300), 6), (T + timedelta(seconds=301), 6)]


@pytest.mark.parametrize("seed", [1, 2])
def test_rate_alerts_equal_a_brute_force_count(spark, seed):
    import random

    rng = random.Random(seed)
    seconds = sorted(rng.randrange(0, 9000) for _ in range(250)) + [3599, 3600, 3601, 7199, 7200]
    conf = Settings(alert_window_seconds=300, alert_threshold=9)
    got = {r.alert_at: r.messages_in_window for r in alerts.dead_letter_rate(
        failures(spark, seconds), "failed_at", settings=conf).collect()}
    want = {}
    for s in set(seconds):
        n = sum(s - 300 <= x <= s for x in seconds)
        if n > 9:
            want[T + timedelta(seconds=s)] = n
    assert got == want and want


def test_exact_streaming_alerts_over_batches(spark, tmp_path):
    for part, seconds in enumerate([[0, 1, 2, 3], [4, 300], [301, 5000]]):
        failures(spark, seconds).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("topic string, partition int, failed_at timestamp_ntz").parquet(str(tmp_path / "in"))
        q = (monitors.exact_dead_letter_alerts(stream).writeStream.outputMode("update")
             .foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(str(tmp_path / "out" / f"batch={i}")))
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
        q.awaitTermination()
    got = sorted((r.alert_at, r.messages_in_window) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(T + timedelta(seconds=300), 6), (T + timedelta(seconds=301), 6)]


def test_exact_streaming_alerts_count_late_failures(spark, tmp_path):
    """Five failures and a late sixth, in the window and after the stream has moved on by more than two windows."""
    for seconds in [[100, 101, 102, 103, 300], [5000], [99], [0, 98, 5000]]:
        failures(spark, seconds).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("topic string, partition int, failed_at timestamp_ntz").parquet(str(tmp_path / "in"))
        q = (monitors.exact_dead_letter_alerts(stream).writeStream.outputMode("update")
             .foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(str(tmp_path / "out" / f"batch={i}")))
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
        q.awaitTermination()
    got = sorted((r.batch, r.alert_at, r.messages_in_window) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(2, T + timedelta(seconds=300), 6), *[
        (3, T + timedelta(seconds=s), n) for s, n in ((102, 6), (103, 7), (300, 8))]]


def test_windowed_alerts_as_a_batch(spark):
    got = monitors.windowed_dead_letter_rate(failures(spark, [0, 1, 2, 3, 4, 5])).collect()
    assert {r.messages_in_window for r in got} == {6} and len(got) == 5


def test_lag(spark):
    df = spark.createDataFrame([("t", 0, 5, 9), ("t", 1, -1001, 4), ("t", 2, 9, 7), ("t", 3, None, 2)],
                               "topic string, partition int, position long, high long")
    assert [r.lag for r in alerts.consumer_lag(df).orderBy("partition").collect()] == [4, 4, 0, 2]
    assert alerts.total_lag(alerts.consumer_lag(df)).head().total_lag == 10
    progress = SimpleNamespace(batchId=3, numInputRows=7, observedMetrics={}, sources=[
        SimpleNamespace(latestOffset='{"t":{"0":9,"1":4}}', endOffset='{"t":{"0":5}}'),
        SimpleNamespace(latestOffset=None, endOffset='{"logOffset":1}'),
        SimpleNamespace(latestOffset="not json", endOffset=None)])
    seen = []
    listener = monitors.LagListener(seen.append)
    listener.onQueryProgress(SimpleNamespace(progress=progress))
    assert seen[0]["total_lag"] == 8 and seen[0]["rows_seen"] == 7
    assert {p["partition"]: p["lag"] for p in seen[0]["partitions"]} == {0: 4, 1: 4}


def test_observed_counters(spark, tmp_path):
    from pyspark.sql import Observation

    rows = spark.createDataFrame([(None,), ("e",), (None,)], "error_type string")
    o = Observation("outcome")
    rows.observe(o, F.count(F.lit(1)).alias("processed")).count()
    assert o.get == {"processed": 3}
    assert monitors.observed(rows).count() == 3


@pytest.mark.parametrize("max_ids", [500_000, 1])
def test_labels_for_a_batch(spark, max_ids):
    rows = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "service_request_id string")
    recorded = table(spark, request("A", urgency_label="Low"), request("Z"),
                     request("A", urgency_label="High", classified_at=T0 + timedelta(hours=1)))
    got = pipeline.labels_for(rows, recorded, max_ids)
    assert [(r.service_request_id, r.urgency_label) for r in got.collect()] == [("A", "High")]


def refusing(*names, always=False):
    calls = []

    def write(table, rows, merge_id):
        calls.append(merge_id)
        if always or rows.filter(F.col("service_request_id").isin(*names) & (F.col("status") != "closed")).count():
            raise OSError("refused")
        table.upsert(rows, merge_id, ["offset", "partition"])
    return write, calls


def test_only_the_refused_rows_are_dead_lettered(spark, tmp_path):
    ids = [f"A{k}" for k in range(20)]
    bodies = [body(service_request_id=i, status="closed" if i == "A3" else "open") for i in ids]
    # the newest message of A3 is refused, the one before it is not
    bodies += [body(service_request_id="A3", status="closed"), body(service_request_id="A3", status="open"), b"{cut"]
    put(spark, tmp_path / "in", *bodies)
    write, calls = refusing("A3", "A11")
    counts = []
    run(spark, tmp_path, labels(spark, **{i: "High" for i in ids}), write=write, on_batch=counts.append)
    lost = dead(spark, tmp_path)
    assert {k: r.exception_type for k, r in lost.items()} == {11: "OSError", 21: "OSError", 22: "message_parse_error"}
    assert lost[21].exception_message == "warehouse_write_error: refused"
    assert set(stored(spark, tmp_path)) == set(ids) - {"A11"}
    current = RequestTable(spark, str(tmp_path / "requests")).current()
    assert current.filter("service_request_id = 'A3'").head().status == "closed"
    assert counts == [{"batch_id": 0, "processed": 20, "failed": 3}] and len(calls) < 40


@pytest.mark.parametrize("n", [2, 40])
def test_a_table_that_refuses_everything_stops_the_stream(spark, tmp_path, n):
    ids = [f"A{k}" for k in range(n)]
    put(spark, tmp_path / "in", *[body(service_request_id=i) for i in ids], b"{cut")
    recorded = labels(spark, **{i: "High" for i in ids})
    write, calls = refusing(always=True)
    with pytest.raises(Exception, match="refused"):
        run(spark, tmp_path, recorded, write=write)
    assert not (tmp_path / "dead").exists() and not list((tmp_path / "cp" / "commits").glob("[0-9]*")) and len(calls) <= 15
    # once the table is back, the same batch goes through whole
    run(spark, tmp_path, recorded)
    assert set(stored(spark, tmp_path)) == set(ids) and set(dead(spark, tmp_path)) == {n}


def test_compaction_while_streaming(spark, tmp_path):
    recorded = labels(spark, A="High", B="Low", C="High", D="Low")
    for k, name in enumerate("ABCDA"):
        put(spark, tmp_path / "in", body(service_request_id=name), start=k)
        run(spark, tmp_path, recorded, compact_every=2)
    t = RequestTable(spark, str(tmp_path / "requests"))
    assert stored(spark, tmp_path) == {"A": "High", "B": "Low", "C": "High", "D": "Low"}
    assert len(t._merges()) == 1 and len(t._bases()) == 2
