"""What streams cost as their input or their state grows."""

from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from curbline import schemas
from curbline.bindings import streams
from curbline.session import scratch, shared_dir, through_files
from curbline.streaming import monitors, pipeline
from test_streaming import dead, labels, put, run, stored
from test_validate import body


def test_a_step_of_several_files_is_one_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "ROWS_PER_FILE", 100)
    rows = spark.range(1600).withColumnRenamed("id", "event_id")
    stream = streams._parts(spark, rows, str(tmp_path / "in"), 4)
    files = [p for p in (tmp_path / "in").iterdir() if p.suffix == ".parquet"]
    assert len(files) > 4 and len(files) % 4 == 0
    seen = []
    stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).foreachBatch(
        lambda batch, k: seen.append((batch.rdd.getNumPartitions(), sorted(r[0] for r in batch.collect())))).start().awaitTermination()
    assert seen == [(spark.sparkContext.defaultParallelism, list(range(k, 1600, 4))) for k in range(4)]


class Blocks:
    def __init__(self):
        self.held, self.read = {}, 0

    def containsKey(self, k):
        return k in self.held

    def getValue(self, k):
        self.read += 1
        return self.held[k]

    def updateValue(self, k, v):
        self.held[k] = v

    def removeKey(self, k):
        del self.held[k]

    def keys(self):
        return iter(list(self.held))


class Newest:
    held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, v):
        self.held = v


def test_a_batch_reads_only_the_blocks_around_it():
    count = monitors._TrailingCount(60, 2, 10**9)
    count.recent, count.newest = Blocks(), Newest()

    def batch(seconds):
        rows = pd.DataFrame({"second": seconds, "n": 1})
        return [tuple(r) for f in count.handleInputRows(("t", 0), iter([rows]), None) for r in f.itertuples(index=False)]

    assert batch(list(range(0, 3_600_000, 100))) == []
    before = count.recent.read
    assert batch([1_800_030, 1_800_031]) == [("t", 0, 1_800_031, 3)]
    assert count.recent.read - before <= 2 and len(count.recent.held) == 1000


def test_isolating_a_row_reads_the_rest_a_few_times(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(len(b))
            yield b

    n = 512
    rows = spark.range(n).selectExpr("concat('r', id) as service_request_id", "'t' as topic", "0 as partition", "id as offset",
                                     "cast(null as string) as error_type", "cast(null as string) as error_message")
    written = set()

    def write(table, some, name):
        ids = {r[0] for r in some.select("service_request_id").collect()}
        if "r77" in ids:
            raise ValueError("refused")
        written.update(ids)

    refused = pipeline.write_or_isolate(write, None, rows.mapInPandas(counted, rows.schema), "m")
    assert read.value <= 10 * n
    assert [r["service_request_id"] for r in refused.collect()] == ["r77"] and len(written) == n - 1
    assert refused.select(F.first("error_message")).head()[0] == "warehouse_write_error: refused"


def kept(spark):
    """Persisted blocks, and folders for the time of a batch or an isolation."""
    blocks = {b.id() for b in spark.sparkContext._jsc.sc().getRDDStorageInfo()}
    return blocks, {p.name for p in Path(shared_dir(spark)).glob("*") if p.name.startswith(("batch-", "isolate-"))}


def test_a_batch_is_kept_in_files_until_its_end(spark, tmp_path):
    """A persisted partition takes memory that grows with the batch, also if it ends on disk."""
    before, during = kept(spark), []

    def write(table, some, name):
        during.append(kept(spark))
        table.upsert(some, name, ["offset", "partition"])

    put(spark, tmp_path / "in", body(service_request_id="A"), b"{cut", body(service_request_id="X"), body(service_request_id="B"))
    run(spark, tmp_path, labels(spark, A="High", B="Low"), write=write)
    assert stored(spark, tmp_path) == {"A": "High", "B": "Low"} and set(dead(spark, tmp_path)) == {1, 2}
    assert during[0][0] <= before[0] and len(during[0][1] - before[1]) == 1
    assert kept(spark)[1] == before[1]


def test_a_batch_that_fails_leaves_no_files(spark, tmp_path):
    before = kept(spark)

    def write(table, some, name):
        raise OSError("refused")

    put(spark, tmp_path / "in", body(service_request_id="A"), body(service_request_id="B"))
    with pytest.raises(Exception, match="refused"):
        run(spark, tmp_path, labels(spark, A="High", B="Low"), write=write)
    assert kept(spark)[1] == before[1]


def parts_of(spark, n):
    return spark.range(n).selectExpr("concat('r', id) as service_request_id", "'t' as topic", "0 as partition", "id as offset",
                                     "cast(null as string) as error_type", "cast(null as string) as error_message")


def test_isolating_keeps_what_is_left_in_files(spark):
    before, during, written = kept(spark), [], []

    def write(table, some, name):
        new = kept(spark)
        folders = [Path(shared_dir(spark)) / f for f in new[1] - before[1]]
        during.append((new[0] - before[0], [p.name for f in folders for p in f.glob("*")]))
        ids = {r[0] for r in some.select("service_request_id").collect()}
        if ids & {"r7", "r30"}:
            raise ValueError("refused")
        written.extend(ids)

    refused = pipeline.write_or_isolate(write, None, parts_of(spark, 64), "m")
    assert sorted(r["offset"] for r in refused.collect()) == [7, 30]
    assert sorted(written) == sorted(f"r{k}" for k in range(64) if k not in (7, 30))
    assert not any(blocks for blocks, _ in during) and max(len(copies) for _, copies in during) == 1
    assert kept(spark)[1] == before[1]


def test_a_table_that_refuses_everything_has_no_copies_made(spark):
    before, during = kept(spark), []

    def write(table, some, name):
        new = kept(spark)
        during.append((new[0] - before[0], [p.name for f in new[1] - before[1] for p in (Path(shared_dir(spark)) / f).glob("*")]))
        raise ValueError("refused")

    with pytest.raises(ValueError, match="refused"):
        pipeline.write_or_isolate(write, None, parts_of(spark, 64), "m")
    assert len(during) == 15 and not any(blocks or copies for blocks, copies in during)
    assert kept(spark)[1] == before[1]


def test_rows_through_files_stay_as_they_are(spark):
    rows = spark.sql("select * from values (1, null, timestamp '1800-01-01 00:00:00', X'ff00', double('nan')),"
                     " (null, null, null, null, -0.0d) as t(a, b, c, d, e)").withColumn("headers", F.lit(None).cast(
                         schemas.MESSAGE["headers"].dataType))
    with scratch(spark, "batch") as folder:
        got = through_files(rows, f"{folder}/rows")
        assert got.columns == rows.columns and [f.dataType for f in got.schema] == [f.dataType for f in rows.schema]
        assert sorted(map(str, got.collect())) == sorted(map(str, rows.collect()))
        assert through_files(rows.limit(0), f"{folder}/none").count() == 0
