"""Streaming runs over the driver's events, drained to completion into the shared folder."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline import schemas
from curbline.bindings import inputs
from curbline.config import Settings
from curbline.session import shared_dir, spread
from curbline.sinks import paths
from curbline.sinks.requests import RequestTable, publish_messages
from curbline.streaming import monitors, pipeline


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = inputs.table(spark, sf_dir, "events").schema
    return spread(spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet"), "event_id")


def _messages(events: DataFrame) -> DataFrame:
    """Each event as one message; every 50th is cut short and every 50th lacks a service name."""
    rows = inputs._project(events.sparkSession, inputs.REQUESTS_SQL, events=events)
    sent = publish_messages(rows).withColumn("_id", F.decode("key", "UTF-8"))
    offset = F.substring("_id", 2, 20).cast("long")
    text = F.decode("value", "UTF-8")
    body = (
        F.when(offset % 50 == 1, F.substring(text, 1, 20))
        .when(offset % 50 == 2, F.regexp_replace(text, '"service_name":', '"renamed":'))
        .otherwise(text)
    )
    return sent.select(
        "key",
        F.encode(body, "UTF-8").alias("value"),
        F.lit("requests").alias("topic"),
        (offset % 3).cast("int").alias("partition"),
        offset.alias("offset"),
        F.timestamp_seconds(offset).alias("timestamp"),
        F.lit(None).cast(schemas.MESSAGE["headers"].dataType).alias("headers"),
    )


def _drain(spark: SparkSession, sf_dir: str) -> str:
    inputs.prepare(spark)
    root = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    recorded = inputs.service_requests(spark, sf_dir).filter(F.col("urgency_label") != "Unknown")
    query = pipeline.start_enrichment(
        _messages(_events(spark, sf_dir)),
        pipeline.labeller("recorded", labels=recorded),
        f"{root}/requests", f"{root}/dead", f"{root}/checkpoint", drain=True,
    )
    query.awaitTermination()
    return root


def upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _drain(spark, sf_dir)
    return RequestTable(spark, f"{root}/requests").current().drop("_inserted_at", "raw_payload")


def dead_lettered(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _drain(spark, sf_dir)
    return pipeline.read_dead_letters(spark, f"{root}/dead").select(
        "topic", "partition", "offset", "exception_type", "exception_message")


def polled_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page polled twice; each accepted id comes through once."""
    inputs.prepare(spark)
    root = f"{shared_dir(spark)}/poll-{uuid.uuid4().hex}"
    events = _events(spark, sf_dir)
    pages = inputs._project(spark, inputs.PAGES_SQL, events=events)
    twice = pages.withColumn("_poll", F.explode(F.array(F.lit(1), F.lit(2)))).select(
        "page", F.timestamp_seconds(F.lit(1_700_000_000)).alias("arrived_at"), "value")
    query = (
        pipeline.new_requests(twice).writeStream.format("parquet")
        .option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{root}/out").drop("raw_payload", "arrived_at")


PENDING_AT, LATE_AT = datetime(2040, 1, 1, tzinfo=timezone.utc), datetime(1999, 1, 1, tzinfo=timezone.utc)


def _run(spark: SparkSession, messages: DataFrame, labels: DataFrame, root: str, name: str, **options) -> None:
    pipeline.start_enrichment(
        messages, pipeline.labeller("recorded", labels=labels), f"{root}/requests", f"{root}/dead",
        f"{root}/checkpoint-{name}", drain=True, name=name, **options).awaitTermination()


def replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table fed by two queries and by merges between them, under clocks that disagree.

    The first query's recording lacks every third id. A merge rates every fifth id, by a clock far ahead. The second
    query replays what the first could not label. The table is compacted, and a merge by a clock far behind rates
    every seventh id. Then the first merge comes once more, and changes nothing.
    """
    inputs.prepare(spark)
    root = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    table = RequestTable(spark, f"{root}/requests")
    rows = inputs.service_requests(spark, sf_dir)
    number = F.substring("service_request_id", 2, 20).cast("long")
    recorded = rows.filter(F.col("urgency_label") != "Unknown")

    def rated(every: int, label: str, score: float) -> DataFrame:
        return rows.filter(number % every == 0).withColumns(
            {"urgency_label": F.lit(label), "urgency_score": F.lit(score)}).select(schemas.ENRICHED.fieldNames())

    _run(spark, _messages(_events(spark, sf_dir)), recorded.filter(number % 3 != 0), root, "first")
    table.upsert(rated(5, "Low", 0.5), "pending", merged_at=PENDING_AT)
    missed = pipeline.read_dead_letters(spark, f"{root}/dead").filter("exception_type = 'ReplayMiss'")
    pipeline.replayable(missed).select(schemas.MESSAGE.fieldNames()).write.parquet(f"{root}/again")
    _run(spark, spark.readStream.schema(schemas.MESSAGE).parquet(f"{root}/again"), recorded, root, "second")
    table.compact()
    table.upsert(rated(7, "Critical", 0.75), "late", merged_at=LATE_AT)
    table.upsert(rated(5, "Low", 0.5), "pending", merged_at=PENDING_AT)
    year = F.year("_inserted_at")
    return table.current().select(
        *[c for c in schemas.ENRICHED.fieldNames() if c != "raw_payload"],
        F.when(year.isin(PENDING_AT.year, LATE_AT.year), year).alias("inserted_year"))


def write_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that refuses the last good request, and one that refuses everything: what the dead letters and
    the table hold then, and whether the stream stopped."""
    inputs.prepare(spark)
    rows = inputs.service_requests(spark, sf_dir).filter(F.col("urgency_label") != "Unknown")
    number = F.substring("service_request_id", 2, 20).cast("long")
    usable = rows.filter(~(number % 50).isin(1, 2) & F.col("service_code").isNotNull())
    last = usable.agg(F.max(number)).head()[0]
    out = []
    for name, refused in (("one", F.col("offset") == last), ("all", F.lit(True))):
        root = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"

        def write(table: RequestTable, some: DataFrame, merge_id: str) -> None:
            if not some.filter(refused).isEmpty():
                raise ValueError("refused")
            table.upsert(some, merge_id, ["offset", "partition"])

        try:
            _run(spark, _messages(_events(spark, sf_dir)), rows, root, name, write=write)
            stopped = False
        except StreamingQueryException:
            stopped = True
        written = RequestTable(spark, f"{root}/requests").current().agg(F.count(F.lit(1)).alias("written"))
        if paths.subfolders(spark, f"{root}/dead"):
            at_fault = F.col("exception_message") == "warehouse_write_error: refused"
            letters = pipeline.read_dead_letters(spark, f"{root}/dead").agg(
                F.count(F.lit(1)).alias("dead_letters"), F.max(F.when(at_fault, F.col("offset"))).alias("refused_offset"))
        else:
            letters = spark.sql("select 0L as dead_letters, cast(null as bigint) as refused_offset")
        out.append(spark.createDataFrame([(name, stopped)], "table_refuses string, stopped boolean").withColumns(
            {"written": written.scalar(), "l": letters.select(F.struct("*")).scalar()})
            .select("table_refuses", "stopped", "written", "l.*"))
    return out[0].unionByName(out[1])


# Rows of a part beyond which it is landed as several files.
ROWS_PER_FILE = 500_000


def _parts(spark: SparkSession, rows: DataFrame, folder: str, parts: int) -> DataFrame:
    """``rows`` landed in ``parts`` steps one after another, by their event_id, and read back one step a micro-batch.

    A step is one file, or as many as its rows need; all steps have as many, so that a micro-batch takes just one.
    """
    files = -(-rows.count() // (parts * ROWS_PER_FILE)) or 1
    for k in range(parts):
        some = rows.filter(F.col("event_id") % parts == k)
        # So many rows have every remainder in every step, so the steps fill the same files.
        piece = F.floor(F.col("event_id") / parts) % files
        some.repartition(files, piece).write.mode("append").parquet(folder)
        # A step without rows is an empty file.
        landed = len(paths.files(spark, folder, ".parquet"))
        if k == 0:
            taken = landed
        elif landed != (k + 1) * taken:
            raise RuntimeError(f"steps of {taken} files, but {landed} after {k + 1}")
    return spread(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", taken).parquet(folder), "event_id")


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed and failed messages of four micro-batches."""
    inputs.prepare(spark)
    root = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    events = _parts(spark, inputs.table(spark, sf_dir, "events"), f"{root}/events", 4)
    recorded = inputs.service_requests(spark, sf_dir).filter(F.col("urgency_label") != "Unknown")
    seen: list[dict] = []
    _run(spark, _messages(events), recorded, root, "progress", on_batch=seen.append, compact_every=2)
    return spark.createDataFrame(seen, "batch_id long, processed long, failed long")


def deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages polled in four micro-batches. Each page comes in two of them, next to each other; its request comes
    through once."""
    inputs.prepare(spark)
    root = f"{shared_dir(spark)}/poll-{uuid.uuid4().hex}"
    poll = F.explode(F.array(F.col("event_id"), F.col("event_id") + 1))
    rows = inputs.table(spark, sf_dir, "events").withColumn("page_of", F.col("event_id")).withColumn("event_id", poll)
    events = _parts(spark, rows, f"{root}/events", 4).withColumn("event_id", F.col("page_of")).drop("page_of")
    pages = inputs._project(spark, inputs.PAGES_SQL, events=events).select("page", "value")
    query = (
        pipeline.new_requests(pages).writeStream.format("parquet")
        .option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{root}/out").drop("raw_payload", "arrived_at")


def rate_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts on errors that arrive out of order in five micro-batches, per partition: the highest count that each
    second alerted with."""
    inputs.prepare(spark)
    root = f"{shared_dir(spark)}/alerts-{uuid.uuid4().hex}"
    errors = inputs.table(spark, sf_dir, "events").filter(F.col("event_type") == "error").select(
        "event_id", F.lit("requests").alias("topic"), (F.col("user_id") % 3).cast("int").alias("partition"), F.col("ts").alias("failed_at"))
    stream = _parts(spark, errors, f"{root}/errors", 5).drop("event_id")
    query = (
        monitors.exact_dead_letter_alerts(
            stream, settings=Settings(alert_window_seconds=3600, alert_threshold=2), late_seconds=10 * 365 * 86_400)
        .writeStream.outputMode("update").option("checkpointLocation", f"{root}/checkpoint")
        .foreachBatch(lambda batch, k: batch.write.mode("overwrite").parquet(f"{root}/out/batch={k}"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    alerts = spark.read.schema("topic string, partition int, alert_at timestamp, messages_in_window long").parquet(f"{root}/out")
    return alerts.groupBy("topic", "partition", "alert_at").agg(F.max("messages_in_window").alias("messages_in_window")).withColumn(
        "alert_at", F.col("alert_at").cast("timestamp_ntz"))
