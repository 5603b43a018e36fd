"""The enrichment query: parse, classify, upsert; every failure goes to the dead-letter table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from curbline import schemas
from curbline.config import DEFAULT, Settings
from curbline.operators import validate
from curbline.operators.classify import classify
from curbline.operators.latest import latest_per_key
from curbline.session import scratch, spread, through_files
from curbline.sinks import paths
from curbline.sinks.requests import KEY, RequestTable, dead_letters

Labeller = Callable[[DataFrame], DataFrame]


def labeller(strategy: str, **options) -> Labeller:
    """A classifier bound to a strategy; an unknown one fails here, before the query starts."""
    if strategy == "recorded":
        return lambda rows: classify(
            rows, strategy, labels=labels_for(rows, options["labels"], options.get("max_ids", 200_000)))
    if strategy not in ("by_type", "rules", "function"):
        raise ValueError(f"unknown strategy {strategy!r}")
    return lambda rows: classify(rows, strategy, **options)


def labels_for(rows: DataFrame, labels: DataFrame, max_ids: int) -> DataFrame:
    """The recorded labels a micro-batch asks for, one per id.

    A batch is small beside the recording. Its distinct ids are counted, and up to ``max_ids`` of
    them are broadcast, so the recording is filtered where it is read and neither side of the later
    join is shuffled, however often one id repeats. A larger batch joins by shuffle.
    """
    ids = rows.select("service_request_id").distinct()
    small = ids.count() <= max_ids
    wanted = labels.join(F.broadcast(ids) if small else ids, "service_request_id", "left_semi")
    newest = latest_per_key(wanted, ["service_request_id"], ["classified_at"])
    return F.broadcast(newest) if small else newest


def label_parsed(parsed: DataFrame, label: Labeller) -> DataFrame:
    """Parsed messages with label columns and the first error met, if any.

    All rows take the same path: labels of rows that did not parse are ignored, so nothing has to be
    joined back together.
    """
    named = parsed.withColumnsRenamed(
        {"error_type": "parse_error", "error_message": "parse_message"})
    unparsed = F.col("parse_error").isNotNull()
    return label(named).withColumns({
        "error_type": F.when(unparsed, F.col("parse_error")).otherwise(F.col("error_type")),
        "error_message": F.when(unparsed, F.col("parse_message")).otherwise(F.col("error_message")),
    }).drop("parse_error", "parse_message")


Writer = Callable[[RequestTable, DataFrame, str], object]


def write_or_isolate(write: Writer, table: RequestTable, rows: DataFrame, merge_id: str, most: int = 2_000) -> DataFrame | None:
    """Write ``rows`` and return those that the table refuses, with ``error_type`` and ``error_message``; None if none.

    When the whole fails, its requests are halved by a hash of their id, again and again, until what fails is a
    single request; of its messages the newest is refused and the others are tried without it. All messages of one
    request stay in one part, so that the newest of them still wins. This takes about 2 log2(n) writes for each
    request refused; after ``most`` writes the batch fails. Each halving reads only the parts that failed before it,
    so together they read about as many rows again as the batch has, for each request refused.

    What is left is copied to files whenever some part went through, and not while all of them fail.

    If nothing at all can be written although there are several requests, the fault is the table's and not theirs:
    the error is raised, and the stream stops without having moved past the batch. That shows after eight parts.
    """
    with scratch(rows.sparkSession, "isolate") as folder:
        return _isolate(write, table, rows, merge_id, most, folder)


def _isolate(write: Writer, table: RequestTable, rows: DataFrame, merge_id: str, most: int, folder: str) -> DataFrame | None:
    parts, alone, refused, written, tries = [(1, 0)], [], [], False, 0
    hashed = F.xxhash64(KEY)
    left, copy = rows, None

    def narrowed(failing: list, path: str) -> DataFrame:
        """The rows of parts that failed and of requests that are alone, kept apart."""
        wanted: dict[int, list[int]] = {}
        for modulus, rest, _ in failing + alone:
            wanted.setdefault(modulus, []).append(rest)
        some = [F.pmod(hashed, F.lit(m)).isin(rests) for m, rests in wanted.items()]
        return through_files(left.filter(reduce(or_, some)), path)

    def attempt(some: DataFrame, name: str) -> Exception | None:
        nonlocal written, tries
        tries += 1
        try:
            write(table, some, name)
            written = True
            return None
        except Exception as exc:  # whatever a sink raises
            if tries >= most:
                raise
            return exc

    while parts:
        failing = []
        for modulus, rest in parts:
            some = left if modulus == 1 else left.filter(F.pmod(hashed, F.lit(modulus)) == rest)
            if (exc := attempt(some, merge_id if modulus == 1 else f"{merge_id}-{modulus}-{rest}")) is not None:
                failing.append((modulus, rest, exc))
        if not failing:
            break
        if not written and len(parts) >= 8:
            raise failing[0][2]
        # Requests in each half of the parts that failed: two rows for each.
        modulus = 2 * failing[0][0]
        if len(failing) < len(parts):
            before, copy = copy, f"{folder}/{modulus}"
            left = narrowed(failing, copy)
            if before is not None:
                paths.remove(rows.sparkSession, before)
        sizes = {r["part"]: r["requests"] for r in left.groupBy(F.pmod(hashed, F.lit(modulus)).alias("part")).agg(
            F.count_distinct(KEY).alias("requests")).filter(
                F.col("part").isin([h for _, rest, _ in failing for h in (rest, rest + modulus // 2)])).collect()}
        parts = []
        for half, rest, exc in failing:
            inside = [(modulus, h) for h in (rest, rest + half) if h in sizes]
            if sum(sizes[h] for _, h in inside) <= 1:
                alone.append((half, rest, exc))
            else:
                parts += inside
    if not alone:
        return None
    if not written and len(alone) > 1:
        raise alone[0][2]
    for modulus, rest, exc in alone:
        some = left.filter(F.pmod(hashed, F.lit(modulus)) == rest)
        while exc is not None:
            newest = some.agg(F.max(F.struct("offset", "partition", "topic"))).head()[0]
            refused.append((newest["topic"], newest["partition"], newest["offset"], type(exc).__name__, f"warehouse_write_error: {exc}"))
            at = F.col("offset") == newest["offset"]
            some = some.filter((F.col("offset") < newest["offset"]) | (at & (F.col("partition") < newest["partition"])))
            if some.isEmpty():
                break
            exc = attempt(some, f"{merge_id}-{modulus}-{rest}-{newest['offset']}")
    reasons = rows.sparkSession.createDataFrame(
        refused, "topic string, partition int, offset long, error_type string, error_message string")
    return rows.drop("error_type", "error_message").join(F.broadcast(reasons), ["topic", "partition", "offset"])


def start_enrichment(
    messages: DataFrame,
    label: Labeller,
    requests_path: str,
    dead_letter_path: str,
    checkpoint: str,
    settings: Settings = DEFAULT,
    drain: bool = False,
    name: str = "enrichment",
    write: Writer | None = None,
    on_batch: Callable[[dict], None] | None = None,
    compact_every: int = 100,
) -> StreamingQuery:
    """Run until stopped, or with ``drain`` until the source is exhausted.

    Both outputs are folders named after the query's lasting id and the micro-batch, so a batch
    replayed after a failure overwrites its own rows and no other query's. Rows that the request table refuses
    are dead-lettered with the reason and the others are written; if it refuses everything, the batch fails
    (:func:`write_or_isolate`). Every ``compact_every`` batches the table is compacted. ``on_batch`` receives each
    batch's processed and failed counts.
    """
    write = write or (lambda table, rows, merge_id: table.upsert(rows, merge_id, ["offset", "partition"]))

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        merge_id = f"{name}-{query_id}-{batch_id:012d}"
        table = RequestTable(spark, requests_path)
        with scratch(spark, "batch") as folder:
            parsed = through_files(validate.parse_messages(spread(batch), settings), f"{folder}/parsed")
            rows = through_files(label_parsed(parsed, label), f"{folder}/rows")
            paths.remove(spark, f"{folder}/parsed")
            failed = F.col("error_type").isNotNull()
            counts = rows.agg(F.count_if(~failed).alias("good"), F.count_if(failed).alias("bad")).head()
            good, bad = counts["good"], counts["bad"]
            lost = rows.filter(failed)
            if good:
                refused = write_or_isolate(write, table, rows.filter(~failed), merge_id)
                if refused is not None:
                    lost = lost.unionByName(refused)
                    more = refused.count()
                    good, bad = good - more, bad + more
            if bad:
                dead_letters(lost).withColumn(
                    "failed_at", F.current_timestamp().cast("timestamp_ntz")
                ).write.mode("overwrite").parquet(f"{dead_letter_path}/batch_id={merge_id}")
            if good and (batch_id + 1) % compact_every == 0:
                table.compact()
            if on_batch is not None:
                on_batch({"batch_id": batch_id, "processed": good, "failed": bad})

    writer = (
        messages.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(handle)
    )
    if drain:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{settings.poll_seconds} seconds").start()


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """Dead letters with the reason as columns, each source message once, with its newest reason."""
    rows = spark.read.option("basePath", path).parquet(path)
    reason = F.map_from_entries("headers")
    rows = rows.select(
        *schemas.DEAD_LETTER.fieldNames(),
        "failed_at",
        F.decode(reason["exception_type"], "UTF-8").alias("exception_type"),
        F.decode(reason["exception_message"], "UTF-8").alias("exception_message"),
    )
    newest = F.row_number().over(
        Window.partitionBy("topic", "partition", "offset")
        .orderBy(F.desc("failed_at"), "exception_type", "exception_message"))
    return rows.withColumn("_newest", newest).filter("_newest = 1").drop("_newest")


def replayable(dead: DataFrame) -> DataFrame:
    """Dead letters as source messages again, for a second run once the cause is fixed."""
    return dead.select(
        "key", "value", "topic", "partition", "offset",
        F.col("failed_at").cast("timestamp").alias("timestamp"),
        F.lit(None).cast(schemas.MESSAGE["headers"].dataType).alias("headers"),
    )


def start_polling(
    pages: DataFrame,
    out_path: str,
    drift_path: str,
    checkpoint: str,
    settings: Settings = DEFAULT,
    memory: str = "7 days",
    drain: bool = False,
    service_codes: list[str] | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Land new requests and drift tallies from feed pages, as two queries.

    A request id is let through once while it is remembered. Memory is bounded by arrival time:
    an id whose record failed to parse was never let through, so it is not remembered.
    """
    fresh = new_requests(pages, memory, settings)
    if service_codes:
        fresh = fresh.filter(F.col("service_code").isin(*service_codes))
    trigger = {"availableNow": True} if drain else {"processingTime": f"{settings.poll_seconds} seconds"}
    landed = (
        fresh.writeStream.format("parquet").outputMode("append")
        .option("path", out_path).option("checkpointLocation", f"{checkpoint}/requests")
        .trigger(**trigger).start()
    )

    def tally(batch: DataFrame, batch_id: int) -> None:
        validate.drift_tally(batch).write.mode("overwrite").parquet(
            f"{drift_path}/batch_id={batch_id:012d}")

    drift = (
        pages.writeStream.option("checkpointLocation", f"{checkpoint}/drift")
        .foreachBatch(tally).trigger(**trigger).start()
    )
    return landed, drift


def new_requests(pages: DataFrame, memory: str = "7 days", settings: Settings = DEFAULT) -> DataFrame:
    """Accepted requests of a page stream, each id once within the memory, counted from arrival.

    Arrival is the time of the micro-batch that reads the page. A page's own ``arrived_at``, such as a file's
    modification time, may lie far back and would be taken for a late row, so it isn't used.
    """
    return (
        validate.feed_records(pages.select("page", "value"), settings=settings)
        .filter(F.col("reject_reason").isNull())
        .withColumn("arrived_at", F.current_timestamp())
        .withWatermark("arrived_at", memory)
        .dropDuplicatesWithinWatermark(["service_request_id"])
        .select(*schemas.REQUEST.fieldNames(), "arrived_at")
    )
