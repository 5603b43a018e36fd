"""Keyed upserts of enriched requests on plain Parquet.

A merge never rewrites what is already stored. It adds the new rows as one more folder, named after the
merge's number and id. Merges take numbers in the order in which they first arrive, so no clock decides
which row is newest; a repeated merge id keeps its number and replaces its own folder, so a replayed
micro-batch changes nothing. Compaction folds the merges so far into a base with one row per id, and
readers take the newest complete base and the merges after it.
"""

from __future__ import annotations

from datetime import datetime, timezone
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline import schemas
from curbline.operators.latest import latest_per_key
from curbline.sinks import paths

KEY = "service_request_id"
_STORED = T.StructType(schemas.ENRICHED.fields + [T.StructField("_merged_at", schemas.NTZ, True)])
_BASE = T.StructType(schemas.SERVICE_REQUESTS.fields + [T.StructField("_bucket", T.IntegerType(), True)])
_FOLDED = T.StructType([T.StructField("merge_id", T.StringType(), True), T.StructField("requests", T.LongType(), True)])


def merged(target: DataFrame, source: DataFrame, at, order: list[str] | None = None) -> DataFrame:
    """The target after an upsert of ``source``: new values for known ids, whose ``_inserted_at``
    stays, and new rows stamped ``at``. Repeated source ids keep the last one by ``order``."""
    columns = schemas.ENRICHED.fieldNames()
    newest = latest_per_key(source, [KEY], order or ["classified_at"]).select(columns)
    both = (
        target.select(*columns, "_inserted_at", F.lit(0).alias("_side"))
        .unionByName(newest.select(
            *columns, at.cast("timestamp_ntz").alias("_inserted_at"), F.lit(1).alias("_side")))
        .withColumn("_first", F.col("_inserted_at"))
    )
    picked = latest_per_key(
        both.drop("_first"), [KEY], ["_side"],
        extra=[F.min_by("_inserted_at", "_side").alias("_kept")])
    return picked.select(*columns, F.col("_kept").alias("_inserted_at"))


class RequestTable:
    """The raw request table at a path shared by the cluster.

    ``merges/<number>-<id>`` has one merge's newest row per request, ``base/<number>`` the state after that
    merge and the ids of all merges folded into it. A folder counts once its job has committed, so a reader
    sees a merge or a compaction whole or not at all.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16) -> None:
        self.spark, self.path, self.buckets = spark, path, buckets

    def upsert(self, rows: DataFrame, merge_id: str, order: list[str] | None = None,
               merged_at: datetime | None = None) -> int:
        """Add one merge and return how many requests it has; one without rows leaves no trace.

        ``merge_id`` names it; the same id again replaces it, with its number and time. An id that is folded into
        the base already changes nothing. Two merges that begin at the same moment may share a number; the id
        then decides which is newer.
        """
        merges, folded = self._merges(), self._folded(merge_id)
        if folded is not None:
            return folded
        earlier = [name for name in merges if _id_of(name) == merge_id]
        number = _number(earlier[0]) if earlier else 1 + max(
            [_number(name) for name in merges] + [_number(base) for base in self._bases()], default=0)
        stamp = self._stamp(earlier[0]) if earlier else (
            merged_at or datetime.now(timezone.utc)).astimezone(timezone.utc).replace(tzinfo=None)
        newest = latest_per_key(rows, [KEY], order or ["classified_at"])
        folder = f"{self.path}/merges/{number:012d}-{quote(merge_id, safe='')}"
        (
            newest.select(*schemas.ENRICHED.fieldNames(), F.lit(stamp).alias("_merged_at"))
            .write.mode("overwrite").parquet(folder)
        )
        merged = self.spark.read.schema(_STORED).parquet(folder).count()
        if not merged:
            paths.remove(self.spark, folder)
        return merged

    def _bases(self) -> list[str]:
        return [b for b in paths.subfolders(self.spark, f"{self.path}/base")
                if paths.is_complete(self.spark, f"{self.path}/base/{b}/merges")]

    def _merges(self) -> list[str]:
        """The complete merges that the base doesn't have."""
        bases = self._bases()
        after = _number(bases[-1]) if bases else 0
        return [m for m in paths.subfolders(self.spark, f"{self.path}/merges")
                if _number(m) > after and paths.is_complete(self.spark, f"{self.path}/merges/{m}")]

    def _folded(self, merge_id: str) -> int | None:
        """The requests of a merge that the base has, if it has it."""
        bases = self._bases()
        if not bases:
            return None
        known = self.spark.read.schema(_FOLDED).parquet(f"{self.path}/base/{bases[-1]}/merges")
        row = known.filter(F.col("merge_id") == merge_id).select("requests").head()
        return row and row[0]

    def _stamp(self, merge: str) -> datetime | None:
        """The time of a merge that is stored already."""
        stored = self.spark.read.schema(_STORED).parquet(f"{self.path}/merges/{merge}")
        return stored.agg(F.max("_merged_at")).head()[0]

    def _live(self, merges: list[str]) -> DataFrame:
        """The rows of merges, with the merge's folder name, which sorts by number."""
        if not merges:
            return self.spark.createDataFrame([], _STORED).withColumn("_merge", F.lit(""))
        rows = self.spark.read.schema(_STORED).parquet(*[f"{self.path}/merges/{m}" for m in merges])
        return rows.withColumn("_merge", F.regexp_extract("_metadata.file_path", "/merges/([^/]*)/[^/]*$", 1))

    def _base(self, base: str) -> DataFrame:
        path = f"{self.path}/base/{base}/rows"
        return self.spark.read.schema(_BASE).option("basePath", path).parquet(path)

    def current(self) -> DataFrame:
        """One row per id: its newest values and the time of the first merge that had it.

        The merges after the base are reduced to one row per id. Only their ids are looked up in the base, whose
        other rows pass through: with merges that are small beside it, it isn't shuffled.
        """
        return self._state(self._bases(), self._merges())

    def _state(self, bases: list[str], merges: list[str]) -> DataFrame:
        newest = latest_per_key(
            self._live(merges), [KEY], ["_merge"], extra=[F.min_by("_merged_at", "_merge").alias("_first")])
        if not bases:
            return newest.withColumn("_inserted_at", F.col("_first")).select(schemas.SERVICE_REQUESTS.fieldNames())
        base = self._base(bases[-1])
        if not merges:
            return base.select(schemas.SERVICE_REQUESTS.fieldNames())
        ids = newest.select(KEY)
        known = base.join(ids, KEY, "left_semi").select(KEY, F.col("_inserted_at").alias("_known"))
        changed = newest.join(known, KEY, "left").withColumn("_inserted_at", F.coalesce("_known", "_first"))
        return base.join(ids, KEY, "left_anti").select(schemas.SERVICE_REQUESTS.fieldNames()).unionByName(
            changed.select(schemas.SERVICE_REQUESTS.fieldNames()))

    def find(self, ids: DataFrame) -> DataFrame:
        """The rows of the ids in ``ids``. Of the base, only the buckets that they fall into are read."""
        wanted = ids.select(KEY).distinct().withColumn("_bucket", _bucket(self.buckets))
        bases, merges = self._bases(), self._merges()
        if not bases or merges:
            return self._state(bases, merges).join(wanted.select(KEY), KEY, "left_semi")
        return self._base(bases[-1]).join(wanted, ["_bucket", KEY], "left_semi").select(schemas.SERVICE_REQUESTS.fieldNames())

    def compact(self) -> bool:
        """Fold all merges into a new base, if there are any. A reader that began before goes on: what the last
        base replaced is deleted only by the next compaction."""
        bases, merges = self._bases(), self._merges()
        if not merges:
            return False
        folder = f"{self.path}/base/{_number(merges[-1]):012d}"
        self._write_base(self._state(bases, merges), folder)
        counted = self._live(merges).groupBy("_merge").agg(F.count(F.lit(1)).alias("requests"))
        counts = {r["_merge"]: r["requests"] for r in counted.collect()}
        known = self.spark.createDataFrame([(_id_of(m), counts.get(quote(m), counts.get(m, 0))) for m in merges], _FOLDED)
        if bases:
            known = known.unionByName(self.spark.read.schema(_FOLDED).parquet(f"{self.path}/base/{bases[-1]}/merges"))
        # The base counts from here on: its list of merges is written last.
        known.coalesce(1).write.mode("overwrite").parquet(f"{folder}/merges")
        for old in bases[:-1]:
            paths.remove(self.spark, f"{self.path}/base/{old}")
        for merge in paths.subfolders(self.spark, f"{self.path}/merges"):
            if bases and _number(merge) <= _number(bases[-1]):
                paths.remove(self.spark, f"{self.path}/merges/{merge}")
        return True

    def _write_base(self, rows: DataFrame, folder: str) -> None:
        rows.withColumn("_bucket", _bucket(self.buckets)).hint("rebalance", "_bucket").write.mode(
            "overwrite").partitionBy("_bucket").parquet(f"{folder}/rows")

    def rewrite_to(self, path: str) -> "RequestTable":
        """A compact copy with one stored row per id, keeping each first-merged time."""
        copy = RequestTable(self.spark, path, self.buckets)
        if copy._bases() or copy._merges():
            raise FileExistsError(f"{path} holds a table")
        self._copy_to(copy)
        return copy

    def _copy_to(self, copy: "RequestTable") -> None:
        copy._write_base(self.current(), f"{copy.path}/base/{0:012d}")
        self.spark.createDataFrame([], _FOLDED).write.parquet(f"{copy.path}/base/{0:012d}/merges")


def _number(folder: str) -> int:
    return int(folder[:12])


def _id_of(folder: str) -> str:
    return unquote(folder[13:])


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(KEY), F.lit(buckets)).cast("int")


def upsert_with_catalog(rows: DataFrame, table: str, order: list[str] | None = None) -> None:
    """The same upsert as one MERGE, for a catalog table whose format supports it."""
    newest = latest_per_key(rows, [KEY], order or ["classified_at"]).select(schemas.ENRICHED.fieldNames())
    values = {c: F.col(f"source.{c}") for c in schemas.ENRICHED.fieldNames()}
    stamp = F.current_timestamp().cast("timestamp_ntz")
    (
        newest.alias("source")
        .mergeInto(table, F.col(f"{table}.{KEY}") == F.col(f"source.{KEY}"))
        .whenMatched().update({c: v for c, v in values.items() if c != KEY})
        .whenNotMatched().insert({**values, "_inserted_at": stamp})
        .merge()
    )


def create_tables(spark: SparkSession, database: str = "raw") -> None:
    """The raw tables in the session catalog, if absent."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    contracts = {
        "service_requests": (schemas.SERVICE_REQUESTS, []),
        "portal_requests": (schemas.PORTAL_REQUESTS, ["pull_id", "partition_date"]),
        "portal_pulls": (schemas.PORTAL_PULLS, []),
        "portal_parent_lookup": (schemas.PARENT_LOOKUP, []),
    }
    for name, (schema, partitions) in contracts.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet{by}")


def publish_messages(requests: DataFrame) -> DataFrame:
    """Requests as stream messages: the id as key, the request fields without any label as JSON."""
    payload = F.try_parse_json(F.coalesce("raw_payload", F.lit("{}")))
    fields = [F.col(c) for c in schemas.REQUEST.fieldNames() if c not in ("raw_payload", "requested_datetime")]
    when = F.date_format(F.col("requested_datetime").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    body = F.to_json(F.struct(
        *fields, when.alias("requested_datetime"), payload.alias("raw_payload")))
    return requests.select(
        F.encode("service_request_id", "UTF-8").alias("key"), F.encode(body, "UTF-8").alias("value"))


def publish(requests: DataFrame, bootstrap: str, topic: str) -> None:
    """Send requests to a topic; needs the Kafka connector on the cluster's class path."""
    publish_messages(requests).write.format("kafka").option(
        "kafka.bootstrap.servers", bootstrap).option("topic", topic).save()


def dead_letters(failed: DataFrame) -> DataFrame:
    """Failed messages with their original bytes; the reason travels in the headers."""
    def header(name: str, column: str):
        return F.struct(
            F.lit(name).alias("key"),
            F.encode(F.coalesce(column, F.lit("")), "UTF-8").alias("value"))

    return failed.select(
        "key", "value",
        F.array(header("exception_type", "error_type"),
                header("exception_message", "error_message")).alias("headers"),
        "topic", "partition", "offset",
    )


def export_classified(requests: DataFrame, path: str) -> None:
    """Rated requests as JSON lines in id order."""
    from curbline.sources.files import fetch_classified

    stamp = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    rows = fetch_classified(requests)
    for name in ("requested_datetime", "classified_at"):
        rows = rows.withColumn(name, F.date_format(F.col(name).cast("timestamp"), stamp))
    rows.withColumn("raw_payload", F.try_parse_json("raw_payload")).write.mode("overwrite").json(path)


def write_label_sheet(sheet: DataFrame, path: str, force: bool = False) -> None:
    """A blind sheet as CSV; an existing one is only replaced on request."""
    sheet.coalesce(1).sortWithinPartitions("item").write.mode(
        "overwrite" if force else "errorifexists").option("header", True).csv(path)
