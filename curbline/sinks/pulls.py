"""Landing an extract pull: append versions per day, count, and record the ledger."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline import schemas
from curbline.operators.latest import latest_per_key
from curbline.session import materialise
from curbline.sinks import paths
from curbline.sources.files import listed


# Rows of a day beyond which it is written as several files.
ROWS_PER_FILE = 2_000_000


class CountMismatch(RuntimeError):
    """A day landed a different number of rows than its source reported."""


class DuplicateKey(RuntimeError):
    """One request appeared twice in a pull."""


def duplicate_days(rows: DataFrame) -> DataFrame:
    """Days of a pull holding a repeated sr_number, wherever its other copy is."""
    repeated = rows.groupBy("sr_number").agg(F.count(F.lit(1)).alias("n"),
                                             F.max("partition_date").alias("partition_date"))
    return repeated.filter(F.col("n") > 1).select("partition_date").distinct()


def ledger(plan: DataFrame, landed: DataFrame, manifest: DataFrame, failed_days: DataFrame | None = None
           ) -> DataFrame:
    """Every planned day with its source counts, landed count and status.

    ``plan`` carries pull_id, window_label, partition_date, where_clause, started_at, finished_at;
    ``manifest`` the source's counts before and after paging. A day is verified only when all three
    counts agree; a planned day without rows lands zero, and a failed one has no counts.
    """
    counts = landed.groupBy("pull_id", "partition_date").agg(F.count(F.lit(1)).alias("landed_count"))
    rows = (
        plan.join(counts, ["pull_id", "partition_date"], "left")
        .join(manifest.select("pull_id", "partition_date", "expected_count", "expected_count_after"),
              ["pull_id", "partition_date"], "left")
        .withColumn("landed_count", F.coalesce("landed_count", F.lit(0).cast("long")))
    )
    agree = (F.col("expected_count") == F.col("landed_count")) & (
        F.col("landed_count") == F.col("expected_count_after"))
    status = F.when(F.coalesce(agree, F.lit(False)), "verified").otherwise("count_mismatch")
    if failed_days is not None:
        failed = failed_days.select("partition_date", F.lit(True).alias("_failed"))
        rows = rows.join(failed, "partition_date", "left")
        status = F.when(F.col("_failed"), "failed").otherwise(status)
        rows = rows.withColumns({c: F.when(F.col("_failed").isNull(), F.col(c))
                                 for c in ("expected_count", "expected_count_after", "landed_count")})
    return rows.withColumn("status", status).select(schemas.PORTAL_PULLS.fieldNames())


def write_pages(rows: DataFrame, root: str, columns: list[str] | None = None) -> None:
    """Extract rows as gzipped CSV with a header, added to ``root/page=<name>/``, a file for each page in ``rows``."""
    def text(name: str):
        if schemas.EXTRACT_TYPES[name] == schemas.NTZ:
            return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(name)
        return F.col(name).cast("string").alias(name)

    (
        rows.select("page", *[text(c) for c in columns or schemas.EXTRACT_TYPES])
        .repartition("page").write.mode("append").partitionBy("page")
        .option("header", True).option("quote", '"').option("escape", '"').option("compression", "gzip")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(root)
    )


def portal_pull(
    spark: SparkSession,
    extract: DataFrame,
    plan: DataFrame,
    manifest: DataFrame,
    target: str,
    pull_id: str,
    pulled_at: datetime,
    finished_at: datetime | None = None,
) -> DataFrame:
    """Land one pull under ``target`` and return its ledger rows.

    ``extract`` holds the typed columns and their ``partition_date``; ``plan`` is a partition plan;
    ``manifest`` has the source's counts per day. A day goes from ``loading`` to ``verified``,
    ``count_mismatch`` or ``failed``, and the ledger has one row per pull and day, its newest:

    1. every planned day is ``loading``, so that readers pass over it from here on;
    2. the new versions are written aside, where a repeated key fails its day;
    3. the days are swapped: one with versions replaces what an earlier run of the pull landed there, one
       without, or one that failed, loses it;
    4. the rows that are now in the table are counted and the days get their last status.

    A run that stops anywhere leaves days ``loading`` or ``failed``, which no reader takes; running the pull again
    lands them. A repeated key or a count mismatch raises, after the record of it is written.
    """
    days = materialise(plan.select(
        F.lit(pull_id).alias("pull_id"), "window_label", "partition_date", "where_clause",
        F.lit(pulled_at).cast("timestamp_ntz").alias("started_at")).distinct(), "planned-days")
    now = F.lit(finished_at) if finished_at else F.current_timestamp()
    stamped = days.withColumn("finished_at", now.cast("timestamp_ntz"))
    record_days(spark, target, pull_id, without_counts(days.withColumn("finished_at", F.lit(None)), "loading"))
    try:
        versions = materialise(
            extract.join(plan.select("partition_date"), "partition_date", "left_semi").select(
                F.lit(pull_id).alias("pull_id"),
                F.lit(pulled_at).cast("timestamp_ntz").alias("pulled_at"),
                "partition_date", *schemas.EXTRACT_TYPES,
            ),
            "pull",
        )
        failed = materialise(duplicate_days(versions), "failed-days")
        swap_days(spark, target, pull_id, versions.join(failed, "partition_date", "left_anti"), days)
        landed = landed_requests(spark, target).filter(F.col("pull_id") == pull_id)
        record = materialise(
            ledger(stamped, landed, manifest.withColumn("pull_id", F.lit(pull_id)), failed), "ledger")
    except Exception:
        record_days(spark, target, pull_id, without_counts(stamped, "failed"))
        raise
    record_days(spark, target, pull_id, record)
    if broken := listed(failed, "partition_date"):
        raise DuplicateKey(f"repeated sr_number on {broken}")
    if off := listed(record.filter(F.col("status") != "verified"), "partition_date"):
        raise CountMismatch(f"counts disagree on {off}")
    return record


def landed_requests(spark: SparkSession, target: str) -> DataFrame:
    """The versions landed under ``target``, of all pulls and days."""
    return _landed(spark, f"{target}/portal_requests", schemas.PORTAL_REQUESTS)


def landed_ledger(spark: SparkSession, target: str) -> DataFrame:
    """The ledger under ``target``: one row per pull and day."""
    return _landed(spark, f"{target}/portal_pulls", schemas.PORTAL_PULLS)


def _landed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # The schema is given, as a pull id made of digits would be read back as a number. A table that
    # has no pull yet has no files either.
    if not paths.subfolders(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(path).select(schema.fieldNames())


def without_counts(days: DataFrame, status: str) -> DataFrame:
    """Ledger rows of days that were not counted."""
    none = F.lit(None).cast("long")
    return days.select(
        "pull_id", "window_label", "partition_date", "where_clause",
        *[none.alias(c) for c in ("expected_count", "expected_count_after", "landed_count")],
        F.lit(status).alias("status"), "started_at", F.col("finished_at").cast("timestamp_ntz").alias("finished_at"))


def record_days(spark: SparkSession, target: str, pull_id: str, rows: DataFrame) -> None:
    """Put ledger rows of one pull in place of those of the same days. A pull's rows are one small file,
    written anew each time; other pulls' aren't touched."""
    older = landed_ledger(spark, target).filter(F.col("pull_id") == pull_id).join(
        rows.select("partition_date"), "partition_date", "left_anti")
    whole = materialise(older.select(schemas.PORTAL_PULLS.fieldNames()).unionByName(
        rows.select(schemas.PORTAL_PULLS.fieldNames())), "ledger-rows")
    _replace(whole.coalesce(1), f"{target}/portal_pulls", "pull_id")


def _replace(rows: DataFrame, path: str, *by: str) -> None:
    """Write rows in place of what the partitions that they belong to hold."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def swap_days(spark: SparkSession, target: str, pull_id: str, rows: DataFrame, days: DataFrame) -> None:
    """Let a pull's planned ``days`` hold ``rows`` and nothing else.

    A day is one file, or as many as its rows need, and the files are dealt over all tasks: many small days
    don't queue up in one, and a day that is far larger isn't left to one. Days without rows aren't reached
    by overwriting; the folders of what they held are deleted.
    """
    sizes = rows.groupBy("partition_date").agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_FILE).alias("_files"))
    piece = F.pmod(F.xxhash64("sr_number"), F.col("_files")).alias("_piece")
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.join(sizes, "partition_date").select(*rows.columns, piece).repartition(tasks, "partition_date", "_piece")
    _replace(dealt.drop("_piece"), f"{target}/portal_requests", "pull_id", "partition_date")
    emptied = days.select("partition_date").join(sizes, "partition_date", "left_anti")
    if not paths.subfolders(spark, f"{target}/portal_requests"):
        return
    held = (
        spark.read.schema(schemas.PORTAL_REQUESTS).parquet(f"{target}/portal_requests")
        .filter(F.col("pull_id") == pull_id)
        .select("partition_date", F.col("_metadata.file_path").alias("file")).distinct()
        .join(emptied, "partition_date", "left_semi")
        .select(F.regexp_replace("file", "/[^/]*$", "").alias("folder")).distinct()
    )
    # One folder per day of the plan at most.
    for row in held.collect():
        paths.remove_uri(spark, row["folder"])


def upsert_parent_lookup(current: DataFrame, new: DataFrame) -> DataFrame:
    """The lookup with new rows inserted or replacing those of the same sr_number. Of new rows that
    share one, the latest looked up stays."""
    new = latest_per_key(new.select(current.columns), ["sr_number"], ["looked_up_at"])
    return current.join(new.select("sr_number"), "sr_number", "left_anti").select(
        current.columns).unionByName(new.select(current.columns))


def fixture_tables(
    portal_requests: DataFrame, portal_pulls: DataFrame, parent_lookup: DataFrame, types: DataFrame
) -> dict[str, DataFrame]:
    """Every verified version of whole types, a ledger re-derived for them, and their parents."""
    kept = portal_requests.join(types.select("sr_type"), "sr_type", "left_semi").select(
        portal_requests.columns)
    good = portal_pulls.filter(F.col("status") == "verified")
    day = ["pull_id", "partition_date"]
    requests = kept.join(good.select(day), day, "left_semi").select(portal_requests.columns)
    counts = kept.groupBy(day).agg(F.count("sr_number").alias("_n"))
    n = F.coalesce("_n", F.lit(0).cast("long"))
    pulls = good.join(counts, day, "left").select(
        "pull_id", "window_label", "partition_date",
        F.concat("where_clause", F.lit(" AND sr_type IN (fixture types)")).alias("where_clause"),
        n.alias("expected_count"), n.alias("expected_count_after"), n.alias("landed_count"),
        F.lit("verified").alias("status"), "started_at", "finished_at",
    )
    named = kept.filter(F.col("parent_sr_number").isNotNull()).select(
        F.col("parent_sr_number").alias("sr_number")).distinct()
    parents = parent_lookup.join(named, "sr_number", "left_semi").select(parent_lookup.columns)
    return {"portal_requests": requests, "portal_pulls": pulls, "portal_parent_lookup": parents}


def export_fixture(tables: dict[str, DataFrame], root: str) -> None:
    """The fixture tables as CSV; the versions sorted within files and gzipped."""
    order = {"portal_requests": ["pull_id", "sr_number"],
             "portal_pulls": ["pull_id", "partition_date"],
             "portal_parent_lookup": ["sr_number"]}
    for name, rows in tables.items():
        writer = rows.orderBy(*order[name]).write.mode("overwrite").option("header", True).option("escape", '"')
        if name == "portal_requests":
            writer = writer.option("compression", "gzip")
        writer.csv(f"{root}/{name}")
