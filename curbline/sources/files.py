"""Batch readers over landed files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline import schemas
from curbline.functions import times, values
from curbline.operators import latest, validate
from curbline.session import materialise


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A headed CSV with declared column types."""
    return (
        spark.read.schema(schema)
        .option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
        .csv(path)
    )


def feed_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed response file: its text and the file it came from."""
    return (
        spark.read.option("wholetext", True).text(path)
        .select(F.col("_metadata.file_path").alias("page"), "value")
    )


def backfill_window(
    pages: DataFrame,
    start: datetime,
    end: datetime,
    status: str | None = None,
    service_codes: list[str] | None = None,
) -> DataFrame:
    """Accepted requests of a bounded period; no memory of earlier polls, status None means all."""
    rows = validate.accepted(validate.feed_records(pages, require_id=False)).filter(
        F.col("requested_datetime").between(F.lit(start), F.lit(end))
    )
    if status:
        rows = rows.filter(F.col("status") == status)
    if service_codes:
        rows = rows.filter(F.col("service_code").isin(*service_codes))
    return rows


def _cast_extract(name: str) -> Column:
    text, kind = F.col(name), schemas.EXTRACT_TYPES[name]
    if kind == schemas.NTZ:
        return times.local_timestamp(text).alias(name)
    if isinstance(kind, T.BooleanType):
        return values.lenient_bool(text).alias(name)
    if isinstance(kind, T.IntegerType):
        return values.lenient_int(text).alias(name)
    if isinstance(kind, T.DoubleType):
        return text.try_cast("double").alias(name)
    return text


def typed_extract(raw: DataFrame) -> DataFrame:
    """Lenient casts of the all-text extract columns; columns beyond the 18 are kept in front."""
    extra = [c for c in raw.columns if c not in schemas.EXTRACT_TYPES]
    return raw.select(*extra, *[_cast_extract(c) for c in schemas.EXTRACT_TYPES])


def portal_csv(spark: SparkSession, path: str) -> DataFrame:
    """An extract page: 18 text columns with a header, cast leniently."""
    raw = (
        spark.read.schema(schemas.EXTRACT_CSV)
        .option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
        .csv(path)
    )
    return typed_extract(raw)


def portal_days(spark: SparkSession, root: str) -> DataFrame:
    """Extract pages landed as ``root/partition_date=<day>/*.csv``, with their day."""
    raw = (
        spark.read.schema(
            T.StructType(schemas.EXTRACT_CSV.fields + [T.StructField("partition_date", T.DateType())])
        )
        .option("basePath", root)
        .option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
        .csv(f"{root}/partition_date=*")
    )
    return typed_extract(raw)


CORRUPT = "corrupt"


def extract_pages(spark: SparkSession, root: str) -> DataFrame:
    """Every record of the pages landed as ``root/page=<name>/*.csv`` or ``.csv.gz``: the page, the 18 typed columns, and
    in ``corrupt`` the text of a record that has not 18 fields (NULL for all others; its columns mean nothing). An empty
    field is NULL, quoted or not. Parsed once and written, as the report and the rows both read them."""
    fields = [*schemas.EXTRACT_CSV.fields, T.StructField(CORRUPT, T.StringType()), T.StructField("page", T.StringType())]
    raw = (
        spark.read.schema(T.StructType(fields))
        .option("basePath", root).option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
        .option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
        .csv(f"{root}/page=*")
    )
    return materialise(typed_extract(raw).withColumn(CORRUPT, F.rtrim(F.col(CORRUPT), F.lit("\r\n"))), "extract-pages")


def reconcile_pages(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """What came of each page that the manifest (page, expected_count) or the folder has.

    ``complete``: as many records as expected, none corrupt. ``corrupt``: some record didn't parse, the first by its
    text is told. ``count_mismatch``: another number of records, also none at all. ``unplanned``: not in the manifest.
    """
    read = records.groupBy("page").agg(
        F.count(F.lit(1)).alias("records"), F.count(CORRUPT).alias("corrupt_records"), F.min(CORRUPT).alias("first_corrupt"))
    none = F.lit(0).cast("long")
    both = manifest.select("page", "expected_count").join(read, "page", "full").withColumns(
        {c: F.coalesce(c, none) for c in ("records", "corrupt_records")})
    status = (
        F.when(F.col("expected_count").isNull(), "unplanned")
        .when(F.col("corrupt_records") > 0, "corrupt")
        .when(F.col("records") != F.col("expected_count"), "count_mismatch")
        .otherwise("complete")
    )
    return both.select("page", "expected_count", "records", "corrupt_records", "first_corrupt", status.alias("status"))


def complete_pages(records: DataFrame, report: DataFrame) -> DataFrame:
    """The records of the pages that the report calls complete."""
    return records.drop(CORRUPT).join(report.filter("status = 'complete'").select("page"), "page", "left_semi")


def read_recorded_labels(spark: SparkSession, path: str) -> DataFrame:
    """Recorded enriched requests as JSON lines; blank lines vanish, the newest label per id wins."""
    text = {"requested_datetime", "classified_at"}
    schema = T.StructType([
        T.StructField(f.name, T.StringType(), True)
        if f.name in text or f.name == "raw_payload" else f
        for f in schemas.ENRICHED.fields
    ])
    rows = spark.read.schema(schema).json(path).filter(F.col("service_request_id").isNotNull())
    for name in sorted(text):
        rows = rows.withColumn(name, times.utc_timestamp(F.col(name)))
    return latest.latest_per_key(rows, ["service_request_id"], ["classified_at"]).select(
        schemas.ENRICHED.fieldNames()
    )


def listed(rows: DataFrame, column: str, n: int = 10) -> str:
    """For an error text: the first values of a column and how many rows there are; "" for none."""
    first = rows.select(F.col(column).cast("string")).orderBy(column).head(n)
    return f"{[r[0] for r in first]} ({rows.count()} in all)" if first else ""


def read_label_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A filled-in sheet. Raises if any row still has no human label."""
    sheet = (
        spark.read.schema(schemas.LABEL_SHEET)
        .option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
        .csv(path)
    )
    if blank := listed(sheet.filter(F.trim(F.coalesce("human_label", F.lit(""))) == ""), "item"):
        raise ValueError(f"no human label yet for items {blank}")
    return sheet


def read_extract_fixture(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The three extract tables exported as CSV (gzip is transparent)."""
    return {
        "portal_requests": read_seed(spark, f"{root}/portal_requests", schemas.PORTAL_REQUESTS),
        "portal_pulls": read_seed(spark, f"{root}/portal_pulls", schemas.PORTAL_PULLS),
        "portal_parent_lookup": read_seed(
            spark, f"{root}/portal_parent_lookup", schemas.PARENT_LOOKUP),
    }


def load_extract_fixture(spark: SparkSession, root: str, target: str) -> None:
    """Replace the three raw tables under ``target`` with the exported ones."""
    for name, rows in read_extract_fixture(spark, root).items():
        rows.write.mode("overwrite").parquet(f"{target}/{name}")


def lookup_by_ids(lookup: DataFrame, ids: DataFrame, key: str = "sr_number") -> DataFrame:
    """Only the listed ids of an external table."""
    return lookup.join(ids.select(key), key, "left_semi")


def fetch_unclassified(
    requests: DataFrame, limit: int | None = None, sample_seed: int | None = None
) -> DataFrame:
    """Requests still unrated: oldest first, or in a seeded pseudo-random order."""
    from curbline.operators.sampling import oldest_first, seeded_order

    pending = validate.with_read_defaults(
        requests.filter(F.col("urgency_label") == "Unknown")
    ).select(schemas.REQUEST.fieldNames())
    if sample_seed is None:
        return oldest_first(pending, limit)
    return seeded_order(pending, sample_seed, limit)


def fetch_classified(requests: DataFrame) -> DataFrame:
    """Every rated request in id order."""
    return (
        requests.filter(F.col("urgency_label") != "Unknown")
        .select(schemas.ENRICHED.fieldNames())
        .orderBy(F.col("service_request_id").asc_nulls_last())
    )
