"""Streaming readers. Every one yields the seven message columns or feed pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline import schemas


def kafka_messages(
    spark: SparkSession,
    bootstrap: str,
    topic: str,
    group: str | None = None,
    starting: str = "earliest",
    max_offsets: int | None = None,
) -> DataFrame:
    """Messages of a topic; needs the Kafka connector on the cluster's class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("includeHeaders", True)
    )
    if group:
        reader = reader.option("kafka.group.id", group)
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(*schemas.MESSAGE.fieldNames())


def file_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same columns from Parquet files, for replays and tests."""
    reader = spark.readStream.schema(schemas.MESSAGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def feed_pages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New response files of a landing folder, one row each, stamped with the time of the micro-batch that reads it.

    A file counts as new whatever its modification time; Spark would pass over those a week older than the
    newest. So the source remembers the name of every file it has read.
    """
    reader = spark.readStream.option("wholetext", True).option("maxFileAge", "36500d")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("page"),
        F.current_timestamp().alias("arrived_at"),
        "value",
    )
