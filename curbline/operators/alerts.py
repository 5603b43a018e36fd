"""Trailing-window failure counts and consumer lag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.config import DEFAULT, Settings


def dead_letter_rate(
    failures: DataFrame, ts: str, by: list[str] | None = None, settings: Settings = DEFAULT
) -> DataFrame:
    """Seconds at which more than the threshold of failures lie in the trailing window, inclusive.

    Failures are first counted per second. The seconds are then windowed in time slices, each
    holding a copy of the seconds just before it, so that the work splits over time and no task
    sees the whole history.
    """
    by = by or []
    span = settings.alert_window_seconds
    slice_seconds = max(3600, span)
    second = F.unix_seconds(F.col(ts).cast("timestamp"))
    per_second = failures.groupBy(*by, second.alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
    own = F.floor(F.col("_s") / slice_seconds)
    reach = F.floor((F.col("_s") + span) / slice_seconds)
    sliced = per_second.withColumn("_slice", F.explode(F.sequence(own, reach)))
    trailing = Window.partitionBy(*by, "_slice").orderBy("_s").rangeBetween(-span, 0)
    return (
        sliced.withColumn("messages_in_window", F.sum("_n").over(trailing))
        .filter((F.col("_slice") == own) & (F.col("messages_in_window") > settings.alert_threshold))
        .select(*by, F.timestamp_seconds("_s").cast("timestamp_ntz").alias("alert_at"),
                "messages_in_window")
    )


def consumer_lag(offsets: DataFrame) -> DataFrame:
    """(topic, partition, position, high) rows with lag = max(0, high - position)."""
    position = F.greatest(F.coalesce("position", F.lit(0)), F.lit(0))
    return offsets.select(
        "topic", "partition", position.alias("position"), "high",
        F.greatest(F.lit(0), F.col("high") - position).alias("lag"),
    )


def total_lag(lag: DataFrame) -> DataFrame:
    return lag.groupBy("topic").agg(
        F.count(F.lit(1)).alias("partitions"), F.sum("lag").alias("total_lag"))
