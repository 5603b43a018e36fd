"""Ordering, top-n and seeded samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbline import schemas


def oldest_first(requests: DataFrame, limit: int | None = None) -> DataFrame:
    ordered = requests.orderBy(
        F.col("requested_datetime").asc_nulls_last(), F.col("service_request_id").asc_nulls_last()
    )
    return ordered if limit is None else ordered.limit(limit)


def seeded_order(
    rows: DataFrame, seed: int, limit: int | None = None, key: str = "service_request_id"
) -> DataFrame:
    """A repeatable shuffle: ordered by a digest of the id and the seed, whatever the partitioning."""
    ordered = rows.orderBy(F.md5(F.concat(F.col(key), F.lit(str(int(seed))))), key)
    return ordered if limit is None else ordered.limit(limit)


def label_sheet(labelled: DataFrame, n: int = 50, seed: int = 20260923) -> DataFrame:
    """A blind sheet of n seeded rows: never the model's label. n bounds the numbering window."""
    digest = F.md5(F.concat(F.col("service_request_id"), F.lit(str(int(seed)))))
    drawn = (
        labelled.select("service_request_id", "service_name", "status", "address")
        .withColumn("_digest", digest)
        .orderBy("_digest", "service_request_id")
        .limit(n)
    )
    order = Window.orderBy("_digest", "service_request_id")
    return (
        drawn.withColumn("item", F.row_number().over(order))
        .withColumn("human_label", F.lit(""))
        .withColumn("notes", F.lit(""))
        .select(schemas.LABEL_SHEET.fieldNames())
    )


def every_nth_and_last(rows: DataFrame, order_by: str, n: int = 4) -> DataFrame:
    """Rows 1, n+1, 2n+1, … and the final one of a short report (one row per week)."""
    order = Window.orderBy(order_by)
    marked = rows.withColumn("_i", F.row_number().over(order)).withColumn(
        "_last", F.lead(order_by).over(order).isNull()
    )
    return marked.filter((F.pmod(F.col("_i") - 1, F.lit(n)) == 0) | F.col("_last")).drop("_i", "_last")
