"""Running sums in an order, without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbline.session import materialise


def running_sum(rows: DataFrame, by: list[str], order: str, value: str, name: str) -> DataFrame:
    """``rows`` with ``before``, the sum of ``value`` over the rows of the same group that come before in ``order``.

    Rows are dealt by range of (group, order). Sums run within a task's share of a group, and what a group's
    earlier tasks hold is added from a table of one row per group and task: a group with most of the rows is
    spread over as many tasks as its rows need. (group, order) must be unique.
    """
    dealt = materialise(
        rows.repartitionByRange(*by, order).withColumn("_task", F.spark_partition_id()), f"{name}-dealt")
    inside = Window.partitionBy(*by, "_task").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*by).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shares = dealt.groupBy(*by, "_task").agg(F.sum(value).alias("_sum")).select(
        *[F.col(c).alias(f"_of_{c}") for c in by], F.col("_task").alias("_of_task"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_earlier"))
    same = F.col("_task") == F.col("_of_task")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return (
        dealt.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(shares, same)
        .select(*rows.columns, (F.col("_inside") + F.col("_earlier")).alias("before"))
    )


def weighted_median(counts: DataFrame, by: list[str], value: str, n: str, name: str) -> DataFrame:
    """The exact median of ``value`` per group, as ``median``, where a row stands for ``n`` equal values.

    With an even number it is the mean of the two in the middle. Null values don't count; a group of nothing
    but nulls has no row.
    """
    given = counts.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.sum(n).alias("_n"))
    placed = running_sum(given, by, value, "_n", name)
    totals = given.groupBy(*by).agg(F.sum("_n").alias("_all")).withColumnsRenamed({c: f"_in_{c}" for c in by})
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_in_{c}"))
    holds = lambda place: (F.col("before") <= place) & (place < F.col("before") + F.col("_n"))
    lower, upper = F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2)
    middle = placed.join(totals, same).filter(holds(lower) | holds(upper))
    return middle.groupBy(*by).agg(((F.min(value) + F.max(value)) / 2).alias("median"))
