"""A left lookup join that stays balanced when a few keys hold most of the left rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.session import materialise


def spread_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: str,
    hot_rows: int = 2_000_000,
) -> DataFrame:
    """``left`` ⟕ ``right`` on ``key`` where ``right`` has at most one row per key.

    Keys with more than ``hot_rows`` left rows are split into pieces of about that size; the piece
    comes from a hash of ``spread_by`` (a retried task picks the same one) and the single right row
    of such a key is repeated once per piece. All other keys join as they are. There are at most
    rows / hot_rows hot keys, and if there is none the join is an ordinary one.
    """
    counts = left.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot = materialise(
        counts.filter(F.col("_n") > hot_rows)
        .select(key, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_pieces")),
        "hot-keys",
    )
    if hot.isEmpty():
        return left.join(right, key, "left")
    piece = F.when(
        F.col("_pieces").isNotNull(), F.pmod(F.xxhash64(spread_by), F.col("_pieces")).cast("int")
    ).otherwise(0)
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1)
    spread = left.join(hot, key, "left").withColumn("_piece", piece).drop("_pieces")
    repeated = right.join(hot, key, "left").withColumn("_piece", F.explode(copies)).drop("_pieces")
    return spread.join(repeated, [key, "_piece"], "left").drop("_piece")
