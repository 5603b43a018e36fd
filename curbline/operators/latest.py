"""Keep one row per key without sending a key's whole history to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    extra: list[Column] | None = None,
    order_is_total: bool = False,
) -> DataFrame:
    """The row with the greatest ``order`` tuple per key; NULL ranks lowest.

    ``max_by`` is an aggregate, so each map task first reduces its rows to one per key. A key
    holding a third of the table therefore costs one row per map task in the shuffle, where a
    ranking window would pull all its rows into one task. Unless the order is known to be total,
    ties fall to a hash of the row, so that a retried task keeps the same one.
    """
    rest = [c for c in rows.columns if c not in keys]
    rank = [F.col(c) for c in order]
    if not order_is_total:
        rank.append(F.xxhash64(*[c for c in rest if c not in order]))
    picked = rows.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*rank)).alias("_row"), *(extra or []))
    kept = [F.col(f"_row.{c}").alias(c) if c not in keys else F.col(c) for c in rows.columns]
    added = [c for c in picked.columns if c not in keys and c != "_row"]
    return picked.select(*kept, *added)
