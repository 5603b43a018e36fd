"""Compute costly expressions a single time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(rows: DataFrame, computed: dict[str, Column], keep: list[str] | None = None) -> DataFrame:
    """``rows`` (or its ``keep`` columns) with the computed columns.

    The values travel through a one-element explode. A filter on an ordinary computed column is
    pushed below it with the whole expression copied into the filter, and copied again for each use
    above; an explode stops that, so a parse is paid once per row. Unused values are still pruned.
    """
    keep = rows.columns if keep is None else keep
    packed = F.struct(*[value.alias(name) for name, value in computed.items()])
    return rows.select(*keep, F.explode(F.array(packed)).alias("_once")).select(*keep, "_once.*")
