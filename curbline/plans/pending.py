"""Classify the stored requests that are still unrated, and write the results back."""

from __future__ import annotations

from pyspark.sql import functions as F

from curbline.operators.classify import classify
from curbline.session import materialise
from curbline.sinks.requests import RequestTable
from curbline.sources.files import fetch_unclassified


def classify_pending(
    table: RequestTable,
    merge_id: str,
    strategy: str,
    limit: int | None = None,
    sample_seed: int | None = None,
    **options,
) -> dict[str, int]:
    """Label unrated rows by a strategy and merge the successes under ``merge_id``.

    Rows that fail stay unrated and are met again next time, so a repeated run only does what is
    left. The labelled rows are written once before they are counted and merged, so that a costly
    labelling function runs once per row.
    """
    pending = fetch_unclassified(table.current(), limit, sample_seed)
    labelled = materialise(classify(pending, strategy, **options), "labelled")
    failed = F.col("error_type").isNotNull()
    counts = labelled.agg(
        F.count_if(~failed).alias("classified"), F.count_if(failed).alias("failed")).head()
    if counts["classified"]:
        table.upsert(labelled.filter(~failed), merge_id)
    return {"classified": counts["classified"], "failed": counts["failed"]}
