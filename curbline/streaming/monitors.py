"""Alerts over the dead-letter stream, lag and counters of a running query."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

from curbline.config import DEFAULT, Settings


def windowed_dead_letter_rate(
    failures: DataFrame, ts: str = "failed_at", slide: str = "1 minute", settings: Settings = DEFAULT
) -> DataFrame:
    """Sliding windows holding more than the threshold of failures. Counts combine on the map side;
    the window edges make this approximate, see ``exact_dead_letter_alerts``."""
    return (
        failures.withWatermark(ts, f"{settings.alert_window_seconds} seconds")
        .groupBy(F.window(ts, f"{settings.alert_window_seconds} seconds", slide))
        .agg(F.count(F.lit(1)).alias("messages_in_window"))
        .filter(F.col("messages_in_window") > settings.alert_threshold)
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                "messages_in_window")
    )


# Seconds that are stored together.
BLOCK_SECONDS = 3_600


class _TrailingCount(StatefulProcessor):
    """Per source partition: counts per second, and the seconds over the limit whose window has grown.

    Seconds are stored by blocks. A micro-batch reads and writes the blocks around its own seconds, so what it costs
    goes by its rows and not by what is stored; of the other blocks it sees the numbers only.
    """

    def __init__(self, window_seconds: int, threshold: int, late_seconds: int) -> None:
        self.window_seconds, self.threshold, self.late_seconds = window_seconds, threshold, late_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getMapState("blocks", "block long", "counts binary")
        self.newest = handle.getValueState("newest", "second long")

    def _stored(self, blocks: np.ndarray, horizon: int) -> tuple[np.ndarray, np.ndarray]:
        """Seconds and counts that these blocks hold, from the horizon on."""
        found = [self.recent.getValue((b,))[0] for b in blocks.tolist() if self.recent.containsKey((b,))]
        seconds, counts = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2).T
        return seconds[seconds >= horizon], counts[seconds >= horizon]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = pd.concat([batch.groupby("second")["n"].sum() for batch in rows]).groupby(level=0).sum()
        new, added = fresh.index.to_numpy(np.int64), fresh.to_numpy(np.int64)
        kept = self.window_seconds + self.late_seconds
        newest = self.newest.get()[0] if self.newest.exists() else None
        # Blocks with a second whose window has a fresh one, or that is in such a window.
        first, last = (new - self.window_seconds) // BLOCK_SECONDS, (new + self.window_seconds) // BLOCK_SECONDS
        touched = np.unique(np.concatenate([first + k for k in range(int((last - first).max()) + 1)]))
        old, n = self._stored(touched, newest - kept) if newest is not None else (new[:0], added[:0])
        seconds, back = np.unique(np.concatenate([old, new]), return_inverse=True)
        counts = np.zeros(len(seconds), np.int64)
        np.add.at(counts, back, np.concatenate([n, added]))
        upto = np.concatenate([[0], np.cumsum(counts)])
        totals = upto[1:] - upto[np.searchsorted(seconds, seconds - self.window_seconds)]
        # A second's window has grown if a fresh second lies in it.
        at = np.searchsorted(new, seconds, side="right")
        grown = (at > 0) & (seconds - new[np.maximum(at - 1, 0)] <= self.window_seconds)
        alerts = [(*key, int(s), int(n)) for s, n in zip(seconds[grown], totals[grown]) if n > self.threshold]
        newest = max(int(new[-1]), newest if newest is not None else int(new[-1]))
        self.newest.update((newest,))
        horizon = newest - kept
        block = seconds // BLOCK_SECONDS
        for b in np.unique(new // BLOCK_SECONDS).tolist():
            held = (block == b) & (seconds >= horizon) if b <= horizon // BLOCK_SECONDS else slice(*np.searchsorted(block, [b, b + 1]))
            if len(seconds[held]):
                self.recent.updateValue((b,), (np.column_stack([seconds[held], counts[held]]).tobytes(),))
        for b in [k[0] for k in self.recent.keys()]:
            if (b + 1) * BLOCK_SECONDS <= horizon:
                self.recent.removeKey((b,))
        yield pd.DataFrame(alerts, columns=["topic", "partition", "second", "messages_in_window"])

    def close(self) -> None:
        pass


def exact_dead_letter_alerts(
    failures: DataFrame, ts: str = "failed_at", settings: Settings = DEFAULT, late_seconds: int = 86_400
) -> DataFrame:
    """Seconds with more than the threshold of failures in the trailing window, per source
    partition, as one consumer per partition would count them.

    Needs the RocksDB state store. A second alerts again, with the higher count, whenever failures within its
    window arrive in a later micro-batch, in whatever order. That is exact for failures up to ``late_seconds``
    behind the partition's newest; of older ones, only those that come together and what is still stored are
    counted. State is bounded by the seconds of the window and ``late_seconds`` per partition.
    """
    rows = failures.select(
        "topic", "partition", F.unix_seconds(F.col(ts).cast("timestamp")).alias("second"),
        F.lit(1).cast("long").alias("n"))
    return (
        rows.groupBy("topic", "partition")
        .transformWithStateInPandas(
            statefulProcessor=_TrailingCount(
                settings.alert_window_seconds, settings.alert_threshold, late_seconds),
            outputStructType="topic string, partition int, second long, messages_in_window long",
            outputMode="Update",
            timeMode="None",
        )
        .select("topic", "partition", F.timestamp_seconds("second").alias("alert_at"),
                "messages_in_window")
    )


def lag_of_progress(progress) -> list[dict]:
    """Per-partition lag of a progress event: latest offset minus end offset, never negative."""
    out = []
    for source in progress.sources:
        try:
            latest = json.loads(source.latestOffset or "{}")
            reached = json.loads(source.endOffset or "{}")
        except ValueError:
            continue
        if not isinstance(latest, dict) or not isinstance(reached, dict):
            continue
        for topic, partitions in latest.items():
            if not isinstance(partitions, dict):
                continue
            at = reached.get(topic) or {}
            for partition, high in partitions.items():
                position = max(0, int(at.get(partition, 0)))
                out.append({"topic": topic, "partition": int(partition), "position": position,
                            "high": int(high), "lag": max(0, int(high) - position)})
    return out


class LagListener(StreamingQueryListener):
    """Hands lag and row counts of every progress event to a callback."""

    def __init__(self, report: Callable[[dict], None]) -> None:
        self.report = report
        self.rows_seen = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.rows_seen += event.progress.numInputRows
        partitions = lag_of_progress(event.progress)
        self.report({
            "batch_id": event.progress.batchId,
            "rows": event.progress.numInputRows,
            "rows_seen": self.rows_seen,
            "total_lag": sum(p["lag"] for p in partitions),
            "partitions": partitions,
            "observed": dict(event.progress.observedMetrics or {}),
        })

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def observed(enriched: DataFrame, name: str = "outcome") -> DataFrame:
    """Processed and failed counters as metrics of the job that writes the rows."""
    return enriched.observe(
        name,
        F.count(F.lit(1)).alias("processed"),
        F.count_if(F.col("error_type").isNotNull()).alias("failed"),
    )
