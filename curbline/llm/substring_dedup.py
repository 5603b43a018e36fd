"""Removal of word sequences that occur more than once, found through difference-cover anchors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curbline.llm.common import MULTIPLIER, mixed, one_per_id, window_hashes, word_hashes, words_of

# Perfect difference covers. For any two places there is a shift below the period
# that puts both on the cover.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}

FOUND = "hash long, doc_id long, at int, state int"
# States of a place: its hash is alone in its batch and needs the others'; it repeats in its batch and
# speaks for it; it repeats in its batch.
ALONE, SPEAKER, KNOWN = 0, 1, 2


def cover_for(words: int) -> tuple[int, int]:
    """Period and anchor length for repeats of ``words`` words: the sparsest cover that leaves anchors a
    third of the repeat or more. An aligned anchor starts less than a period after a repeat's start."""
    period = max(p for p in COVERS if words - p + 1 >= max(1, words / 3))
    return period, words - period + 1


def _batch(hashes: list[np.ndarray], docs: list, places: list[np.ndarray]) -> pa.RecordBatch:
    """Rows of one batch. Hashes that repeat in it are known to; one row speaks for them elsewhere, and
    the rest get their document's hash, so a common passage doesn't gather anywhere."""
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    at = np.concatenate(places).astype(np.int32) if places else np.zeros(0, np.int32)
    which = np.repeat(np.arange(len(docs)), [len(x) for x in places]) if places else np.zeros(0, np.int64)
    state = np.zeros(len(h), np.int32)
    if len(h):
        _, first, inverse, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        again = count[inverse] > 1
        state[again] = KNOWN
        state[first[count > 1]] = SPEAKER
        scattered = state == KNOWN
        ids = np.array([0 if d is None else d for d in docs], dtype=np.int64).view(np.uint64)
        h = np.where(scattered, mixed(ids * MULTIPLIER)[which], h)
    doc_ids = pa.array(docs, pa.int64()).take(pa.array(which))
    return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), doc_ids, pa.array(at), pa.array(state)],
                                      names=["hash", "doc_id", "at", "state"])


def _repeated(found: DataFrame) -> DataFrame:
    """(of, places): per document, the places whose hash occurs at more than one place."""
    times = F.count("*").over(Window.partitionBy("hash"))
    return (found.repartition("hash").withColumn("times", times)
            .where(f"state >= {SPEAKER} OR times > 1")
            .groupBy(F.col("doc_id").alias("of")).agg(F.collect_list("at").alias("places")))


def _anchors(docs: DataFrame, words: int) -> DataFrame:
    period, size = cover_for(words)
    cover = np.zeros(period, dtype=bool)
    cover[list(COVERS[period])] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, ids, places = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                h = word_hashes(words_of(text))
                if len(h) >= words:
                    starts = np.arange(len(h) - size + 1)
                    starts = starts[cover[starts % period]]
                    hashes.append(window_hashes(h, size, starts))
                    ids.append(doc_id)
                    places.append(starts)
            yield _batch(hashes, ids, places)

    return docs.mapInArrow(run, FOUND)


def _windows(docs: DataFrame, words: int) -> DataFrame:
    """The windows of ``words`` words that a repeated anchor extends to, before and after it."""
    period, _ = cover_for(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, ids, places = [], [], []
            for doc_id, text, anchors in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), batch.column(2)):
                if not anchors.is_valid:
                    continue
                h = word_hashes(words_of(text.as_py()))
                edge = np.zeros(len(h) + 1, dtype=np.int32)
                a = anchors.values.to_numpy()
                np.add.at(edge, np.maximum(0, a - period + 1), 1)
                np.add.at(edge, a + 1, -1)
                starts = np.flatnonzero(np.cumsum(edge)[: len(h) - words + 1] > 0)
                hashes.append(window_hashes(h, words, starts))
                ids.append(doc_id)
                places.append(starts)
            yield _batch(hashes, ids, places)

    return docs.mapInArrow(run, FOUND)


def _kept(docs: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, windows in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), batch.column(2)):
                own = words_of(text.as_py())
                gone = 0
                n = len(own)
                if windows.is_valid:
                    edge = np.zeros(n + 1, dtype=np.int32)
                    a = windows.values.to_numpy()
                    np.add.at(edge, a, 1)
                    np.add.at(edge, a + words, -1)
                    stay = np.cumsum(edge)[:n] == 0
                    gone = n - int(stay.sum())
                    own = [own[i] for i in np.flatnonzero(stay).tolist()]
                rows.append((doc_id, n, gone, b" ".join(own)))
            columns = list(zip(*rows)) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()),
                 pa.array(columns[3], pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return docs.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def remove_repeats(docs: DataFrame, words: int = 35) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every document of (doc_id, text, ...).

    Words are separated by \\x20 and \\x09 to \\x0D. A window is ``words`` consecutive words of a
    document; every word in a window whose words also start at another place, in whichever document, is
    removed from all of them. ``kept`` is what is left, joined by single spaces.

    Only windows on a difference cover are hashed at first (5 of 21 places for 35 words). Two equal
    windows of ``words`` words have an equal anchor at the same distance from their starts, so anchors
    that occur once end the matter; the others extend to all windows around them, which are compared whole.

    Cases: a null or empty text has no words and is kept as ""; a document shorter than a window keeps
    all; overlapping repeats within one document count; rows that share a doc_id (null is one) count as one
    document, with the smallest text; further columns are ignored; an empty table gives an empty table.

    Repeats inside a task's batch are settled there, so a passage that a third of all documents hold
    sends one row per batch to the task that compares its hash.
    """
    docs = one_per_id(docs, "doc_id", "text")

    def beside(places: DataFrame) -> DataFrame:
        return docs.join(places, F.col("doc_id").eqNullSafe(F.col("of")), "left").select("doc_id", "text", "places")

    anchors = _repeated(_anchors(docs, words))
    windows = _repeated(_windows(beside(anchors), words))
    return _kept(beside(windows), words)


def query(spark, sf_dir):
    kept = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))
