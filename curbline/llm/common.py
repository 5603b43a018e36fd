"""What several operators share: one row per id, size-checked joins, words and their hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A broadcast side is a table of at most this many rows of one or two longs (about 32 MB in a hash
# relation); a larger side is joined by a shuffle.
BROADCAST_ROWS = 500_000

# The characters \x20 and \x09 to \x0D, which separate words. bytes.split() uses the same set.
BLANKS = " \t\n\x0b\f\r"

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def one_per_id(df: DataFrame, key: str, *values: str) -> DataFrame:
    """The columns ``key`` and ``values``, one row per key; of rows that share a key (null is a key
    too), the one with the smallest values stays.

    Only the key column is read to see whether any repeats; the values are grouped only then.
    """
    df = df.select(key, *values)
    repeated = df.groupBy(key).count().where("count > 1").limit(1)
    if repeated.isEmpty():
        return df
    return (df.groupBy(key).agg(F.min(F.struct(*values)).alias("_least"))
            .select(key, *[F.col("_least").getField(v).alias(v) for v in values]))


def bounded(df: DataFrame) -> DataFrame:
    """``df``, a materialised table of long keys, marked for broadcast if its row count allows it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def given_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run``, a function for mapInArrow, after whose last batch the worker gives its free memory back to the system. It
    goes on to other stages, and else keeps what the task with the largest batches took."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return whole


def words_of(text: bytes | None) -> list[bytes]:
    return text.split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over 64-bit integers, so that every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(h: np.ndarray, size: int, starts: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of the windows of ``size`` word hashes, at ``starts`` or at every position."""
    n = max(0, len(h) - size + 1) if starts is None else len(starts)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out *= MULTIPLIER
        out += h[k: k + n] if starts is None else h[starts + k]
    return mixed(out ^ np.uint64(size))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct elements."""
    x = np.sort(x)
    first = np.ones(len(x), dtype=bool)
    np.not_equal(x[1:], x[:-1], out=first[1:])
    return x[first]
