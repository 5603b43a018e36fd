"""Principal components of vectors and their whitened coordinates, from an exact integer grid."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.session import materialise

# Entries are placed on a grid of whole numbers: floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024.0, 100_000
# Vectors with an entry at or beyond this on the grid are left out: sums and differences stay exact.
WIDEST = float(1 << 62)
RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def _grid(column: pa.Array, length: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and grid entries of the vectors of each length, or of one length."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    for d in np.unique(lengths) if length is None else [length]:
        at = np.flatnonzero(lengths == d)
        if not len(at) or d == 0:
            continue
        x = np.floor(SCALE * flat[starts[at][:, None] + np.arange(d)])
        fits = (np.abs(x) < WIDEST).all(axis=1)
        yield at[fits], x[fits].astype(np.int64) + SHIFT


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each length: rows, and per dimension the sums of the entries' upper and lower halves."""
    found: dict[int, list] = {}
    for batch in batches:
        for at, x in _grid(batch.column(0)):
            if len(at):
                total = found.setdefault(x.shape[1], [0, 0, 0])
                total[0] += len(x)
                total[1] = total[1] + (x >> 32).sum(axis=0)
                total[2] = total[2] + (x & 0xFFFFFFFF).sum(axis=0)
    for d, (n, high, low) in found.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(d, d, np.int32)), pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, n, np.int64)),
             pa.array(high), pa.array(low)], names=["length", "at", "n", "high", "low"])


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """Columns L, one per pivot and of falling pivots, with L @ L.T == a. In the order in which rows become pivots
    they are lower triangular. There are as many as the rank of ``a``, a positive semidefinite matrix."""
    rest, columns = a.copy(), []
    least = len(a) * np.finfo(float).eps * max(np.diagonal(a).max(initial=0.0), 0.0)
    for _ in range(len(a)):
        pivot = int(np.argmax(np.diagonal(rest)))
        if rest[pivot, pivot] <= least:
            break
        column = rest[:, pivot] / np.sqrt(rest[pivot, pivot])
        rest -= np.outer(column, column)
        rest[pivot, :] = rest[:, pivot] = 0.0
        columns.append(column)
    return np.array(columns).T if columns else np.zeros((len(a), 0))


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of n columns once, in rounds of pairs that have no column in common."""
    ring = list(range(n + n % 2))
    half = len(ring) // 2
    for _ in range(len(ring) - 1):
        pairs = [(a, b) for a, b in zip(ring[:half], reversed(ring[half:])) if a < n and b < n]
        yield np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int)
        ring = [ring[0], ring[-1], *ring[1:-1]]


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor's columns rotated in pairs until all are orthogonal: factor @ Q for an orthogonal Q."""
    w = factor.copy()
    eps = np.finfo(float).eps
    for _ in range(sweeps):
        turned = False
        for i, j in _rounds(w.shape[1]):
            x, y = w[:, i], w[:, j]
            a, b, c = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            need = np.abs(c) > eps * np.sqrt(a * b)
            if not need.any():
                continue
            turned = True
            i, j, x, y, a, b, c = i[need], j[need], x[:, need], y[:, need], a[need], b[need], c[need]
            zeta = (b - a) / (2 * c)
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cosine = 1 / np.hypot(1.0, t)
            w[:, i], w[:, j] = cosine * x - cosine * t * y, cosine * t * x + cosine * y
        if not turned:
            break
    return w


def principal_components(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a scatter matrix, falling, and unit eigenvectors as columns; as many as its rank. Each vector's
    largest entry is positive."""
    rotated = one_sided_jacobi(pivoted_cholesky(scatter))
    norms = np.sqrt((rotated * rotated).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    vectors = rotated[:, order] / norms[order]
    largest = np.abs(vectors).argmax(axis=0) if vectors.size else np.zeros(0, int)
    return norms[order] ** 2, vectors * np.sign(vectors[largest, np.arange(vectors.shape[1])])


def whiten(vectors: DataFrame, components: int = 8) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each vector of
    (vec_id, embedding, ...) and each of the first ``components`` principal components.

    Entries are placed on a grid of whole numbers, whose sums per dimension are exact, so centring loses nothing to
    the grid's offset. A first pass adds up the vectors, a second the scatter of the centred ones: each task sends
    one square matrix as wide as a vector, and the driver holds one such matrix, however many vectors there are.
    Its pivoted Cholesky factor is turned by one-sided Jacobi rotations until its columns are orthogonal; their
    squared norms over n are the covariance's eigenvalues and the columns, normalised, its components. A third pass
    projects. ``deviation`` is n*n times the squared distance from the mean, exactly; ``identity_error`` the largest
    entry, in absolute value, of the whitened coordinates' covariance minus the identity.

    Cases: vectors that are null or empty or hold null or non-finite entries, or entries of 2^62 or more on the grid,
    are left out; so are those whose length isn't the commonest (of equally common ones the largest). A null or repeated
    vec_id has rows like any other. Components without variance don't exist: there are at most as many as the
    covariance's rank, none for a single vector or equal ones, and then no rows. Equal eigenvalues come in any order
    of their components. A deviation that doesn't fit a long is null. Further columns are ignored and may have any
    name; an empty table gives an empty table.
    """
    spark = vectors.sparkSession
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(
        F.coalesce((F.size("embedding") > 0) & ~bad, F.lit(False)))
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    sums = materialise(
        good.select("embedding").mapInArrow(_sums, "length int, at int, n long, high long, low long")
        .groupBy("length", "at").agg(F.sum("n").alias("n"), exact("high"), exact("low")), "whitening-sums")
    common = sums.where("at = 0").orderBy(F.desc("n"), F.desc("length")).select("length", "n").head()
    if common is None:
        return spark.createDataFrame([], f"vec_id {id_type}, {RESULT}")
    d, n = common
    # One row per dimension of a vector.
    total = [(int(r["high"]) << 32) + int(r["low"]) for r in sums.where(F.col("length") == d).orderBy("at").collect()]
    floor = np.array([s // n for s in total], np.int64)
    rest = np.array([s % n for s in total], np.int64)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((d, d))
        for batch in batches:
            for _, x in _grid(batch.column(0), d):
                centred = (x - floor) - rest / n
                found += centred.T @ centred
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(d, dtype=np.int32)), pa.array(found.tolist(), pa.list_(pa.float64()))], names=["at", "entries"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            entries = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            for at, row in zip(batch.column(0).to_pylist(), entries):
                found[at] = found[at] + row if at in found else row.copy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int32()), pa.array([r.tolist() for r in found.values()], pa.list_(pa.float64()))],
            names=["at", "entries"])

    shape = "at int, entries array<double>"
    parts = good.select("embedding").mapInArrow(scatter, shape)
    matrix = materialise(parts.repartition("at").mapInArrow(added, shape), "whitening-scatter")
    # A square matrix as wide as a vector.
    whole = np.array([r["entries"] for r in matrix.orderBy("at").collect()])
    squares, axes = principal_components((whole + whole.T) / 2)
    kept = min(components, len(squares))
    explained = (squares / np.trace(whole))[:kept].tolist()
    weights = axes[:, :kept] / np.sqrt(squares[:kept] / n)
    spread = sum(int(r) ** 2 for r in rest)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _grid(batch.column(1), d):
                if not len(at):
                    continue
                y = x - floor
                widest = max(int(y.max()), -int(y.min()))
                whole_numbers = y, rest
                if widest * max(widest, n) * d >= 1 << 63:
                    whole_numbers = y.astype(object), rest.astype(object)
                # sum (n y - rest)^2, by its three parts
                a, b = (whole_numbers[0] ** 2).sum(axis=1).tolist(), (whole_numbers[0] * whole_numbers[1]).sum(axis=1).tolist()
                deviation = [n * n * p - 2 * n * q + spread for p, q in zip(a, b)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.array([v if v < 1 << 63 else None for v in deviation], pa.int64()),
                     pa.array(((y - rest / n) @ weights).tolist(), pa.list_(pa.float64()))], names=["vec_id", "deviation", "w"])

    if not kept:
        return spark.createDataFrame([], f"vec_id {id_type}, {RESULT}")
    placed = materialise(good.mapInArrow(project, f"vec_id {id_type}, deviation long, w array<double>"), "whitened")
    mean = placed.agg(*[F.avg(F.col("w")[i]).alias(f"m{i}") for i in range(kept)]).head()
    product = lambda i, j: F.avg((F.col("w")[i] - mean[i]) * (F.col("w")[j] - mean[j]))
    covariance = placed.agg(*[product(i, j).alias(f"c{i}_{j}") for i in range(kept) for j in range(i + 1)]).head()
    error = max(abs(covariance[f"c{i}_{j}"] - (i == j)) for i in range(kept) for j in range(i + 1))
    shares = F.array(*[F.lit(e) for e in explained])
    return placed.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"))


def query(spark, sf_dir):
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
