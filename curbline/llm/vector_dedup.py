"""Near-duplicate vectors by random-hyperplane signs, verified by exact cosines."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import bounded, one_per_id
from curbline.llm.components import connected_components
from curbline.session import materialise

# Vectors of a bucket that meet in one task: a larger bucket is cut into blocks of about this many,
# and every pair of blocks is a task's work of its own.
BLOCK = 256
# Members that a bucket should have on average when vectors are spread evenly.
AIM = 8


def table_shape(vectors: int, min_cosine: float, recall: float) -> tuple[int, int]:
    """Bits per table, from the vectors to tell apart, and tables, so that a pair at ``min_cosine``
    shares a bucket with probability ``recall``."""
    bits = min(30, max(4, math.ceil(math.log2(max(2, vectors) / AIM)) if vectors > AIM else 4))
    same = (1 - math.acos(min(1.0, min_cosine)) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same))) if same < 1 else 1


def _signs(dim: int, bits: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim, bits, tables]).standard_normal((dim, bits * tables))


def _linked(group: dict[str, np.ndarray], min_cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one block pair: the rows with links, how many vectors each is newly linked to, and the
    smallest row reachable by links of this block pair."""
    x, ids, table = group["unit"], group["rep"], int(group["tab"][0])
    close = x @ x.T >= min_cosine
    if group["left"][0] != group["right"][0]:  # pairs within a block are found where it meets itself
        close &= group["block"][:, None] != group["block"][None, :]
    np.fill_diagonal(close, False)
    at = np.flatnonzero(close.any(axis=1))
    if not len(at):
        return at, at, at
    close = close[np.ix_(at, at)]
    a, b = np.nonzero(close)
    earlier = group["signs"][at][:, :table]
    first = ~(earlier[a] == earlier[b]).any(axis=1)  # a pair counts in the first table that has it
    links = np.bincount(a[first], weights=group["copies"][at][b[first]], minlength=len(at)).astype(np.int64)
    root = ids[at].copy()
    while True:
        least = root.copy()
        np.minimum.at(least, a, root[b])
        if (least == root).all():
            return ids[at], links, root
        root = least


def near_duplicate_vectors(vectors: DataFrame, min_cosine: float = 0.98, recall: float = 0.9999, seed: int = 11) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding, label, ...).

    Vectors are compared when their labels are equal and not null and their lengths are equal. Equal
    vectors are one class, whose smallest id stands for it; a link counts with its class's size.
    Each table hashes a class to the signs of some random projections; classes in one bucket are
    compared in double precision, so no link is below ``min_cosine``, and one at it is found with
    probability ``recall`` or more. Bits grow with the logarithm of the largest label's classes.

    Cases: vectors that are null, empty, all zero or hold null or non-finite components, and those
    without a label, have no links; rows that share a vec_id (null is one) count as one vector, with
    the smallest values; a null vec_id never links; further columns are ignored; an empty table gives
    an empty table.

    A bucket that holds a third of all vectors is cut into blocks by a hash, and pairs of blocks are
    compared apart; tasks send counts and a spanning edge per vector, never the pairs.
    """
    rows = one_per_id(vectors, "vec_id", "embedding", "label")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0)
              & ~bad & F.exists("embedding", lambda x: x != 0))
    good = rows.where(F.coalesce(usable, F.lit(False))).withColumn("e", F.col("embedding").cast("array<double>"))
    same = ["label", "h1", "h2"]
    keyed = good.select("vec_id", "label", F.xxhash64("e").alias("h1"), F.xxhash64(F.reverse("e"), F.size("e")).alias("h2"))
    classes = materialise(keyed.groupBy(*same).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vector-classes")
    reps = materialise(good.join(classes.select("rep", "copies"), F.col("vec_id") == F.col("rep"))
                       .select("rep", "label", "copies", "e"), "vector-reps")
    most = reps.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = table_shape(most, min_cosine, recall)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            out = []
            for row in batch.column(3).to_pylist():
                x = np.array(row)
                x = x / np.abs(x).max()
                x /= math.sqrt(x @ x)
                if len(x) not in planes:
                    planes[len(x)] = _signs(len(x), bits, tables, seed)
                out.append((x, ((x @ planes[len(x)]).reshape(tables, bits) > 0) @ weights))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([x.tolist() for x, _ in out], pa.list_(pa.float64())),
                 pa.array([s.tolist() for _, s in out], pa.list_(pa.int64()))],
                names=["rep", "label", "copies", "unit", "signs"])

    label_type = dict(rows.dtypes)["label"]
    signed = materialise(reps.mapInArrow(
        sign, f"rep {dict(rows.dtypes)['vec_id']}, label {label_type}, copies long, unit array<double>, signs array<long>"), "vector-signs")
    key = ["label", "dim", "tab", "sign"]
    placed = signed.select("rep", "label", F.size("unit").alias("dim"), F.posexplode("signs").alias("tab", "sign"))
    buckets = bounded(materialise(placed.groupBy(*key).agg(F.count("*").alias("members")).where("members > 1"), "vector-buckets"))
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep", "tab"), F.col("blocks")).cast("int")
    sent = (signed.select("rep", "label", "copies", "unit", "signs", F.size("unit").alias("dim"), F.posexplode("signs").alias("tab", "sign"))
            .join(buckets, key).withColumn("blocks", blocks).withColumn("block", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("left", F.least("block", "other")).withColumn("right", F.greatest("block", "other"))
            .withColumn("of", F.struct(*key, "left", "right"))
            .select(F.xxhash64("of").alias("group"), *key, "left", "right", "block", "rep", "copies", "unit", "signs"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def solved(table: pa.Table) -> pa.RecordBatch:
            columns = {n: table.column(n).to_numpy(zero_copy_only=False) for n in ("dim", "tab", "sign", "left", "right", "block", "rep", "copies")}
            label = table.column("label").combine_chunks()
            codes = label.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            width = [columns[n] for n in ("dim", "tab", "sign", "left", "right")] + [codes]
            change = np.zeros(table.num_rows, dtype=bool)
            change[0] = True
            for c in width:
                change[1:] |= c[1:] != c[:-1]
            starts = np.append(np.flatnonzero(change), table.num_rows)
            unit, signs = (table.column(n).combine_chunks() for n in ("unit", "signs"))
            flat, offsets = unit.flatten().to_numpy(zero_copy_only=False), unit.offsets.to_numpy() - unit.offsets[0].as_py()
            signs = signs.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, tables)
            found = []
            for lo, hi in zip(starts[:-1], starts[1:]):
                if hi - lo > 1:
                    group = {n: c[lo:hi] for n, c in columns.items()}
                    group |= {"unit": flat[offsets[lo]: offsets[hi]].reshape(hi - lo, -1), "signs": signs[lo:hi]}
                    found.append(_linked(group, min_cosine))
            parts = [np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(3)]
            return pa.RecordBatch.from_arrays([pa.array(p, pa.int64()) for p in parts], names=["rep", "links", "root"])

        for batch in batches:
            if not batch.num_rows:
                continue
            # The last group of a batch may go on in the next one; a group is two blocks at most.
            kept.append(batch)
            table = pa.Table.from_batches(kept)
            names = ("group",)
            last = table.column(names[0])[-1].as_py()
            groups = table.column(names[0]).to_numpy()
            cut = int(np.flatnonzero(groups != last)[-1]) + 1 if (groups != last).any() else 0
            if cut:
                yield solved(table.slice(0, cut))
            kept = table.slice(cut).combine_chunks().to_batches()
        if kept:
            yield solved(pa.Table.from_batches(kept))

    ordered = sent.repartition("group").sortWithinPartitions("group", *key, "left", "right", "rep")
    found = materialise(ordered.mapInArrow(compare, "rep long, links long, root long"), "vector-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    component = connected_components(found.where("rep <> root"), "rep", "root")
    of_class = materialise(
        classes.join(links, "rep", "left").join(component.withColumnRenamed("node", "rep"), "rep", "left")
        .select(*same, (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("component", "rep").alias("component")), "vector-components")
    per_vector = keyed.join(bounded(of_class), same).select(F.col("vec_id").alias("of"), "n_links", "component")
    return (rows.select("vec_id").join(per_vector, F.col("vec_id") == F.col("of"), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def query(spark, sf_dir):
    return near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
