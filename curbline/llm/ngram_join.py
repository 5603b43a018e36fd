"""Similarity join of documents on word shingles: size-aware, with an exact check of every candidate."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import bounded, distinct, given_back, mixed, one_per_id, window_hashes, word_hashes, words_of
from curbline.llm.components import connected_components
from curbline.session import arrow_batches, materialise

# The most frequent shingles, which come last in every set's order; only the order depends on them.
FREQUENT = 100_000
# Sets above this size are never enumerated by subsets, whatever the estimated cost.
LARGEST_SMALL = 256
# Hashes of shingles that a task holds together while it counts them or publishes keys.
TOGETHER = 2_000_000
# Documents that a task surveys together.
ROWS_TOGETHER = 10_000
# Signatures of sets that a task remembers, not to publish equal ones twice.
REMEMBERED = 200_000
# Bits of a set's sketch, as 64-bit words, and of the second one of a large set. Two sets differ in at least as many
# elements as their sketches in bits.
SKETCH_WORDS = 16
WIDE_WORDS = 64
# A pair is settled by shortened hashes only where a wrong answer is less likely than this.
DOUBT = 1e-18
# Bytes of shortened sets that a task hands on together.
TOGETHER_BYTES = 16_000_000
# Rows and bytes of texts that a task gets at once.
BATCH = (1_000, "16m")
# Ranges of sizes that a list's members are summed up by: so many for each factor of e.
BANDS = 16
# Rounds in which every member of a list tries one other before the rest of the pairs are looked at.
ATTEMPTS = 3

Ratio = tuple[int, int]


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``size`` words (A-Z lower-cased); of a shorter text,
    one hash of all its words; of a text without words, none."""
    h = word_hashes(words_of(text.lower() if text else text))
    return distinct(window_hashes(h, min(size, len(h)))) if len(h) else h


def _least(n: int, at_least: Ratio) -> int:
    """The smallest overlap, and the smallest partner, of a set of size n."""
    return -(-n * at_least[0] // at_least[1])


def _has_partners(n: int, at_least: Ratio) -> bool:
    """Whether a set of another content can reach the similarity with one of size n."""
    return n * at_least[1] // at_least[0] > n or _least(n, at_least) < n


def boundary(sizes: dict[int, int], list_rows: float, at_least: Ratio) -> int:
    """The largest size of a small set, by estimated cost in rows.

    A small set costs one row per pair of its prefix; a large one a row per prefix element and the
    rows of that element's list. Sets a large one can match publish their elements as well.
    """
    def pairs(n: int) -> int:
        p = n - _least(n, at_least) + 2
        return p * (p - 1) // 2

    def singles(n: int) -> float:
        return (n - _least(n, at_least) + 1) * (1 + list_rows)

    best, cheapest = 0, None
    for x in range(LARGEST_SMALL + 1):
        cost = sum(c * pairs(n) for n, c in sizes.items() if n <= x)
        cost += sum(c * singles(n) for n, c in sizes.items() if n >= (_least(x + 1, at_least) if x else 0))
        if cheapest is None or cost < cheapest:
            best, cheapest = x, cost
    return best


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int | None, bytes | None]]:
    return zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist())


def _signature(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set's content."""
    return int(mixed(s).sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(mixed(s ^ np.uint64(0x5851F42D4C957F2D))).view(np.int64))


def _sketch(s: np.ndarray, words: int = SKETCH_WORDS) -> list[int]:
    """Per bit, whether an odd number of the set's elements hash to it. What two sets share cancels out, so their
    sketches differ by the sketch of what they don't share, however large they are."""
    at = (mixed(s ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(64 * words)).astype(np.int64)
    odd = np.bincount(at, minlength=64 * words) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view("<i8").tolist()


def _is_wide(n: int, at_least: Ratio) -> bool:
    """Whether the sets a set of size n can link with may differ from it in over a third of a sketch's bits."""
    num, den = at_least
    return 3 * 2 * n * (den - num) > 64 * SKETCH_WORDS * (den + num)


def _survey(docs: DataFrame, size: int, at_least: Ratio) -> DataFrame:
    """Per document (kind 0) its set's size, signature and sketches; of some sets at a time the shingles that recur in
    them (kind 1, with their number) and the rows of their lists (kind 2: elements, sum of squared lengths)."""
    types = (pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))

    def counted(rows: list, sets: list[np.ndarray]) -> pa.RecordBatch:
        if sets:
            u, c = np.unique(np.concatenate(sets), return_counts=True)
            often = c >= max(3, len(sets) // 1000)
            rows += [(1, None, n, h, 0, None, None) for h, n in zip(u[often].view(np.int64).tolist(), c[often].tolist())]
            usual = c[~often].astype(np.int64)
            rows.append((2, None, int(usual.sum()), int((usual * usual).sum()), 0, None, None))
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types],
            names=["kind", "doc_id", "n", "h1", "h2", "sketch", "wide"])

    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sets, seen, held = [], [], set(), 0
        for batch in batches:
            for doc_id, text in _texts(batch):
                s = shingle_set(text, size)
                if not len(s):
                    rows.append((0, doc_id, 0, 0, 0, None, None))
                    continue
                signature = _signature(s)
                wide = _sketch(s, WIDE_WORDS) if _is_wide(len(s), at_least) else None
                rows.append((0, doc_id, len(s), *signature, _sketch(s), wide))
                if signature not in seen:
                    seen.add(signature)
                    sets.append(s)
                    held += len(s)
                if held >= TOGETHER or len(rows) >= ROWS_TOGETHER:
                    yield counted(rows, sets)
                    rows, sets, seen, held = [], [], set(), 0
        yield counted(rows, sets)

    return docs.mapInArrow(run, "kind byte, doc_id long, n long, h1 long, h2 long, sketch array<long>, wide array<long>")


def _keys(docs: DataFrame, size: int, at_least: Ratio, small: int, hashes: np.ndarray, counts: np.ndarray) -> DataFrame:
    """(key, doc, packed) of every document's prefix; packed is its size and its reach, the largest
    overlap that a partner can have whose first common elements are those of the key.

    Sets are ordered by frequency, then hash, rare first. Of equal sets in a task, one is published.
    """
    shared = docs.sparkSession.sparkContext.broadcast((hashes, counts))

    def ordered(s: np.ndarray) -> np.ndarray:
        hashes, counts = shared.value
        if not len(hashes):
            return s
        at = np.minimum(np.searchsorted(hashes, s), len(hashes) - 1)
        often = hashes[at] == s
        late = s[often]
        return np.concatenate([s[~often], late[np.argsort(counts[at[often]], kind="stable")]])

    def made(keys: list, docs_of: list, packed: list) -> pa.RecordBatch:
        arrays = [np.concatenate(x).astype(t, copy=False) if x else np.zeros(0, t)
                  for x, t in ((keys, np.uint64), (docs_of, np.int64), (packed, np.int64))]
        return pa.RecordBatch.from_arrays([pa.array(arrays[0].view(np.int64)), pa.array(arrays[1]), pa.array(arrays[2])],
                                          names=["key", "doc", "packed"])

    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        keys, docs_of, packed, held = [], [], [], 0
        for batch in batches:
            for doc_id, text in _texts(batch):
                s = shingle_set(text, size)
                n = len(s)
                if doc_id is None or not n or not _has_partners(n, at_least):
                    continue
                signature = _signature(s)
                if signature in seen:
                    continue
                if len(seen) < REMEMBERED:
                    seen.add(signature)
                s, least = ordered(s), _least(n, at_least)
                if n <= small:
                    i, j = np.triu_indices(min(n, n - least + 2), 1)
                    keys.append(window_hashes(np.stack([s[i], s[j]], axis=1).ravel(), 2, 2 * np.arange(len(i))))
                    packed.append((np.int64(n) << 32) + n - j + 1)
                    docs_of.append(np.full(len(i), doc_id))
                if n > small or n >= _least(small + 1, at_least):
                    p = n - least + 1
                    keys.append(s[:p])
                    packed.append((np.int64(n) << 32) + n - np.arange(p))
                    docs_of.append(np.full(p, doc_id))
                held += n
                if held >= TOGETHER // 4:
                    yield made(keys, docs_of, packed)
                    keys, docs_of, packed, held = [], [], [], 0
        yield made(keys, docs_of, packed)

    return docs.mapInArrow(run, "key long, doc long, packed long")


def _within_reach(at_least: Ratio, n: str, m: str, reach_n: str, reach_m: str):
    """Both reaches allow the overlap that the two sizes need."""
    num, den = at_least
    return F.expr(f"least({reach_n}, {reach_m}) * {num + den} >= {num} * ({n} + {m})")


def _live(lists: DataFrame, at_least: Ratio) -> DataFrame:
    """The rows (key, doc, n, reach, keys, component) of lists that may still have a partner in their list: one of
    another component whose size they reach and which reaches theirs.

    A list's members are summed up by ranges of sizes, of which a list has a bounded number however many members it
    has. A row stays if a range has another component, its smallest size is within the row's reach and its largest
    reach is up to the row's size. Every pair that :func:`_within_reach` allows passes, so no pair is lost.
    """
    num, den = at_least
    # The largest partner: reach * (num + den) >= num * (n + partner).
    rows = lists.withColumn("largest", F.expr(f"reach * {num + den} div {num} - n"))
    ranges = rows.groupBy("key", F.expr(f"floor({BANDS} * ln(n))").alias("band")).agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("n").alias("least"), F.max("largest").alias("most"))
    summed = ranges.groupBy("key").agg(F.collect_list(F.struct("lo", "hi", "least", "most")).alias("ranges"))
    partner = "exists(ranges, r -> (r.lo <> component OR r.hi <> component) AND r.least <= largest AND r.most >= n)"
    return rows.join(summed, "key").where(partner).select(*lists.columns)


def _merged(lists: DataFrame) -> DataFrame:
    """Lists of nearly the same documents as one list, in which a document has the largest of its reaches.

    Near copies share hundreds of rare shingles, and each of these has a list of nearly all of them. Lists with the
    same member of least hash are merged where the square of their union's members is no more than the sum of their
    own, so there are never more pairs; a union holds every pair of its lists, so none is lost.
    """
    columns = lists.columns
    told = lists.groupBy("key").agg(F.xxhash64(F.min(F.xxhash64("doc"))).alias("family"), F.count("*").alias("members"))
    rows = lists.join(told, "key")
    union = rows.groupBy("family", "doc", "n", "component").agg(F.max("reach").alias("reach"), F.sum("keys").alias("keys"))
    squares = told.groupBy("family").agg(F.sum(F.expr("members * members")).alias("squares"))
    fewer = (union.groupBy("family").agg(F.count("*").alias("all")).join(squares, "family")
             .where("all * all <= squares").select("family"))
    return (union.join(fewer, "family").withColumnRenamed("family", "key").select(columns)
            .unionByName(rows.join(fewer, "family", "left_anti").select(columns)))


def _lists(keys: DataFrame, at_least: Ratio) -> DataFrame:
    """(key, doc, n, reach, keys) of the lists that several documents publish. Those with the same members get the same
    number and are one list; should others get it too, they are one list as well, and no pair is lost. A list of two
    that can't reach each other is none.

    Keys are shuffled once, for the counts and for the rows.
    """
    num, den = at_least
    dealt = keys.repartition("key")
    counted = dealt.groupBy("key").agg(
        F.count("*").alias("members"), F.bit_xor(F.xxhash64("doc")).alias("list"),
        F.min(F.expr("packed & 4294967295")).alias("reach"), F.sum(F.expr("packed >> 32")).alias("sizes"))
    repeated = counted.where(f"members > 2 OR members = 2 AND reach * {num + den} >= {num} * sizes").select("key", "list")
    return (dealt.join(repeated, "key").groupBy(F.col("list").alias("key"), "doc", F.expr("packed >> 32").alias("n"))
            .agg(F.max(F.expr("packed & 4294967295")).alias("reach"), F.count("*").alias("keys")))


def _alike(at_least: Ratio):
    """The sketches of sides a and b differ in no more bits than sets of these sizes and this similarity in elements."""
    num, den = at_least
    # The large sketches are counted by a loop: a sum of so many terms is too long a method for the JVM to compile.
    narrow = " + ".join(f"bit_count(sketch_a[{k}] ^ sketch_b[{k}])" for k in range(SKETCH_WORDS))
    wide = "aggregate(zip_with(wide_a, wide_b, (x, y) -> bit_count(x ^ y)), 0, (total, bits) -> total + bits)"
    within = f"* {num + den} <= {den - num} * (n_a + n_b)"
    return F.expr(f"({narrow}) {within} AND (wide_a IS NULL OR wide_b IS NULL OR {wide} {within})")


def _differ(n: int, at_least: Ratio) -> float:
    """In about how many elements a set of size n differs from one at the edge of the similarity."""
    return n * (at_least[1] - at_least[0]) / (at_least[1] + at_least[0])


def _width(n: int, at_least: Ratio) -> int:
    """Bytes of a hash that are kept of a set of size n: all of a small set's or where few would leave doubt."""
    fits = (w for w in (3, 4) if 32 * _differ(n, at_least) ** 2 <= 256 ** w)
    return 8 if n <= 64 else next(fits, 8)


def _chance(differing: float, width: int) -> int:
    """How many equal shortened hashes of different elements are conceivable (beyond DOUBT) in that many."""
    rate, k = differing * differing / 256 ** width, 0
    while rate ** (k + 1) / math.factorial(k + 1) > DOUBT:
        k += 1
    return k


def _shortened(s: np.ndarray, width: int) -> bytes:
    """The lowest bytes of a set's hashes, sorted, highest byte of all first; a first byte tells how many each has."""
    low = np.sort(s if width == 8 else s & np.uint64(256 ** width - 1))
    return bytes([width]) + low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T[::-1].tobytes()


def _restored(short: bytes) -> tuple[np.ndarray, int]:
    """The sorted shortened hashes and their number of bytes."""
    width = short[0]
    planes = np.frombuffer(short, np.uint8, offset=1).reshape(width, -1)[::-1]
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel(), width


def _judged(a: tuple[np.ndarray, int], b: tuple[np.ndarray, int], at_least: Ratio) -> bool | None:
    """Whether two shortened sets reach the similarity; None where shortening leaves it open.

    Shared elements stay shared, so what is found in common, and what fell together within the sets, bounds the
    overlap from above; different elements that became equal are few, which bounds it from below.
    """
    num, den = at_least
    n, m, width = len(a[0]), len(b[0]), min(a[1], b[1])
    x, y = (distinct(v if w == width else v & np.uint64(256 ** width - 1)) for v, w in (a, b))
    common = len(np.intersect1d(x, y, assume_unique=True))
    needed = -(-num * (n + m) // (num + den))
    if common + min(n - len(x), m - len(y)) < needed:
        return False
    if width == 8:
        return True
    return True if common - _chance(max(n, m) - needed, width) >= needed else None


def _short_sets(docs: DataFrame, size: int, at_least: Ratio, names: str) -> DataFrame:
    """The shortened set of every row of (doc_id, text, other): (doc_id, other, s) under the given names."""
    first, second = names.split()

    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = batch.column(2).to_pylist()
            rows, held = [], 0
            for (doc_id, text), other in zip(_texts(batch), others):
                s = shingle_set(text, size)
                rows.append((doc_id, other, _shortened(s, _width(len(s), at_least))))
                held += len(rows[-1][2])
                if held >= TOGETHER_BYTES:
                    yield made(rows)
                    rows, held = [], 0
            if rows:
                yield made(rows)

    def made(rows: list) -> pa.RecordBatch:
        arrays = [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))]
        return pa.RecordBatch.from_arrays(arrays, names=[first, second, f"s_{first}"])

    return docs.mapInArrow(run, f"{first} long, {second} long, s_{first} binary")


def _sets(docs: DataFrame, size: int, names: str) -> DataFrame:
    """The set of every row of (doc_id, text, other): (doc_id, other, s) under the given names."""
    first, second = names.split()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [shingle_set(t, size).view(np.int64) for _, t in _texts(batch)]
            offsets = np.cumsum([0, *map(len, rows)])
            flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))],
                names=[first, second, f"s_{first}"])

    return docs.mapInArrow(run, f"{first} long, {second} long, s_{first} array<long>")


def _sides(docs: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The texts (doc_id, text, b) of the first and of the second documents of a written table of pairs."""
    partners = materialise(pairs.select("b").distinct(), "join-partners")
    return (docs.join(bounded(pairs), F.col("doc_id") == F.col("a")).select("doc_id", "text", "b"),
            docs.join(bounded(partners), F.col("doc_id") == F.col("b")).select("doc_id", "text", "b"))


def _settled(docs: DataFrame, sketches: DataFrame, pairs: DataFrame, size: int, at_least: Ratio) -> DataFrame:
    """(a, b, sure) of the pairs of a written table that reach the similarity, surely or possibly. Sizes and sketches
    travel first and settle the pairs that differ too much; of the others one shortened set per pair travels to the
    other's, and a set with many partners is split by AQE."""
    a, b = (sketches.select(F.col("doc_id").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n", "sketch", "wide")]) for x in "ab")
    partners = materialise(pairs.select("b").distinct(), "join-partners")
    both = a.join(bounded(pairs), "a").join(b.join(bounded(partners), "b"), "b")
    alike = materialise(both.where(_alike(at_least)).select("a", "b"), "join-alike")
    left, right = _sides(docs, alike)
    near = _short_sets(left, size, at_least, "a b").join(_short_sets(right, size, at_least, "b same"), "b").select("a", "b", "s_a", "s_b")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, whole = None, None
        for batch in batches:
            rows = []
            for k, (a, b) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if b != before:
                    before, whole = b, _restored(batch.column(3)[k].as_py())
                sure = _judged(_restored(batch.column(2)[k].as_py()), whole, at_least)
                if sure is not False:
                    rows.append((a, b, bool(sure)))
            columns = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.bool_()))], names=["a", "b", "sure"])

    return near.mapInArrow(judge, "a long, b long, sure boolean")


def _verified(docs: DataFrame, pairs: DataFrame, size: int, at_least: Ratio) -> DataFrame:
    """The pairs (a, b) of a written table whose sets reach the similarity, by the whole sets."""
    left, right = _sides(docs, pairs)
    both = _sets(left, size, "a b").join(_sets(right, size, "b same"), "b").withColumn("common", F.size(F.array_intersect("s_a", "s_b")))
    return both.where(f"common * {at_least[1]} >= {at_least[0]} * (size(s_a) + size(s_b) - common)").select("a", "b")


def ngram_join(docs: DataFrame, size: int = 4, at_least: Ratio = (85, 100)) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every document of (doc_id, text, ...).

    A document's set holds its distinct shingles (:func:`shingle_set`). Two documents link when their
    Jaccard similarity is ``at_least`` (a fraction above one half), and component_id is the smallest
    doc_id that links reach, the document included. Equal sets are one class. Of the others:

    * small sets publish all two-element subsets of their prefix, large sets the elements of theirs,
      into inverted lists; the boundary between small and large is where the estimated rows are fewest.
      Sets that a large one can match publish elements too, so a pair on either side of it is found;
    * lists with the same members are one list, in which a document has the largest of its reaches; a document leaves
      a list that has no member of another component which it reaches and which reaches it (:func:`_live`);
      then lists of nearly the same documents are one list (:func:`_merged`);
    * each list proposes to its members one of them, at first that with the fewest rare elements; a set is
      checked against the one that most of its lists propose. Links give components, and the lists that
      still hold several propose anew, ``ATTEMPTS`` times in all. Then only members of different components in one list pair
      with each other, if sizes, places in the lists and sketches allow the similarity, and are checked;
    * a check compares sketches first, the parities of bits that elements hash to: sets differ in at least as many
      elements as their sketches in bits, so no link is lost and few sets travel. Those that do are shortened to the
      lowest bytes of their hashes; the few pairs which that leaves open are checked by whole hashes at the end.

    So a group of copies costs as many pairs as members, and no linked pair of different components is
    missed: the lists have every pair that can reach the similarity.

    Cases: texts that are null, empty or blank have an empty set and link with nothing; rows that share
    a doc_id (null is one) count as one document, with the smallest text; a null doc_id has no
    component; further columns are ignored; an empty table gives an empty table; texts are read whole.
    """
    if not at_least[1] < 2 * at_least[0] <= 2 * at_least[1]:
        raise ValueError("the similarity must be above one half and at most one")
    with arrow_batches(docs.sparkSession, *BATCH):
        return _joined(one_per_id(docs, "doc_id", "text"), size, at_least)


def _joined(docs: DataFrame, size: int, at_least: Ratio) -> DataFrame:
    survey = materialise(_survey(docs, size, at_least), "join-survey")
    sets = survey.where("kind = 0")
    sketches = sets.where("n > 0 AND doc_id IS NOT NULL").select("doc_id", "n", "sketch", "wide")
    top = (survey.where("kind = 1").groupBy("h1").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "h1").limit(FREQUENT).toPandas())
    hashes, counts = top["h1"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    order = np.argsort(hashes)
    capped = F.least("n", F.lit(LARGEST_SMALL + 1))
    sizes = {r["n"]: r["count"] for r in sets.where("n > 0").groupBy(capped.alias("n")).count().collect() if _has_partners(r["n"], at_least)}
    elements, squares = survey.where("kind = 2").agg(F.sum("n"), F.sum("h1")).first()
    small = boundary(sizes, (squares or 0) / elements if elements else 1.0, at_least)

    keys = materialise(_keys(docs, size, at_least, small, hashes[order], counts[order]), "join-keys")
    lists = materialise(_lists(keys, at_least), "join-lists").withColumn("component", F.col("doc"))
    open_lists = materialise(_merged(materialise(_live(lists, at_least), "join-live")), "join-merged")
    nodes, tried, linked, unsure = None, None, None, None
    for attempt in range(ATTEMPTS):
        preference = F.expr("n - reach") if attempt == 0 else F.xxhash64("doc", F.lit(attempt))
        centre = open_lists.groupBy("key").agg(F.min(F.struct(preference.alias("rank"), "doc", "n", "reach", "component")).alias("hub"))
        near = (open_lists.join(centre, "key").where("component <> hub.component")
                .where(_within_reach(at_least, "n", "hub.n", "reach", "hub.reach"))
                .groupBy("doc", F.col("hub.doc").alias("hub")).agg(F.sum("keys").alias("lists")))
        tries = (near.groupBy("doc").agg(F.max_by("hub", F.struct("lists", "hub")).alias("hub"))
                 .select(F.col("doc").alias("a"), F.col("hub").alias("b")))
        if tried is not None:
            tries = tries.join(tried, ["a", "b"], "left_anti")
        tries = materialise(tries, "join-tries")
        tried = tries if tried is None else tried.unionByName(tries)
        settled = materialise(_settled(docs, sketches, tries, size, at_least), "join-links")
        doubtful = settled.where("NOT sure").select("a", "b")
        unsure = doubtful if unsure is None else unsure.unionByName(doubtful)
        found = settled.where("sure").select("a", "b")
        linked = found if linked is None else found.unionByName(nodes.where("node <> component").select(
            F.col("node").alias("a"), F.col("component").alias("b")))
        nodes = materialise(connected_components(linked, "a", "b"), "join-nodes")
        # What has no partner left stays so, as components only grow.
        grouped = (open_lists.drop("component").join(bounded(nodes.withColumnRenamed("node", "doc")), "doc", "left")
                   .withColumn("component", F.coalesce("component", "doc")))
        open_lists = materialise(_live(grouped, at_least), "join-open")
    open_lists = open_lists.join(sketches.select(F.col("doc_id").alias("doc"), "sketch", "wide"), "doc")
    x, y = (open_lists.select("key", *[F.col(c).alias(f"{c}_{side}") for c in ("doc", "n", "reach", "component", "sketch", "wide")])
            for side in "ab")
    rest = (x.join(y, "key").where("doc_a < doc_b AND component_a <> component_b")
            .where(_within_reach(at_least, "n_a", "n_b", "reach_a", "reach_b")).where(_alike(at_least))
            .select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b")).distinct())
    tried = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    rest = materialise(rest.join(tried, ["a", "b"], "left_anti"), "join-rest")
    settled = materialise(_settled(docs, sketches, rest, size, at_least), "join-more")
    unsure = materialise(unsure.unionByName(settled.where("NOT sure").select("a", "b")).distinct(), "join-unsure")
    more = settled.where("sure").select("a", "b").unionByName(materialise(_verified(docs, unsure, size, at_least), "join-whole"))

    same = sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "h1", "h2").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("members")).where("members > 1")
    copies = (sets.join(bounded(materialise(same, "join-classes")), ["n", "h1", "h2"]).where("doc_id <> rep")
              .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    edges = nodes.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more).unionByName(copies)
    final = materialise(connected_components(edges, "a", "b"), "join-components")
    return (sets.join(bounded(final), F.col("doc_id") == F.col("node"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")))


def query(spark, sf_dir):
    return ngram_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))
