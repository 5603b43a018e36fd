"""Benchmark passages in documents, found in a latent space or by their rarest words and confirmed word by word."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import given_back, mixed, one_per_id, word_hashes
from curbline.session import arrow_batches, materialise

# Fixed sizes of what is broadcast: columns of the term matrix, and the passages that one block of queries holds.
COLUMNS = 1 << 13
RANK, EXTRA, ROUNDS = 192, 16, 2
BLOCK_ITEMS = 2_000
# Rows that the documents' rows are added up in, each with a sign, for the fit of the latent space.
FOLDED_ROWS = 256
# Rows of the matrix that are a task's, as every task hands on a product as large as the basis; rows that it multiplies
# together, and columns of the product that it hands on at once.
ROWS_A_TASK = 256
ROWS_TOGETHER = 32
STRETCH = 512
# Rows and bytes that a task gets at once.
BATCH = (1_000, "4m")

WINDOW, STRIDE = 64, 32
# Latent cosine from which a window and a passage are compared word by word.
MIN_COSINE = 0.45
# Windows of a text whose vectors and cosines are held at once.
HELD_WINDOWS = 32
# Of a passage's rarest words, those looked up are so many that any match has this many of them.
RARE_MATCHES = 4
ANSWER_WORDS = 8
PUNCTUATION = b".,;:!?\"'()[]"


def plain_words(text: bytes | None) -> list[bytes]:
    """Blank-separated words, A-Z in lower case, without ASCII punctuation."""
    return text.lower().translate(None, PUNCTUATION).split() if text else []


def longest_common_subsequence(places: dict[bytes, int], length: int, words: list[bytes]) -> int:
    """Of a passage of ``length`` words, given as a bit mask of places per word, and ``words``."""
    full = (1 << length) - 1
    row = full
    for w in words:
        if mask := places.get(w):
            met = row & mask
            row = ((row + met) | (row - met)) & full
    return length - row.bit_count()


def _masks(words: list[bytes]) -> dict[bytes, int]:
    out: dict[bytes, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


def _binary_texts(batch: pa.RecordBatch, column: int = 1) -> list[bytes | None]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def vocabulary_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, at, times): how often each document's whole text has the words of a vocabulary, by their index."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            found = [np.unique(vocabulary.find(plain_words(t))[1], return_counts=True) for t in _binary_texts(batch)]
            offsets = pa.array(np.cumsum([0, *(len(at) for at, _ in found)]), pa.int32())
            flat = [np.concatenate(x).astype(np.int32) if found else np.zeros(0, np.int32) for x in (zip(*found) if found else ((), ()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.ListArray.from_arrays(offsets, pa.array(x)) for x in flat]],
                                             names=["doc_id", "at", "times"])

    return docs.mapInArrow(run, "doc_id long, at array<int>, times array<int>")


def document_frequencies(counts: DataFrame, words: int) -> tuple[np.ndarray, int]:
    """In how many documents each word of a vocabulary is, and how many documents there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, rows = np.zeros(words, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            count += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=words)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(count[at], rows))], names=["at", "n"])

    found = counts.select("at").mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(words, np.int64)
    real = found[found["at"] >= 0]
    out[real["at"].to_numpy()] = real["n"].to_numpy()
    return out, int(found.loc[found["at"] < 0, "n"].sum())


def folded_rows(counts: DataFrame, vocabulary: Vocabulary, total: int) -> DataFrame:
    """(at, x): the TF-IDF rows of all documents, added up in ``FOLDED_ROWS`` rows.

    A hash of the doc_id gives a document's row and sign, so what different documents add to the rows' product with
    their transpose cancels out on average, and what is left is the sum over every single document. The rows are as
    long, on average, as one document's.
    """
    shared = counts.sparkSession.sparkContext.broadcast((vocabulary.columns, vocabulary.weights))
    scale = np.sqrt(FOLDED_ROWS / max(1, total))

    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, weights = shared.value
        out = np.zeros(FOLDED_ROWS * COLUMNS)
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(len(sizes)), sizes)
            at, times = (batch.column(k).flatten().to_numpy(zero_copy_only=False) for k in (1, 2))
            x = times * weights[at]
            length = np.sqrt(np.bincount(rows, weights=x * x, minlength=len(sizes)))
            dealt = mixed(batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False).view(np.uint64) ^ np.uint64(0x9FB21C651E98DF25))
            sign = np.where(dealt >> np.uint64(63), 1.0, -1.0) / np.maximum(length, 1e-9)
            row = (dealt % np.uint64(FOLDED_ROWS)).astype(np.int64)
            np.add.at(out, row[rows] * COLUMNS + columns[at], x * sign[rows])
        whole = out.reshape(FOLDED_ROWS, COLUMNS)
        used = np.flatnonzero(whole.any(axis=1)).tolist()
        for k in used:
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([whole[k].tobytes()], pa.binary())], names=["row", "sums"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b) for b in group["sums"]) * scale
        at = np.flatnonzero(total)
        return pd.DataFrame({"at": [at.tolist()], "x": [total[at].tolist()]})

    return counts.mapInArrow(run, "row int, sums binary").groupBy("row").applyInPandas(add, "at array<int>, x array<double>")


def randomised_svd(rows: DataFrame, columns: int, rank: int, extra: int, rounds: int, seed: int) -> np.ndarray:
    """An orthonormal basis (columns x rank) of the leading right singular space of a sparse matrix.

    ``rows`` has (at array<int>, x array<double>), a matrix row each. Every round multiplies a random
    block by the matrix and its transpose: tasks add up their rows' part, parts are summed by stretches
    of columns, and only columns x (rank + extra) numbers reach the driver, whatever the row count.
    """
    width = rank + extra
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((columns, width)))[0]

    def product(basis: np.ndarray) -> np.ndarray:
        shared = rows.sparkSession.sparkContext.broadcast(basis)

        @given_back
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((columns, width))
            for batch in batches:
                for begin in range(0, batch.num_rows, ROWS_TOGETHER):
                    piece = batch.slice(begin, ROWS_TOGETHER)
                    at, x = (piece.column(k).flatten().to_numpy(zero_copy_only=False) for k in (0, 1))
                    dense = np.zeros((piece.num_rows, columns))
                    dense[np.repeat(np.arange(piece.num_rows), piece.column(0).value_lengths()), at] = x
                    near = dense @ shared.value
                    for k in range(0, columns, STRETCH):
                        out[k: k + STRETCH] += dense[:, k: k + STRETCH].T @ near
            for k in range(0, columns, STRETCH):
                if out[k: k + STRETCH].any():
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([out[k: k + STRETCH].tobytes()], pa.binary())],
                                                     names=["part", "sums"])

        def add(group: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(b) for b in group["sums"])
            return pd.DataFrame({"part": [group["part"].iloc[0]], "sums": [total.tobytes()]})

        out = np.zeros((columns, width))
        found = rows.select("at", "x").mapInArrow(run, "part int, sums binary").groupBy("part").applyInPandas(add, "part int, sums binary").toArrow()
        for part, sums in zip(found["part"], found["sums"]):
            piece = np.frombuffer(sums.as_buffer()).reshape(-1, width)
            out[part.as_py(): part.as_py() + len(piece)] = piece
        shared.destroy()
        return out

    for _ in range(rounds):
        basis = product(basis)
        basis = np.linalg.qr(basis)[0]
    final = product(basis)
    values, vectors = np.linalg.eigh(basis.T @ final)
    return basis @ vectors[:, np.argsort(-values)[:rank]]


class Vocabulary:
    """The words of a block of benchmark passages: hash, matrix column and, once weighed, weight of each."""

    def __init__(self, words: set[bytes]):
        ordered = sorted(words)
        hashes, index = np.unique(word_hashes(ordered), return_inverse=True)
        self.hashes = hashes
        self.index = dict(zip(ordered, index.tolist()))
        self.columns = (hashes % np.uint64(COLUMNS)).astype(np.int64)
        self.weights = np.zeros(len(hashes))

    def weigh(self, frequency: np.ndarray, total: int) -> None:
        """Weigh the words by the documents, of ``total``, that each is in."""
        self.weights = np.log((1 + total) / (1 + frequency))

    def find(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words that are in the vocabulary, and their index there."""
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        place = np.flatnonzero(at >= 0)
        return place, at[place]

    def row(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """A TF-IDF row of length one: columns and values."""
        _, at = self.find(words)
        x = np.bincount(self.columns[at], weights=self.weights[at], minlength=0) if len(at) else np.zeros(0)
        columns = np.flatnonzero(x)
        x = x[columns]
        return columns, x / (np.linalg.norm(x) or 1.0)


def _passages(words: list[bytes]) -> list[tuple[int, list[bytes]]]:
    """Stretches of at most ``WINDOW`` words, each half a window after the one before."""
    starts = range(0, max(1, len(words) - WINDOW + STRIDE), STRIDE)
    return [(s, words[s: s + WINDOW]) for s in starts if words[s: s + WINDOW]]


class RareWords:
    """Which passages a stretch of words can match, without loss.

    A match has at least ``least`` of a passage's places in common, so at most length - least places are
    unmatched. Of the passage's rarest words that hold length - least + k places, any match has k or more.
    """

    def __init__(self, passages: list[list[bytes]], vocabulary: Vocabulary, share: float):
        found: list[tuple[int, int, int]] = []
        self.need = np.zeros(len(passages), np.int64)
        for q, p in enumerate(passages):
            least = next(n for n in range(len(p) + 1) if n / len(p) >= share)
            self.need[q] = need = min(least, RARE_MATCHES)
            at, times = np.unique(vocabulary.find(p)[1], return_counts=True)
            places = 0
            for k in np.lexsort((at, -vocabulary.weights[at])).tolist():
                if places >= len(p) - least + need:
                    break
                found.append((int(at[k]), q, int(times[k])))
                places += int(times[k])
            self.need[q] += places - (len(p) - least + need)
        found.sort()
        words, self.passage, self.times = (np.array(x, np.int64) for x in zip(*found))
        self.edges = np.searchsorted(words, np.arange(len(vocabulary.hashes) + 1))

    def candidates(self, place: np.ndarray, at: np.ndarray, windows: int) -> tuple[np.ndarray, np.ndarray]:
        """Windows and passages that can match, for a text's places of vocabulary words. Window g has the words from
        g * STRIDE - STRIDE / 2 (0 at least) on, ``WINDOW`` + ``STRIDE`` of them."""
        rare = self.edges[at + 1] > self.edges[at]
        place, at = place[rare], at[rare]
        last = (place + STRIDE // 2) // STRIDE
        first = place < WINDOW + STRIDE
        g = np.concatenate([last, last - 1, last - 2, np.zeros(first.sum(), np.int64)])
        w = np.concatenate([at, at, at, at[first]])
        inside = (g >= 0) & (g < windows)
        size = len(self.edges)
        code = np.unique(g[inside] * size + w[inside])
        g, w = code // size, code % size
        many = self.edges[w + 1] - self.edges[w]
        entry = np.arange(many.sum()) + np.repeat(self.edges[w] - np.cumsum(many) + many, many)
        pairs, back = np.unique(np.repeat(g, many) * len(self.need) + self.passage[entry], return_inverse=True)
        places = np.bincount(back, weights=self.times[entry], minlength=len(pairs))
        g, q = pairs // len(self.need), pairs % len(self.need)
        can = places >= self.need[q]
        return g[can], q[can]


class LatentSpace:
    """The passages of a block as unit vectors in a latent space, and the windows of a text near them there."""

    def __init__(self, passages: list[list[bytes]], vocabulary: Vocabulary, basis: np.ndarray):
        self.words = basis[vocabulary.columns] * vocabulary.weights.astype(np.float32)[:, None]
        self.vectors = self._unit(np.array([self.words[vocabulary.find(p)[1]].sum(0) for p in passages]))

    @staticmethod
    def _unit(rows: np.ndarray) -> np.ndarray:
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)

    def windows(self, place: np.ndarray, at: np.ndarray, begin: int, end: int) -> np.ndarray:
        """Unit vectors of the windows ``begin`` to ``end``; window g has the words from g * STRIDE on, ``WINDOW`` of them."""
        first, last = np.searchsorted(place, (begin * STRIDE, (end + 1) * STRIDE))
        used, word = np.unique(at[first:last], return_inverse=True)
        size = (end - begin + 1, len(used))
        half = place[first:last] // STRIDE - begin
        times = np.bincount(half * size[1] + word, minlength=size[0] * size[1]).reshape(size)
        halves = times.astype(np.float32) @ self.words[used]
        return self._unit(halves[:-1] + halves[1:])

    def candidates(self, place: np.ndarray, at: np.ndarray, windows: int, least: float) -> dict[tuple[int, int], float]:
        """(window, passage): cosine, of all pairs whose cosine is ``least`` or more."""
        found: dict[tuple[int, int], float] = {}
        for begin in range(0, windows, HELD_WINDOWS):
            cosines = self.windows(place, at, begin, min(windows, begin + HELD_WINDOWS)) @ self.vectors.T
            g, q = np.nonzero(cosines >= least)
            found.update(zip(zip((g + begin).tolist(), q.tolist()), cosines[g, q].tolist()))
        return found


def _cut(benchmark: DataFrame) -> DataFrame:
    """(item_id, passage, answer): the passages of every text that has an item_id, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), _binary_texts(batch)):
                words = plain_words(text)
                parts = _passages(words)
                for k in range(0, len(parts), BLOCK_ITEMS):
                    own = [b" ".join(p) for _, p in parts[k: k + BLOCK_ITEMS]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(own), pa.int64()), pa.array(own, pa.binary()),
                         pa.array([b" ".join(words[-ANSWER_WORDS:])] * len(own), pa.binary())], names=["item_id", "passage", "answer"])

    given = benchmark.select(F.col("item_id").cast("long"), "text").where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    return given.mapInArrow(run, "item_id long, passage binary, answer binary").distinct()


def _search(docs: DataFrame, block: list[tuple[int, list[bytes], list[bytes]]],
            min_cosine: float, copied: float, paraphrased: float, answered: float) -> DataFrame:
    """Hits of one block of passages (item, words, answer) in all documents."""
    spark = docs.sparkSession
    passages = [p for _, p, _ in block]
    vocabulary = Vocabulary({w for p in passages for w in p})
    counts = materialise(vocabulary_counts(docs, vocabulary), "vocabulary-counts")
    frequency, total = document_frequencies(counts, len(vocabulary.hashes))
    vocabulary.weigh(frequency, total)
    own = list(map(vocabulary.row, passages))
    # By Arrow, as rows that Spark gets as Python objects leave a second set of workers in every executor.
    own = spark.createDataFrame(pa.table({"at": pa.array([c for c, _ in own], pa.list_(pa.int32())), "x": pa.array([x for _, x in own], pa.list_(pa.float64()))}))
    rows = materialise(own.unionByName(folded_rows(counts, vocabulary, total)), "svd-rows")
    rows = rows.coalesce(-(-(FOLDED_ROWS + len(passages)) // ROWS_A_TASK))
    basis = randomised_svd(rows, COLUMNS, min(RANK, COLUMNS - EXTRA), EXTRA, ROUNDS, 5).astype(np.float32)
    shared = spark.sparkContext.broadcast((
        vocabulary, LatentSpace(passages, vocabulary, basis), RareWords(passages, vocabulary, paraphrased),
        [(i, len(p), _masks(p), len(a), _masks(a)) for i, p, a in block]))

    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, latent, rare, known = shared.value
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), _binary_texts(batch)):
                words = plain_words(text)
                if not words:
                    continue
                place, at = vocabulary.find(words)
                windows = len(words) // STRIDE + 1
                near_ones = latent.candidates(place, at, windows, min_cosine)
                pairs = dict.fromkeys(near_ones, "latent")
                for pair in zip(*(x.tolist() for x in rare.candidates(place, at, windows))):
                    pairs.setdefault(pair, "words")
                best: dict[int, tuple] = {}
                for (g, q), way in pairs.items():
                    item, length, masks, answer_length, answer_masks = known[q]
                    start = max(0, g * STRIDE - STRIDE // 2)
                    near = words[start: start + WINDOW + STRIDE]
                    if sum(map(masks.__contains__, near)) / length < paraphrased:  # no subsequence is longer
                        continue
                    found = longest_common_subsequence(masks, length, near) / length
                    if found < paraphrased:
                        continue
                    answer = longest_common_subsequence(answer_masks, answer_length, near) / answer_length
                    if found >= copied or answer >= answered:
                        cosine = near_ones[g, q] if way == "latent" else float((latent.windows(place, at, g, g + 1) @ latent.vectors[q])[0])
                        best[item] = max(best.get(item, (0.0,)), (found, answer, cosine, start, way))
                out += [(doc_id, item, *x) for item, x in sorted(best.items())]
            columns = list(zip(*out)) if out else [[]] * 7
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                             names=["doc_id", "item_id", "overlap", "answer", "cosine", "place", "way"])

    hits = materialise(docs.mapInArrow(run, HITS), "benchmark-hits")
    shared.destroy()
    return hits


HITS = "doc_id long, item_id long, overlap double, answer double, cosine double, place long, way string"


def find_benchmark(docs: DataFrame, benchmark: DataFrame, min_cosine: float = MIN_COSINE, copied: float = 0.75,
                   paraphrased: float = 0.6, answered: float = 0.75) -> DataFrame:
    """(doc_id, item_id, overlap, answer, cosine, place, way): the benchmark items that documents contain.

    Passages are stretches of at most ``WINDOW`` words of an item, ``STRIDE`` apart; windows are stretches of
    ``WINDOW`` + ``STRIDE`` words, as far apart, over every whole text. ``overlap`` is the longest common
    subsequence of a passage and a window over the passage's length, ``answer`` that of the item's last
    words. A hit is a copy (overlap of ``copied``) or a paraphrase (overlap of ``paraphrased``, and the
    answer's of ``answered``). ``place`` is a word before the hit.

    Passages and the ``WINDOW`` words in a window's middle are TF-IDF rows: the words of the benchmark with document
    frequencies of all documents. A distributed randomised SVD of the block's passages and the whole texts of all
    documents (:func:`folded_rows`) gives a latent space; all pairs with a cosine of
    ``min_cosine`` or more there are compared word by word. As a latent space loses some pairs, those that share
    enough of a passage's rarest words for the overlap to be possible (:class:`RareWords`) are compared too, so
    that every hit is found. ``way`` is ``latent`` if the cosine brought the told match up, else ``words``.

    Cases: null, empty or blank texts match nothing, on either side; rows that share a doc_id (null is one)
    count as one, with the smallest text; every text of an item_id is searched, and rows without an item_id
    aren't; of several matches of an item the best is told;
    further columns are ignored; an empty table on either side gives no rows.

    The benchmark is the stated query set: its passages go through in blocks of about ``BLOCK_ITEMS``, however long
    the texts they come from, each against all documents; one block's vectors and words are broadcast at a time.
    Tasks get rows in small batches; so that this holds for the hits too, they are written once.
    """
    with arrow_batches(docs.sparkSession, *BATCH):
        return _found(one_per_id(docs, "doc_id", "text"), benchmark, min_cosine, copied, paraphrased, answered)


def _found(docs: DataFrame, benchmark: DataFrame, min_cosine: float, copied: float, paraphrased: float, answered: float) -> DataFrame:
    passages = materialise(_cut(benchmark), "passages")
    blocks = -(-passages.count() // BLOCK_ITEMS)
    hits = None
    for b in range(blocks):
        rows = passages.where(F.pmod(F.xxhash64("item_id", "passage"), F.lit(blocks)) == b).collect()
        block = sorted((r["item_id"], bytes(r["passage"]).split(), bytes(r["answer"]).split()) for r in rows)
        if block:
            found = _search(docs, block, min_cosine, copied, paraphrased, answered)
            hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        return docs.sparkSession.createDataFrame([], HITS)
    if blocks > 1:  # an item's passages may be in several
        best = F.max(F.struct("overlap", "answer", "cosine", "place", "way")).alias("best")
        hits = hits.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")
    return hits


def query(spark, sf_dir):
    return find_benchmark(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
