"""Toxicity scores: lexicon terms, misspellings by Levenshtein automata, and the words around them."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import bounded, given_back, one_per_id
from curbline.session import arrow_batches, materialise

# Terms that count as abusive before anything is learned. Prior evidence, not the whole lexicon.
SEED = ("arschloch bastard cabrón clown connard crétin cretin disgusting dumb dummkopf estúpido freak fool garbage "
        "idiot idiota idiote imbecile imbécil imbécile jerk lächerlich loser minable moron pathetic pendejo "
        "scum stupid stupide trash trottel ugly vermin worthless").split()
SEED_EVIDENCE = 5

# Words that report what others said; a term near them, or in quotation marks, is counted apart.
REPORTING = frozenset("said says wrote writes called quote quoted quotes word term phrase dit écrit mot sagte schrieb wort dijo escribió palabra".split())
ADDRESS = frozenset("you your u ur tu toi vous du dich ihr eres usted vosotros".split())
QUOTES = "\"'“”„«»‘’`"
CONTEXT = 8

WORD = re.compile(r"[^\W_]+")
LEET = str.maketrans("013457", "oieast")

# Of the toxic rows, this share (and a few at least) has to hold a unit for it to be a term, so that the lexicon is
# bounded however many rows there are.
LEAST_SHARE = 1 / 2_000
PREFIXES = (4, 5, 6)
FEATURES = 8

# Rows and bytes of texts that a task gets at once.
BATCH = (1_000, "4m")
# Different units that a task counts before it hands the counts on.
UNITS_TOGETHER = 100_000

Term = tuple[str, bool, float]  # text, whether longer words that begin with it count, weight


class FuzzyLexicon:
    """Words within one edit of a lexicon term: the product of the terms' trie and a Levenshtein
    automaton, made deterministic state by state as words are read.

    A state holds (trie node, edits so far, letter due) triples; a letter is due where the word has two letters of
    the term in the other order, which is one edit. Most words reach the dead state after a few letters. A node can
    end a whole term and begin longer words at once, with a weight for each. Misspellings count for whole terms of five
    letters or more.
    """

    def __init__(self, terms: list[Term], edits: int = 1, shortest: int = 5, states: int = 20_000):
        self.children: list[dict[str, int]] = [{}]
        self.whole, self.begin, self.depth = [0.0], [0.0], [0]
        for text, prefix, weight in terms:
            node = 0
            for c in text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.whole.append(0.0)
                    self.begin.append(0.0)
                    self.depth.append(self.depth[node] + 1)
                node = self.children[node][c]
            weights = self.begin if prefix else self.whole
            weights[node] = max(weights[node], weight)
        self.edits, self.shortest, self.most = edits, shortest, states
        self.forget()

    def forget(self) -> None:
        self.steps: list[dict[str, int]] = []
        self.sets: list[tuple] = []
        self.index: dict[tuple, int] = {}
        self.start = self._state({(0, 0, "")}, 0.0)

    def _state(self, pairs: set[tuple[int, int, str]], seen: float) -> int:
        """``seen``: the weight of the best prefix term that the letters so far begin with."""
        pairs = set(pairs)
        waiting = list(pairs)
        while waiting:  # a letter of the term left out
            node, e, due = waiting.pop()
            if e < self.edits and not due:
                for child in self.children[node].values():
                    if (child, e + 1, "") not in pairs:
                        pairs.add((child, e + 1, ""))
                        waiting.append((child, e + 1, ""))
        for node, e, _ in pairs:
            if e == 0:
                seen = max(seen, self.begin[node])
        key = (frozenset(pairs), seen)
        if key not in self.index:
            self.index[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
        return self.index[key]

    def _step(self, state: int, c: str) -> int:
        pairs, seen = self.sets[state]
        after = set()
        for node, e, due in pairs:
            if due:
                if c == due:
                    after.add((node, e, ""))
                continue
            if c in self.children[node]:
                after.add((self.children[node][c], e, ""))
            if e < self.edits:
                after.add((node, e + 1, ""))
                for letter, child in self.children[node].items():
                    after.add((child, e + 1, ""))
                    if c in self.children[child]:
                        after.add((self.children[child][c], e + 1, letter))
        self.steps[state][c] = found = self._state(after, seen)
        return found

    def match(self, word: str) -> tuple[float, float]:
        """The best weight of a term equal to the word or beginning it, and of one an edit away."""
        if len(self.sets) > self.most:
            self.forget()
        state = self.start
        for c in word:
            state = self.steps[state].get(c) or self._step(state, c)
            if not self.sets[state][0]:
                break
        pairs, exact = self.sets[state]
        near = 0.0
        for node, e, due in pairs:
            if e == 0:
                exact = max(exact, self.whole[node])
            elif not due and self.depth[node] >= self.shortest:
                near = max(near, self.whole[node])
        return exact, near


class Scanner:
    """Features of texts for a lexicon. Answers per word are remembered, so many at most."""

    def __init__(self, terms: list[Term], remembered: int = 200_000):
        self.lexicon, self.remembered = FuzzyLexicon(terms), remembered
        self.known: dict[str, tuple[float, float] | None] = {}

    def _look(self, word: str) -> tuple[float, float] | None:
        found = self.lexicon.match(word)
        if found == (0.0, 0.0) and not word.isalpha():
            found = self.lexicon.match(word.translate(LEET))
            found = (0.0, max(found))
        if len(self.known) >= self.remembered:
            self.known.clear()
        self.known[word] = out = found if max(found) > 0 else None
        return out

    def features(self, text: str | None) -> np.ndarray:
        out = np.zeros(FEATURES)
        if not text:
            return out
        low = text.lower()
        words = WORD.findall(low)
        known, missing = self.known, object()
        hits = []
        for i, w in enumerate(words):
            found = known.get(w, missing)
            if found is missing:
                found = self._look(w)
            if found:
                hits.append((i, w, found))
        if not hits:
            return out
        spans = [m.span() for m in WORD.finditer(low)]
        abusive, terms = 0.0, set()
        for i, w, (exact, near) in hits:
            a, b = spans[i]
            around = words[max(0, i - CONTEXT): i] + words[i + 1: i + 1 + CONTEXT]
            marks = low[max(0, a - 2): a] + low[b: b + 2]
            quoted = any(c in QUOTES for c in marks) or not REPORTING.isdisjoint(around)
            if quoted:
                out[3] += 1
                continue
            if exact:
                terms.add(w)
                out[0] += 1
            else:
                out[2] += 1
            abusive = max(abusive, exact, near / 2)
            out[6] += not ADDRESS.isdisjoint(around)
        out[5] = 100 * len(hits) / len(words)
        out[[0, 2, 3, 5, 6]] = np.log1p(out[[0, 2, 3, 5, 6]])
        out[1] = np.log1p(len(terms))
        out[4] = abusive
        out[7] = 1.0
        return out


def _fold(doc_id: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 5


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of the rows to learn from: all that are labelled and not held out."""
    chosen = materialise(
        labels.select("doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(_fold(F.col("doc_id")) != 0), "toxic-labels")
    return docs.join(bounded(chosen), "doc_id")


def _units(words: set[str]) -> set[str]:
    return words | {w[:k] + "*" for w in words for k in PREFIXES if len(w) > k}


def _term_counts(rows: DataFrame, only: frozenset[str] | None = None) -> DataFrame:
    """(unit, n): the documents that hold a word, or a word with a beginning (shown with a star)."""

    def counted(count: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(count.keys()), pa.string()), pa.array(list(count.values()), pa.int64())],
                                          names=["unit", "n"])

    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                units = _units(set(WORD.findall((text or "").lower())))
                count.update(units if only is None else units & only)
                if len(count) >= UNITS_TOGETHER:
                    yield counted(count)
                    count.clear()
        yield counted(count)

    return rows.select("text").mapInArrow(run, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))


def _collected(counts: DataFrame) -> dict[str, int]:
    """Units and numbers in the driver, by columns: a Row for each would take several times as much."""
    table = counts.select("unit", "n").toArrow()
    return dict(zip(table["unit"].to_pylist(), table["n"].to_pylist()))


def learn_terms(rows: DataFrame) -> list[Term]:
    """Words, and beginnings of words, that toxic rows of (text, toxic) hold far more often than others.

    Weights are log odds of document frequencies. All units that enough toxic rows hold are looked at; as enough is
    ``LEAST_SHARE`` of them at least, there are at most 2,000 times as many units as a toxic row has.
    """
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_bad, n_good = sizes.get(1, 0), sizes.get(0, 0)
    least = max(3 if n_bad < 200 else 5, math.ceil(n_bad * LEAST_SHARE))
    common = _term_counts(rows.where("toxic = 1")).where(F.col("n") >= least)
    bad = _collected(common)
    good = _collected(_term_counts(rows.where("toxic = 0"), frozenset(bad))) if bad else {}
    for w in SEED:
        bad[w] = bad.get(w, 0) + SEED_EVIDENCE
    scored = []
    for unit, n in bad.items():
        odds = np.log((n + 0.5) / (n_bad + 1)) - np.log((good.get(unit, 0) + 0.5) / (n_good + 1))
        if odds >= np.log(8) and n >= 4 * (1 + good.get(unit, 0)) * max(1, n_bad) / max(1, n_good, n_bad) or unit in SEED and odds > 0:
            scored.append((float(odds), unit))
    scored.sort(key=lambda x: (-x[0], x[1]))
    return [(u.rstrip("*"), u.endswith("*"), w) for w, u in scored]


def fit_logistic(features: DataFrame, ridge: float = 0.5, rounds: int = 40) -> np.ndarray:
    """Weights of a logistic regression with an intercept on (toxic, features), by Newton steps. Every task adds up its
    rows' gradient and curvature; only these sums reach the driver."""
    size = FEATURES + 1
    w = np.zeros(size)
    penalty = np.full(size, ridge)
    penalty[-1] = 1e-3

    def sums(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            curve, slope = np.zeros((size, size)), np.zeros(size)
            for batch in batches:
                y, n = (batch.column(k).to_numpy(zero_copy_only=False).astype(float) for k in (0, 2))
                x = np.column_stack([batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES), np.ones(len(y))])
                p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
                curve += (x * (n * p * (1 - p))[:, None]).T @ x
                slope += x.T @ (n * (y - p))
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([curve.tobytes() + slope.tobytes()])],
                                             names=["task", "sums"])

        found = sorted(features.mapInArrow(run, "task int, sums binary").collect(), key=lambda r: r["task"])
        total = sum(np.frombuffer(r["sums"]) for r in found)
        return total[:-size].reshape(size, size), total[-size:]

    for _ in range(rounds):
        curve, slope = sums(w)
        step = np.linalg.solve(curve + np.diag(penalty), slope - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _apply(rows: DataFrame, schema: str, terms: list[Term], out_of) -> DataFrame:
    """``rows`` of (id, extra, text) with what ``out_of`` makes of a task's scanner and a batch's texts. The scanner goes
    with its task, so a worker that goes on to other stages doesn't keep what it remembers."""
    names = [c.split()[0] for c in schema.split(", ")]

    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(terms)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), out_of(scan, batch.column(2).to_pylist())], names=names)

    return rows.mapInArrow(run, schema)


def learn(docs: DataFrame, labels: DataFrame) -> tuple[list[Term], np.ndarray]:
    """The lexicon and the weights of the features, from all labelled rows outside the held-out fold."""
    chosen = materialise(_labelled(docs, labels).select("doc_id", "toxic", "text"), "toxic-fit")
    terms = learn_terms(chosen)

    def measured(scan: Scanner, texts: list) -> pa.Array:
        return pa.array([scan.features(t).tolist() for t in texts], pa.list_(pa.float64()))

    found = _apply(chosen.select("doc_id", F.col("toxic").cast("int").alias("toxic"), "text"),
                   "doc_id long, toxic int, features array<double>", terms, measured)
    # Rows without a match have the same features.
    features = materialise(found.groupBy("toxic", "features").agg(F.count("*").alias("n")), "toxic-features")
    if features.isEmpty():
        prior = np.zeros(FEATURES + 1)
        prior[[4, 7, 8]] = 1.0, 0.0, -3.0
        return terms, prior
    return terms, fit_logistic(features)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document of (doc_id, text, ...).

    The lexicon and the classifier are learned from (doc_id, toxic, ...) of ``labels`` for documents
    whose crc32(doc_id as text) mod 5 isn't 0; the others are ``held_out``. Only the text is scored:
    matches of lexicon terms, of words that begin with one, and of words an edit away, each seen with
    the words and marks around it, so that quotation and report count apart from abuse.

    Cases: a null or empty text gets the score of a text without matches; rows that share a doc_id
    (null is one) count as one document, with the smallest text; a label other than 0 or 1, or without
    a doc_id, is ignored, and of several labels of a document the largest counts; without labels the
    seed terms alone decide; further columns are ignored; an empty table gives an empty table.

    Every text is read whole, and learning reads all labelled ones outside the fold. Tasks get the texts in small
    batches; so that this holds for the scores too, they are written once.
    """
    docs = one_per_id(docs, "doc_id", "text")

    def scored(scan: Scanner, texts: list) -> pa.Array:
        x = np.array([scan.features(t) for t in texts]).reshape(-1, FEATURES)
        return pa.array(1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30))), pa.float64())

    held_out = (_fold(F.col("doc_id")) == 0).alias("held_out")
    with arrow_batches(docs.sparkSession, *BATCH):
        terms, weights = learn(docs, labels)
        scores = materialise(_apply(docs.select("doc_id", held_out, "text"), "doc_id long, held_out boolean, score double", terms, scored),
                             "toxicity-scores")
    return scores.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def query(spark, sf_dir):
    return score_toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
