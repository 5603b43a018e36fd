"""What tasks hold at once: rows of a batch, and what workers keep when their task is over."""

import gc
import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from curbline.llm import common, decontamination, token_planes, toxicity


def spy_batches(monkeypatch, spark, most_of):
    """From now on a task of mapInArrow fails when it gets a batch of more rows than ``most_of`` says for its schema.
    Returns the limits of the calls so far."""
    kind, seen = type(spark.range(0)), []

    def spied(self, func, schema, *args, given=kind.mapInArrow, **named):
        seen.append(most := most_of(schema))

        def bounded(batches):
            for batch in batches:
                if batch.num_rows > most:
                    raise ValueError(f"a batch of {batch.num_rows} rows")
                yield batch

        return given(self, lambda batches: func(bounded(batches)), schema, *args, **named)

    monkeypatch.setattr(kind, "mapInArrow", spied)
    return seen


def test_toxicity_gets_texts_in_small_batches(spark, monkeypatch):
    """In learning and in scoring, whoever reads the scores; and what a task counts is handed on in parts."""
    docs = spark.range(9_000).selectExpr("id as doc_id", "concat('word', id, if(id % 3 = 0, ' you moron', ' plain')) as text").coalesce(1)
    labels = spark.range(9_000).selectExpr("id as doc_id", "int(id % 3 = 0) as toxic").coalesce(1)
    seen = spy_batches(monkeypatch, spark, lambda schema: 1_000)
    got = toxicity.score_toxicity(docs, labels).collect()
    assert len(seen) > 4 and Counter((r["doc_id"] % 3 == 0, r["predicted"]) for r in got) == {(True, 1): 3_000, (False, 0): 6_000}
    monkeypatch.undo()
    counts = {r["unit"]: r["n"] for r in toxicity._term_counts(docs).collect()}
    assert counts["moron"] == counts["moro*"] == 3_000 and counts["word17"] == 1
    monkeypatch.setattr(toxicity, "UNITS_TOGETHER", 50)
    assert {r["unit"]: r["n"] for r in toxicity._term_counts(docs).collect()} == counts


def test_token_planes_hold_little_in_workers(spark, monkeypatch):
    """Texts come in small batches and blocks a few at a time, whoever reads the result; no worker keeps an encoder."""
    docs = spark.range(6_000).selectExpr("id as doc_id", "concat('a word ', id) as text").coalesce(1)
    seen = spy_batches(monkeypatch, spark, lambda schema: 1_000 if "planes" in schema else 4)
    monkeypatch.setattr(token_planes.write_token_planes, "__defaults__", ("byte", 500, 1 << 26))
    got = {r["doc_id"]: r for r in token_planes.encode_documents(docs).collect()}
    assert set(seen) == {4, 1_000} and len(got) == 6_000
    assert all(got[i]["start"] + got[i]["n_tokens"] == got[i + 1]["start"] for i in range(5_999))
    monkeypatch.undo()

    def encoders(batches):
        for batch in batches:
            held = sum(type(x).__name__ == "Encoder" for x in gc.get_objects())
            yield pa.RecordBatch.from_arrays([pa.array([held] * batch.num_rows, pa.int64())], names=["held"])

    assert spark.range(0, 64, 1, 16).mapInArrow(encoders, "held long").agg(F.sum("held")).first()[0] == 0


def test_decontamination_gets_rows_in_small_batches(spark, monkeypatch):
    """In the fit and in the search, whoever reads the hits; no rows go through Python objects, which would leave workers
    of another kind in every executor; and few tasks hand on a product as large as the basis."""
    item = " ".join(f"b{k}" for k in range(40))
    docs = spark.range(6_000).selectExpr("id as doc_id", f"concat('noise ', id, if(id % 1000 = 7, ' {item}', ' b1')) as text").coalesce(1)
    benchmark = spark.range(1).selectExpr("id as item_id", f"'{item}' as text")
    kind, fitted = type(spark.sparkContext), []

    def refused(*args, **named):
        raise AssertionError("rows as Python objects")

    def fit(rows, *args, given=decontamination.randomised_svd):
        fitted.append(rows.rdd.getNumPartitions())
        return given(rows, *args)

    monkeypatch.setattr(kind, "parallelize", refused)
    monkeypatch.setattr(decontamination, "randomised_svd", fit)
    seen = spy_batches(monkeypatch, spark, lambda schema: 1_000)
    found = decontamination.find_benchmark(docs, benchmark).collect()
    assert sorted(r["doc_id"] for r in found) == [k * 1_000 + 7 for k in range(6)] and all(r["overlap"] == 1.0 for r in found)
    assert len(seen) > 6 and fitted == [2]


def test_randomised_svd_finds_the_leading_space(spark):
    rng = np.random.default_rng(3)
    dense = rng.standard_normal((70, 4)) @ rng.standard_normal((4, 1_100)) * (rng.random((70, 1_100)) < 0.9)
    dense[5] = 0
    rows = spark.createDataFrame([(np.flatnonzero(r).tolist(), r[np.flatnonzero(r)].tolist()) for r in dense], "at array<int>, x array<double>")
    basis = decontamination.randomised_svd(rows.coalesce(2), 1_100, 4, 8, 4, 5)
    want = np.linalg.svd(dense, full_matrices=False)[2][:4]
    assert np.allclose(basis.T @ basis, np.eye(4)) and np.linalg.svd(want @ basis)[1].min() > 0.999


def test_workers_give_memory_back_after_their_last_batch(monkeypatch):
    trims = []
    monkeypatch.setattr(common.ctypes, "CDLL", lambda name: SimpleNamespace(malloc_trim=trims.append))
    batches = [pa.RecordBatch.from_arrays([pa.array([k])], names=["k"]) for k in range(3)]
    run = common.given_back(lambda given: (b for b in given))(iter(batches))
    assert next(run) is batches[0] and trims == []
    assert list(run) == batches[1:] and trims == [0]


def test_words_are_cut_beside_marks_as_the_library_cuts():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, encoder = Tokenizer.from_file(path), token_planes.Encoder(path)
    rng = random.Random(7)
    parts = [*".,;:!?#$%&*()\"-'_/=<>|", *"aBsStTdLl", " ", "\n", "0", "7", "É", "é", "Σ", "̸", "İ", "漢", "'re", "Word"]
    for k in range(60):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(50)] + [None, ""]
        if k % 10 == 0:
            texts += ["a.<|endoftext|>.B", "<|ENDOFTEXT|>#a", "x<|StartOfText|>"]
        given = pa.array(["skipped. A", *texts], pa.large_string() if k % 3 == 0 else pa.string())[1:]
        for text, ids in zip(texts, encoder.many(given)):
            assert ids.tolist() == library.encode(text or "", add_special_tokens=False).ids, repr(text)
    cut = token_planes.apart(pa.array(["One,two ONE", "", "#(one) won't"])).to_pylist()
    assert " ".join(cut).split() == ["one", ",", "two", "one", "#(", "one", ")", "won't"]
