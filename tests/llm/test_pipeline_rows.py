"""Pipeline stages row by row: null and repeated ids, clashing and map columns, empty tables; and the lexicon and the
sketches against plain loops."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from curbline.llm import ngram_join, toxicity

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, gone string, chosen int, words string, domain string, "
          "key int, row string, copies int, part int, item_id long, n int, tags map<string,int>, `a.b` int")
EXTRA = ("g", 1, "w", "dom", 2, "r", 3, 4, 5, 6, {"x": 1, "y": 2}, 7)


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "src1", len(t) if t is not None else None, *EXTRA) for i, t in rows], SCHEMA)


def kept(stage, spark, rows, folder):
    given = table(spark, rows)
    after = stage(spark, given.repartition(3), str(folder))
    assert after.schema.names == given.schema.names
    found = after.collect()
    assert all(r["tags"] == {"x": 1, "y": 2} and r["domain"] == "dom" and r["a.b"] == 7 and r["gone"] == "g" for r in found)
    return Counter((r["doc_id"], r["text"]) for r in found)


def write(spark, folder, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


ODD = [(None, None), (None, ""), (901, None), (902, " \t\n"), (902, "")]


def test_toxic_rows_go_one_by_one(spark, tmp_path):
    good = [(i, f"plain words {i} and nothing else") for i in range(120)]
    bad = [(1000 + i, f"plain words {i} you moron idiot scum") for i in range(60)]
    write(spark, tmp_path, labels=([(i, 1, int(i >= 1000)) for i, _ in good + bad], "doc_id long, quality int, toxic int"))
    rows = good + bad + ODD + [(None, "you moron idiot scum again"), (None, "nothing of the kind"), (5, "plain you moron idiot scum words"),
                               (5, "plain words 5 and nothing else"), (1000, "plain words at last")]
    assert kept(corpus_pipeline.drop_toxic, spark, rows, tmp_path) == Counter(r for r in rows if "moron" not in (r[1] or ""))
    assert kept(corpus_pipeline.drop_toxic, spark, good + bad, tmp_path) == Counter(good)
    assert kept(corpus_pipeline.drop_toxic, spark, [], tmp_path) == Counter()


def test_one_row_of_near_copies_stays(spark, tmp_path):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(6)]
    near = [t.replace(t.split()[30], "other") for t in texts]
    rows = [(10 + k, t) for k, t in enumerate(texts)] + [(5 + k, t) for k, t in enumerate(near[:3])] + ODD
    rows += [(None, texts[0]), (None, near[5]), (15, texts[5]), (11, "alone but of the same id"), (None, "no id and no copy")]
    shingles = [{tuple((t or "").split()[k:k + 5]) for k in range(max(1, len((t or "").split()) - 4))} - {()} for _, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            common = len(shingles[a] & shingles[b])
            if common and 100 * common >= 80 * (len(shingles[a]) + len(shingles[b]) - common):
                root[find(a)] = find(b)
    groups = {}
    for at, r in enumerate(rows):
        groups.setdefault(find(at), []).append(r)
    want = Counter(min(g, key=lambda r: (r[0] is None, r[0] or 0))[0] for g in groups.values())
    got = kept(corpus_pipeline.drop_near_copies, spark, rows, tmp_path)
    assert Counter(i for i, _ in got.elements()) == want and set(got) <= set(rows) and len(groups) < len(rows)
    assert kept(corpus_pipeline.drop_near_copies, spark, [], tmp_path) == Counter()


def test_contaminated_rows_go_one_by_one(spark, tmp_path):
    rng = random.Random(6)
    items = [" ".join(f"b{rng.randrange(3000)}" for _ in range(30)) for _ in range(3)]
    filler = lambda n: " ".join(f"f{rng.randrange(3000)}" for _ in range(n))
    write(spark, tmp_path, benchmark=([(1, items[0]), (1, items[1]), (None, items[2]), (4, None), (5, "")], "item_id long, text string"))
    rows = [(k, filler(80)) for k in range(20)] + ODD
    rows += [(None, f"{filler(20)} {items[0]} {filler(9)}"), (3, f"{filler(5)} {items[1]}"), (30, items[2]), (None, filler(40))]
    want = Counter(r for r in rows if not any(t in (r[1] or "") for t in items))
    assert kept(corpus_pipeline.drop_benchmark, spark, rows, tmp_path) == want
    assert kept(corpus_pipeline.drop_benchmark, spark, [], tmp_path) == Counter()
    write(spark, tmp_path, benchmark=([], "item_id long, text string"))
    assert kept(corpus_pipeline.drop_benchmark, spark, rows, tmp_path) == Counter(rows)


def test_mixture_keeps_columns_and_empty_tables(spark, tmp_path):
    rows = [(k, f"one two three {k}") for k in range(50)] + ODD
    got = kept(corpus_pipeline.mix_sources, spark, rows, tmp_path)
    assert sum(len((t or "").split()) for _, t in got.elements()) == 160
    assert all(any(i == j and (t or "").startswith(u or "") for j, t in rows) for i, u in got)
    assert kept(corpus_pipeline.mix_sources, spark, [], tmp_path) == Counter()


def test_ids_are_written_for_odd_rows(spark, tmp_path):
    got = corpus_pipeline.write_ids(spark, table(spark, ODD + [(1, "a b"), (1, "a b")]), str(tmp_path)).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.start, r.n_tokens) for r in got) == [(-1, 0, 1), (1, 1, 3), (901, 4, 1), (902, 5, 1)]
    assert corpus_pipeline.write_ids(spark, table(spark, []), str(tmp_path)).collect() == []


def one_edit(a, b):
    """Whether a letter added, left out or changed, or two neighbours in the other order, or nothing, makes a from b."""
    if a == b:
        return True
    if len(a) == len(b):
        at = [i for i in range(len(a)) if a[i] != b[i]]
        return len(at) == 1 or len(at) == 2 and at[1] == at[0] + 1 and a[at[0]] == b[at[1]] and a[at[1]] == b[at[0]]
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


@pytest.mark.parametrize("seed", range(4))
def test_lexicon_equals_an_edit_distance_loop(seed):
    rng = random.Random(seed)
    word = lambda lo, hi: "".join(rng.choice("abc") for _ in range(rng.randint(lo, hi)))
    terms = [(word(3, 8), rng.random() < 0.4, round(rng.random() + 0.1, 3)) for _ in range(25)]
    terms += [(t, not p, w + 0.05) for t, p, w in terms[:8]]
    lexicon = toxicity.FuzzyLexicon(terms, states=200)
    for _ in range(3_000):
        w = word(1, 10)
        exact = max([x for t, p, x in terms if (w.startswith(t) if p else w == t)], default=0.0)
        near = max([x for t, p, x in terms if not p and len(t) >= 5 and one_edit(w, t)], default=0.0)
        assert lexicon.match(w) == (exact, near), w


def test_lexicon_keeps_whole_terms_beside_beginnings():
    lexicon = toxicity.FuzzyLexicon([("idiot", False, 2.0), ("idiot", True, 3.0), ("moron", True, 1.0), ("moron", False, 4.0)])
    assert lexicon.match("idot") == (0.0, 2.0) and lexicon.match("moronic") == (1.0, 0.0)
    assert lexicon.match("idoit") == (0.0, 2.0) and lexicon.match("idiot")[0] == 3.0


def test_sketches_lose_no_link():
    rng = np.random.default_rng(3)
    for n in (1, 5, 60, 400, 3_000):
        s = rng.integers(1 << 62, size=n).astype(np.uint64)
        for share in (0.0, 0.02, 0.1, 0.5):
            t = s.copy()
            changed = rng.random(n) < share
            t[changed] = rng.integers(1 << 62, size=int(changed.sum())).astype(np.uint64)
            a, b = (np.array(ngram_join._sketch(np.unique(x)), np.int64) for x in (s, t))
            bits = sum(int(x).bit_count() for x in (a ^ b).view(np.uint64).tolist())
            assert bits <= len(set(s.tolist()) ^ set(t.tolist()))


def test_a_template_whose_members_do_not_link(spark):
    """Half of every text is the same; no two are similar enough, but for a few planted pairs."""
    rng = random.Random(8)
    head = [f"h{k}" for k in range(40)]
    rows = [(k, " ".join(head + [f"t{rng.randrange(10**6)}" for _ in range(40)])) for k in range(300)]
    rows += [(1000 + k, rows[k][1].rsplit(" ", 1)[0]) for k in range(5)]
    found = {r.doc_id: r.component_id for r in ngram_join.ngram_join(
        spark.createDataFrame(rows, "doc_id long, text string").withColumn("sketch", F.lit(1)).withColumn("key", F.lit("k"))).collect()}
    assert found == {k: k for k in range(300)} | {1000 + k: k for k in range(5)}
