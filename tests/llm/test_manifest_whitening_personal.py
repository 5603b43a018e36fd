"""Merkle manifest, whitening and personal data against plain loops, with nulls, blanks, ties, repeats, clashes, no rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbline.llm import merkle, personal_data, whitening

DOC = ("doc_id long, source string, lang string, n_chars long, text string, tree string, size int, place int, digest string, "
       "level int, ranked int, leaf string, root string, kind int, plain int, contexts string, of int, `all` int, _nth int")
CLASH = ("t", 1, 2, "d", 3, 4, "l", "r", 5, 6, "c", 7, 8, 9)


def documents(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], DOC)


# --- Merkle manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree_by_hand(leaves, fan):
    """The root, and of every leaf its siblings per level as (those before, those after)."""
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + fan])) for i in range(0, len(levels[-1]), fan)])
    paths = []
    for at in range(len(leaves)):
        path = []
        for level in levels[:-1]:
            lo = at - at % fan
            path.append((level[lo:at], level[at + 1:lo + fan]))
            at //= fan
        paths.append(path)
    return levels[-1][0], paths


def fold_by_hand(leaf, path):
    for before, after in path:
        leaf = sha("".join(before) + leaf + "".join(after))
    return leaf


def manifest_by_hand(rows, fan, forge=None):
    def leaf_of(row):
        doc_id, source, lang, n_chars, text = row
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))

    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree_by_hand([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], fan) for g in names}
    root, tops = tree_by_hand([trees[g][0] for g in names], fan)
    out = []
    for g, top in zip(names, tops):
        for (_, _, leaf, row), path in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1]):
            whole = path + top
            changed = leaf_of(forge(row)) if forge and forge(row) else leaf
            reached = fold_by_hand(changed, whole)
            out.append((row[0], leaf, trees[g][0], root, sha("".join("".join(b) + "".join(a) for b, a in whole)), reached, reached == root))
    return sorted(out, key=repr)


def forge(row):
    if row[0] is None or zlib.crc32(str(row[0]).encode()) % 3:
        return None
    text = row[4] and "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
    return (*row[:4], text)


def sample_rows(counts):
    rng = random.Random(len(counts))
    rows, at = [], 0
    for lang, n in counts:
        for _ in range(n):
            at += rng.randrange(1, 4)
            rows.append((at, rng.choice(["a", None, "ß"]), lang, rng.choice([3, None]), rng.choice(["Text É " + str(at), None, "", "plain"])))
    rng.shuffle(rows)
    return rows


SPECIAL = [(None, "a", "en", 1, "no id"), (None, "a", "en", 1, "no id"), (None, None, None, None, None), (7, "a", "en", 1, "X"),
           (7, "a", "en", 1, "X"), (7, "a", "en", 1, "Y"), (-3, "a", "en", 1, "LONG " * 50_000), (5, "s", "+", 1, "Lone"), (6, "s", "", 1, "A")]


@pytest.mark.parametrize("rows", [
    SPECIAL, [(1, "a", "en", 1, "One")], sample_rows([("en", 73), ("de", 8), (None, 9), ("é", 1), ("z", 65)]),
    sample_rows([(f"l{i}", 1) for i in range(20)])], ids=["special", "one", "groups", "many groups"])
def test_manifest_query(spark, rows, tmp_path):
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = merkle.query(spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == manifest_by_hand(rows, 8, forge)


@pytest.mark.parametrize("fan", [2, 3, 5])
def test_manifest_of_other_fans(spark, fan):
    rows = sample_rows([("en", 30), ("de", 2), (None, 4)])
    found = merkle.manifest(documents(spark, rows), merkle.FIELDS, "lang", "doc_id", fan)
    up = lambda c: F.lower(F.hex(c))
    seen = found.select("doc_id", up("leaf"), up("subroot"), up("root"), merkle.proof_hash(F.col("path")),
                        up(merkle.folded(F.col("leaf"), F.col("path"))), F.lit(True)).collect()
    assert sorted((tuple(r) for r in seen), key=repr) == manifest_by_hand(rows, fan)
    assert {(r.doc_id, r.lang) for r in found.collect()} == {(r[0], r[2]) for r in rows}


def test_manifest_of_nothing(spark, tmp_path):
    documents(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    found = merkle.query(spark, str(tmp_path))
    assert found.collect() == []
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


# --- whitening


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, "w", 1, "a") for i, e in rows], "vec_id long, embedding array<float>, w string, at int, label string")


def whitening_by_hand(rows):
    good = [(i, e) for i, e in rows if e and all(c is not None and np.isfinite(c) for c in e)]
    x = [[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in e] for _, e in good]
    n, d = len(x), len(x[0])
    s = [sum(v[j] for v in x) for j in range(d)]
    centred = np.array([[(n * v[j] - s[j]) / n for j in range(d)] for v in x])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    deviation = [sum((n * v[j] - s[j]) ** 2 for j in range(d)) for v in x]
    return [i for i, _ in good], n, deviation, values, centred @ axes


@pytest.mark.parametrize("d, n", [(12, 300), (3, 50), (9, 40)])
def test_whitening_equals_an_eigendecomposition(spark, d, n):
    rng = np.random.default_rng(d)
    data = rng.standard_normal((n, d)) * np.linspace(1, 3, d) + rng.standard_normal((n, 1))
    rows = [(i, [float(c) for c in np.float32(v)]) for i, v in enumerate(data)]
    odd = [(500, None), (501, []), (502, [None] * d), (503, [float("nan")] * d), (504, [float("inf")] + [0.0] * (d - 1)),
           (505, [1e30] * d), (506, [1.0] * (d + 1)), (None, rows[0][1]), (0, rows[1][1]), (0, rows[1][1])]
    good = rows + odd[-3:]
    ids, count, deviation, values, projected = whitening_by_hand(good)
    found = whitening.whiten(vectors(spark, rows + odd).repartition(5)).collect()
    kept = min(8, d)
    assert len(found) == kept * len(good)
    for k in range(kept):
        mine = sorted((str(r.vec_id), r.deviation, r.whitened) for r in found if r.component == k + 1)
        flip = 1
        for sign in (1, -1):
            theirs = sorted((str(i), v, sign * p / np.sqrt(values[k])) for i, v, p in zip(ids, deviation, projected[:, k]))
            if np.allclose([m[2] for m in mine], [t[2] for t in theirs], atol=1e-9):
                flip = 0
                assert [m[:2] for m in mine] == [t[:2] for t in theirs]
        assert not flip, k
    assert {r.n for r in found} == {count}
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9
    shares = {r.component: r.explained for r in found}
    assert np.allclose([shares[k + 1] for k in range(kept)], values[:kept] / values.sum(), rtol=1e-9)


def test_whitening_without_variance(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None), (2, [])]):
        found = whitening.whiten(vectors(spark, rows))
        assert found.collect() == []
        assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    # two dimensions that move together: one component
    found = whitening.whiten(vectors(spark, [(i, [float(i), 2.0 * i, 7.0]) for i in range(20)])).collect()
    assert {r.component for r in found} == {1} and abs(found[0].explained - 1) < 1e-12


def test_whitening_far_from_the_origin_is_exact(spark):
    rows = [(i, [3.0e6 + i * 0.25, -2.0e6 + (i * i % 17) * 0.25]) for i in range(200)]
    ids, _, deviation, values, _ = whitening_by_hand(rows)
    found = {r.vec_id: r for r in whitening.whiten(vectors(spark, rows)).collect() if r.component == 1}
    assert [found[i].deviation for i in ids] == deviation
    assert np.isclose(found[0].explained, values[0] / values.sum(), rtol=1e-9)
    wide = [(1, [4.0e15]), (2, [-4.0e15]), (3, [0.0])]
    assert {r.deviation for r in whitening.whiten(vectors(spark, wide)).collect()} <= {None, 0}


def test_factor_and_rotations():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((20, 9))
    scatter = a @ a.T
    factor = whitening.pivoted_cholesky(scatter)
    assert factor.shape == (20, 9) and np.allclose(factor @ factor.T, scatter, atol=1e-9)
    turned = whitening.one_sided_jacobi(factor)
    gram = turned.T @ turned
    assert np.abs(gram - np.diag(np.diagonal(gram))).max() < 1e-10 and np.allclose(turned @ turned.T, scatter, atol=1e-9)


# --- personal data

FORMS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
         r"\+[0-9][\x20().0-9-]+[0-9]"]


def spans_by_hand(text):
    out = []
    for kind, form in enumerate(FORMS):
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m.group())
            doubled = sum(v - 9 if v > 9 else v for v in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))))
            stands = (True, kind != 1 or all(int(p) <= 255 for p in m.group().split(".")),
                      12 <= len(digits) <= 19 and doubled % 10 == 0, 9 <= len(digits) <= 15)[kind]
            if stands:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


@pytest.mark.parametrize("letters", ["a.@-0 ", "0123456789 -.", "01.", "+12345 ()-.9", "ab@.é +1234-.0 "])
def test_plain_forms_equal_the_expressions(letters):
    rng = random.Random(letters)
    for _ in range(3_000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(60)))
        assert personal_data.base_spans(text) == spans_by_hand(text), text


@pytest.mark.parametrize("text", ["a" * 1_000_000, "1" * 1_000_000, "1 " * 500_000, "@a.b " * 200_000, "+1" + " " * 1_000_000, "1.2.3 " * 100_000])
def test_very_long_texts_take_linear_time(text):
    assert personal_data.base_spans(text) == []


def corpus():
    """Telephone numbers stand after `phone at`, most in the plain form; others only after `fax line`."""
    rng = random.Random(9)
    plain = [f"+1 (017) 555-{rng.randrange(1000, 9999)}" for _ in range(12)]
    short = [f"555 77{i} {rng.randrange(100, 999)}" for i in range(6)]
    texts = [f"You may reach me by phone at {p} any day. The end of the note." for p in plain]
    texts += [f"You may reach me by phone at {p} any day." for p in short]
    texts += [f"Our new fax line {p} is open." for p in short[:5]] + ["Our new fax line 123 9876 55 is open."]
    texts += [f"Then the {p} came after the sun and the moon and the rain." for p in plain] + ["the 431 2233 99 stays"] * 3
    texts += ["write to old box 777 1212 88", None, "", "phone at", "PHONE AT: 555-7700-123"]
    return texts, short


def test_contexts_find_other_ways_to_write(spark):
    texts, short = corpus()
    rows = [(i, "s", "en", 1, t) for i, t in enumerate(texts)] + [(None, "s", "en", 1, "phone at 555 1111 222"), (0, "s", "en", 1, texts[0])]
    found = {r.doc_id: r for r in personal_data.find_personal(documents(spark, rows).repartition(3)).collect()}
    assert len(found) == len(texts) + 1
    for i, t in [*enumerate(texts), (None, "phone at 555 1111 222")]:
        base = [f"{personal_data.KINDS[k]}:{s}:{e}" for s, k, e in spans_by_hand(t or "")]
        assert found[i].base == base and set(base) <= set(found[i].spans)
        assert [found[i][f"n_{k}"] for k in personal_data.KINDS] == [sum(b.startswith(k) for b in base) for k in personal_data.KINDS]
        more = [s for s in found[i].spans if s not in base]
        number = re.search(r"555 77\d \d{3}|123 9876 55|555-7700-123|555 1111 222", t or "")
        assert more == ([f"phone:{number.start()}:{number.end()}"] if number else []), t


def test_contexts_need_several_values_and_precision(spark):
    texts = ["call +1 (017) 555-7713 now"] * 50 + ["call 555 1212 33 now"]
    found = personal_data.find_personal(documents(spark, [(i, "s", "en", 1, t) for i, t in enumerate(texts)]))
    assert found.where(F.size("spans") > F.size("base")).count() == 0
    texts = [f"call +1 (017) 555-77{i} now" for i in range(10, 20)] + ["call 555 1212 33 now"] + ["call me maybe"] * 10
    found = personal_data.find_personal(documents(spark, [(i, "s", "en", 1, t) for i, t in enumerate(texts)]))
    assert found.where(F.size("spans") > F.size("base")).count() == 0


def test_context_counts_equal_a_loop(spark):
    texts, _ = corpus()
    docs = documents(spark, [(i, "s", "en", 1, t) for i, t in enumerate(texts)])
    mentions = [m for t in texts if t for m in personal_data.mentions(t)]
    wanted = {c for m in mentions for c in m[5]}
    want = {}
    for t in texts:
        words = personal_data.WORD.findall((t or "").translate(personal_data.TEXT_TABLE))
        for end in range(1, len(words)):
            for n in range(1, min(end, 3) + 1):
                hashes = personal_data.word_hashes([w.encode() for w in words[end - n:end]])
                c = int(personal_data.window_hashes(hashes, n)[0].view(np.int64))
                if c in wanted:
                    want[c] = want.get(c, 0) + 1
    frame = spark.createDataFrame([(c,) for c in wanted], "context long")
    assert {r.context: r.n for r in personal_data.count_contexts(docs, frame).collect()} == want


def test_personal_data_in_no_rows(spark):
    found = personal_data.find_personal(documents(spark, []))
    assert found.collect() == []
    assert found.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "spans"]
