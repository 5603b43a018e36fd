"""What the shingle join carries along: no rows without a possible partner, and small batches of texts."""

import random

import pytest
from pyspark.sql import functions as F

from curbline.llm import ngram_join
from curbline.session import arrow_batches


@pytest.fixture
def written(monkeypatch):
    """Rows of every table that the join writes, and the largest batch allowed meanwhile, by name."""
    tables, before = [], ngram_join.materialise

    def kept(df, name):
        out = before(df, name)
        tables.append((name, out.count(), int(df.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))))
        return out

    monkeypatch.setattr(ngram_join, "materialise", kept)
    return tables


def test_documents_that_share_words_but_cannot_link_leave_the_lists(spark, written):
    """Sixty groups of three whose sizes are too far apart: every list they share is dropped before it is searched."""
    rng = random.Random(5)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    rows = []
    for g in range(60):
        shared = fresh(30)
        rows += [(3 * g + k, " ".join(shared + fresh(30 * 2 ** k))) for k in range(3)]
    rows.append((1000, rows[2][1] + " end"))
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    found = {r.doc_id: r.component_id for r in ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {k: k for k in range(180)} | {1000: 2}
    assert max(n for name, n, _ in written if name == "join-open") <= 2 * 4 * 20
    assert [n for name, n, _ in written if name == "join-open"][-1] == 0
    assert {most for _, _, most in written} == {ngram_join.BATCH[0]} and spark.conf.get(size) == before


def test_rows_with_a_partner_stay(spark):
    num, den = ratio = (85, 100)
    rng = random.Random(7)
    rows = []
    for key in range(80):
        for doc in rng.sample(range(500), rng.randint(2, 12)):
            n = rng.choice([rng.randint(20, 40), rng.randint(90, 130), rng.randint(200, 1500)])
            rows.append((key, doc, n, n - rng.randrange(max(1, n - ngram_join._least(n, ratio))), 1, doc % 100))
    schema = "key long, doc long, n long, reach long, keys long, component long"
    live = {(r.key, r.doc) for r in ngram_join._live(spark.createDataFrame(rows, schema), ratio).collect()}
    partners = {(a[0], a[1]) for a in rows for b in rows if a[0] == b[0] and a[5] != b[5]
                and min(a[3], b[3]) * (num + den) >= num * (a[2] + b[2])}
    assert partners <= live and len(live) < len(rows)


def test_lists_of_near_copies_are_one(spark):
    """Two hundred lists with most of the same twenty documents, and lists of two that share one of them."""
    rng = random.Random(9)
    rows = [(key, doc, 100, rng.randint(85, 100), 1, doc) for key in range(200) for doc in rng.sample(range(20), 18)]
    rows += [(1000 + k, doc, 100, 100, 1, doc) for k in range(300) for doc in (k % 20, 100 + k)]
    pairs = lambda lists: {(a, b): min(lists[k][a], lists[k][b]) for k in sorted(lists)
                           for a in lists[k] for b in lists[k] if a < b}
    work = lambda lists: sum(len(m) ** 2 for m in lists.values())

    def by_key(found):
        lists = {}
        for key, doc, _, reach, _, _ in found:
            lists.setdefault(key, {})[doc] = max(reach, lists.get(key, {}).get(doc, 0))
        return lists

    schema = "key long, doc long, n long, reach long, keys long, component long"
    after = ngram_join._merged(spark.createDataFrame(rows, schema)).collect()
    assert sum(r.keys for r in after) == len(rows) and len(after) < 1_000
    before, after = by_key(rows), by_key(after)
    assert set(pairs(before)) <= set(pairs(after)) and work(after) <= work(before) / 10
    for key, members in before.items():  # some list has all of a list's members, with reaches as large
        assert any(all(other.get(d, 0) >= reach for d, reach in members.items()) for other in after.values()), key


def test_a_list_of_two_out_of_reach_is_none(spark):
    packed = lambda n, reach: (n << 32) + reach
    keys = [(1, 10, packed(100, 100)), (1, 11, packed(400, 400)), (2, 10, packed(100, 100)), (2, 12, packed(110, 110)),
            (3, 10, packed(100, 99)), (3, 11, packed(400, 399)), (3, 12, packed(110, 109)), (4, 10, packed(100, 98)),
            (5, 10, packed(100, 97)), (5, 12, packed(110, 104))]
    lists = ngram_join._lists(spark.createDataFrame(keys, "key long, doc long, packed long"), (85, 100))
    got = lists.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("doc", "n", "reach", "keys"))).alias("members")).collect()
    assert sorted([tuple(m) for m in r.members] for r in got) == [
        [(10, 100, 99, 1), (11, 400, 399, 1), (12, 110, 109, 1)], [(10, 100, 100, 2), (12, 110, 110, 2)]]


def test_settings_of_the_session_come_back_after_an_error(spark):
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    with pytest.raises(ZeroDivisionError), arrow_batches(spark, 7, "1m"):
        assert spark.conf.get(size) == "7"
        1 / 0
    assert spark.conf.get(size) == before
