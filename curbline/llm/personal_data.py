"""Personal data: plain forms by pattern, and further identifiers by contexts bootstrapped from them."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import one_per_id, window_hashes, word_hashes
from curbline.session import materialise

# Kinds in the order in which spans at one place are listed.
KINDS = ["email", "ip", "card", "phone"]
EMAIL, IP, CARD, PHONE = range(4)

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
MAIL_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
PHONE_FORM = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# A stretch of digits and the marks between them: every address, card and telephone number stands in one.
DIGITS = re.compile(r"[0-9](?:[\x20().-]{0,2}[0-9])*+")
CARD_FORM = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
# A whole run of digits where no address begins, so that none is tried from within a run.
IP_FORM = re.compile(r"[0-9]++(?:(?:\.[0-9]++){3})?")

# Other ways to write an identifier. They count only where a learnt context precedes them.
OTHER_MAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(?:\x20?[\[(]at[\])]\x20?|\x20at\x20(?=[A-Za-z0-9-]+(?:\x20?[\[(]dot|\x20dot\x20|\.))|@)"
    r"[A-Za-z0-9-]{1,63}(?:(?:\x20?[\[(]dot[\])]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]{1,63}){0,8}", re.IGNORECASE)
OTHER_MAIL_MARK = re.compile(r"@|[\[(]at[\])]|\x20at\x20[^\x20]+\x20?[\[(]?dot\b", re.IGNORECASE)
OTHER_IP = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{0,4}:){3,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])")
OTHER_CARD = re.compile(r"[0-9](?:[\x20.-]?[0-9])++")

# Context words are runs of other characters than blanks and these marks, A-Z in lower case, every digit as 0.
MARKS = "=:;,\"'<>[]{}|()"
_FROM = MARKS + "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "123456789"
_TO = " " * len(MARKS) + "abcdefghijklmnopqrstuvwxyz" + "0" * 9
TEXT_TABLE, BYTE_TABLE = str.maketrans(_FROM, _TO), bytes.maketrans(_FROM.encode(), _TO.encode())
WORD = re.compile(r"[^\x20\x09-\x0D]+")
MOST_WORDS = 3  # words of a context

# Contexts are looked up in a set of bits of this fixed size before they are counted: 1 MB, whatever their number.
BITS = 23
# Contexts gathered before a task adds up equal ones.
GATHERED = 1_000_000


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0  # where a next match can begin at the earliest
    for host in MAIL_HOST.finditer(text):
        at = host.start()
        before = text[free:at]
        start = at - (len(before) - len(before.rstrip(LOCAL)))
        if start < at:
            yield start, host.end()
            free = host.end()
        else:
            free = at + 1


def _is_address(part: str) -> bool:
    pieces = [p.lstrip("0") for p in part.split(".")]
    return len(pieces) == 4 and all(len(p) <= 3 and int(p or "0") <= 255 for p in pieces)


def _luhn(digits: str) -> bool:
    doubled = [sum(divmod(2 * int(c), 10)) for c in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(doubled)) % 10 == 0


def _digits(part: str) -> str:
    return "".join(c for c in part if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all plain forms, leftmost and non-overlapping per kind, by start and kind."""
    return sorted(_base(text, _stretches(text)))


def _stretches(text: str) -> list[tuple[int, int]]:
    """The stretches of digits that can hold an address or a number of seven digits or more."""
    return [m.span() for m in DIGITS.finditer(text) if m.end() - m.start() >= 7]


def _base(text: str, stretches: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    found = [(s, EMAIL, e) for s, e in _emails(text)] if "@" in text else []
    for lo, hi in stretches:
        for m in IP_FORM.finditer(text, lo, hi):
            if m.end() - m.start() >= 7 and _is_address(m.group()):
                found.append((m.start(), IP, m.end()))
        for m in CARD_FORM.finditer(text, lo, hi):
            if 12 <= m.end() - m.start() <= 37:
                digits = _digits(m.group())
                if 12 <= len(digits) <= 19 and _luhn(digits):
                    found.append((m.start(), CARD, m.end()))
    if "+" in text:
        for m in PHONE_FORM.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                found.append((m.start(), PHONE, m.end()))
    return found


def _others(text: str, stretches: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(start, kind, end) of everything written in another way."""
    if OTHER_MAIL_MARK.search(text):
        for m in OTHER_MAIL.finditer(text):
            yield m.start(), EMAIL, m.end()
    if text.count(":") >= 3:
        for m in OTHER_IP.finditer(text):
            yield m.start(), IP, m.end()
    for lo, hi in stretches:
        for m in OTHER_CARD.finditer(text, lo, hi):
            if 12 <= len(_digits(m.group())) <= 19:
                yield m.start(), CARD, m.end()
        if 7 <= len(_digits(text[lo:hi])) <= 15:
            yield lo - (lo > 0 and text[lo - 1] == "("), PHONE, hi


def _value(kind: int, part: str) -> int:
    """A signed hash of what is written, not of how: digits alone for numbers, letters in lower case."""
    plain = _digits(part) if kind in (CARD, PHONE) else part.translate(str.maketrans(_FROM[len(MARKS):-9], _TO[len(MARKS):-9]))
    return xxhash.xxh3_64_intdigest(plain.encode()) - (1 << 63)


def mentions(text: str) -> list[tuple[int, int, int, bool, int, list[int]]]:
    """(start, kind, end, plain, value, contexts) of everything that is or could be personal data.

    Contexts are hashes of the last one, two and three words before it. Other ways to write one that
    overlap a plain form aren't listed.
    """
    stretches = _stretches(text)
    base = sorted(_base(text, stretches))
    taken: list[tuple[int, int]] = []  # the plain forms as disjoint stretches
    for s, _, e in base:
        if taken and s < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(taken[-1][1], e))
        else:
            taken.append((s, e))
    begins = [s for s, _ in taken]

    def free(s: int, e: int) -> bool:
        at = bisect_right(begins, e - 1) - 1
        return at < 0 or taken[at][1] <= s

    found = [(s, k, e, True) for s, k, e in base] + [(s, k, e, False) for s, k, e in set(_others(text, stretches)) if free(s, e)]
    if not found:
        return []
    places = [m.span() for m in WORD.finditer(text.translate(TEXT_TABLE))]
    ends = [e for _, e in places]
    out = []
    for s, k, e, plain in sorted(found):
        at = bisect_right(ends, s)  # the words before it
        contexts: list[int] = []
        if at and (at == len(places) or places[at][0] >= s):
            words = [text[a:b].translate(TEXT_TABLE).encode() for a, b in places[max(0, at - MOST_WORDS): at]]
            hashes = word_hashes(words)
            contexts = [int(window_hashes(hashes[-n:], n)[0].view(np.int64)) for n in range(1, len(words) + 1)]
        out.append((s, k, e, plain, _value(k, text[s:e]), contexts))
    return out


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, columns = [], [[] for _ in range(6)]
        for row, text in enumerate(batch.column(1).to_pylist()):
            for mention in mentions(text) if text else ():
                rows.append(row)
                for column, value in zip(columns, mention):
                    column.append(value)
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, kinds)]],
            names=["doc_id", "start", "kind", "end", "plain", "value", "contexts"])


def count_contexts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(context, n): how often each of the contexts ``wanted`` precedes a word, in all whole texts.

    Tasks look contexts up in a set of bits of fixed size, add up those that may be wanted, and a join by
    equality drops those that aren't.
    """
    place = F.col("context").bitwiseAND(F.lit((1 << BITS) - 1))
    bits = np.zeros(1 << (BITS - 3), np.uint8)
    for row in wanted.groupBy(F.shiftright(place, 15).alias("part")).agg(
            F.bitmap_construct_agg(place.bitwiseAND(F.lit((1 << 15) - 1))).alias("bits")).collect():
        bits[row["part"] << 12: (row["part"] + 1) << 12] = np.frombuffer(bytes(row["bits"]), np.uint8)

    def summed(parts: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], names=["context", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for batch in batches:
            for text in batch.column(0):
                data = text.as_py()
                hashes = word_hashes(data.translate(BYTE_TABLE).split())[:-1] if data else np.zeros(0, np.uint64)
                for n in range(1, MOST_WORDS + 1):
                    windows = window_hashes(hashes, n)
                    low = windows & np.uint64((1 << BITS) - 1)
                    hit = windows[(bits[(low >> np.uint64(3)).astype(np.int64)] >> (low & np.uint64(7)).astype(np.uint8)) & 1 == 1]
                    if len(hit):
                        kept.append(hit)
                        size += len(hit)
                if size >= GATHERED:
                    yield summed(kept)
                    kept, size = [], 0
        if kept:
            yield summed(kept)

    found = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(count, "context long, n long")
    return found.groupBy("context").agg(F.sum("n").alias("n")).join(wanted, "context", "left_semi")


def bootstrap(docs: DataFrame, found: DataFrame, min_seeds: int, min_confidence: float, rounds: int) -> tuple[DataFrame, DataFrame]:
    """Patterns (kind, context, confidence) and values (kind, value, score), from mentions.

    A pattern is a context that precedes ``min_seeds`` different values of a kind or more. Its confidence is
    p / (p + o + 1): p adds up the scores of the different values after it, and o counts where something else
    follows, over all texts. Plain forms score 1, others 0 at first; a pattern is trusted when p reaches ``min_seeds``
    and the confidence ``min_confidence``; each round gives every other value 1 - product(1 - confidence) over its
    trusted patterns, which can raise further patterns in the next one.
    """
    edges = found.select("kind", "value", "plain", F.explode("contexts").alias("context"))
    seen = edges.groupBy("kind", "context", "value").agg(F.count("*").alias("times"), F.max("plain").alias("plain"))
    patterns = materialise(
        seen.groupBy("kind", "context").agg(F.count("*").alias("values"), F.sum("times").alias("times"))
        .where(F.col("values") >= min_seeds), "personal-patterns")
    counts = materialise(count_contexts(docs, materialise(patterns.select("context").distinct(), "personal-contexts")), "personal-counts") \
        if not patterns.isEmpty() else patterns.select("context", F.lit(0).cast("long").alias("n"))
    # A pattern that can't be trusted even if every value after it were personal leaves now: common words do.
    best = F.col("values") / (F.col("values") + F.col("elsewhere") + 1)
    hopeful = materialise(
        patterns.join(counts, "context").withColumn("elsewhere", F.greatest(F.col("n") - F.col("times"), F.lit(0)))
        .where(best >= min_confidence).select("kind", "context", "elsewhere"), "personal-hopeful")
    graph = materialise(seen.join(hopeful, ["kind", "context"]).select("kind", "context", "value", "plain", "elsewhere"), "personal-graph")
    scores = graph.where(F.lit(False)).select("kind", "value", F.lit(0.0).alias("score"))
    trusted = graph.where(F.lit(False)).select("kind", "context", F.lit(0.0).alias("confidence"))
    known = -1
    for k in range(rounds if not graph.isEmpty() else 0):
        scored = graph.join(scores, ["kind", "value"], "left")
        p = F.sum(F.when(F.col("plain"), 1.0).otherwise(F.coalesce("score", F.lit(0.0))))
        trusted = materialise(
            scored.groupBy("kind", "context").agg(p.alias("p"), F.max("elsewhere").alias("o"))
            .withColumn("confidence", F.col("p") / (F.col("p") + F.col("o") + 1))
            .where((F.col("p") >= min_seeds) & (F.col("confidence") >= min_confidence))
            .select("kind", "context", "confidence"), f"personal-trusted-{k}")
        scores = materialise(
            graph.where(~F.col("plain")).join(trusted, ["kind", "context"]).groupBy("kind", "value")
            .agg((1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("score")), f"personal-scores-{k}")
        now = scores.count()
        if now == known:
            break
        known = now
    return trusted, scores


def find_personal(docs: DataFrame, min_seeds: int = 4, min_confidence: float = 0.8, rounds: int = 4) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans) for every document of (doc_id, text, ...).

    ``base`` are the plain forms as kind:start:end by start, then kind as listed in ``KINDS``, in code points and with
    exclusive ends; the counts are theirs. ``spans`` has them and the identifiers written in another way whose value
    the bootstrapped patterns (:func:`bootstrap`) found, wherever it stands.

    Cases: a null or empty text has no spans; rows that share a doc_id (null is one) count as one document, with the
    smallest text; plain forms of different kinds may overlap and all stand; a mention that begins within a word has no
    context; further columns are ignored; an empty table gives an empty table. Only mentions are shuffled, never texts.
    """
    docs = one_per_id(docs, "doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = materialise(docs.mapInArrow(
        _find, f"doc_id {id_type}, start int, kind int, end int, plain boolean, value long, contexts array<long>"), "personal-mentions")
    _, scores = bootstrap(docs, found, min_seeds, min_confidence, rounds)
    others = found.where(~F.col("plain")).join(scores.where(F.col("score") >= min_confidence), ["kind", "value"], "left_semi")
    spans = found.where("plain").unionByName(others.select(found.columns))
    per_doc = spans.groupBy(F.col("doc_id").alias("of")).agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end", "plain"))).alias("all"))
    names = F.array(*[F.lit(k) for k in KINDS])
    shown = lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])
    count = lambda kind: F.coalesce(F.size(F.filter("all", lambda x: x["plain"] & (x["kind"] == kind))), F.lit(0))
    empty = F.array().cast("array<string>")
    return (docs.select("doc_id").join(per_doc, F.col("doc_id").eqNullSafe(F.col("of")), "left")
            .select("doc_id", *[count(i).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)],
                    F.coalesce(F.transform(F.filter("all", lambda x: x["plain"]), shown), empty).alias("base"),
                    F.coalesce(F.transform("all", shown), empty).alias("spans")))


def query(spark, sf_dir):
    found = find_personal(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", *[f"n_{k}" for k in KINDS],
                        F.sha2(F.encode(F.array_join("base", ","), "UTF-8"), 256).alias("base_sha256"),
                        F.array_join("spans", ",").alias("spans"))
