"""Lines that many documents repeat are dropped everywhere but in one document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import BLANKS, bounded, one_per_id
from curbline.session import materialise

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A to Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, UPPER.lower())


def _key_hash(line: Column) -> Column:
    return F.unhex(F.md5(line_key(line)))


def drop_repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept) for every document of (doc_id, text, ...).

    A line is a stretch between \\n; its key is :func:`line_key`. A key of at least ``min_chars`` code
    points in at least ``min_docs`` documents loses all its lines except in the largest doc_id that
    holds it; there, repeats stay too. The other lines keep their order.

    Cases: a null or empty text is one empty line; rows that share a doc_id (null is one) count as one
    document, with the smallest text; a null doc_id counts as a document and is the largest only if it
    is alone; further columns are ignored; an empty table gives an empty table.

    Keys travel as 128-bit hashes. Documents per key are counted by two partial aggregates, so a line
    that a third of the documents hold reaches the reducers as one row per map task and salt.
    """
    docs = one_per_id(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    long_lines = F.array_distinct(F.transform(
        F.filter(F.split("text", "\n", -1), lambda x: F.char_length(line_key(x)) >= min_chars), _key_hash))
    # Keys are distinct within a document and there is one row per document: a count of rows is a
    # count of documents.
    per_key = (docs.select("doc_id", F.explode(long_lines).alias("key")).groupBy("key")
               .agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper")))
    repeated = bounded(materialise(per_key.where(F.col("n") >= min_docs).select("key", "keeper"), "lines"))

    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    dropped = (lines.where(F.char_length(line_key(F.col("line"))) >= min_chars)
               .select("doc_id", "at", _key_hash(F.col("line")).alias("key")).join(repeated, "key")
               .where(~F.col("keeper").eqNullSafe(F.col("doc_id")))
               .groupBy("doc_id").agg(F.collect_list("at").alias("gone"))
               .select(F.col("doc_id").alias("of"), "gone"))
    gone = bounded(materialise(dropped, "dropped-lines"))
    parts = F.split("text", "\n", -1)
    return (docs.join(gone, F.col("doc_id").eqNullSafe(F.col("of")), "left")
            .select("doc_id", F.size(parts).cast("long").alias("n_lines"),
                    F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
                    F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(
                        _without(parts), "\n")).alias("kept")))


def _without(parts: Column) -> Column:
    """The elements whose index isn't in the array ``gone``, by a map from index for long texts."""
    marks = F.map_from_arrays(F.col("gone"), F.col("gone"))
    indexed = F.transform(parts, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    return F.transform(F.filter(indexed, lambda y: ~F.map_contains_key(marks, y["i"])), lambda y: y["x"])


def query(spark, sf_dir):
    """kept_sha256 is that of the kept text."""
    kept = drop_repeated_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


SQL = r"""
WITH docs AS (SELECT doc_id, min(coalesce(text, '')) AS text FROM documents GROUP BY doc_id),
parts AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM docs),
lines AS (SELECT doc_id, unnest(p) AS line, unnest(range(len(p))) AS place FROM parts),
keyed AS (SELECT doc_id, place, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
often AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
          GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT k.doc_id, k.place, k.line, o.key IS NOT NULL AND o.keeper <> k.doc_id AS gone
           FROM keyed k LEFT JOIN often o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
