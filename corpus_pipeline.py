"""A training-corpus pipeline: filter, deduplicate, decontaminate, mix and write token ids.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor kept, and returns the columns of
documents; the last returns a row per document read back from the token files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.llm import decontamination, mixture, ngram_join, token_planes, toxicity
from curbline.llm.common import bounded
from curbline.session import materialise

ORACLE_SQL = None

# A word with the blanks before it.
LEADING_WORD = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"


def _named(docs: DataFrame, *names: str) -> list:
    return [F.col(f"`{c}`") for c in (names or docs.columns)]


def _rows(docs: DataFrame, name: str) -> DataFrame:
    """(key, row): every row whole, under a key of its own, so that no column's name can clash with a stage's.

    The key is the doc_id where all have one and none repeats. Otherwise rows are numbered by doc_id, those without
    one last, and written with their numbers.
    """
    whole = F.struct(*_named(docs)).alias("row")
    odd = docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").limit(1)
    if odd.isEmpty():
        return docs.select(F.col("doc_id").alias("key"), whole)
    order = [F.col("row.doc_id").asc_nulls_last(), F.xxhash64("row.text")]
    dealt = docs.select(whole).repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(dealt.select(F.monotonically_increasing_id().alias("key"), "row"), f"{name}-rows")


def _without(rows: DataFrame, rejected: DataFrame, name: str) -> DataFrame:
    """The rows whose key isn't in the doc_id column of ``rejected``."""
    gone = bounded(materialise(rejected.select(F.col("doc_id").alias("key")).distinct(), name))
    return rows.join(gone, "key", "left_anti").select("row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores 0.5 or more go. Every row is judged by its own text, whether or not it has a doc_id
    or shares it; a null or empty text stays; columns are returned as they are, whatever their names and types; an
    empty table gives an empty table."""
    rows = _rows(docs, "toxic")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    given = rows.select(F.col("key").alias("doc_id"), F.col("row.doc_id").alias("named"), F.col("row.text").alias("text"))
    # Labels name documents; each row of a document has its label.
    by_row = given.join(labels.withColumnRenamed("doc_id", "named"), "named").select("doc_id", "toxic")
    scores = toxicity.score_toxicity(given, by_row)
    return _without(rows, scores.where("predicted = 1"), "toxic")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, that with the smallest doc_id; one without a doc_id only if none has one. Five
    words, similarity 0.8. Rows that share a doc_id, or have none, are rows of their own; texts without words stay;
    columns are returned as they are; an empty table gives an empty table."""
    rows = _rows(docs, "copies")
    groups = ngram_join.ngram_join(rows.select(F.col("key").alias("doc_id"), F.col("row.text").alias("text")), size=5, at_least=(80, 100))
    return _without(rows, groups.where("component_id <> doc_id"), "near-copies")


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a text of the benchmark go; every such text counts, whether or not it has an item_id. Every row
    is judged by its own text, whether or not it has a doc_id or shares it; a null or empty text stays; columns are
    returned as they are; an empty table of either kind drops nothing."""
    rows = _rows(docs, "benchmark")
    texts = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select(F.xxhash64("text").alias("item_id"), "text")
    hits = decontamination.find_benchmark(rows.select(F.col("key").alias("doc_id"), F.col("row.text").alias("text")), texts)
    return _without(rows, hits, "contaminated")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document is used once at most; the budget is four fifths of the tokens that are left.

    Every leaf fills its share exactly: the document that the share's end cuts stays with its first ``part``
    words, so its text ends after them and ``n_chars`` counts what is left. Rows that share a doc_id (null is
    one) are one document: the row with the smallest text, language and source, and of equal ones that with the
    smallest JSON. Further columns are returned as they are, whatever their names and types.
    """
    rows = docs.select(F.col("doc_id").alias("key"), F.struct(*_named(docs)).alias("row"))
    if not docs.groupBy("doc_id").count().where("count > 1").limit(1).isEmpty():
        order = F.struct("row.text", "row.lang", "row.source", F.to_json("row"))
        rows = materialise(rows.groupBy("key").agg(F.min_by("row", order).alias("row")), "mixture-rows")
    placed = rows.select(F.col("key").alias("doc_id"), F.col("row.text").alias("text"), F.col("row.lang").alias("lang"),
                         F.col("row.source").alias("source"), mixture.domain_of_source(F.col("row.source")).alias("domain"))
    given = mixture.mix(placed, mixture.WEIGHTS, total_of=(4, 5), max_epochs=1)
    chosen = bounded(materialise(given.select(
        F.col("doc_id").alias("chosen"), F.when(F.col("copies") == 0, F.col("part")).alias("words")), "mixture"))
    words = F.slice(F.regexp_extract_all("row.text", F.lit(LEADING_WORD), F.lit(0)), F.lit(1), F.col("words").cast("int"))
    cut = {"text": F.array_join(words, "")}
    if "n_chars" in docs.columns:
        cut["n_chars"] = F.char_length(cut["text"]).cast(docs.schema["n_chars"].dataType)
    kept = rows.join(chosen, F.col("key").eqNullSafe(F.col("chosen")))
    return kept.select([
        F.when(F.col("words").isNotNull(), cut[c]).otherwise(F.col("row")[c]).alias(c) if c in cut else F.col("row")[c].alias(c)
        for c in docs.columns])


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read back from the token files of all documents, in ascending doc_id order,
    null first. A null or empty text has the end id only; rows that share a doc_id (null is one) are one document, with
    the smallest text; further columns are ignored; an empty table gives an empty table."""
    return token_planes.encode_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("mixture", mix_sources),
    ("token_planes", write_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialise(docs, f"pipeline-{name}")
    return docs
