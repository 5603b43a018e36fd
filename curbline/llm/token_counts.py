"""Token counts of texts from counts of distinct pre-tokens."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import one_per_id
from curbline.session import materialise

# Fixed values of the byte-level vocabulary: its special string, the Unicode white-space characters,
# and the split of a text into pre-tokens.
SPECIAL = "<|endoftext|>"
SPACE = r"\x{9}-\x{D}\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
PRE_TOKEN = (r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+"
             r"|[" + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+")

# The most frequent pre-tokens, whose counts go to every task: at most so many of at most so many
# characters, under 40 MB. The rest are joined by a shuffle.
FREQUENT = 200_000
FREQUENT_CHARS = 32

_LOADED: dict[str, object] = {}


def _tokenizer(path: str):
    from tokenizers import Tokenizer

    if path not in _LOADED:
        _LOADED[path] = Tokenizer.from_file(path)
    return _LOADED[path]


def pre_tokens(text: Column) -> Column:
    """All pre-tokens of a text, in order; special strings split it and aren't among them."""
    parts = F.split(text, r"<\|endoftext\|>", -1)
    return F.flatten(F.transform(parts, lambda x: F.regexp_extract_all(x, F.lit(PRE_TOKEN), F.lit(0))))


def count_pieces(distinct: DataFrame, tokenizer_path: str) -> DataFrame:
    """(piece, pieces, ...): how many tokens each pre-token of the column ``piece`` becomes."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = _tokenizer(tokenizer_path)
        for batch in batches:
            found = tokenizer.encode_batch(batch["piece"].tolist(), add_special_tokens=False)
            yield batch.assign(pieces=[len(x.ids) for x in found])

    fields = ", ".join(f"{name} {kind}" for name, kind in distinct.dtypes)
    return distinct.mapInPandas(encode, f"{fields}, pieces int")


def token_counts(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for every document of (doc_id, text, ...).

    Every distinct pre-token is encoded once; a document's count is the sum over its pre-tokens of
    those piece counts, plus one for each special string. No ids are made for documents.

    Cases: a null or empty text has 0 bytes and 0 tokens; rows that share a doc_id (null is one) count
    as one document, with the smallest text; further columns are ignored; an empty table gives an
    empty table; a pre-token may be as long as the text.

    The frequent pre-tokens' counts (a fixed number of short strings) are broadcast and summed per
    document in the map task. The others, most of them in few documents, meet their counts in a
    shuffled join after they are summed per document.
    """
    docs = one_per_id(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    occurrences = docs.select(F.explode(pre_tokens(F.col("text"))).alias("piece"))
    distinct = occurrences.groupBy("piece").agg(F.count("*").alias("uses"))
    pieces = materialise(count_pieces(distinct, tokenizer_path), "pieces")
    frequent = materialise(
        pieces.where(F.char_length("piece") <= FREQUENT_CHARS)
        .orderBy(F.desc("uses"), "piece").limit(FREQUENT).select("piece", F.col("pieces").alias("known")), "frequent")

    each = (docs.select("doc_id", F.explode(pre_tokens(F.col("text"))).alias("piece"))
            .join(F.broadcast(frequent), "piece", "left"))
    common = each.where("known IS NOT NULL").groupBy("doc_id").agg(F.sum("known").alias("n"))
    rare = (each.where("known IS NULL").groupBy("piece", "doc_id").agg(F.count("*").alias("times"))
            .join(pieces.select("piece", "pieces"), "piece")
            .groupBy("doc_id").agg(F.sum(F.col("times") * F.col("pieces")).alias("n")))
    specials = F.size(F.split("text", r"<\|endoftext\|>", -1)) - 1
    whole = docs.select("doc_id", specials.cast("long").alias("n"), F.octet_length("text").cast("long").alias("n_bytes"))
    nothing = F.lit(0).cast("long").alias("n_bytes")
    sums = whole.unionByName(common.select("doc_id", "n", nothing)).unionByName(rare.select("doc_id", "n", nothing))
    return sums.groupBy("doc_id").agg(F.sum("n_bytes").alias("n_bytes"), F.sum("n").alias("n_tokens"))


def query(spark, sf_dir, limit: int = 1024):
    counts = token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                          public_tokenizers.path("byte_bpe_50k.json"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
