"""Secrets in texts, and weak credential parts that count only beside complementary parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curbline.llm.common import one_per_id

# Kinds in the order in which spans at one place are listed, with their patterns.
# A pattern with a length is one whose matches are whole runs, so the bound can stand inside it.
BASE = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}
WEAK = {
    "weak_id": r"(?<![A-Za-z0-9])(?=[A-Z]*[0-9])(?=[0-9]*[A-Z])[A-Z0-9]{16,}(?![A-Za-z0-9])",
    "weak_secret": r"(?<![A-Za-z0-9+/])(?=[A-Za-z+/]*[0-9])(?=[0-9a-z+/]*[A-Z])[A-Za-z0-9+/]{32,}(?![A-Za-z0-9+/])",
    "endpoint": r"""https?://[^\s"'<>]+""",
}
KINDS = [*BASE, *WEAK]
IDS, SECRETS = ("access", "weak_id"), ("assign", "hex", "weak_secret")

# Two characters that mark a match; texts that hold them get another one of the same length there.
OPEN, CLOSE, OTHER = "\ue000", "\ue001", "\ue002"


def _matches(kind: str, text: Column) -> Column:
    """An array with one struct per stretch that a match begins: kind, its number, its code points, the
    match's code points, and whether the match stands. The stretch before the first match is number 0."""
    marked = F.regexp_replace(text, F.lit({**BASE, **WEAK}[kind]), F.lit(f"{OPEN}$0{CLOSE}"))
    pieces = F.split(marked, OPEN, -1)

    def piece(x: Column, i: Column) -> Column:
        match = F.substring_index(x, CLOSE, 1)
        stands = F.char_length(F.regexp_extract(match, BASE["assign"], 2)) >= 6 if kind == "assign" else F.lit(True)
        first = i == 0
        return F.struct(F.lit(KINDS.index(kind)).alias("kind"), i.alias("number"),
                        F.when(first, F.char_length(x)).otherwise(F.char_length(x) - 1).alias("length"),
                        F.when(first, 0).otherwise(F.char_length(match)).alias("width"),
                        (~first & stands).alias("stands"))

    return F.when(F.contains(marked, F.lit(OPEN)), F.transform(pieces, piece))


def find_parts(docs: DataFrame) -> DataFrame:
    """(doc_id, kind, start, end) of every match of every kind: kind is an index of ``KINDS``, places
    count code points and the end is exclusive. Only the matches are shuffled, never the texts."""
    text = F.translate("text", OPEN + CLOSE, OTHER + OTHER)
    found = docs.select("doc_id", *[_matches(kind, text).alias(kind) for kind in KINDS])
    none = F.array().cast("array<struct<kind:int,number:int,length:int,width:int,stands:boolean>>")
    rows = found.select("doc_id", F.inline(F.concat(*[F.coalesce(F.col(k), none) for k in KINDS])))
    before = Window.partitionBy("doc_id", "kind").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("start", F.sum("length").over(before))
    return placed.where("stands").select("doc_id", "kind", F.col("start").cast("long").alias("start"),
                                         (F.col("start") + F.col("width")).cast("long").alias("end"))


def link_parts(parts: DataFrame, scope: int = 200) -> DataFrame:
    """The weak parts of (doc_id, kind, start, end) that complementary parts support.

    Two parts share a scope when at most ``scope`` code points lie between them. A weak identifier or
    secret is reported beside its counterpart when one of the two is a base match or an endpoint is in
    scope too; an endpoint when an identifier and a secret are in scope. Weak parts that overlap a base
    match aren't reported.

    The interval join meets on (doc_id, bin): a part stands in the bins from its start to its end plus
    the scope, and its partner in that of its start. Parts of one kind don't overlap, so a bin holds a
    bounded number of them, whatever the document's length.
    """
    name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    parts = parts.withColumn("name", name)
    # Texts without any weak part need no join.
    weak_docs = parts.where(~F.col("name").isin(*BASE)).select("doc_id").distinct()
    parts = parts.join(weak_docs, parts["doc_id"].eqNullSafe(weak_docs["doc_id"]), "left_semi")
    left = parts.select(F.struct("name", "kind", "start", "end").alias("a"), F.coalesce("doc_id", F.lit(-1)).alias("d"),
                        F.col("doc_id").isNull().alias("nameless"),
                        F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor((F.col("end") + scope) / scope))).alias("bin"))
    right = parts.select(F.struct("name", "kind", "start", "end").alias("b"), F.coalesce("doc_id", F.lit(-1)).alias("d"),
                         F.col("doc_id").isNull().alias("nameless"), F.floor(F.col("start") / scope).alias("bin"))
    near = left.join(right, ["d", "nameless", "bin"]).where(
        (F.col("b.start") >= F.col("a.start")) & (F.col("b.start") <= F.col("a.end") + scope)
        & (F.struct("a.start", "a.kind") != F.struct("b.start", "b.kind")))
    both = near.select("d", "nameless", F.col("a").alias("x"), F.col("b").alias("y")).unionByName(
        near.select("d", "nameless", F.col("b").alias("x"), F.col("a").alias("y")))
    x, y = F.col("x.name"), F.col("y.name")
    has = lambda condition: F.max(F.coalesce(condition, F.lit(False)).cast("int"))
    seen = both.where(~x.isin(*BASE)).groupBy("d", "nameless", "x").agg(
        has(y.isin(*BASE) & (F.col("y.start") < F.col("x.end")) & (F.col("x.start") < F.col("y.end"))).alias("covered"),
        has(y == "access").alias("strong_id"), has(y.isin(*IDS)).alias("id"),
        has(y.isin("assign", "hex")).alias("strong_secret"), has(y.isin(*SECRETS)).alias("secret"),
        has(y == "endpoint").alias("endpoint"))
    complete = (F.when(x == "weak_id", (F.col("strong_secret") == 1) | (F.col("secret") + F.col("endpoint") == 2))
                .when(x == "weak_secret", (F.col("strong_id") == 1) | (F.col("id") + F.col("endpoint") == 2))
                .otherwise(F.col("id") + F.col("secret") == 2))
    return (seen.where((F.col("covered") == 0) & complete)
            .select(F.when(~F.col("nameless"), F.col("d")).alias("doc_id"), "x.kind", "x.start", "x.end"))


def scan_secrets(docs: DataFrame, scope: int = 200) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base, spans) for every document of (doc_id, text, ...).

    ``base`` and ``spans`` are arrays of kind:start:end by start, then kind as listed in ``KINDS``;
    ``spans`` has the base matches and the weak parts that :func:`link_parts` reports.

    Cases: a null or empty text has no spans; rows that share a doc_id (null is one) count as one
    document, with the smallest text; overlapping matches of different kinds all stand; further columns
    are ignored; an empty table gives an empty table.
    """
    docs = one_per_id(docs, "doc_id", "text")
    parts = find_parts(docs)
    base = parts.where(F.col("kind") < len(BASE)).withColumn("basic", F.lit(True))
    spans = base.unionByName(link_parts(parts, scope).withColumn("basic", F.lit(False)))
    listed = F.array_sort(F.collect_list(F.struct("start", "kind", "end", "basic")))
    per_doc = spans.groupBy(F.col("doc_id").alias("of")).agg(listed.alias("all"))
    names = F.array(*[F.lit(k) for k in KINDS])
    shown = lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])
    basic = F.filter("all", lambda x: x["basic"])
    count = lambda kind: F.coalesce(F.size(F.filter("all", lambda x: x["basic"] & (x["kind"] == KINDS.index(kind)))), F.lit(0))
    empty = F.array().cast("array<string>")
    return (docs.select("doc_id").join(per_doc, F.col("doc_id").eqNullSafe(F.col("of")), "left")
            .select("doc_id", *[count(k).cast("long").alias(f"n_{k}") for k in BASE],
                    F.coalesce(F.transform(basic, shown), empty).alias("base"),
                    F.coalesce(F.transform("all", shown), empty).alias("spans")))


def query(spark, sf_dir):
    found = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(F.encode(F.array_join("base", ","), "UTF-8"), 256).alias("base_sha256"),
                        F.array_join("spans", ",").alias("spans"))
