"""A token budget over a domain-language-source tree, and the documents that fill it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curbline.llm.common import bounded, one_per_id
from curbline.session import materialise

LEVELS = ("domain", "lang", "source")
NOBODY = "(none)"
# Documents per bucket of a leaf's seeded order; a bucket is the largest stretch one task sorts.
BUCKET_DOCS = 4096
WORD = r"[^\x20\x09-\x0D]+"

# The registered query's target weights; branches that aren't named have weight 1.
WEIGHTS = {"domain": {"d0": 5, "d1": 3, "d2": 2}, "lang": {"en": 6, "de": 2, "fr": 1, "es": 1}, "source": {}}


def domain_of_source(source: Column) -> Column:
    """The registered tables have no domain: a source's number modulo 3 stands for it."""
    digits = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    return F.when(digits != "", F.concat(F.lit("d"), (digits.cast("long") % 3).cast("string")))


def _weight(level: str, weights: dict) -> Column:
    out = F.lit(1)
    for name, weight in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, weight).otherwise(out)
    return out.cast("decimal(38,0)")


def share_out(nodes: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Divide each parent's ``budget`` among its children by ``weight``, none above its ``room``.

    Adds ``share``. What a full child can't take goes to its siblings by their weights; a budget is
    never above the room of its parent, so nothing is left for the level above. Children are ordered by
    the level at which they fill up: those that are full at the final level are a prefix of that order.
    Whole tokens only, rounded down.
    """
    order = Window.partitionBy(*parent).orderBy("fills", child)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    after = order.rowsBetween(1, Window.unboundedFollowing)
    whole = Window.partitionBy(*parent)
    ranked = (nodes.withColumn("fills", F.col("room").cast("double") / F.col("weight").cast("double"))
              .withColumn("taken", F.sum("room").over(upto))
              .withColumn("rest", F.coalesce(F.sum("weight").over(after), F.lit(0))))
    full = (F.col("budget") - F.col("taken")) * F.col("weight") >= F.col("room") * F.col("rest")
    ranked = ranked.withColumn("full", full)
    ranked = (ranked.withColumn("spent", F.coalesce(F.sum(F.when(F.col("full"), F.col("room"))).over(whole), F.lit(0)))
              .withColumn("open", F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole)))
    left = (F.col("budget") - F.col("spent")).cast("long") * F.col("weight").cast("long")
    share = F.when(F.col("full"), F.col("room").cast("long")).otherwise(F.floor(left.cast("decimal(38,0)") / F.col("open")))
    return ranked.withColumn("share", share.cast("decimal(18,0)")).drop("fills", "taken", "rest", "full", "spent", "open")


def allot(leaves: DataFrame, weights: dict, total: Column | int, max_epochs: int) -> DataFrame:
    """Leaf budgets for (domain, lang, source, tokens, docs): adds ``share``, at most ``max_epochs``
    times the leaf's tokens. ``total`` is the tree's budget; what the whole tree can't hold is unspent."""
    room = Window.partitionBy
    leaves = leaves.withColumn("room", (F.col("tokens") * max_epochs).cast("decimal(18,0)"))
    path: list[str] = []
    tree = leaves.withColumn("budget", F.least(F.lit(total).cast("decimal(18,0)"), F.sum("room").over(room(F.lit(0))).cast("decimal(18,0)")))
    for level in LEVELS:
        own = [*path, level]
        nodes = (tree.groupBy(*own).agg(F.sum("room").cast("decimal(18,0)").alias("room"), F.first("budget").alias("budget"))
                 .withColumn("weight", _weight(level, weights).cast("decimal(18,0)")))
        shared = share_out(nodes, path or [F.lit(0)], level).select(*own, "share")
        tree = tree.drop("budget").join(shared, own).withColumnRenamed("share", "budget")
        path = own
    return tree.withColumnRenamed("budget", "share").drop("room")


def mix(docs: DataFrame, weights: dict, total_of: tuple[int, int] = (1, 2), max_epochs: int = 2, seed: int = 7) -> DataFrame:
    """(doc_id, domain, lang, source, tokens, copies, part): what each document gives to the mixture.

    ``docs`` has (doc_id, text, domain, lang, source, ...). Tokens are blank-separated words. The budget
    is the fraction ``total_of`` of all tokens, divided by :func:`allot`. A leaf first takes all its
    documents as often as its share allows (whole epochs); of the epoch after, it takes documents in an
    order seeded by (seed, epoch) until the share is used up. ``copies`` counts whole uses and ``part``
    the leading tokens of the one document that the share's end cuts. Documents without any are left out.

    Cases: a null level is a branch of its own, "(none)"; a null or empty text has no tokens and is left
    out; rows that share a doc_id (null is one) count as one document, with the smallest values; ties in
    the seeded order go by doc_id; further columns are ignored; an empty table gives an empty table.

    Texts are read once, for their sizes. A leaf's order is cut into hash buckets of about
    ``BUCKET_DOCS`` documents: sums per bucket find the bucket in which the share ends, and only that
    one is sorted, so a source with a third of all documents is never in one task.
    """
    docs = one_per_id(docs, "doc_id", "text", *LEVELS)
    sized = materialise(docs.select(
        "doc_id", *[F.coalesce(F.col(x).cast("string"), F.lit(NOBODY)).alias(x) for x in LEVELS],
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("tokens")), "sizes")
    leaves = materialise(sized.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")).where("tokens > 0"), "leaves")
    supply = leaves.agg(F.sum("tokens")).first()[0] or 0
    allotted = allot(leaves, weights, supply * total_of[0] // total_of[1], max_epochs)
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("docs") / BUCKET_DOCS))).cast("int")
    share = F.col("share").cast("long")
    leaf = bounded(materialise(allotted.select(
        *LEVELS, F.expr("cast(share AS long) div tokens").alias("epochs"), (share % F.col("tokens")).alias("rest"),
        bits.alias("bits")), "shares"))
    place = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "epochs", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 15), 16, 10).cast("long")
    rows = (sized.where("tokens > 0").join(leaf, list(LEVELS)).withColumn("place", place)
            .withColumn("bucket", F.expr("shiftright(place, 60 - bits)")))
    per_bucket = rows.groupBy(*LEVELS, "bucket", "rest").agg(F.sum("tokens").alias("size"))
    upto = Window.partitionBy(*LEVELS).orderBy("bucket")
    # The first bucket that ends beyond the share; a share is less than its leaf, so there is one.
    cuts = bounded(materialise(
        per_bucket.withColumn("ends", F.sum("size").over(upto)).where("ends > rest")
        .groupBy(*LEVELS).agg(F.min("bucket").alias("cut"), F.min_by(F.col("ends") - F.col("size"), "bucket").alias("before")), "cuts"))
    rows = rows.join(cuts, list(LEVELS))
    within = Window.partitionBy(*LEVELS).orderBy("place", F.col("doc_id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    sorted_cut = (rows.where("bucket = cut").withColumn("ends", F.col("before") + F.sum("tokens").over(within))
                  .select("doc_id", *LEVELS, "tokens",
                          (F.col("epochs") + (F.col("ends") <= F.col("rest")).cast("long")).alias("copies"),
                          F.when(F.col("ends") <= F.col("rest"), 0)
                          .otherwise(F.greatest(F.lit(0), F.col("rest") - F.col("ends") + F.col("tokens"))).cast("long").alias("part")))
    others = (rows.where("bucket <> cut")
              .select("doc_id", *LEVELS, "tokens", (F.col("epochs") + (F.col("bucket") < F.col("cut")).cast("long")).alias("copies"),
                      F.lit(0).cast("long").alias("part")))
    return others.unionByName(sorted_cut).where("copies > 0 OR part > 0")


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs.withColumn("domain", domain_of_source(F.col("source"))), WEIGHTS)


def _sql_level(k: int) -> str:
    """One level of the tree: siblings by the level at which they fill, then the shares."""
    path, own = ", ".join(LEVELS[:k]) or "0", ", ".join(LEVELS[: k + 1])
    level = LEVELS[k]
    weight = "CASE " + " ".join(f"WHEN {level} = '{n}' THEN {w}" for n, w in WEIGHTS[level].items()) + " ELSE 1 END" if WEIGHTS[level] else "1"
    return f"""
n{k} AS (SELECT {own}, sum(room)::HUGEINT AS room, min(budget)::HUGEINT AS budget, {weight} AS weight FROM t{k} GROUP BY {own}),
r{k} AS (SELECT *, sum(room) OVER (PARTITION BY {path} ORDER BY room::DOUBLE / weight, {level} ROWS UNBOUNDED PRECEDING) AS taken,
         coalesce(sum(weight) OVER (PARTITION BY {path} ORDER BY room::DOUBLE / weight, {level} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS later
         FROM n{k}),
f{k} AS (SELECT *, (budget - taken) * weight >= room * later AS filled FROM r{k}),
s{k} AS (SELECT {own}, CASE WHEN filled THEN room ELSE ((budget - coalesce(sum(room) FILTER (filled) OVER (PARTITION BY {path}), 0)) * weight)
         // (sum(weight) FILTER (NOT filled) OVER (PARTITION BY {path})) END AS share FROM f{k}),
t{k + 1} AS (SELECT t{k}.* EXCLUDE (budget), s{k}.share AS budget FROM t{k} JOIN s{k} USING ({own}))"""


SQL = rf"""
WITH d AS (SELECT doc_id, coalesce('d' || (nullif(regexp_extract(source, '([0-9]{{1,9}})$', 1), '')::BIGINT % 3), '{NOBODY}') AS domain,
      coalesce(lang, '{NOBODY}') AS lang, coalesce(source, '{NOBODY}') AS source,
      len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS tokens FROM documents),
leaf AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens FROM d GROUP BY ALL HAVING sum(tokens) > 0),
t0 AS (SELECT *, tokens * 2 AS room, (SELECT sum(tokens) // 2 FROM leaf) AS budget FROM leaf),{','.join(_sql_level(k) for k in range(3))},
shares AS (SELECT domain, lang, source, (budget // tokens)::BIGINT AS epochs, (budget % tokens)::BIGINT AS rest FROM t3),
placed AS (SELECT d.*, epochs, rest, ('0x' || substr(md5('7:' || epochs || ':' || doc_id), 1, 15))::BIGINT AS place
      FROM d JOIN shares USING (domain, lang, source) WHERE d.tokens > 0),
run AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING) AS ends FROM placed),
final AS (SELECT doc_id, domain, lang, source, tokens, epochs + (ends <= rest)::BIGINT AS copies,
      CASE WHEN ends <= rest THEN 0 ELSE greatest(0, rest - ends + tokens) END::BIGINT AS part FROM run)
SELECT * FROM final WHERE copies > 0 OR part > 0
"""
