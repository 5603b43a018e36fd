"""Rater agreement over (human, model) label pairs, and category-against-request labels.

Every statistic is a closed form over sums of ranks and counts, so pairs reduce on the map side
and no grid of label combinations has to be built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.config import TIERS, UNKNOWN
from curbline.functions import values
from curbline.sources.files import listed


def pair_labels(sheet: DataFrame, recorded: DataFrame) -> DataFrame:
    """Sheet rows with the model's label. Raises on a label outside the tiers or an unknown id."""
    human = sheet.withColumn("human", values.normalised_label(F.col("human_label")))
    if odd := listed(human.filter(F.col("human").isNull() | ~F.col("human").isin(*TIERS)), "item"):
        raise ValueError(f"unrecognised human label on items {odd}")
    model = recorded.select(
        "service_request_id",
        F.col("urgency_label").alias("model"),
        F.col("urgency_score").alias("model_score"),
        F.col("llm_reasoning").alias("model_reasoning"),
    )
    if absent := listed(human.join(model, "service_request_id", "left_anti"), "service_request_id"):
        raise LookupError(f"no recorded label for {absent}")
    return human.join(model, "service_request_id").select(
        "item", "service_request_id", "service_name", "address", "human", "model",
        "model_score", "model_reasoning", F.trim(F.coalesce("notes", F.lit(""))).alias("notes"))


def _kappa(numerator: Column, denominator: Column) -> Column:
    """1 - numerator / denominator, and 1 where chance disagreement is impossible."""
    return F.when(denominator == 0, 1.0).otherwise(1 - numerator / denominator)


def agreement(pairs: DataFrame) -> DataFrame:
    """One row: n, exact and within-one agreement, both kappas, counts above and below the human."""
    ranked = pairs.select(
        "human", "model",
        values.tier_rank(F.col("human")).cast("long").alias("h"),
        values.tier_rank(F.col("model")).cast("long").alias("m"),
    )
    margin = [F.count_if(F.col(side) == t).alias(f"{side}_{t}") for side in ("human", "model") for t in TIERS]
    sums = ranked.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("h") == F.col("m")).alias("same"),
        F.count_if(F.abs(F.col("h") - F.col("m")) <= 1).alias("near"),
        F.count_if(F.col("m") > F.col("h")).alias("above"),
        F.count_if(F.col("m") < F.col("h")).alias("below"),
        F.sum("h").alias("sum_h"),
        F.sum("m").alias("sum_m"),
        F.sum(F.col("h") * F.col("h")).alias("sum_hh"),
        F.sum(F.col("m") * F.col("m")).alias("sum_mm"),
        F.sum((F.col("h") - F.col("m")) * (F.col("h") - F.col("m"))).alias("sum_sq"),
        *margin,
    )
    n = F.col("n")
    chance = sum((F.col(f"human_{t}") * F.col(f"model_{t}") for t in TIERS), F.lit(0))
    nominal = _kappa((n - F.col("same")) * n, (n * n - chance).cast("double"))
    weighted = _kappa(
        n * F.col("sum_sq"),
        (n * F.col("sum_hh") + n * F.col("sum_mm") - 2 * F.col("sum_h") * F.col("sum_m")).cast("double"),
    )
    return sums.select(
        "n",
        values.ratio(F.col("same"), n).alias("exact_agreement"),
        values.ratio(F.col("near"), n).alias("within_one_tier"),
        nominal.alias("cohens_kappa"),
        weighted.alias("quadratic_weighted_kappa"),
        F.col("above").alias("model_more_urgent"),
        F.col("below").alias("model_less_urgent"),
    )


def confusion(pairs: DataFrame) -> DataFrame:
    """human × model counts with zero cells: one row per tier, one column per model tier."""
    tiers = F.explode(F.array(*[F.lit(t) for t in TIERS]))
    rows = pairs.sparkSession.range(1, numPartitions=1).select(tiers.alias("human"))
    counts = pairs.groupBy("human").agg(
        *[F.count_if(F.col("model") == t).alias(t.lower()) for t in TIERS])
    zero = F.lit(0).cast("long")
    return rows.join(counts, "human", "left").select(
        "human", *[F.coalesce(t.lower(), zero).alias(t.lower()) for t in TIERS])


def per_tier(pairs: DataFrame) -> DataFrame:
    """Per tier: human and model counts, precision and recall (NULL where undefined)."""
    both = F.array(
        F.struct(F.col("human").alias("tier"), F.lit(1).alias("h"), F.lit(0).alias("m"),
                 (F.col("human") == F.col("model")).cast("int").alias("hit")),
        F.struct(F.col("model").alias("tier"), F.lit(0).alias("h"), F.lit(1).alias("m"),
                 F.lit(0).alias("hit")),
    )
    counts = pairs.select(F.explode(both).alias("s")).groupBy(F.col("s.tier").alias("tier")).agg(
        F.sum("s.h").alias("human_count"),
        F.sum("s.m").alias("model_count"),
        F.sum("s.hit").alias("hits"),
    )
    tiers = pairs.sparkSession.range(1, numPartitions=1).select(
        F.explode(F.array(*[F.lit(t) for t in TIERS])).alias("tier"))
    zero = F.lit(0).cast("long")
    full = tiers.join(counts, "tier", "left").select(
        "tier",
        F.coalesce("human_count", zero).alias("human_count"),
        F.coalesce("model_count", zero).alias("model_count"),
        F.coalesce("hits", zero).alias("hits"),
    )
    return full.select(
        "tier", "human_count", "model_count",
        values.ratio(F.col("hits"), F.col("model_count")).alias("precision"),
        values.ratio(F.col("hits"), F.col("human_count")).alias("recall"),
    )


def disagreements(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("human") != F.col("model"))


def write_metrics(pairs: DataFrame, path: str) -> None:
    """The one-row summary as JSON."""
    agreement(pairs).write.mode("overwrite").json(path)


def category_counts(labelled: DataFrame, sr_types: DataFrame) -> DataFrame:
    """Per category known to both sources: its own label, the modal request label, and counts."""
    own = sr_types.filter(F.col("urgency_label") != "").select(
        F.col("sr_type").alias("service_name"), F.col("urgency_label").alias("category_label"))
    counts = labelled.filter(F.col("urgency_label") != UNKNOWN).groupBy(
        "service_name", "urgency_label").agg(F.count(F.lit(1)).alias("n"))
    modal = F.min(F.struct((-F.col("n")).alias("rank"), F.col("urgency_label").alias("label")))
    return (
        counts.join(own, "service_name")
        .groupBy("service_name", "category_label")
        .agg(
            modal["label"].alias("modal_label"),
            F.sum("n").alias("requests"),
            F.sum(F.when(F.col("urgency_label") == F.col("category_label"), F.col("n")).otherwise(0))
            .alias("matching_requests"),
        )
        .withColumn("modal_matches", F.col("modal_label") == F.col("category_label"))
    )


def category_agreement(by_category: DataFrame) -> DataFrame:
    """One row: shared categories, those whose modal label agrees, matching share of requests."""
    return by_category.agg(
        F.count(F.lit(1)).alias("shared_categories"),
        F.count_if("modal_matches").alias("modal_agree"),
        F.sum("matching_requests").alias("matching_requests"),
        F.sum("requests").alias("requests"),
        values.ratio(F.sum("matching_requests"), F.sum("requests")).alias("matching_share"),
    )
