"""Complexity scores, tiers, overrides and the decision, as column arithmetic over the metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from vizquarry import fixed
from vizquarry.functions.numbers import round1
from vizquarry.operators.metrics import METRICS, estate_facts, stored_calcs

STRICT_LINEAR, BROAD_LOG = "strict-linear", "broad-log"
SCORERS = {STRICT_LINEAR: ("strict", "linear"), BROAD_LOG: ("broad", "log")}


def category_input(category: str) -> Column:
    terms = [F.col(m) * w for m, w in fixed.CATEGORY_INPUTS[category].items()]
    return reduce(lambda a, b: a + b, terms).cast("double")


def linear(value: Column, category: str) -> Column:
    return F.least(F.lit(100.0), F.lit(100.0) * value / F.lit(float(fixed.CATEGORY_CEILINGS[category])))


def log_scaled(value: Column, scale: float = fixed.LOG_SCALE) -> Column:
    return F.least(F.lit(100.0), F.lit(100.0) * F.log1p(value) / F.log1p(F.lit(scale)))


def category_scores(metrics: DataFrame, curve: str = "linear") -> DataFrame:
    """Adds unrounded ``score_<category>`` columns."""
    for category in fixed.CATEGORIES:
        value = category_input(category)
        score = linear(value, category) if curve == "linear" else log_scaled(value)
        metrics = metrics.withColumn(f"score_{category}", score)
    return metrics


def composite() -> Column:
    """Weighted sum of the unrounded category scores, added in category order."""
    terms = [F.col(f"score_{c}") * F.lit(w) for c, w in fixed.CATEGORY_WEIGHTS.items()]
    return reduce(lambda a, b: a + b, terms)


def tier_rank(score: Column) -> Column:
    chain = F.when(score < fixed.TIER_LIMITS[0], 0)
    for rank, limit in enumerate(fixed.TIER_LIMITS[1:], 1):
        chain = chain.when(score < limit, rank)
    return chain.otherwise(len(fixed.TIER_LIMITS))


def tier_name(rank: Column) -> Column:
    return F.get(F.array(*[F.lit(t) for t in fixed.TIERS]), rank)


def override_rank(rank: Column) -> Column:
    forced = [
        F.when(F.col(metric) > limit, fixed.TIERS.index(tier)).otherwise(0)
        for metric, limit, tier, _ in fixed.OVERRIDES
    ]
    return F.greatest(rank, *forced)


def override_flags() -> Column:
    """Labels of all rules that hold, also of those that did not move the tier."""
    return F.concat_ws(
        ", ", *[F.when(F.col(m) > limit, F.lit(label)) for m, limit, _, label in fixed.OVERRIDES]
    )


def with_tiers(scored: DataFrame) -> DataFrame:
    """Adds composite (unrounded), base_tier, complexity_tier and override_flags."""
    return (
        scored.withColumn("composite", composite())
        .withColumn("_rank", tier_rank(F.col("composite")))
        .withColumn("base_tier", tier_name(F.col("_rank")))
        .withColumn("complexity_tier", tier_name(override_rank(F.col("_rank"))))
        .withColumn("override_flags", override_flags())
        .drop("_rank")
    )


def with_decision(tiered: DataFrame) -> DataFrame:
    """Adds proceed and proceed_reason; needs no_equivalent_features, override_flags, complexity_tier."""
    allowed = fixed.TIERS[: fixed.TIERS.index(fixed.HIGHEST_TIER_TO_PROCEED) + 1]
    features, flags, tier = (
        F.col("no_equivalent_features"), F.col("override_flags"), F.col("complexity_tier"),
    )
    reasons = F.concat_ws(
        "; ",
        F.when(features != "", F.format_string(fixed.REASON_FEATURES, features)),
        F.when(flags != "", F.format_string(fixed.REASON_OVERRIDES, flags)),
        F.when(~tier.isin(allowed), F.format_string(fixed.REASON_TIER, tier)),
    )
    return tiered.withColumn("proceed", reasons == "").withColumn(
        "proceed_reason", F.when(reasons == "", F.lit(fixed.REASON_NONE)).otherwise(reasons)
    )


def authoring_line(product: str, vendor: str) -> Column:
    """The line of context for whoever rebuilds the dashboard.

    Needs workbook_name, complexity_tier, table_paths (array), calc_names (array), the counts and
    no_equivalent_features.
    """
    none = lambda c: F.when(c == "", F.lit("none")).otherwise(c)
    return F.format_string(
        fixed.AUTHORING_LINE.format(product=product, vendor=vendor),
        "workbook_name",
        "complexity_tier",
        F.array_join("table_paths", ", "),
        "num_sheets",
        "num_dashboards",
        "num_filters",
        "num_parameters",
        none(F.array_join("calc_names", "; ")),
        none(F.col("no_equivalent_features")),
    )


def calc_name_lists(calcs: DataFrame) -> DataFrame:
    """(workbook_id, calc_names) in document order; the list is part of the line, so it is as long."""
    return calcs.groupBy("workbook_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("ord", "calc_name"))), lambda s: s["calc_name"]
        ).alias("calc_names")
    )


def scorecard(
    elements: DataFrame,
    books: DataFrame,
    scorer: str = STRICT_LINEAR,
    product: str = "Spark",
    vendor: str = "Spark",
) -> DataFrame:
    """One row per workbook: names, score, tier, flags, decision, tables, line, category scores, metrics.

    ``books`` holds (workbook_id, twb_file, workbook_name, table_paths). The decision is part of the
    strict-linear scorer only.
    """
    variant, curve = SCORERS[scorer]
    calcs = stored_calcs(elements, variant)
    tiered = with_tiers(category_scores(estate_facts(elements, variant, calcs), curve))
    if scorer == STRICT_LINEAR:
        tiered = with_decision(tiered)
    full = (
        tiered.join(books, "workbook_id")
        .join(calc_name_lists(calcs), "workbook_id", "left")
        .withColumn("calc_names", F.coalesce("calc_names", F.array().cast("array<string>")))
    )
    decision = ["proceed", "proceed_reason"] if scorer == STRICT_LINEAR else []
    return full.select(
        "workbook_id",
        "twb_file",
        "workbook_name",
        round1(F.col("composite")).alias("composite_score"),
        "complexity_tier",
        "override_flags",
        "no_equivalent_features",
        *decision,
        F.array_join("table_paths", ", ").alias("table_paths"),
        authoring_line(product, vendor).alias("authoring_line"),
        *[round1(F.col(f"score_{c}")).alias(f"score_{c}") for c in fixed.CATEGORIES],
        *METRICS,
    )
