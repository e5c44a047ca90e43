"""Data-quality reports over classified permits."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from leadpanel.functions import permit_rules as R
from leadpanel.operators.permits import explode_types
from leadpanel.operators.ranking import exact_medians
from leadpanel.session import pin


def category_coverage(permits: DataFrame, column: str = "permit_category", flag_above: int = 50) -> DataFrame:
    """Per category value: permits, the keyword rules it triggers, and whether it needs a rule."""
    counts = permits.groupBy(F.coalesce(column, F.lit("(empty)")).alias("category")).agg(
        F.count(F.lit(1)).alias("n_permits")
    )
    low = F.lower("category")
    rules = F.concat_ws(", ", *[
        F.when(reduce(or_, [low.contains(k) for k in words]), F.lit(rule))
        for rule, words in R.CATEGORY_KEYWORDS.items()
    ])
    return counts.select(
        "category", "n_permits", rules.alias("rules"),
        ((rules == "") & (F.col("n_permits") > flag_above)).alias("needs_rule"),
    )


def type_distribution(classified: DataFrame, baseline: DataFrame | None = None) -> DataFrame:
    """Permits per type, share of all permits, and change against a saved baseline (type, pct)."""
    # One pass: every permit counts once in `total` (null type) and once per type.
    types = F.transform(F.split("permit_type", ","), lambda t: F.trim(t))
    # Pinned (a row per type): the two filters below would otherwise each classify every permit again.
    per_type = pin(
        classified.select(F.explode(F.concat(types, F.array(F.lit(None).cast("string")))).alias("permit_type"))
        .groupBy("permit_type").agg(F.count(F.lit(1)).alias("n"))
    )
    total = per_type.where(F.col("permit_type").isNull()).select(F.col("n").alias("total"))
    share = (
        per_type.where(F.col("permit_type").isNotNull()).crossJoin(F.broadcast(total))  # one row
        .select("permit_type", "n", "total", (100 * F.col("n") / F.col("total")).alias("pct"))
    )
    if baseline is None:
        return share
    return share.join(
        baseline.select("permit_type", F.col("pct").alias("baseline_pct")), "permit_type", "full_outer"
    ).withColumn("delta_pct", F.col("pct") - F.col("baseline_pct"))


# Warning limits in percent.
OTHER_HIGH, TARGET_HIGH, TARGET_LOW, TARGET_LOW_MIN_ROWS = 50, 5, 0.1, 1000


def distribution_warnings(distribution: DataFrame) -> DataFrame:
    """One row per raised warning over a type distribution."""
    pct = lambda t: F.coalesce(F.max(F.when(F.col("permit_type") == t, F.col("pct"))), F.lit(0.0))
    one = distribution.agg(pct("other").alias("other"), pct("solar").alias("target"), F.max("total").alias("total"))
    checks = F.array_compact(F.array(
        F.when(F.col("other") > OTHER_HIGH, F.struct(F.lit("other high").alias("warning"), F.col("other").alias("pct"))),
        F.when(F.col("target") > TARGET_HIGH, F.struct(F.lit("solar high").alias("warning"), F.col("target").alias("pct"))),
        F.when(
            (F.col("target") < TARGET_LOW) & (F.col("total") > TARGET_LOW_MIN_ROWS),
            F.struct(F.lit("solar low").alias("warning"), F.col("target").alias("pct")),
        ),
    ))
    return one.select(F.explode(checks).alias("w")).select("w.warning", "w.pct")


def unclassified_pairs(classified: DataFrame, n: int = 30) -> DataFrame:
    """The most frequent (category, description) pairs no rule matched."""
    return (
        explode_types(classified).where(F.col("permit_type") == "other")
        .groupBy(
            F.coalesce("permit_category", F.lit("(no category)")).alias("category"),
            F.coalesce("description", F.lit("(no description)")).alias("description"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "category", "description")
        .limit(n)
    )


def shared_texts(permits: DataFrame, min_chars: int = 30, min_homes: int = 2) -> DataFrame:
    """Long descriptions that occur on more than ``min_homes`` homes."""
    long_text = (F.trim("description") != "") & (F.length("description") > min_chars)
    # (text, home) first, so a text on many rows is counted in two even steps.
    pairs = permits.where(long_text).groupBy("description", "strap").agg(F.count(F.lit(1)).alias("n"))
    return (
        pairs.groupBy("description")
        .agg(F.count(F.lit(1)).alias("n_homes"), F.sum("n").alias("n_permits"))
        .where(F.col("n_homes") > min_homes)
    )


def valuation_stats(classified: DataFrame, value: str = "estimated_value") -> DataFrame:
    """Exact median, mean, min, max and null share of the value per type."""
    rows = pin(explode_types(classified).select("permit_type", F.col(value).cast("double").alias("v")))
    basic = rows.groupBy("permit_type").agg(
        F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean"), F.min("v").alias("min"),
        F.max("v").alias("max"),
        (100 * F.count_if(F.col("v").isNull()) / F.count(F.lit(1))).alias("pct_null"),
    )
    medians = exact_medians(rows, ["v"], ["permit_type"]).withColumnRenamed("v", "median")
    return basic.join(medians, "permit_type", "left")


def cheap_target(classified: DataFrame, value: str = "estimated_value", below: float = 3000) -> DataFrame:
    """Target permits kept although their value is low."""
    return explode_types(classified).where((F.col("permit_type") == "solar") & (F.col(value) < below))


def match_counts(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Rows, rows whose key is known on the right, and rows left without a value."""
    keyed = right.select(key, F.col(value).alias("_v"), F.lit(1).alias("_hit"))
    return left.join(keyed, key, "left").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("_hit").alias("n_matched"),
        F.count_if(F.col("_v").isNull()).alias("n_without_value"),
    )


def reviewer_agreement(classified: DataFrame, reviews: DataFrame) -> DataFrame:
    """Rule types against a reviewer's single type, per permit."""
    return classified.join(reviews, "permit_num").withColumn(
        "agrees", F.array_contains(F.transform(F.split("permit_type", ","), lambda t: F.trim(t)), F.col("ai_type"))
    )


def agreement_report(agreement: DataFrame) -> DataFrame:
    """Overall, per rule type, disagreement pairs, confident disagreements and missed texts in one table."""
    every = F.lit("*")
    # Counted and pinned once by all dimensions; each section then sums the small cube.
    cube = pin(agreement.groupBy("permit_type", "ai_type", "ai_confidence", "agrees").agg(
        F.count(F.lit(1)).alias("n")
    ))
    n, agree = F.sum("n").alias("n"), F.sum(F.when(F.col("agrees"), F.col("n")).otherwise(0)).alias("n_agree")
    differs = ~F.col("agrees")

    def section(kind: str, rows: DataFrame, rule: Column, other: Column) -> DataFrame:
        return rows.groupBy(rule.alias("rule_type"), other.alias("ai_type")).agg(n, agree).select(
            F.lit(kind).alias("section"), "rule_type", "ai_type", "n", "n_agree"
        )

    rule, other = F.col("permit_type"), F.col("ai_type")
    return (
        section("overall", cube, every, every)
        .unionByName(section("by_type", cube, rule, every))
        .unionByName(section("pair", cube.where(differs), rule, other))
        .unionByName(section("confident", cube.where(differs & (F.col("ai_confidence") == "high")), rule, other))
        .unionByName(section("missed", cube.where(differs & (F.trim(rule) == "other")), rule, other))
    )
