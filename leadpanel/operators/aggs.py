"""Grouped summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leadpanel.functions import permit_rules as R

c = F.col


def yearly_mean(df: DataFrame, date: str, value: str, first: int, last: int) -> DataFrame:
    """Mean of the readable values per year in the inclusive range."""
    year = F.year(date)
    return (
        df.where(year.between(first, last))
        .groupBy(year.cast("bigint").alias("year"))
        .agg(F.avg(c(value).try_cast("double")).alias("average_rate"))
    )


# Month labels of a wide series; two-digit years below the pivot are 20xx.
MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()


def unpivot_months(wide: DataFrame, ids: list[str], value: str = "price") -> DataFrame:
    """Columns like ``Jan-01`` to rows (ids, year, month, value); unreadable cells are dropped."""
    months = [n for n in wide.columns if n[:3] in MONTHS and n[3:4] == "-" and n[4:].isdigit()]
    text = wide.select(*ids, *[c(f"`{n}`").cast("string").alias(n) for n in months])
    long = text.unpivot(ids, [c(f"`{n}`") for n in months], "_label", "_cell")
    yy = F.substring("_label", 5, 4).cast("int")
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.substring("_label", 1, 3))
    return long.select(
        *ids, F.when(yy < 50, yy + 2000).otherwise(yy + 1900).cast("bigint").alias("year"),
        month.cast("bigint").alias("month"), c("_cell").try_cast("double").alias(value),
    ).where(c(value).isNotNull())


def yearly_price_trend(monthly: DataFrame, value: str = "price") -> DataFrame:
    """Mean and in-year slope per year; one month alone has no slope."""
    return monthly.groupBy("year").agg(
        F.avg(value).alias("avg_price"),
        F.when(F.count(value) >= 2, F.regr_slope(c(value), c("month").cast("double"))).alias("year_trend"),
    )


def roll_up_flags(classified: DataFrame, key: str, year: Column, flags: list[str] = R.FLAGS) -> DataFrame:
    """Largest flag per (key, year); undated permits are dropped."""
    return (
        classified.withColumn("year", year.cast("int")).where(c("year").isNotNull())
        .groupBy(key, "year").agg(*[F.max(f).alias(f) for f in flags])
    )


def first_event_year(df: DataFrame, key: str, flag: str, year: str = "year") -> DataFrame:
    return df.where(c(flag) == 1).groupBy(key).agg(F.min(year).alias("first_year"))


def group_share(df: DataFrame, group: str, flag: Column, name: str) -> DataFrame:
    """Percent of flagged rows in each row's group, two places."""
    share = df.groupBy(group).agg(F.round(100 * F.avg(flag.cast("double")), 2).alias(name))
    return df.join(share, group, "left")


def adoption_by_year(panel: DataFrame, flag: str = "adopted", key: str = "strap") -> DataFrame:
    """Homes, new adopters, adopters so far and penetration per year of a (key, year) panel.

    (key, year) rows are unique, so plain counts replace distinct counts. ``flag``
    marks every year from the first adoption on.
    """
    first = first_event_year(panel, key, flag).groupBy(c("first_year").alias("year")).agg(
        F.count(F.lit(1)).alias("new_adopters"))
    per_year = panel.groupBy("year").agg(
        F.count(F.lit(1)).alias("homes"), F.sum(flag).alias("adopters"))
    return per_year.join(first, "year", "left").select(
        "year", "homes", F.coalesce("new_adopters", F.lit(0)).alias("new_adopters"), "adopters",
        (100 * c("adopters") / c("homes")).alias("penetration_pct"),
    )


def decile_summary(deciles: DataFrame) -> DataFrame:
    """Per decile over all years: captured, homes, rate and share of all captures."""
    per = deciles.groupBy("decile").agg(
        F.sum("captured").alias("installs"), F.sum("n").alias("homes"),
        F.avg("capture_pct").alias("mean_capture"),
    )
    total = per.agg(F.sum("installs").alias("_all"))  # one row
    return per.crossJoin(F.broadcast(total)).select(
        "decile", "installs", "homes", (c("installs") / c("homes")).alias("rate"), "mean_capture",
        (100 * c("installs") / c("_all")).alias("share_pct"),
    )


def decile_pivot(deciles: DataFrame, value: str = "captured") -> DataFrame:
    """One row per year, one column per decile 1..10; a missing decile counts zero."""
    return deciles.groupBy("install_year").pivot("decile", list(range(1, 11))).sum(value).na.fill(0)


def contacts_per_adopter(metrics: DataFrame, baseline: str = "baseline", lift: str = "lift") -> DataFrame:
    """Contacts needed per adopter without and with ranking, and the saving, by tier."""
    return metrics.groupBy("tier").agg(
        F.avg(1 / c(baseline)).alias("contacts_random"),
        F.avg(1 / (c(baseline) * F.nullif(c(lift), F.lit(0.0)))).alias("contacts_ranked"),
    ).withColumn("reduction_pct", 100 * (1 - c("contacts_ranked") / c("contacts_random")))


def metric_summary(metrics: DataFrame, names: list[str]) -> DataFrame:
    """Mean and sample deviation per model, four places."""
    return metrics.groupBy("model").agg(*[
        F.round(f(m), 4).alias(f"{m}_{label}")
        for m in names for label, f in (("mean", F.avg), ("std", F.stddev_samp))
    ])


def importance_stability(importance: DataFrame) -> DataFrame:
    """Correlation of feature importances of consecutive years; an absent feature counts zero."""
    pairs = importance.select("year").distinct()
    steps = pairs.select("year", (c("year") + 1).alias("next")).join(
        pairs.select(c("year").alias("next")), "next")
    of = lambda name, year: importance.select(c("year").alias(year), "feature", c("importance").alias(name))
    # Each value enters its own year as "a" and the step before as "b".
    a = steps.join(of("a", "year"), "year").select("year", "next", "feature", "a")
    b = steps.join(of("b", "next"), "next").select("year", "next", "feature", "b")
    both = a.join(b, ["year", "next", "feature"], "full_outer").na.fill(0.0, ["a", "b"])
    return both.groupBy("year", "next").agg(
        F.corr("a", "b").alias("correlation"), F.stddev_pop("a").alias("_sa"), F.stddev_pop("b").alias("_sb")
    ).where((c("_sa") > 1e-9) & (c("_sb") > 1e-9)).drop("_sa", "_sb")


def permit_cards(permits: DataFrame, by: list[Column], names: list[str], types: str = "permit_type") -> DataFrame:
    """Type rows of one permit as one card: sorted type set, other fields from the first row."""
    rest = [n for n in permits.columns if n not in (types, *names)]
    return permits.select(*[b.alias(n) for b, n in zip(by, names)], types, *rest).groupBy(*names).agg(
        F.array_sort(F.collect_set(types)).alias("types"), F.min(F.struct(*rest)).alias("_f")
    ).select(*names, "types", "_f.*")


def type_counters(cards: DataFrame, types: list[str]) -> DataFrame:
    return cards.agg(
        F.count(F.lit(1)).alias("n_cards"),
        *[F.count_if(F.array_contains("types", t)).alias(f"n_{t}") for t in types],
    )


def filter_options(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-blank values, trimmed and sorted."""
    value = F.trim(column)
    return df.where(value != "").select(value.alias("value")).distinct().orderBy("value")


def flag_from_events(homes: DataFrame, events: DataFrame, key: str, condition: Column, name: str) -> DataFrame:
    """Homes with a flag that tells whether any event meets the condition."""
    hit = events.where(condition).select(key).distinct().withColumn("_hit", F.lit(True))
    return homes.join(hit, key, "left").withColumn(name, F.coalesce("_hit", F.lit(False))).drop("_hit")


# ---- column profiles ---------------------------------------------------------------
def missing_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls per column in one pass, as rows."""
    one = df.agg(*[F.count_if(c(n).isNull()).alias(n) for n in columns])
    return one.unpivot([], columns, "column", "n_missing")


def rate_by_bin(df: DataFrame, value: Column, label: str) -> DataFrame:
    """Rows and mean label per one-wide bin of the value."""
    return df.where(value.isNotNull()).groupBy(F.floor(value).cast("bigint").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(label).alias("rate"))


def label_correlations(df: DataFrame, columns: list[str], label: str, top: int = 20) -> DataFrame:
    """Columns by absolute correlation with the label."""
    one = df.agg(*[F.corr(c(n).cast("double"), c(label).cast("double")).alias(n) for n in columns])
    return (
        one.unpivot([], columns, "column", "correlation").where(c("correlation").isNotNull())
        .orderBy(F.abs("correlation").desc(), "column").limit(top)
    )


def correlation_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Upper triangle of the correlation matrix in one pass, as rows."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    one = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = one.unpivot([], [c(f"`{a}|{b}`") for a, b in pairs], "pair", "correlation")
    parts = F.split("pair", r"\|")
    return long.select(parts[0].alias("a"), parts[1].alias("b"), "correlation")


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width counts between the smallest and largest value; the largest joins the last bin."""
    ends = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))  # one row
    at = F.floor((c(column) - c("_lo")) / (c("_hi") - c("_lo")) * bins)
    return (
        df.where(c(column).isNotNull()).crossJoin(F.broadcast(ends))
        .groupBy(F.least(at, F.lit(bins - 1)).cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    )
