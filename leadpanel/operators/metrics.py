"""Evaluation of scored labels, exact and without a single-task sort.

Input: one row per (group..., id) with ``y`` (0/1) and a score. Equal scores are
ordered by id where a cut needs an order, and averaged where ranks are meant.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadpanel.operators.ranking import add_position, add_running_sums, exact_quantiles, percentile_rank
from leadpanel.session import pin

c = F.col
TOP_SHARES = {"20pct": 0.20, "10pct": 0.10, "5pct": 0.05, "2pct": 0.02}


def ranked(scored: DataFrame, groups: Sequence[str], score: str = "score", key: str = "id") -> DataFrame:
    """Position (1 = best) and group size."""
    return add_position(scored, [c(score).desc(), c(key).asc()], groups)


def top_count(n: Column, share: float) -> Column:
    return F.greatest(F.lit(1), F.floor(n * F.lit(share)))


#: How far below a share's cut rows still count as its best ones, and how exact that cut is, both as parts of the rows.
NEAR_CUT, CUT_ERROR = 0.003, 0.001


def best_rows(scored: DataFrame, groups: Sequence[str], score: str, share: float) -> tuple[DataFrame, DataFrame]:
    """The best ``share`` of each group with some more, and each group's rows and positives: what ranks there it ranks in the whole.

    The cut is a sketch's quantile, which lies below the share's end. A group with a missing score stays whole.
    """
    x = c(score).cast("double")
    cut = F.percentile_approx(F.when(~F.isnan(x), x), max(0.0, 1.0 - share - NEAR_CUT), round(1 / CUT_ERROR))
    sizes = scored.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("n_pos"), F.when(F.count(x) == F.count(F.lit(1)), cut).alias("_cut"))
    sizes = pin(sizes)
    if not groups:
        kept = scored.crossJoin(F.broadcast(sizes.select("_cut")))
    else:
        cuts = sizes.select(*[c(g).alias(f"_g{i}") for i, g in enumerate(groups)], "_cut")
        kept = scored.join(cuts, reduce(lambda a, b: a & b, [c(g).eqNullSafe(c(f"_g{i}")) for i, g in enumerate(groups)]))
    return kept.where(F.coalesce(x >= c("_cut"), F.lit(True))).select(*scored.columns), sizes.drop("_cut")


def lift_and_capture(scored: DataFrame, groups: Sequence[str] = (), score: str = "score", key: str = "id",
                     shares: dict[str, float] = TOP_SHARES, only_top: bool = False) -> DataFrame:
    """Lift and capture in the best 20, 10, 5 and 2 percent; zero without positives.

    ``only_top`` orders no more than the best rows, for one more look at all of them.
    """
    hit = lambda p: F.sum(F.when(c("position") <= top_count(c("n_rows"), p), c("y")).otherwise(0))
    if only_top:
        best, sizes = best_rows(scored, groups, score, max(shares.values()))
        rows = ranked(best, groups, score, key).drop("n_rows").alias("b").join(
            F.broadcast(sizes) if not groups else sizes.alias("s"),
            reduce(lambda a, b: a & b, [c(f"b.{g}").eqNullSafe(c(f"s.{g}")) for g in groups], F.lit(True)))
        rows = rows.select(*[c(f"b.{g}").alias(g) for g in groups], "position", "y", c("n").alias("n_rows"), "n_pos")
        agg = rows.groupBy(*groups).agg(
            F.max("n_rows").alias("n"), F.max("n_pos").alias("n_pos"), *[hit(p).alias(f"_h_{k}") for k, p in shares.items()])
    else:
        rows = ranked(scored, groups, score, key)
        agg = rows.groupBy(*groups).agg(
            F.max("n_rows").alias("n"), F.sum("y").alias("n_pos"), *[hit(p).alias(f"_h_{k}") for k, p in shares.items()]
        )
    # No positives: every measure is zero.
    ratio = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    return agg.select(
        *groups, "n", "n_pos",
        *[ratio(c(f"_h_{k}") / top_count(c("n"), p), c("n_pos") / c("n")).alias(f"lift_{k}") for k, p in shares.items()],
        *[ratio(c(f"_h_{k}").cast("double"), c("n_pos").cast("double")).alias(f"capture_{k}") for k in shares],
    )


def decile_lift(scored: DataFrame, groups: Sequence[str] = (), score: str = "score", key: str = "id") -> DataFrame:
    """Ten slices by position: lift, rate, size, captured positives and their share."""
    rows = ranked(scored, groups, score, key)
    at, n = c("position") - 1, c("n_rows")
    # Slice d holds positions floor(n*d/10) .. floor(n*(d+1)/10) - 1.
    decile = F.floor((at * 10 + 9) / n)
    decile = F.when(F.floor(n * (decile + 1) / 10) <= at, decile + 1).when(F.floor(n * decile / 10) > at, decile - 1).otherwise(decile)
    rows = rows.withColumn("decile", decile.cast("int") + 1)
    per = rows.groupBy(*groups, "decile").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("captured"))
    whole = Window.partitionBy(*groups)  # ten rows per group
    joined = per.withColumns({"_n": F.sum("n").over(whole), "_p": F.sum("captured").over(whole)})
    rate = c("captured") / c("n")
    return joined.where(c("_p") > 0).select(
        *groups, "decile", (rate / (c("_p") / c("_n"))).alias("lift"), rate.alias("adoption_rate"), "n", "captured",
        (c("captured") / c("_p")).alias("capture_pct"),
    )


def threshold_metrics(scored: DataFrame, groups: Sequence[str] = (), score: str = "score", cut: float = 0.5) -> DataFrame:
    """Confusion counts, accuracy, precision, recall and F1; zero where undefined."""
    said = (c(score) >= cut).cast("int")
    out = scored.groupBy(*groups).agg(
        F.sum(said * c("y")).alias("tp"), F.sum(said * (1 - c("y"))).alias("fp"),
        F.sum((1 - said) * c("y")).alias("fn"), F.sum((1 - said) * (1 - c("y"))).alias("tn"),
    )
    ratio = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    tp, fp, fn, tn = (c(n) for n in ("tp", "fp", "fn", "tn"))
    return out.select(
        *groups, "tp", "fp", "fn", "tn", ((tp + tn) / (tp + fp + fn + tn)).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def _curve(scored: DataFrame, groups: Sequence[str], score: str) -> DataFrame:
    """One row per distinct score, best first, with running and total positives and negatives."""
    per = scored.where(c(score).isNotNull()).groupBy(*groups, score).agg(
        F.sum("y").cast("bigint").alias("pos"), F.sum(1 - c("y")).cast("bigint").alias("neg"))
    return add_running_sums(per, [c(score).desc()], ["pos", "neg"], groups)


def roc_auc(scored: DataFrame, groups: Sequence[str] = (), score: str = "score") -> DataFrame:
    """Area under the ROC curve, ties counted half; null when one class is absent."""
    area = F.sum(c("pos") * (c("total_neg") - c("cum_neg") + c("neg") / 2))
    return _curve(scored, groups, score).groupBy(*groups).agg(
        (area / F.nullif(F.first("total_pos") * F.first("total_neg"), F.lit(0))).alias("roc_auc"))


def roc_points(scored: DataFrame, groups: Sequence[str] = (), score: str = "score") -> DataFrame:
    return _curve(scored, groups, score).select(
        *groups, c(score).alias("threshold"), (c("cum_neg") / c("total_neg")).alias("fpr"),
        (c("cum_pos") / c("total_pos")).alias("tpr"))


def average_precision(scored: DataFrame, groups: Sequence[str] = (), score: str = "score") -> DataFrame:
    """Precision at each distinct score weighted by its recall step."""
    step = c("pos") / F.nullif(c("total_pos"), F.lit(0)) * (c("cum_pos") / (c("cum_pos") + c("cum_neg")))
    return _curve(scored, groups, score).groupBy(*groups).agg(F.sum(step).alias("average_precision"))


def brier(scored: DataFrame, groups: Sequence[str] = (), score: str = "score") -> DataFrame:
    """Mean squared error, the errors of always-zero and always-the-rate, and the gain over the rate."""
    square = lambda x: x * x
    out = scored.groupBy(*groups).agg(
        F.avg(square(c(score) - c("y"))).alias("brier"), F.avg(c("y").cast("double")).alias("_rate"))
    rate = c("_rate")
    return out.select(
        *groups, "brier", rate.alias("zero_baseline"), (rate * (1 - rate)).alias("rate_baseline"),
        (1 - c("brier") / F.nullif(rate * (1 - rate), F.lit(0.0))).alias("improvement"))


# ---- score ranks ---------------------------------------------------------------------
def published_percentile(scored: DataFrame, score: str, out: str = "model_score") -> DataFrame:
    """Average-tie percentile 1..100, rounded half to even; rows without a score are dropped."""
    ranks = percentile_rank(scored.where(c(score).isNotNull()), score, out="_p")
    return ranks.withColumn(out, F.greatest(F.bround(c("_p") * 100, 0), F.lit(1.0)).cast("bigint")).drop("_p")


def rank_fusion(scored: DataFrame, scores: list[str], groups: Sequence[str] = (), out: str = "fused") -> DataFrame:
    """Mean of the models' average-tie percentile ranks."""
    ranked_rows = scored
    for i, name in enumerate(scores):
        ranked_rows = percentile_rank(ranked_rows, name, groups, f"_p{i}")
    total = sum((c(f"_p{i}") for i in range(1, len(scores))), c("_p0"))
    return ranked_rows.withColumn(out, total / len(scores)).drop(*[f"_p{i}" for i in range(len(scores))])


# Share of the ranking -> decile label.
DECILE_BOUNDS = [(0.05, 0.5), (0.10, 1.0), (0.20, 2.0), (0.30, 3.0), (0.40, 4.0), (0.50, 5.0), (0.60, 6.0),
                 (0.70, 7.0), (0.80, 8.0), (0.90, 9.0)]


def position_decile(scored: DataFrame, groups: Sequence[str] = (), score: str = "score", key: str = "id") -> DataFrame:
    """0.5 for the best 5 percent, 1 up to 10 percent, then 2..10."""
    share = c("position") / c("n_rows")
    label = F.lit(10.0)
    for bound, value in reversed(DECILE_BOUNDS):
        label = F.when(share <= bound, value).otherwise(label)
    return ranked(scored, groups, score, key).withColumn("decile", label)


def quantile_decile(scored: DataFrame, score: str = "score", n: int = 10) -> DataFrame:
    """Deciles by exact score quantiles, 1 = highest; equal edges are merged."""
    q = exact_quantiles(scored, [score], [i / n for i in range(n + 1)])
    edges = sorted({r["quantile"] for r in q.collect()})  # at most n + 1 values
    inner = edges[1:-1]
    below = sum(((c(score) > e).cast("int") for e in inner), F.lit(0))
    return scored.where(c(score).isNotNull()).withColumn("decile", (F.lit(len(inner)) - below + 1).cast("bigint"))


# Fixed value: random weight vectors tried for four or more models.
RANDOM_WEIGHTS = 200


# ---- ensembles ------------------------------------------------------------------------
def mean_ensemble(scored: DataFrame, scores: list[str], out: str = "score") -> DataFrame:
    return scored.withColumn(out, sum((c(s) for s in scores[1:]), c(scores[0])) / len(scores))


def simplex_weights(n_models: int, n_grid: int = 11) -> list[tuple[float, ...]]:
    """Weight grid for two or three models; for more, random points of the simplex, equal and single weights."""
    if n_models == 2:
        return [(i / (n_grid - 1), 1 - i / (n_grid - 1)) for i in range(n_grid)]
    if n_models == 3:
        steps = max(5, n_grid // 2)
        return [(i / steps, j / steps, (steps - i - j) / steps) for i in range(steps + 1) for j in range(steps + 1 - i)]
    if n_models < 2:
        raise ValueError("weights need two models or more")
    rng = random.Random(42)
    draws = [[rng.expovariate(1.0) for _ in range(n_models)] for _ in range(RANDOM_WEIGHTS)]
    points = [tuple(x / sum(d) for x in d) for d in draws]
    single = [tuple(float(i == j) for j in range(n_models)) for i in range(n_models)]
    return [*points, tuple([1 / n_models] * n_models), *single]


def lift_by_weights(scored: DataFrame, scores: list[str], weights: list[tuple[float, ...]], key: str = "id",
                    shares: tuple[float, ...] = (0.02, 0.05, 0.10)) -> DataFrame:
    """Total lift at the target shares per weight vector; every weight is one group of the same ranking job."""
    blends = F.array(*[
        F.struct(F.lit(i).alias("w"), sum((F.lit(float(x)) * c(s) for x, s in zip(ws[1:], scores[1:])),
                                          F.lit(float(ws[0])) * c(scores[0])).alias("blend"))
        for i, ws in enumerate(weights)
    ])
    rows = scored.select(key, "y", F.explode(blends).alias("b")).select(key, "y", "b.w", F.round("b.blend", 9).alias("blend"))
    names = {str(i): s for i, s in enumerate(shares)}
    lifts = lift_and_capture(rows, ["w"], "blend", key, names)
    return lifts.select("w", sum((c(f"lift_{n}") for n in list(names)[1:]), c("lift_0")).alias("total_lift"))
