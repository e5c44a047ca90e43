"""Walk-forward model jobs on Spark ML."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leadpanel.operators import metrics as E
from leadpanel.operators.features import interaction
from leadpanel.operators.information import NEIGHBOURS, neighbour_information, unpivoted
from leadpanel.operators.isotonic import few_steps, isotonic_curve, isotonic_values, values_of_steps
from leadpanel.operators.ranking import add_position, median_scalars
from leadpanel.operators.sampling import fold_of, hash_order, in_test, split_by_group
from leadpanel.plans.boosting import Boosted, fit_together, scores_together, supported
from leadpanel.session import held, pin

c = F.col

# ---- fixed values: folds, weights, filters ------------------------------------------
TRAIN_WINDOW = 5
DECAY = 0.85
MAX_LEVELS = 20
MIN_ONES = 100
MIN_PREVALENCE = 0.02
MAX_CORRELATION = 0.80
GROUP_CAP = 2
# Name beginnings of features that measure the same thing.
GROUPS = {
    "building_age": ["calculated_roof_age", "calculated_build_year", "yearbuilt", "census_vs_property_age",
                     "time_since_build", "recent_build", "median_year_built"],
    "sale_recency": ["time_since_sale", "recent_purchase"],
    "neighbor_contagion": ["count_3mi", "count_1mi", "count_0_5mi", "count_0_25mi", "count_0_1mi", "count_0_05mi", "last_year_neighbors_w_solar_", "closest_fifty_percentage",
                           "solar_neighbor_momentum", "neighbor_solar_slope_3yr", "permit_velocity_3yr"],
}
# ---- fixed values: tuned parameters ----------------------------------------------------
FOREST = dict(numTrees=100, maxDepth=16, minInstancesPerNode=33, featureSubsetStrategy="0.44238828649324957")
BOOST = dict(maxIter=200, maxDepth=7, stepSize=0.030410071368193792, subsamplingRate=0.6986917019740992,
             minInstancesPerNode=38)


# Folds and fits that run at a time; their jobs share the cluster.
SIDE_BY_SIDE = 4


def side_by_side(work: Callable, items) -> list:
    """``work`` of each item, a few at a time; every one starts Spark jobs of its own."""
    with ThreadPool(SIDE_BY_SIDE) as pool:
        return pool.map(work, list(items), chunksize=1)


def rows(spark: SparkSession, data: list[tuple], schema: str) -> DataFrame:
    """A small result table made from driver numbers."""
    return spark.createDataFrame(data, schema)


# ---- preparation ---------------------------------------------------------------------
def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """Numeric features as a vector, nulls filled with the column's median."""
    medians = median_scalars(df, list(features))
    filled = df.withColumns({f: F.coalesce(c(f).cast("double"), F.lit(medians[f]), F.lit(0.0)) for f in features})
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(filled)


def scale(df: DataFrame) -> DataFrame:
    model = StandardScaler(inputCol="features", outputCol="_scaled", withMean=True).fit(df)
    return model.transform(df).drop("features").withColumnRenamed("_scaled", "features")


@dataclass
class Preprocessor:
    """Scaled numbers and one-hot texts of at most 20 levels; an unseen level is all zeros."""

    numeric: list[str]
    text: list[str]
    medians: dict[str, float | None] = field(default_factory=dict)
    model: PipelineModel | None = None
    names: list[str] = field(default_factory=list)

    def _filled(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            **{n: F.coalesce(c(n).cast("double"), F.lit(self.medians[n]), F.lit(0.0)) for n in self.numeric},
            **{n: F.coalesce(c(n), F.lit("MISSING")) for n in self.text},
        })

    def fit(self, train: DataFrame) -> Preprocessor:
        self.medians = median_scalars(train, self.numeric)
        filled = self._filled(train)
        if self.text:
            levels = filled.agg(*[F.count_distinct(n).alias(n) for n in self.text]).first()
            self.text = [n for n in self.text if levels[n] <= MAX_LEVELS]
        stages = [VectorAssembler(inputCols=self.numeric, outputCol="_num"),
                  StandardScaler(inputCol="_num", outputCol="_scaled", withMean=True)]
        parts = ["_scaled"]
        for n in self.text:
            # keep: unseen levels get one extra index, which dropLast turns into all zeros
            stages += [StringIndexer(inputCol=n, outputCol=f"_i_{n}", handleInvalid="keep"),
                       OneHotEncoder(inputCol=f"_i_{n}", outputCol=f"_o_{n}", dropLast=True)]
            parts.append(f"_o_{n}")
        stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
        self.model = Pipeline(stages=stages).fit(filled)
        self.names = list(self.numeric)
        for stage in self.model.stages:
            if hasattr(stage, "labels") and stage.getInputCol() in self.text:
                self.names += [f"{stage.getInputCol()}={label}" for label in stage.labels]
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(self._filled(df))
        return out.drop(*[n for n in out.columns if n.startswith("_")])


def vector_profile(data: DataFrame, names: Sequence[str]) -> DataFrame:
    """Mean and deviation per feature, in one pass."""
    s = data.select(Summarizer.metrics("mean", "std").summary(c("features")).alias("s")).select("s.mean", "s.std").first()
    return rows(data.sparkSession, [(n, float(m), float(d)) for n, m, d in zip(names, s[0], s[1])],
                "feature string, mean double, std double")


def slice_features(df: DataFrame, keep: Sequence[int]) -> DataFrame:
    """Only the chosen positions of the feature vector."""
    picked = VectorSlicer(inputCol="features", outputCol="_kept", indices=list(keep)).transform(df)
    return picked.drop("features").withColumnRenamed("_kept", "features")


def low_count_flags(df: DataFrame, columns: Sequence[str], min_ones: int = MIN_ONES, exempt: Sequence[str] = ()) -> DataFrame:
    """0/1 columns with fewer ones than the minimum, and each column's share of non-zeros; one pass."""
    one = df.agg(*[
        F.struct(
            F.sum((c(n) == 1).cast("bigint")).alias("ones"), F.avg((c(n) != 0).cast("double")).alias("prevalence"),
            F.min(c(n).isin(0, 1).cast("int")).alias("is_binary")).alias(n)
        for n in columns])
    long = one.unpivot([], list(columns), "feature", "v").select("feature", "v.*")
    rare = (c("is_binary") == 1) & (c("ones") < min_ones) & ~c("feature").isin(list(exempt))
    return long.select("feature", "ones", "prevalence", rare.alias("dropped"), (c("prevalence") < MIN_PREVALENCE).alias("rare"))


# ---- folds ------------------------------------------------------------------------------
def train_years(install_year: int, first_year: int, window: int | None = TRAIN_WINDOW) -> list[int]:
    """Feature years before the test year; the window counts back from the install year."""
    start = first_year if window is None else max(first_year, install_year - window)
    return list(range(start, install_year - 1))


def fold_sizes(panel: DataFrame, first_year: int, last_year: int, label: str = "solar_next_year") -> DataFrame:
    """Train and test rows and positives of every fold, from one pass over yearly counts."""
    per_year = panel.where(c(label) < 2).groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("pos"))
    folds = [(y, t, "test" if t == y - 1 else "train") for y in range(first_year + 1, last_year + 1)
             for t in [*train_years(y, first_year), y - 1]]
    plan = rows(panel.sparkSession, folds, "install_year bigint, year int, part string")
    part = lambda name, col: F.coalesce(F.sum(F.when(c("part") == name, c(col))), F.lit(0)).alias(f"{name}_{col}")
    return plan.join(per_year, "year").groupBy("install_year").agg(*[part(p, v) for p in ("train", "test") for v in ("n", "pos")])


def decay_weight(df: DataFrame, year: str = "year", decay: float = DECAY) -> DataFrame:
    """Older years weigh less: decay to the power of the years before the newest."""
    newest = df.agg(F.max(year).alias("_y"))  # one row
    return df.crossJoin(F.broadcast(newest)).withColumn("weight", F.pow(F.lit(decay), c("_y") - c(year))).drop("_y")


def class_balanced(df: DataFrame, label: str, weight: str = "weight", times: str | None = None) -> DataFrame:
    """Weights n / (2 * class size), times another weight if one is named."""
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    of = _class_weight(label, sizes)
    return df.withColumn(weight, of * c(times) if times else of)


def _class_weight(label: str, sizes: dict) -> Column:
    total = sum(sizes.values())
    of = F.lit(None).cast("double")
    for value, n in sizes.items():
        of = F.when(c(label) == value, total / (2 * n)).otherwise(of)
    return of


def weighted(train: DataFrame) -> DataFrame:
    """``weight`` by age for all models, ``forest_weight`` with balanced classes too."""
    found = train.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max("year").alias("newest")).collect()  # two rows, one pass
    newest = max((r["newest"] for r in found if r["newest"] is not None), default=None)
    aged = train.withColumn("weight", F.pow(F.lit(DECAY), F.lit(newest) - c("year")))
    return aged.withColumn("forest_weight", _class_weight("label", {r["label"]: r["n"] for r in found}) * c("weight"))


# ---- fits ------------------------------------------------------------------------------
def logistic(train: DataFrame, label: str, penalty: str, strength: float, weight: str = "weight", max_iter: int = 200):
    """Logistic fit with inverse strength C as in the usual formulation: lambda = 1 / (C * sum of weights)."""
    total = train.agg(F.sum(weight)).first()[0]
    mix = {"l1": 1.0, "l2": 0.0, "elasticnet": 0.5}[penalty]
    return LogisticRegression(
        featuresCol="features", labelCol=label, weightCol=weight, elasticNetParam=mix, regParam=1 / (strength * total),
        standardization=False, maxIter=max_iter).fit(train)


def scored(model, df: DataFrame, out: str = "score") -> DataFrame:
    result = model.transform(df).withColumn(out, vector_to_array("probability")[1])
    return result.drop("rawPrediction", "probability", "prediction")


def lift_table(data: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    return E.lift_and_capture(data, groups)


def lift_at(data: DataFrame, share: float = 0.10) -> float:
    return E.lift_and_capture(data, [], shares={"top": share}).first()["lift_top"]


def forest(**over):
    return RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="forest_weight", seed=42, **{**FOREST, **over})


def boost(**over):
    return GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", seed=42, **{**BOOST, **over})


def linear_importance(train: DataFrame, label: str, names: Sequence[str]) -> dict[str, float]:
    """Mean of the max-normalised absolute coefficients of sparse, ridge and mixed logistic fits."""
    balanced = pin(class_balanced(train, label))
    total = [0.0] * len(names)
    for penalty, strength in (("l1", 0.1), ("l2", 1.0), ("elasticnet", 0.1)):
        weights = [abs(w) for w in logistic(balanced, label, penalty, strength).coefficients.toArray()]
        top = max(weights) or 1.0
        total = [t + w / top for t, w in zip(total, weights)]
    return {n: t / 3 for n, t in zip(names, total)}


def permutation_lift(train: DataFrame, label: str, names: Sequence[str], key: str = "strap", row_key: str = "row_id",
                     seed: int = 42) -> DataFrame:
    """Loss of top-10 % lift when a feature's values are shuffled between validation rows.

    Fits on 80 % of the homes. Every validation row gets one partner row through two hash
    orders; swapping one feature changes a linear score by coefficient times difference, so
    all features are judged in one grouped ranking.
    """
    fit_rows, held = split_by_group(train, key, 0.2, seed)
    model = LogisticRegression(featuresCol="features", labelCol=label, weightCol="weight", maxIter=200).fit(class_balanced(fit_rows, label))
    held = held.select(row_key, c(label).alias("y"), vector_to_array("features").alias("x"))
    here = add_position(held, [hash_order(row_key, seed), c(row_key)], position="p")
    there = add_position(held, [hash_order(row_key, seed + 1), c(row_key)], position="p").select("p", c("x").alias("other"))
    w = [float(v) for v in model.coefficients.toArray()]
    margin = sum((F.lit(v) * c("x")[i] for i, v in enumerate(w)), F.lit(float(model.intercept)))
    swapped = F.array(
        F.struct(F.lit("").alias("feature"), c("_m").alias("score")),
        *[F.struct(F.lit(n).alias("feature"), (c("_m") + F.lit(w[i]) * (c("other")[i] - c("x")[i])).alias("score"))
          for i, n in enumerate(names)])
    tried = here.join(there, "p").withColumn("_m", margin).select(
        c(row_key).alias("id"), "y", F.explode(swapped).alias("s")).select("id", "y", "s.*")
    lifts = E.lift_and_capture(tried, ["feature"], shares={"top": 0.10}, only_top=True)
    base = lifts.where(c("feature") == "").select(c("lift_top").alias("_base"))  # one row
    return lifts.where(c("feature") != "").crossJoin(F.broadcast(base)).select(
        "feature", F.greatest(F.lit(0.0), c("_base") - c("lift_top")).alias("lift_drop"))


def group_of(name: str) -> str | None:
    return next((g for g, starts in GROUPS.items() if any(name.startswith(s) for s in starts)), None)


def drop_correlated(data: DataFrame, names: Sequence[str], ranked: Sequence[str], limit: int | None = None,
                    threshold: float = MAX_CORRELATION, group_cap: int | None = None) -> list[str]:
    """Features in rank order, skipping those too correlated with a chosen one or whose group is full.

    The matrix (features x features) is computed on Spark; only the choice runs here.
    """
    matrix = Correlation.corr(data, "features").first()[0].toArray()
    at = {n: i for i, n in enumerate(names)}
    chosen: list[str] = []
    per_group: dict[str, int] = {}
    for name in ranked:
        if limit is not None and len(chosen) >= limit:
            break
        group = group_of(name)
        if group_cap is not None and group and per_group.get(group, 0) >= group_cap:
            continue
        # A constant column has no correlation and counts as zero.
        if any(abs(matrix[at[name], at[o]]) > threshold for o in chosen):
            continue
        chosen.append(name)
        if group:
            per_group[group] = per_group.get(group, 0) + 1
    return chosen


def mutual_information(data: DataFrame, label: str, names: Sequence[str], key: str = "row_id", neighbours: int = NEIGHBOURS) -> DataFrame:
    """Mutual information of each feature with the label, from nearest neighbours of the same class."""
    x = vector_to_array("features")
    wide = data.select(c(key).alias("_id"), c(label).alias("_y"), *[x[i].alias(f"_f{i}") for i in range(len(names))])
    found = neighbour_information(unpivoted(wide, [f"_f{i}" for i in range(len(names))], "_y", "_id"), neighbours)
    labels = F.array(*[F.lit(n) for n in names])
    return found.select(F.get(labels, c("f")).alias("feature"), "mi")


def five_way_selection(data: DataFrame, label: str, names: Sequence[str], keep: int = 25, ridge_top: int = 30) -> DataFrame:
    """Features chosen by sparse, ridge, mixed, recursive and information selection, with their votes."""
    data = pin(data.withColumn("weight", F.lit(1.0)))
    coef = lambda p, s, d=data: [abs(w) for w in logistic(d, label, p, s).coefficients.toArray()]

    def sparse(weights: list[float]) -> list[str]:
        positive = sorted(w for w in weights if w > 0)
        cut = _percentile(positive, 0.10) if positive else 0.0
        return [n for n, w in zip(names, weights) if w > cut]

    top = lambda pairs, k: [n for n, _ in sorted(pairs, key=lambda p: (-p[1], p[0]))[:k]]

    def ridge() -> tuple[list[str], list[str]]:
        weights = coef("l2", 1.0)
        chosen = top(zip(names, weights), ridge_top)
        left = list(range(len(names)))
        step = max(1, min(5, len(names) // 20))
        while len(left) > keep:
            drop = sorted(range(len(left)), key=lambda i: weights[i])[:min(step, len(left) - keep)]
            left = [f for i, f in enumerate(left) if i not in drop]
            if len(left) > keep:
                weights = coef("l2", 1.0, slice_features(data, left))
        return chosen, [names[i] for i in left]

    # The ridge fit of all features is the first of the recursion; the four ways run side by side.
    ways = (ridge, lambda: [(r["feature"], r["mi"]) for r in mutual_information(data, label, names).collect()],  # one row per feature
            lambda: sparse(coef("l1", 0.1)), lambda: sparse(coef("elasticnet", 0.1)))
    with held(data):
        (chosen, recursive), info, lasso, mixed = side_by_side(lambda way: way(), ways)
    votes = {"lasso": lasso, "ridge": chosen, "elastic_net": mixed, "rfe": recursive, "mutual_info": top(info, keep)}
    table = rows(data.sparkSession, [(m, f) for m, fs in votes.items() for f in fs], "method string, feature string")
    return table.groupBy("feature").agg(
        F.count(F.lit(1)).alias("votes"), F.array_join(F.array_sort(F.collect_list("method")), ",").alias("methods"))


def _percentile(ordered: list[float], share: float) -> float:
    at = share * (len(ordered) - 1)
    low = int(at)
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] + (ordered[high] - ordered[low]) * (at - low)


# ---- calibration ---------------------------------------------------------------------------
def fitted(estimator, train: DataFrame):
    return fit_together(estimator, train, [None])[0] if supported(estimator, train) else estimator.fit(train)


def scored_by_all(models: Sequence, df: DataFrame, keep: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``keep`` and the score of each model as a column."""
    if all(isinstance(m, Boosted) for m in models):
        return scores_together(models, df, keep, names)
    for model, name in zip(models, names):
        df = scored(model, df, name)
    return df.select(*keep, *names)


CALIBRATION_FOLDS = 3


def calibrated(make: Callable, train: DataFrame, test: DataFrame, folds: int = CALIBRATION_FOLDS, key: str = "strap", seed: int = 42,
               fold: str | None = None) -> DataFrame:
    """Mean of per-fold isotonic corrections: each fold's model is corrected on its held-out rows.

    Scores are used as they are; a fold without held-out rows corrects nothing and is left out of the mean.
    ``fold`` names a column that has the fold numbers of the key already.
    """
    points, models = None, []
    number = fold_of(key, folds, seed) if fold is None else c(fold)
    for i in range(folds):
        models.append(fitted(make(), train.where(number != i)))
        held_out = scored_by_all(models[-1:], train.where(number == i), ["label", "weight"], ["x"]).select(
            F.lit(i).cast("bigint").alias("fold"), "x", c("label").cast("double").alias("y"), c("weight").alias("w"))
        points = held_out if points is None else points.unionByName(held_out)
    names = [f"_x{i}" for i in range(folds)]
    raw = scored_by_all(models, test, ["row_id"], names)
    curve = isotonic_curve(points)
    steps = few_steps(curve)
    if steps is None:
        each = F.posexplode(F.array(*names)).alias("fold", "x")
        values = isotonic_values(curve, pin(raw.select(each, "row_id")))
        summed = values.groupBy("row_id").agg(F.avg("value").alias("score"))
    else:
        placed = values_of_steps(raw, steps, dict(enumerate(names)))
        total = sum((F.coalesce(c(n), F.lit(0.0)) for n in names[1:]), F.coalesce(c(names[0]), F.lit(0.0)))
        known = sum((c(n).isNotNull().cast("int") for n in names[1:]), c(names[0]).isNotNull().cast("int"))
        own = placed.select("row_id", total.alias("s"), known.alias("n"))
        summed = pin(own.groupBy("row_id").agg((F.sum("s") / F.nullif(F.sum("n"), F.lit(0))).alias("score")))
    return test.join(summed, "row_id")


# ---- jobs --------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Job:
    """What to train on: key strap, year, a 0/1/2 label (2 = already adopted) and features."""

    panel: DataFrame
    numeric: tuple[str, ...]
    text: tuple[str, ...]
    first_year: int
    last_year: int
    label: str = "solar_next_year"


# A fold with fewer rows is skipped.
MIN_TRAIN, MIN_TEST = 10, 5


def why_skipped(job: Job, install_year: int) -> str | None:
    """Why an install year has no fold; None when it has one."""
    valid = job.panel.where(c(job.label) < 2)
    size = valid.where(c("year").isin(train_years(install_year, job.first_year))).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct(job.label).alias("k")).first()
    if size["n"] < MIN_TRAIN:
        return "too few training rows"
    if size["k"] < 2:
        return "one class in training"
    return "too few test rows" if valid.where(c("year") == install_year - 1).limit(MIN_TEST).count() < MIN_TEST else None


def fold(job: Job, install_year: int) -> tuple[DataFrame, DataFrame, Preprocessor] | None:
    """Prepared train and test rows of one install year; None when too small or one-class."""
    if why_skipped(job, install_year):
        return None
    valid = job.panel.where(c(job.label) < 2)
    train = valid.where(c("year").isin(train_years(install_year, job.first_year)))
    test = valid.where(c("year") == install_year - 1)
    prep = Preprocessor(list(job.numeric), list(job.text)).fit(train)
    ready = lambda df: prep.transform(df).select("strap", "year", "row_id", c(job.label).cast("int").alias("label"), "features")
    return pin(weighted(ready(train))), pin(ready(test)), prep


@dataclass(frozen=True)
class Selection:
    """How a fold chooses its features."""

    keep: int = 25
    candidates: int = 50
    min_positives: int = 30
    min_ones: int = MIN_ONES
    recent_years: int = 5  # the last install year chooses on these only
    exempt: tuple[str, ...] = ("battery", "ev_charger", "heat_pump")


def rare_ones(train: DataFrame, names: Sequence[str], chosen: Selection) -> set[str]:
    """0/1 features of the vector with too few ones."""
    long = train.select(F.posexplode(vector_to_array("features")).alias("f", "v"))
    found = long.groupBy("f").agg(F.sum((c("v") == 1).cast("bigint")).alias("ones"), F.min(c("v").isin(0.0, 1.0).cast("int")).alias("binary"))
    few = found.where((c("binary") == 1) & (c("ones") < chosen.min_ones)).select("f").collect()  # one row per feature
    return {names[r["f"]] for r in few if not any(e in names[r["f"]] for e in chosen.exempt)}


def select_features(train: DataFrame, names: Sequence[str], chosen: Selection) -> tuple[list[str], list[tuple]]:
    """The features of one fold and ``(feature, importance, lift_drop, rank)`` of the candidates.

    Low-count filter, importance of three linear fits, re-ranking by the lift that
    is lost when a feature is shuffled, then the correlation filter. With few
    features or few positives all that pass the low-count filter stay.
    """
    rare = rare_ones(train, names, chosen)
    left = [n for n in names if n not in rare]
    positives = train.where(c("label") == 1).count()
    if len(left) <= chosen.keep or positives < chosen.min_positives:
        return left, [(n, None, None, i + 1) for i, n in enumerate(left)]
    at = {n: i for i, n in enumerate(names)}
    sliced = pin(slice_features(train, [at[n] for n in left]))
    importance = linear_importance(sliced, "label", left)
    ranked = sorted(left, key=lambda n: (-importance[n], n))[:chosen.candidates]
    drops: dict[str, float] = {}
    if len(ranked) > chosen.keep:
        some = slice_features(train, [at[n] for n in ranked])
        drops = {r["feature"]: r["lift_drop"] for r in permutation_lift(some, "label", ranked).collect()}  # one row per candidate
        ranked = sorted(ranked, key=lambda n: (-drops[n], -importance[n], n))
    kept = drop_correlated(sliced, left, ranked, chosen.keep)
    place = {n: i + 1 for i, n in enumerate(kept)}
    return kept, [(n, float(importance[n]), drops.get(n), place.get(n)) for n in ranked]


@dataclass(frozen=True)
class WalkForward:
    """What a walk-forward job gives."""

    scores: DataFrame  # model, install_year, id, y, score
    features: DataFrame  # install_year, feature, importance, lift_drop, rank (null: not chosen)
    folds: DataFrame  # install_year, n_features, status (done, or why it was skipped)

    def metrics(self) -> DataFrame:
        """Lift, capture, ROC-AUC and average precision of every model and fold."""
        groups = ["model", "install_year"]
        scores = pin(self.scores)
        return (E.lift_and_capture(scores, groups, only_top=True).join(E.roc_auc(scores, groups), groups, "left")
                .join(E.average_precision(scores, groups), groups, "left"))


def walk_forward(job: Job, models: dict[str, Callable], calibrate: bool = True, years: Sequence[int] | None = None,
                 selection: Selection | None = None) -> WalkForward:
    """Every fold: preparation, feature selection, weights, fits, calibration, and the models' mean as ``ensemble``."""
    spark = job.panel.sparkSession

    def one(year: int) -> tuple[DataFrame | None, list[tuple], tuple]:
        reason = why_skipped(job, year)
        if reason:
            return None, [], (year, 0, reason)
        train, test, prep = fold(job, year)
        names, table = list(prep.names), []
        if selection is not None:
            recent = train.where(c("year") >= year - selection.recent_years) if year == job.last_year else train
            with held(train):
                kept, found = select_features(recent, names, selection)
            table = [(year, *row) for row in found]
            at = [names.index(n) for n in kept]
            numbered = slice_features(train, at).withColumn("_fold", fold_of("strap", CALIBRATION_FOLDS))
            train, test, names = pin(numbered), pin(slice_features(test, at)), kept
        fits, number = [], "_fold" if selection is not None else None
        with held(train, test):
            for name, make in models.items():
                result = calibrated(make, train, test, fold=number) if calibrate else scored_by_all([fitted(make(), train)], test, ["strap", "label"], ["score"])
                fits.append(result.select(F.lit(name).alias("model"), F.lit(year).cast("bigint").alias("install_year"),
                                          c("strap").alias("id"), c("label").alias("y"), "score"))
            every = fits[0]
            for f in fits[1:]:
                every = every.unionByName(f)
            every = pin(every)
        if len(fits) > 1:
            mean = every.groupBy("install_year", "id", "y").agg(F.avg("score").alias("score")).withColumn("model", F.lit("ensemble"))
            every = every.unionByName(mean)
        return every, table, (year, len(names), "done")

    years = list(years or range(job.first_year + 1, job.last_year + 1))
    with held(job.panel):
        found = side_by_side(one, years[::-1])[::-1]  # the largest folds are the last years': they begin first
    result = rows(spark, [], "model string, install_year bigint, id string, y int, score double")
    for scores, _, _ in found:
        result = result if scores is None else result.unionByName(scores)
    return WalkForward(
        result,
        rows(spark, [r for _, table, _ in found for r in table],
             "install_year bigint, feature string, importance double, lift_drop double, rank int"),
        rows(spark, [f for *_, f in found], "install_year bigint, n_features int, status string"))


def final_list(job: Job, models: dict[str, Callable], install_year: int) -> DataFrame:
    """Homes without the target in the last feature year with every model's calibrated score and decile."""
    train, test, _ = fold(job, install_year)
    test = test.where(c("label") == 0)
    result, scores = test, []
    for name, make in models.items():
        part = calibrated(make, train, test).select("row_id", c("score").alias(f"{name}_score"))
        result = result.join(part, "row_id")
        scores.append(f"{name}_score")
    result = E.mean_ensemble(result, scores, "ensemble_score").select("strap", *scores, "ensemble_score")
    result = pin(result)
    for s in [*scores, "ensemble_score"]:
        result = E.position_decile(result, score=s, key="strap").withColumnRenamed(
            "decile", s.replace("score", "decile")).drop("position", "n_rows")
    return result


def first_positive_year(panel: DataFrame, label: str = "solar_next_year") -> int | None:
    return panel.where(c(label) == 1).agg(F.min("year")).first()[0]


def fast_walk_forward(job: Job, keep: Sequence[str] | None = None, temporal_only: Sequence[str] | None = None, **params) -> DataFrame:
    """Boosting only, uncalibrated, on a curated or temporal-only list, starting when positives exist."""
    numeric = [n for n in job.numeric if (keep is None or n in keep) and (temporal_only is None or n in temporal_only)]
    start = first_positive_year(job.panel, job.label)
    job = Job(job.panel, tuple(numeric), () if temporal_only is not None else job.text, max(job.first_year, start or job.first_year),
              job.last_year, job.label)
    return walk_forward(job, {"boost": lambda: boost(**params)}, calibrate=False).scores


def out_of_sample(job: Job, make: Callable, year: int, folds: int = 5, seed: int = 42, calibrate: bool = True,
                  window: int = TRAIN_WINDOW) -> DataFrame:
    """Every home of a year, adopters too, scored by models that saw none of its rows: (strap, label, adopter, score).

    Each fold prepares and fits on the other homes' rows of the year and the ``window`` years before it.
    """
    fold_number = fold_of("strap", folds, seed)
    valid = job.panel.where((c(job.label) < 2) & c("year").between(year - window, year))

    def one(i: int) -> DataFrame:
        train, test = valid.where(fold_number != i), job.panel.where((c("year") == year) & (fold_number == i))
        prep = Preprocessor(list(job.numeric), list(job.text)).fit(train)
        ready = lambda df, prep=prep: prep.transform(df).select("strap", "year", "row_id", c(job.label).cast("int").alias("label"), "features")
        # Another seed: the held-out homes of this fold are one fold of the same numbering.
        train, test = pin(weighted(ready(train)).withColumn("_fold", fold_of("strap", CALIBRATION_FOLDS, seed + 1))), pin(ready(test))
        with held(train, test):
            found = calibrated(make, train, test, fold="_fold") if calibrate else scored(make().fit(train), test)
        return found.select("strap", "label", (c("label") == 2).alias("adopter"), "score")

    out = rows(job.panel.sparkSession, [], "strap string, label int, adopter boolean, score double")
    with held(job.panel):
        parts = side_by_side(one, range(folds))
    for part in parts:
        out = out.unionByName(part)
    return out


def adopters_by_decile(found: DataFrame) -> DataFrame:
    """How many homes and adopters each score decile holds: (decile, homes, adopters, share_of_adopters)."""
    ranked = E.position_decile(found, key="strap").groupBy("decile").agg(
        F.count(F.lit(1)).alias("homes"), F.sum(c("adopter").cast("bigint")).alias("adopters"))
    every = ranked.agg(F.sum("adopters").alias("_all"))  # one row
    return ranked.crossJoin(F.broadcast(every)).select(
        "decile", "homes", "adopters", (c("adopters") / F.nullif(c("_all"), F.lit(0))).alias("share_of_adopters"))


def parameter_search(job: Job, make: Callable, grid: dict[str, list], years: Sequence[int], parallel: int = 4) -> DataFrame:
    """Mean top-10 % lift over the given folds for every parameter combination; fits run side by side."""
    spark = job.panel.sparkSession
    with held(job.panel):
        folds = [f for f in side_by_side(lambda y: fold(job, y), years) if f is not None]
    names = list(grid)
    combos = [dict(zip(names, values)) for values in itertools.product(*grid.values())]

    def judge(params: dict) -> tuple[str, float]:
        lifts = []
        for train, test, _ in folds:
            result = scored(make(**params).fit(train), test).select(c("strap").alias("id"), c("label").alias("y"), "score")
            lifts.append(lift_at(result))
        return ", ".join(f"{k}={v}" for k, v in params.items()), float(sum(lifts) / max(1, len(lifts)))

    with held(*[df for train, test, _ in folds for df in (train, test)]), ThreadPool(parallel) as pool:
        found = pool.map(judge, combos, chunksize=1)
    return rows(spark, found, "params string, mean_lift double")


def lifts_of_features(make: Callable, train: DataFrame, test: DataFrame, uses: Sequence[Sequence[int]]) -> list[float]:
    """Top-10 % lift on the test rows of a fit for each list of places in the feature vector."""
    if supported(make(), train):
        names = [f"_s{i}" for i in range(len(uses))]
        wide = scores_together(fit_together(make(), train, uses), test, ["strap", "label"], names)
        each = F.posexplode(F.array(*names)).alias("fit", "score")
        lifts = E.lift_and_capture(wide.select(c("strap").alias("id"), c("label").alias("y"), each), ["fit"], shares={"top": 0.10})
        found = {r["fit"]: r["lift_top"] for r in lifts.collect()}  # one row per fit
        return [found[i] for i in range(len(uses))]

    train, test = pin(train), pin(test)

    def lift(use: Sequence[int]) -> float:
        result = scored(make().fit(slice_features(train, use)), slice_features(test, use))
        return lift_at(result.select(c("strap").alias("id"), c("label").alias("y"), "score"))

    with held(train, test):
        return side_by_side(lift, uses)


# Gain from which a product is worth keeping; smallest folds that are judged.
MIN_GAIN = 0.05
SCREEN_TRAIN, SCREEN_TEST, SCREEN_POSITIVES = 100, 20, 5


def interaction_screen(job: Job, pairs: Sequence[tuple[str, str]], kinds: Sequence[str], make: Callable,
                       years: Sequence[int], seed: int = 42) -> DataFrame:
    """Mean top-10 % lift of boosting with each product of two features on each scale, against none.

    Homes are split 80/20. A fold is prepared once, with all products as columns; each
    fit sees the base features and one product.
    """
    products = {f"{a}_x_{b}:{kind}": interaction(c(a).cast("double"), c(b).cast("double"), kind)
                for (a, b), kind in itertools.product(pairs, kinds)}
    # Kept with the products and the part of each home, which all folds read.
    panel = job.panel.where(c(job.label) < 2).withColumns({**products, "_test": in_test("strap", 0.2, seed)})
    lifts: dict[str, list[float]] = {"": [], **{n: [] for n in products}}
    with held(panel):
        for year in years:
            train = panel.where(~c("_test") & c("year").between(job.first_year, year - 1))
            test = panel.where(c("_test") & (c("year") == year - 1))
            n_test = test.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(job.label), F.lit(0)).alias("pos")).first()
            if train.count() < SCREEN_TRAIN or n_test["n"] < SCREEN_TEST or n_test["pos"] < SCREEN_POSITIVES:
                continue
            prep = Preprocessor([*job.numeric, *products], list(job.text)).fit(train)
            ready = lambda df, prep=prep: prep.transform(df).select("strap", c(job.label).cast("int").alias("label"), "features", F.lit(1.0).alias("weight"))
            base = [i for i, n in enumerate(prep.names) if n not in products]
            uses = [base + ([prep.names.index(name)] if name else []) for name in lifts]
            for name, value in zip(lifts, lifts_of_features(make, ready(train), ready(test), uses)):
                lifts[name].append(value)
    mean = {n: sum(v) / len(v) if v else 0.0 for n, v in lifts.items()}
    gain = lambda n: (mean[n] - mean[""]) / mean[""] if mean[""] > 0 else 0.0
    found = [("none", "none", len(lifts[""]), mean[""], 0.0, False)]
    found += [(*n.split(":"), len(v), mean[n], gain(n), gain(n) >= MIN_GAIN) for n, v in lifts.items() if n]
    return rows(job.panel.sparkSession, found, "pair string, kind string, folds int, lift_10pct double, gain double, keep boolean")


def coefficient_report(data: DataFrame, label: str, names: Sequence[str]) -> DataFrame:
    """Log-odds, p-value, odds ratio and percent change per feature.

    The most common level of each text column is the base of its other levels; without
    a base the levels of a column add up to the intercept and have no p-values.
    """
    columns = [n.split("=")[0] if "=" in n else None for n in names]
    use = [i for i, n in enumerate(columns) if n is None or n in columns[:i]]
    data, names = slice_features(data, use), [names[i] for i in use]
    fit = GeneralizedLinearRegression(family="binomial", link="logit", featuresCol="features", labelCol=label, maxIter=50, regParam=0.0).fit(data)
    found = [(n, float(w), float(p), math.exp(w), 100 * (math.exp(w) - 1), bool(p < 0.05))
             for n, w, p in zip(names, fit.coefficients.toArray(), fit.summary.pValues)]
    return rows(data.sparkSession, found,
                "feature string, log_odds double, p_value double, odds_ratio double, pct_change double, significant boolean")


# ---- fixed values: sizes of the compared models -------------------------------------------
BAKE_OFF = {"tree": dict(maxDepth=10), "forest": dict(numTrees=100, maxDepth=10), "boost": dict(maxIter=100, maxDepth=5)}


def stratified_split(data: DataFrame, label: str, key: str, test_share: float = 0.25, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows with the same share of every class: the first rows of each class in hash order are the test."""
    placed = pin(add_position(data, [hash_order(key, seed), c(key)], [label], position="_p", total="_n"))
    test = c("_p") <= F.round(c("_n") * test_share)
    return placed.where(~test).drop("_p", "_n"), placed.where(test).drop("_p", "_n")


def bake_off(data: DataFrame, label: str = "label", seed: int = 42, sizes: dict[str, dict] = BAKE_OFF, balanced: bool = False) -> DataFrame:
    """Linear, tree, forest and boosting on a 75/25 split with equal class shares."""
    train, test = stratified_split(data, label, "row_id", 0.25, seed)
    train = pin(class_balanced(train, label) if balanced else train.withColumn("weight", F.lit(1.0)))
    common = dict(featuresCol="features", labelCol=label, weightCol="weight")
    makers = {
        "logistic": LogisticRegression(**common, maxIter=100),
        "tree": DecisionTreeClassifier(**common, seed=seed, **sizes["tree"]),
        "forest": RandomForestClassifier(**common, seed=seed, **sizes["forest"]),
        "boost": GBTClassifier(**common, seed=seed, **sizes["boost"]),
    }
    every = None
    for name, maker in makers.items():
        part = scored(maker.fit(train), test).select(
            F.lit(name).alias("model"), c("row_id").alias("id"), c(label).alias("y"), "score")
        every = part if every is None else every.unionByName(part)
    every = pin(every)
    return E.threshold_metrics(every, ["model"]).join(E.roc_auc(every, ["model"]), "model")
