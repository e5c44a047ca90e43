import random

import pytest
from pyspark.sql import functions as F

from leadpanel.plans import models as M


@pytest.fixture(scope="module")
def panel(spark):
    """A label that hangs on x; noise beside it; ten years."""
    rng = random.Random(2)
    rows = []
    for home in range(300):
        x, kind = rng.random(), rng.choice(["a", "b", None])
        for year in range(2000, 2006):
            rows.append((f"h{home}", year, f"{home}-{year}", int(rng.random() < 0.02 + 0.5 * (x > 0.8)), x, rng.random() if home % 9 else None, kind))
    return spark.createDataFrame(rows, "strap string, year int, row_id string, solar_next_year int, x double, noise double, kind string")


@pytest.fixture(scope="module")
def prepared(panel):
    prep = M.Preprocessor(["x", "noise"], ["kind"]).fit(panel)
    return prep.transform(panel).withColumn("label", F.col("solar_next_year")), prep


def test_unseen_level_is_all_zeros(spark, panel):
    prep = M.Preprocessor(["x"], ["kind"]).fit(panel)
    assert prep.names == ["x", *[n for n in prep.names[1:]]] and len(prep.names) == 4
    new = spark.createDataFrame([(0.5, "never seen")], "x double, kind string")
    assert list(prep.transform(new).first()["features"].toArray()[1:]) == [0, 0, 0]


def test_train_years():
    assert M.train_years(2010, 1995) == [2005, 2006, 2007, 2008]
    assert M.train_years(1996, 1995) == []
    assert M.train_years(1999, 1995, window=None) == [1995, 1996, 1997]


def test_importance_and_permutation_find_the_signal(prepared):
    data, prep = prepared
    importance = M.linear_importance(data, "label", prep.names)
    assert max(importance, key=importance.get) == "x"
    drops = {r["feature"]: r["lift_drop"] for r in M.permutation_lift(data, "label", prep.names).collect()}
    assert max(drops, key=drops.get) == "x"


def test_selection(prepared):
    data, prep = prepared
    votes = {r["feature"]: r["votes"] for r in M.five_way_selection(data, "label", prep.names, keep=2, ridge_top=2).collect()}
    assert votes["x"] == 5


def test_correlation_filter(spark):
    df = spark.range(200).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0 + 1).alias("b"),
                                 (F.col("id") % 7).cast("double").alias("count_1mi"), (F.col("id") % 5).cast("double").alias("count_3mi"))
    names = ["a", "b", "count_1mi", "count_3mi"]
    data = M.assemble(df, names)
    assert M.drop_correlated(data, names, names) == ["a", "count_1mi", "count_3mi"]
    assert M.drop_correlated(data, names, names, group_cap=1) == ["a", "count_1mi"]


def test_walk_forward(panel):
    job = M.Job(panel, ("x", "noise"), ("kind",), 2000, 2005)
    make = {"forest": lambda: M.forest(numTrees=5, maxDepth=3, minInstancesPerNode=5), "boost": lambda: M.boost(maxIter=3, maxDepth=2)}
    found = M.walk_forward(job, make, years=[2001, 2005], selection=M.Selection(keep=1, min_positives=5))
    out = found.scores
    assert {r["install_year"]: r["status"] for r in found.folds.collect()} == {2001: "too few training rows", 2005: "done"}
    chosen = [r["feature"] for r in found.features.where("rank = 1").collect()]
    assert chosen == ["x"]
    assert {r["model"] for r in found.metrics().collect()} == {"forest", "boost", "ensemble"}
    lift = {r["model"]: r["lift_10pct"] for r in M.lift_table(out, ["model"]).collect()}
    assert set(lift) == {"forest", "boost", "ensemble"} and lift["ensemble"] > 1.5
    assert out.where("score < 0 OR score > 1").count() == 0
    assert M.fold(job, 2001) is None


def test_out_of_sample_covers_everyone(panel):
    job = M.Job(panel, ("x",), (), 2000, 2005)
    adopted = panel.withColumn("solar_next_year", F.when(F.col("strap") < "h12", 2).otherwise(F.col("solar_next_year")))
    job = M.Job(adopted, ("x",), (), 2000, 2005)
    out = M.out_of_sample(job, lambda: M.forest(numTrees=3, maxDepth=3), 2004, folds=3)
    assert out.count() == out.select("strap").distinct().count() == 300
    assert out.where("adopter").count() == adopted.where("year = 2004 AND solar_next_year = 2").count() > 0
    deciles = M.adopters_by_decile(out).collect()
    assert sum(r["homes"] for r in deciles) == 300 and abs(sum(r["share_of_adopters"] for r in deciles) - 1) < 1e-9


def test_interactions_are_judged_on_all_folds(panel):
    job = M.Job(panel, ("x", "noise"), (), 2000, 2005)
    got = M.interaction_screen(job, [("x", "noise")], ["raw", "log_both"], lambda: M.boost(maxIter=2, maxDepth=2), [2004, 2005]).collect()
    assert [(r["pair"], r["kind"], r["folds"]) for r in got] == [("none", "none", 2), ("x_x_noise", "raw", 2), ("x_x_noise", "log_both", 2)]


def test_stratified_split_keeps_the_shares(spark):
    data = spark.range(400).select(F.col("id").cast("string").alias("row_id"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    train, test = M.stratified_split(data, "label", "row_id")
    assert (test.where("label = 1").count(), test.count(), train.count()) == (10, 100, 300)


def test_forest_weights_balance_the_classes(spark):
    data = spark.range(100).select((F.col("id") < 10).cast("int").alias("label"), (F.lit(2000) + F.col("id") % 2).alias("year"))
    sums = {r["label"]: r["w"] for r in M.weighted(data).groupBy("label").agg(F.sum("forest_weight").alias("w")).collect()}
    assert abs(sums[0] - sums[1]) < 1e-9


def test_weights_for_many_models():
    from leadpanel.operators.metrics import simplex_weights

    found = simplex_weights(4)
    assert len(found) == 205 and all(abs(sum(w) - 1) < 1e-9 and min(w) >= 0 for w in found)
    assert (0.25, 0.25, 0.25, 0.25) in found and (0.0, 1.0, 0.0, 0.0) in found


def test_low_counts(spark):
    df = spark.range(300).select((F.col("id") < 3).cast("int").alias("rare"), (F.col("id") < 250).cast("int").alias("common"), F.col("id").alias("n"))
    got = {r["feature"]: (r["ones"], r["dropped"], r["rare"]) for r in M.low_count_flags(df.select(*[F.col(c).cast("double") for c in df.columns]), df.columns).collect()}
    assert got == {"rare": (3, True, True), "common": (250, False, False), "n": (1, False, False)}


def test_coefficients(prepared):
    data, prep = prepared
    report = {r["feature"]: r for r in M.coefficient_report(M.slice_features(data, [0, 1]), "label", ["x", "noise"]).collect()}
    assert report["x"]["significant"] and report["x"]["odds_ratio"] > 1 and not report["noise"]["significant"]
