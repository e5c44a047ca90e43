"""Boosting in numpy against Spark ML's own fit of the same estimator."""

import pytest
from pyspark.sql import functions as F

from leadpanel.plans import boosting as B
from leadpanel.plans import models as M
from leadpanel.session import pin


def rows(spark, n, weighted):
    df = spark.range(n).repartition(5).select(
        "id", (F.rand(1) * 10).alias("a"), F.when(F.rand(2) > 0.4, F.randn(3)).otherwise(0.0).alias("b"), F.floor(F.rand(4) * 7).cast("double").alias("k"),
        F.lit(3.0).alias("same"), F.element_at(F.array(*map(F.lit, "pqrstuv")), (F.rand(5) * 7 + 1).cast("int")).alias("t"),
        F.when(F.rand(6) > 0.5, "x").otherwise("y").alias("u"), F.rand(7).alias("_r"),
        (F.pow(F.lit(0.85), F.floor(F.rand(8) * 5)) if weighted else F.lit(1.0)).alias("weight"))
    share = 0.1 + 0.3 * (F.col("a") > 7).cast("int") + 0.2 * (F.col("t") == "q").cast("int")
    df = pin(df.withColumn("label", (F.col("_r") < share).cast("int")))
    prep = M.Preprocessor(["a", "b", "k", "same"], ["t", "u"]).fit(df)
    return pin(prep.transform(df).select("id", "label", "weight", "features")), len(prep.names)


# Above 10,000 rows thresholds come from a sample.
@pytest.mark.parametrize("n, weighted, more", [(600, False, {}), (2000, True, {"maxBins": 10, "minInstancesPerNode": 1}), (15_000, True, {}), (3000, False, {"subsamplingRate": 1.0})])
def test_every_fit_is_that_of_spark_ml(spark, monkeypatch, n, weighted, more):
    train, width = rows(spark, n, weighted)
    make = lambda: M.boost(**{"maxIter": 4, "maxDepth": 3, "stepSize": 0.1, **more})
    assert B.supported(make(), train)
    uses = [list(range(width)), [0, 2, 5, 6, width - 1], [1]]
    monkeypatch.setattr(B, "DIRECT", 64 if weighted else 1)
    models = B.fit_together(make(), train, uses)
    got = {r["id"]: r[1:] for r in B.scores_together(models, train, ["id"], ["s0", "s1", "s2"]).collect()}
    assert len(got) == n
    for i, use in enumerate(uses):
        part = M.slice_features(train, use)
        want = {r["id"]: r["score"] for r in M.scored(make().fit(part), part).collect()}
        assert len(set(want.values())) > 2
        assert max(abs(got[k][i] - v) for k, v in want.items()) < 1e-9


def test_other_estimators_are_left_to_spark_ml(spark):
    train, _ = rows(spark, 50, False)
    assert not B.supported(M.forest(), train)
    assert not B.supported(M.boost(featureSubsetStrategy="sqrt"), train)


def test_a_pure_label_gives_one_leaf(spark):
    train, width = rows(spark, 100, False)
    train = train.where("label = 0")
    model = B.fit_together(M.boost(maxIter=2, maxDepth=2, minInstancesPerNode=1), train, [list(range(width))])
    want = {r["score"] for r in M.scored(M.boost(maxIter=2, maxDepth=2, minInstancesPerNode=1).fit(train), train).collect()}
    got = {r["score"] for r in B.scores_together(model, train, ["id"]).collect()}
    assert len(got) == len(want) == 1 and got.pop() == pytest.approx(want.pop())


def test_all_products_of_a_fold_are_fitted_in_the_same_passes(spark, monkeypatch):
    df = spark.range(600).select(
        (F.col("id") % 200).cast("string").alias("strap"), (F.lit(2000) + F.floor(F.col("id") / 200)).cast("int").alias("year"), F.rand(1).alias("x"), F.rand(2).alias("z"),
        (F.rand(3) < 0.4).cast("int").alias("solar_next_year"))
    job, calls = M.Job(pin(df), ("x", "z"), (), 2000, 2002), []
    alone = {}
    for kind in ("", "other"):
        monkeypatch.setattr(M, "supported", lambda *a, kind=kind: not kind and B.supported(*a))
        monkeypatch.setattr(M, "fit_together", lambda est, train, uses, real=B.fit_together: calls.append(len(uses)) or real(est, train, uses))
        found = M.interaction_screen(job, [("x", "z")], ["raw", "log_both"], lambda: M.boost(maxIter=2, maxDepth=2, minInstancesPerNode=5), [2002, 2003])
        alone[kind] = sorted(map(tuple, found.collect()))
    assert calls == [3, 3] and alone[""] == alone["other"] and alone[""][0][2] == 2
