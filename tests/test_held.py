import random

from pyspark.sql import functions as F

from leadpanel.plans import models as M
from leadpanel.session import held, pin


def kept(df):
    return df.storageLevel.useMemory or df.storageLevel.useDisk


def test_kept_with_the_same_partitions_and_order_and_given_back(spark):
    df = pin(spark.range(0, 1000, 1, 7).withColumn("p", F.spark_partition_id()).sortWithinPartitions(F.desc("id")))
    before = df.collect()
    with held(df):
        assert kept(df) and df.collect() == before
        with held(df):
            pass
        assert kept(df)  # by the outer one
    assert not kept(df) and df.collect() == before


def test_jobs_read_their_panel_from_columns_and_give_it_back(spark, monkeypatch):
    rng = random.Random(5)
    values = [(f"h{i}", year, f"h{i}-{year}", int(rng.random() < 0.3), rng.random(), rng.choice("ab")) for i in range(150) for year in range(2000, 2005)]
    panel = pin(spark.createDataFrame(values, "strap string, year bigint, row_id string, solar_next_year int, x double, t string"))
    job, seen = M.Job(panel, ("x",), ("t",), 2000, 2004), []

    def scored(model, df, *more, real=M.scored):
        seen.append(kept(panel) and "InMemoryTableScan" in df._jdf.queryExecution().executedPlan().toString())
        return real(model, df, *more)

    monkeypatch.setattr(M, "scored", scored)
    make = lambda **own: M.forest(**{"numTrees": 2, "maxDepth": 2, **own})
    assert M.out_of_sample(job, make, 2003, folds=2, calibrate=False).count() == 150
    M.walk_forward(job, {"forest": make}, calibrate=False, years=[2004]).scores.count()
    assert len(seen) == 3 and all(seen)
    assert not kept(panel)


def test_weights_in_one_pass_equal_those_of_both_steps(spark):
    train = spark.createDataFrame([("a", 1999, 0), ("b", 2001, 1), ("c", 2001, 0), ("d", 2003, 0)], "strap string, year bigint, label int")
    both = M.class_balanced(M.decay_weight(train), "label", "forest_weight", "weight")
    assert sorted(M.weighted(train).collect()) == sorted(both.collect())


def test_selection_does_not_repeat_the_ridge_fit(spark, monkeypatch):
    rng = random.Random(6)
    names = ["a", "b", "d"]
    rows = [(f"r{i}", int(rng.random() < 0.4), *[rng.gauss(0, 1) for _ in names]) for i in range(200)]
    data = pin(M.assemble(spark.createDataFrame(rows, "row_id string, label int, a double, b double, d double"), names))
    fits = []
    monkeypatch.setattr(M, "logistic", lambda d, label, penalty, *more, real=M.logistic: fits.append(penalty) or real(d, label, penalty, *more))
    found = {r["feature"]: r["methods"] for r in M.five_way_selection(data, "label", names, keep=1, ridge_top=2).collect()}
    assert sorted(fits) == ["elasticnet", "l1", "l2", "l2"]
    assert sum("rfe" in m for m in found.values()) == 1 and sum("ridge" in m for m in found.values()) == 2
