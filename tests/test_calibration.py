"""Calibration, lifts and medians that order only what they need, against those that order everything."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from leadpanel.operators import isotonic as I
from leadpanel.operators import metrics as E
from leadpanel.operators import ranking as R
from leadpanel.plans import models as M
from leadpanel.session import pin


def test_steps_give_the_values_of_the_sorted_curve(spark):
    rng = random.Random(3)
    points = [(f, x / 40, float(rng.random() < x / 40), rng.choice([1.0, 0.85])) for f in (0, 1) for x in rng.choices(range(41), k=120)]
    curve = I.isotonic_curve(spark.createDataFrame(points, "fold bigint, x double, y double, w double"))
    curve = pin(curve)
    steps = I.few_steps(curve)
    asked = [(i, *[rng.choice([None, float("nan"), -1.0, 2.0, rng.random(), rng.randrange(41) / 40]) for _ in range(3)]) for i in range(200)]
    asked = spark.createDataFrame(asked, "id int, a double, b double, z double")
    got = {r["id"]: r[1:] for r in I.values_of_steps(asked, steps, {0: "a", 1: "b", 2: "z"}).collect()}
    for of, name in enumerate("abz"):
        want = I.isotonic_values(curve, asked.select(F.lit(of).alias("fold"), "id", F.col(name).alias("x"))).collect()
        assert len(want) == 200
        for r in want:
            assert got[r["id"]][of] == (None if r["value"] is None else pytest.approx(r["value"], abs=1e-12))
    assert I.FEW_STEPS >= sum(s.shape[1] for s in steps.values()) and set(steps) == {0, 1}


@pytest.mark.parametrize("make", [lambda: M.forest(numTrees=3, maxDepth=3, minInstancesPerNode=5), lambda: M.boost(maxIter=3, maxDepth=2, minInstancesPerNode=5)])
def test_calibration_without_sorting_the_scores(spark, monkeypatch, make):
    rng = random.Random(4)
    rows = [(f"h{i % 150}", f"r{i % 560}", int(rng.random() < 0.2 + 0.4 * (i % 7 == 0)), rng.random() + (i % 7 == 0), rng.gauss(0, 1), 2000 + i % 3) for i in range(600)]
    df = M.assemble(spark.createDataFrame(rows, "strap string, row_id string, label int, x double, z double, year int"), ["x", "z"])
    train = pin(M.weighted(df).withColumn("_fold", M.fold_of("strap", 3)))
    sort = lambda found: sorted((r["row_id"], r["label"], r["score"]) for r in found.select("row_id", "label", "score").collect())
    with monkeypatch.context() as m:
        m.setattr(M, "few_steps", lambda curve: None)
        want = sort(M.calibrated(make, train, train))
    monkeypatch.setattr(M, "isotonic_values", None)
    for fold in (None, "_fold"):
        got = sort(M.calibrated(make, train, train, fold=fold))
        assert [g[:2] for g in got] == [w[:2] for w in want] and len(got) == 600
        assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=1e-12)


@pytest.mark.parametrize("groups", [[], ["g"], ["g", "h"]])
def test_lifts_of_the_best_rows_only(spark, monkeypatch, groups):
    rng = random.Random(5)
    score = lambda g: rng.choice([rng.random(), rng.randrange(4) / 4, None if g == "n" else 0.5, float("nan") if g in "mn" else 0.25])
    rows = [(g, i % 2, f"i{i % 1990:04d}-{j}", int(rng.random() < 0.1) if g != "z" else 0, score(g or "o"))
            for j, (g, k) in enumerate([("a", 4000), ("m", 900), ("n", 900), (None, 900), ("z", 500), ("s", 3), ("t", 1)]) for i in range(k)]
    rows += [("all", 0, f"i{i}", i % 2, None) for i in range(50)]
    df = pin(spark.createDataFrame(rows, "g string, h int, id string, y int, score double").repartition(5))
    sort = lambda found: sorted(map(repr, found.collect()))
    whole = E.lift_and_capture(df, groups)
    ranked = []
    monkeypatch.setattr(E, "ranked", lambda d, *more, real=E.ranked: ranked.append(d.count()) or real(d, *more))
    best = E.lift_and_capture(df, groups, only_top=True)
    assert sort(best) == sort(whole) and best.dtypes == whole.dtypes
    if groups:
        assert ranked[0] < 0.7 * len(rows)


def test_medians_beside_a_sketch(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(rng.choice([None, rng.gauss(0, 1)]), rng.randrange(3), None, rng.choice([0.0, 0.0, 5.5]), float(i), float("nan") if i % 5 == 0 else float(i)) for i in range(1001)]
    names = ["a", "b", "none", "tied", "even", "nan"]
    df = spark.createDataFrame(rows, "a double, b int, none double, tied double, even double, nan double").where("even > 0").repartition(4)
    kept = df.collect()
    want = {n: statistics.median(sorted((float("inf") if math.isnan(r[n]) else r[n] for r in kept if r[n] is not None))) if n != "none" else None for n in names}
    assert R.median_scalars(df, names) == want == R.exact_medians(df, names).first().asDict()
    monkeypatch.setattr(R, "SKETCH", 2 ** 31 - 1)  # the two values are one: what lies beside it is ordered whole
    monkeypatch.setattr(R, "BESIDE", 1)
    assert R.median_scalars(df, names) == want
    monkeypatch.undo()
    monkeypatch.setattr(R, "exact_medians", None)
    assert R.median_scalars(df, names[:5]) == {n: want[n] for n in names[:5]}
    assert R.median_scalars(df.limit(0), ["a"]) == {"a": None} and R.median_scalars(df, []) == {}
