import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from leadpanel.operators import isotonic as I

SCHEMA = "fold bigint, x double, y double, w double"


def plain_pav(rows):
    """``{x: fitted}`` by the plain loop over sorted distinct scores."""
    summed = defaultdict(lambda: [0.0, 0.0])
    for x, y, w in rows:
        summed[x][0] += w
        summed[x][1] += w * y
    stack = []
    for x in sorted(summed):
        xs, (w, wy) = [x], summed[x]
        while stack and stack[-1][2] / stack[-1][1] >= wy / w:
            before, bw, bwy = stack.pop()
            xs, w, wy = before + xs, w + bw, wy + bwy
        stack.append((xs, w, wy))
    return {x: wy / w for xs, w, wy in stack for x in xs}


def fitted(spark, rows, at=None, **more):
    points = spark.createDataFrame(rows, SCHEMA)
    curve = I.isotonic_curve(points, **more)
    wanted = points.select("fold", "x").distinct() if at is None else spark.createDataFrame(at, "fold bigint, x double")
    return {(r["fold"], r["x"]): r["value"] for r in I.isotonic_values(curve, wanted).collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key], abs=1e-12), key


@pytest.mark.parametrize("shape", ["noise", "rising", "falling", "steps", "late_drop"])
@pytest.mark.parametrize("ends", [1, 8])
def test_equals_a_plain_loop(spark, shape, ends):
    """Falling labels pool whole runs into one block; a drop at the end pools back through several."""
    rng = random.Random(shape)
    rows = []
    for fold in range(2):
        for i in range(600):
            x = rng.choice([rng.random(), round(rng.random(), 2)])
            y = {"noise": rng.random() < x, "rising": x, "falling": 1 - x, "steps": int(x * 7) / 7, "late_drop": x if x < 0.9 else -5.0}[shape]
            rows.append((fold, x, float(y), rng.choice([0.5, 1.0, 2.0])))
    want = {(fold, x): v for fold in range(2) for x, v in plain_pav([r[1:] for r in rows if r[0] == fold]).items()}
    same(fitted(spark, rows, ends=ends), want)


def test_scores_that_differ_in_the_seventh_digit(spark):
    """At a low base rate nearly all scores lie close together; each keeps its own value."""
    rows = [(0, 0.0025 + i * 1e-7, float(i % 20 < i / 20), 1.0) for i in range(400)]
    want = {(0, x): v for x, v in plain_pav([r[1:] for r in rows]).items()}
    got = fitted(spark, rows)
    same(got, want)
    assert len(set(got.values())) > 5


def test_between_and_beyond_the_steps(spark):
    rows = [(0, 0.2, 0.0, 1.0), (0, 0.4, 0.0, 1.0), (0, 0.6, 1.0, 1.0), (0, 0.8, 0.5, 1.0)]
    got = fitted(spark, rows, at=[(0, -9.0), (0, 0.3), (0, 0.5), (0, 0.7), (0, 99.0), (1, 0.5), (0, None)])
    assert got[(0, -9.0)] == 0 and got[(0, 0.3)] == 0 and got[(0, 0.5)] == pytest.approx(0.375)
    assert got[(0, 0.7)] == pytest.approx(0.75) and got[(0, 99.0)] == pytest.approx(0.75)
    assert got[(1, 0.5)] is None and got[(0, None)] is None


def test_constant_labels_ties_and_rows_that_do_not_count(spark):
    rows = [(0, float(i % 3), 1.0, 1.0) for i in range(30)] + [(1, 0.5, float(i % 2), 1.0) for i in range(10)]
    rows += [(0, None, 0.0, 1.0), (0, float("nan"), 0.0, 1.0), (0, 1.0, None, 1.0), (0, 1.0, 0.0, 0.0), (0, 1.0, 0.0, None)]
    got = fitted(spark, rows, at=[(0, 0.0), (0, 1.7), (1, 0.1), (1, 0.9)])
    assert got == {(0, 0.0): 1.0, (0, 1.7): 1.0, (1, 0.1): 0.5, (1, 0.9): 0.5}


def test_no_rows(spark):
    assert fitted(spark, [], at=[(0, 1.0)]) == {(0, 1.0): None}
    curve = I.isotonic_curve(spark.createDataFrame([(0, 1.0, 1.0, 1.0)], SCHEMA))
    assert I.isotonic_values(curve, spark.createDataFrame([], "fold bigint, x double")).count() == 0


def test_only_run_ends_reach_the_driver(spark, monkeypatch):
    """A rising curve is as long as its table; eight blocks from either end of a run are asked for."""
    seen = []
    plain = I.pool_ends
    monkeypatch.setattr(I, "pool_ends", lambda runs: (seen.extend(len(r.blocks) for r in runs), plain(runs))[1])
    rows = spark.range(5000).select(F.lit(0).cast("bigint").alias("fold"), F.col("id").cast("double").alias("x"),
                                    F.col("id").cast("double").alias("y"), F.lit(1.0).alias("w"))
    assert I.isotonic_curve(rows).count() == 5000
    assert seen and max(seen) <= 2 * I.ENDS
