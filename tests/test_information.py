import math
import random

import pytest
from pyspark.sql import functions as F

from leadpanel.operators import information as N


def psi(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, n))


def brute(rows, k=3):
    """``{feature: mi}`` with every distance."""
    out = {}
    for f in {r[0] for r in rows}:
        own = [(y, x) for g, y, x in rows if g == f]
        size = {y: sum(1 for z, _ in own if z == y) for y, _ in own}
        own = [(y, x) for y, x in own if size[y] > 1]
        total = psi(len(own))
        for i, (y, x) in enumerate(own):
            kk = min(k, size[y] - 1)
            d = sorted(abs(v - x) for j, (z, v) in enumerate(own) if z == y and j != i)[kk - 1]
            m = sum(1 for _, v in own if abs(v - x) < d or v == x)
            total += (psi(kk) - psi(size[y]) - psi(m)) / len(own)
        out[f] = max(0.0, total)
    return out


def found(spark, rows, k=3):
    long = spark.createDataFrame(rows, "f int, y bigint, x double").repartition(5)
    return {r["f"]: r["mi"] for r in N.neighbour_information(long, k).collect()}


@pytest.mark.parametrize("k", [1, 3, 7])
def test_equals_all_distances(spark, k):
    """Log-normal, uniform, few whole numbers and a constant; three classes, one of them small, one of one row."""
    rng = random.Random(k)
    rows = []
    for i in range(300):
        y = rng.choice([0, 0, 0, 1])
        rows += [(0, y, math.exp(rng.gauss(2 * y, 2))), (1, y, rng.random()), (2, y, float(rng.randrange(5) + 2 * y)), (3, y, 1.0)]
    rows += [(f, 2, float(i)) for f in range(4) for i in range(3)] + [(f, 3, 0.5) for f in range(4)]
    got, want = found(spark, rows, k), brute(rows, k)
    assert got.keys() == want.keys()
    for f in want:
        assert got[f] == pytest.approx(want[f], abs=1e-9), f
    assert got[0] > got[1] + 0.05


def test_a_skewed_feature_tells_as_much_as_its_logarithm(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(1500):
        y = rng.randrange(2)
        x = rng.gauss(1.5 * y, 1)
        rows += [(0, y, x), (1, y, math.exp(4 * x))]
    got = found(spark, rows)
    assert got[0] > 0.15 and got[1] == pytest.approx(got[0], abs=0.05)


def test_noise_parts_equal_values_and_is_the_same_each_time(spark):
    """A flag that follows the class tells nearly all of it, a flag by chance nothing; order and partitions do not matter."""
    rng = random.Random(2)
    rows = [(f"k{i}", i % 2, float(i % 2), float(rng.randrange(2)), None if i % 5 else 1.0) for i in range(800)]
    table = spark.createDataFrame(rows, "row_id string, label int, follows double, chance double, rare double")
    first, second = (
        {r["f"]: r["mi"] for r in N.neighbour_information(N.unpivoted(df, ["follows", "chance", "rare"], "label", "row_id")).collect()}
        for df in (table.repartition(3), table.orderBy(F.desc("row_id")).repartition(7)))
    assert first == pytest.approx(second, abs=1e-12)
    assert first[0] == pytest.approx(math.log(2), abs=0.02) and first[1] < 0.05


def test_digamma(spark):
    values = [1, 2, 3, 10, 1000]
    got = spark.createDataFrame([(v,) for v in values], "n bigint").select(N.digamma(F.col("n")).alias("p")).collect()
    assert [r["p"] for r in got] == pytest.approx([psi(v) for v in values], abs=1e-11)
    assert [N.digamma(v) for v in values] == pytest.approx([psi(v) for v in values], abs=1e-11)


def test_no_rows(spark):
    assert found(spark, []) == {} and found(spark, [(0, 1, 2.0)]) == {}
