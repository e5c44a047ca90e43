"""The model jobs against plain numpy on a fixed table."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors

from leadpanel.plans import models as M
from leadpanel.plans import survival as V

NAMES = ["strong", "weak", "noise", "copy"]


def logistic(x, y, weight, l1, l2, steps=60_000):
    """Coefficients that minimise the weighted mean log loss plus l1 |b| + l2 / 2 b^2, by proximal steps; the intercept is free."""
    x1 = np.column_stack([x, np.ones(len(x))])
    w = weight / weight.sum()
    size = 1 / (np.linalg.norm(x1 * np.sqrt(w)[:, None], 2) ** 2 / 4 + l2)
    b = ahead = np.zeros(x1.shape[1])
    t = 1.0
    for _ in range(steps):
        gradient = x1.T @ (w * (1 / (1 + np.exp(-x1 @ ahead)) - y)) + l2 * np.append(ahead[:-1], 0)
        new = ahead - size * gradient
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - size * l1, 0)
        after = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, moved = new + (t - 1) / after * (new - b), np.abs(new - b).max()
        b, t = new, after
        if moved < 1e-11:
            break
    return b


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(11)
    strong, weak, noise = rng.normal(size=(3, 600))
    x = np.column_stack([strong, weak, noise, strong + 0.1 * rng.normal(size=600)])
    y = (rng.random(600) < 1 / (1 + np.exp(2 - 1.5 * strong - 0.5 * weak))).astype(int)
    rows = [(f"h{i % 150}", f"r{i:04d}", int(label), Vectors.dense(v)) for i, (v, label) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["strap", "row_id", "label", "features"]).repartition(3), rows, x, y


def balanced(y):
    return len(y) / (2 * np.bincount(y)[y])


def test_linear_importance(table):
    data, _, x, y = table
    w, want = balanced(y), np.zeros(4)
    for mix, strength in ((1.0, 0.1), (0.0, 1.0), (0.5, 0.1)):
        strength = 1 / (strength * w.sum())
        b = np.abs(logistic(x, y, w, mix * strength, (1 - mix) * strength)[:-1])
        want += b / b.max() / 3
    got = M.linear_importance(data, "label", NAMES)
    assert [got[n] for n in NAMES] == pytest.approx(want.tolist(), abs=2e-3)


def place(key, seed):
    return int(hashlib.md5(f"{key}-{seed}".encode()).hexdigest()[:12], 16)


def lift(ids, y, score):
    k = max(1, len(y) // 10)
    top = sorted(range(len(y)), key=lambda i: (-score[i], ids[i]))[:k]
    return (sum(y[i] for i in top) / k) / (sum(y) / len(y))


def test_permutation_lift(table):
    """The partner of every held-out row by two orders of hashes; each feature swapped in turn."""
    data, rows, _, _ = table
    held = [r for r in rows if place(r[0], 42) % 1000 < 200]
    fit_rows, _ = M.split_by_group(data, "strap", 0.2, 42)
    model = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", maxIter=200).fit(M.class_balanced(fit_rows, "label"))
    w, b = model.coefficients.toArray(), model.intercept
    here = sorted(held, key=lambda r: (place(r[1], 42), r[1]))
    there = sorted(held, key=lambda r: (place(r[1], 43), r[1]))
    x, other = (np.array([r[3].toArray() for r in rows]) for rows in (here, there))
    y, ids = [r[2] for r in here], [r[1] for r in here]
    base = lift(ids, y, x @ w + b)
    want = {}
    for i, n in enumerate(NAMES):
        swapped = x.copy()
        swapped[:, i] = other[:, i]
        want[n] = max(0.0, base - lift(ids, y, swapped @ w + b))
    got = {r["feature"]: r["lift_drop"] for r in M.permutation_lift(data, "label", NAMES).collect()}
    assert got == pytest.approx(want, abs=1e-9) and max(want.values()) > 0


@pytest.mark.parametrize("threshold", [0.05, 0.8, 0.999])
def test_correlation_filter(table, threshold):
    data, _, x, _ = table
    matrix = np.abs(np.corrcoef(x.T))
    for ranked in (NAMES, NAMES[::-1], ["copy", "noise", "strong", "weak"]):
        want = []
        for n in ranked:
            if all(matrix[NAMES.index(n), NAMES.index(o)] <= threshold for o in want):
                want.append(n)
        assert M.drop_correlated(data, NAMES, ranked, threshold=threshold) == want


def test_coefficient_report(table):
    """Newton's steps for the likelihood and Wald's test."""
    data, _, x, y = table
    x1, b = np.column_stack([x, np.ones(len(x))]), np.zeros(5)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x1 @ b))
        information = x1.T @ (x1 * (p * (1 - p))[:, None])
        b = b + np.linalg.solve(information, x1.T @ (y - p))
    errors = np.sqrt(np.diag(np.linalg.inv(information)))
    got = M.coefficient_report(data, "label", NAMES).collect()
    for i, row in enumerate(got):
        p_value = math.erfc(abs(b[i] / errors[i]) / math.sqrt(2))
        assert (row["feature"], row["log_odds"], row["p_value"]) == (NAMES[i], pytest.approx(b[i], abs=1e-5), pytest.approx(p_value, abs=1e-4))
        assert row["odds_ratio"] == pytest.approx(math.exp(b[i]), rel=1e-4) and row["significant"] == (p_value < 0.05)


def test_discrete_hazard(spark):
    """Hazard ratios of the training homes by proximal steps; the risk list by the same coefficients."""
    rng = np.random.default_rng(5)
    rows = []
    for home in range(150):
        x, z = rng.normal(size=2)
        for year in range(2000, 2008):
            event = rng.random() < 1 / (1 + math.exp(3 - 1.5 * x))
            rows.append((f"h{home:03d}", year, int(event), float(x), float(z + year / 10)))
            if event:
                break
    periods = spark.createDataFrame(rows, "strap string, year int, hazard int, x double, z double").repartition(4)
    out = V.discrete_hazard(periods, ["x", "z"])
    values = np.array([[r[3], r[4]] for r in rows])
    scaled = (values - values.mean(0)) / values.std(0, ddof=1)
    train = np.array([place(r[0], 42) % 1000 >= 200 for r in rows])
    y = np.array([r[2] for r in rows])
    w = balanced(y[train])
    b = logistic(scaled[train], y[train], w, 1 / (0.1 * w.sum()), 0.0)
    got = out["ratios"].collect()
    assert [r["coef"] for r in got] == pytest.approx(b[:-1].tolist(), abs=2e-3)
    assert [r["hazard_ratio"] for r in got] == pytest.approx(np.exp(b[:-1]).tolist(), rel=5e-3)
    last = {r[0]: i for i, r in enumerate(rows)}
    adopters = {r[0] for r in rows if r[2]}
    want = {home: 1 / (1 + math.exp(-(scaled[i] @ b[:-1] + b[-1]))) for home, i in last.items() if home not in adopters}
    risk = {r["strap"]: r["score"] for r in out["risk"].collect()}
    assert risk == pytest.approx(want, abs=2e-3)
