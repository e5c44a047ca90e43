import math
import random

import numpy as np
import pytest

from leadpanel.plans import survival as V


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = []
    for i in range(200):
        x = round(rng.gauss(0, 1), 1)
        t = max(1, min(6, int(rng.expovariate(0.25 * math.exp(0.5 * x))) + 1))
        out.append((str(i), t, int(t < 6 and rng.random() < 0.8), x, float(rng.randint(0, 3))))
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "strap string, duration bigint, event int, x double, z double")


def test_concordance(frame, rows):
    good = total = 0.0
    for a in rows:
        for b in rows:
            if a[2] and (b[1] > a[1] or (b[1] == a[1] and not b[2])):
                total += 1
                good += (a[3] > b[3]) + (a[3] == b[3]) / 2
    assert V.concordance(frame, "x").first()[0] == pytest.approx(good / total)


def test_kaplan_meier(frame, rows):
    got = {(r["z"], r["duration"]): r["survival"] for r in V.kaplan_meier(frame, "z").collect()}
    for z in {r[4] for r in rows}:
        s = 1.0
        for t in sorted({r[1] for r in rows if r[4] == z}):
            here = [r for r in rows if r[4] == z]
            at_risk, died = sum(r[1] >= t for r in here), sum(r[1] == t and r[2] for r in here)
            s *= 1 - died / at_risk
            assert got[(z, t)] == pytest.approx(s)


def test_curve_that_ends_at_zero(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 1)], "g string, duration bigint, event int")
    assert [r["survival"] for r in V.kaplan_meier(df, "g").orderBy("duration").collect()] == [0.5, 0.0]


def test_cox_gradient_is_zero(frame, rows):
    """The fitted coefficients maximise the penalised Efron likelihood, written out term by term."""
    fit = V.cox_fit(frame, ["x", "z"])
    data = np.array([[r[3], r[4]] for r in rows])
    dev = data.std(axis=0, ddof=1)
    scaled = (data - data.mean(axis=0)) / dev
    beta = np.array([f["coef"] for f in fit]) * dev

    def value(b):
        total, w = -0.5 * 0.1 * len(rows) * b @ b, np.exp(scaled @ b)
        for t in {r[1] for r in rows}:
            risk = np.array([r[1] >= t for r in rows])
            died = np.array([bool(r[1] == t and r[2]) for r in rows])
            d = died.sum()
            total += (scaled[died] @ b).sum()
            total -= sum(np.log(w[risk].sum() - i / d * w[died].sum()) for i in range(d))
        return total

    for i in range(2):
        step = np.zeros(2)
        step[i] = 1e-4
        assert abs(value(beta + step) - value(beta - step)) / 2e-4 < 1e-3
        assert value(beta) > value(beta + 100 * step)


def test_durations(spark):
    panel = spark.createDataFrame(
        [("a", y, int(y >= 2002)) for y in range(2000, 2005)] + [("b", y, 0) for y in range(2000, 2005)]
        + [("c", 2000, 1)], "strap string, year int, adopted int")
    times = V.durations(panel)
    assert sorted((r["strap"], r["duration"], r["event"]) for r in times.collect()) == [("a", 2, 1), ("b", 4, 0), ("c", 1, 1)]
    periods = V.person_periods(panel.drop("adopted"), times)
    assert periods.count() == 3 + 5 + 1 and periods.where("hazard = 1").count() == 2


def test_many_ties_have_a_closed_form():
    import numpy as np

    for a, b, events in ((5.0, 2.0, 20_000), (3.0e6, 2.9e6, 30_000), (7.0, 7.0, 15_000)):
        r = 1.0 / (a - np.arange(events) / events * b)
        got = V._tie_sums(a, b, events)
        assert abs(got[0] / r.sum() - 1) < 1e-9 and abs(got[1] / (r * r).sum() - 1) < 1e-8


def pairs(rows):
    """Concordance over all pairs."""
    good = total = 0
    for d, e, r in rows:
        for d2, e2, r2 in rows if e else ():
            if d2 > d or (d2 == d and not e2):
                total += 1
                good += 1 if r > r2 else 0.5 if r == r2 else 0
    return good / total if total else None


@pytest.mark.parametrize("times", [3, 500])
def test_concordance_of_a_real_risk_over_all_pairs(spark, times):
    """Few times and nearly as many times as homes; risks with and without ties."""
    rng = random.Random(times)
    rows = [(rng.randrange(1, times + 1), int(rng.random() < 0.4), rng.choice([rng.random(), round(rng.random(), 1)])) for _ in range(500)]
    df = spark.createDataFrame(rows + [(1, 1, None)], "duration bigint, event int, risk double")
    assert V.concordance(df, "risk").first()[0] == pytest.approx(pairs(rows), abs=1e-12)


def test_concordance_without_pairs(spark):
    schema = "duration bigint, event int, risk double"
    for rows in ([], [(1, 0, 0.5), (2, 0, 0.1)], [(3, 1, 0.5)]):
        assert V.concordance(spark.createDataFrame(rows, schema), "risk").first()[0] is None


def test_cox_report(spark):
    """A risk that hangs on one feature: it is significant, the noise is not, and unseen homes are ordered by it."""
    rng = random.Random(8)
    rows, marks = [], []
    for home in range(500):
        x, noise = rng.gauss(0, 1), rng.gauss(0, 1)
        year = next((y for y in range(2001, 2012) if rng.random() < 0.04 * math.exp(1.2 * x)), None)
        for y in range(2000, 2012):
            rows.append((f"h{home}", y, math.expm1(x + 5) if home % 50 or y < 2005 else None, noise if home % 7 else None))
        marks.append((f"h{home}", (year or 2011) - 2000, int(year is not None)))
    panel = spark.createDataFrame(rows, "strap string, year int, amount double, noise double")
    times = spark.createDataFrame(marks, "strap string, duration bigint, event int")
    out = V.cox_report(times, panel, ["amount", "noise"], ["amount"], penalty=0.001)
    found = {r["feature"]: r for r in out.features.collect()}
    assert found["amount"]["coef"] == pytest.approx(1.2, abs=0.25) and found["amount"]["p_value"] < 1e-6
    assert found["noise"]["p_value"] > 0.01 and found["amount"]["hazard_ratio"] == pytest.approx(math.exp(found["amount"]["coef"]))
    risks = out.risks.collect()
    for row in out.concordance.collect():
        own = [(r["duration"], r["event"], r["risk"]) for r in risks if r["part"] == row["part"]]
        assert row["homes"] == len(own) and row["c_index"] == pytest.approx(pairs(own), abs=1e-12) and row["c_index"] > 0.65
    assert {r["part"] for r in risks} == {"train", "test"} and 60 < sum(r["part"] == "test" for r in risks) < 140


def test_cox_fit_is_where_the_likelihood_is_flat(spark):
    """Numpy's gradient of the penalised Efron likelihood vanishes at the fit."""
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 2))
    d, e = rng.integers(1, 6, 120), rng.integers(0, 2, 120)
    rows = [(int(a), int(b), float(p), float(q)) for a, b, (p, q) in zip(d, e, x)]
    fit = V.cox_fit(spark.createDataFrame(rows, "duration bigint, event int, p double, q double"), ["p", "q"], penalty=0.1)
    z = (x - x.mean(0)) / x.std(0, ddof=1)

    def likelihood(beta):
        w, total = np.exp(z @ beta), -0.1 * len(z) / 2 * beta @ beta
        for t in np.unique(d[e == 1]):
            tied, risk = (d == t) & (e == 1), w[d >= t].sum()
            n = tied.sum()
            total += (z[tied] @ beta).sum() - sum(math.log(risk - i / n * w[tied].sum()) for i in range(n))
        return total

    beta = np.array([r["coef"] for r in fit]) * x.std(0, ddof=1)
    gradient = [(likelihood(beta + s) - likelihood(beta - s)) / 2e-5 for s in (np.array([1e-5, 0]), np.array([0, 1e-5]))]
    assert np.abs(gradient).max() < 1e-4
