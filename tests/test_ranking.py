"""Global order, ties and quantiles against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadpanel.operators import metrics as E
from leadpanel.operators import ranking as K


@pytest.fixture(scope="module")
def data(spark):
    """A third of the rows share one score and one group; one group is tiny, one empty of positives."""
    rng = random.Random(3)
    rows = []
    for i in range(900):
        group = "hot" if i % 3 else rng.choice(["a", "b", None])
        score = 0.5 if i % 3 == 1 else round(rng.random(), 2)
        rows.append((i, group, int(rng.random() < 0.2), score))
    rows.append((900, "one", 1, 0.3))
    rows.append((901, "none", 0, 0.3))
    return rows


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(data, "id bigint, g string, y int, score double").repartition(7)


def by_group(data):
    groups = {}
    for r in data:
        groups.setdefault(r[1], []).append(r)
    return groups


def test_positions(frame, data):
    got = {r["id"]: (r["position"], r["n_rows"]) for r in K.add_position(frame, [F.desc("score"), F.asc("id")], ["g"]).collect()}
    want = {}
    for rows in by_group(data).values():
        for i, r in enumerate(sorted(rows, key=lambda r: (-r[3], r[0]))):
            want[r[0]] = (i + 1, len(rows))
    assert got == want


def test_positions_without_groups_and_empty(frame, data):
    got = [r["id"] for r in sorted(K.add_position(frame, [F.desc("score"), F.asc("id")]).collect(), key=lambda r: r["position"])]
    assert got == [r[0] for r in sorted(data, key=lambda r: (-r[3], r[0]))]
    assert K.add_position(frame.limit(0), [F.asc("id")]).count() == 0


def test_running_sums(frame, data):
    got = {r["id"]: r["cum_y"] for r in K.add_running_sums(frame, [F.asc("id")], ["y"], ["g"]).collect()}
    for rows in by_group(data).values():
        total = 0
        for r in sorted(rows):
            total += r[2]
            assert got[r[0]] == total


def test_average_ranks(frame, data):
    got = {r["score"]: r["avg_rank"] for r in K.tie_ranks(frame, "score").collect()}
    scores = sorted(r[3] for r in data)
    for s, rank in got.items():
        places = [i + 1 for i, v in enumerate(scores) if v == s]
        assert rank == pytest.approx(sum(places) / len(places))


def test_quantiles(frame, data):
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r["g"], r["prob"]): r["quantile"] for r in K.exact_quantiles(frame, ["score"], probs, ["g"]).collect()}
    for g, rows in by_group(data).items():
        for p in probs:
            assert got[(g, p)] == pytest.approx(np.quantile([r[3] for r in rows], p))


def test_quantiles_skip_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (4.0,)], "v double")
    assert K.median_scalars(df, ["v"]) == {"v": 2.5}
    assert K.median_scalars(df.where("v > 9"), ["v"]) == {"v": None}


def test_lift_and_deciles(frame, data):
    got = {r["g"]: r for r in E.lift_and_capture(frame, ["g"]).collect()}
    slices = {}
    for r in E.decile_lift(frame, ["g"]).collect():
        slices.setdefault(r["g"], {})[r["decile"]] = r
    for g, rows in by_group(data).items():
        order = [r[2] for r in sorted(rows, key=lambda r: (-r[3], r[0]))]
        n, p = len(order), sum(order)
        for key, share in E.TOP_SHARES.items():
            k = max(1, int(n * share))
            want = sum(order[:k]) / k / (p / n) if p else 0
            assert got[g][f"lift_{key}"] == pytest.approx(want)
        if not p:
            assert g not in slices
            continue
        for d in range(10):
            part = order[int(n * d / 10):int(n * (d + 1) / 10)]
            if part:
                assert (slices[g][d + 1]["n"], slices[g][d + 1]["captured"]) == (len(part), sum(part))
            else:
                assert d + 1 not in slices[g]
        assert sum(s["capture_pct"] for s in slices[g].values()) == pytest.approx(1)


def test_auc_and_precision(frame, data):
    pos, neg = [r[3] for r in data if r[2]], [r[3] for r in data if not r[2]]
    want = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    assert E.roc_auc(frame).first()[0] == pytest.approx(want)
    steps, hit, seen = 0.0, 0, 0
    for s in sorted({r[3] for r in data}, reverse=True):
        now = [r[2] for r in data if r[3] == s]
        hit, seen = hit + sum(now), seen + len(now)
        steps += sum(now) / len(pos) * hit / seen
    assert E.average_precision(frame).first()[0] == pytest.approx(steps)


def test_decile_labels(spark):
    df = spark.range(40).select(F.col("id"), F.col("id").cast("double").alias("score"))
    got = [r["decile"] for r in E.position_decile(df).orderBy(F.desc("score")).collect()]
    assert got[:5] == [0.5, 0.5, 1.0, 1.0, 2.0] and got[-1] == 10.0


def test_weights():
    assert len(E.simplex_weights(2)) == 11
    assert all(abs(sum(w) - 1) < 1e-9 for w in E.simplex_weights(3))
