import numpy as np
import pytest

from leadpanel.llm import vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int, rep string, component_id int"


def brute(rows, threshold):
    sound = {}
    for at, (vec_id, e, label, *_) in enumerate(rows):
        if vec_id is None or label is None or not e or any(x is None or not np.isfinite(x) for x in e) or not any(e):
            continue
        v = np.array(e, np.float32).astype(np.float64)
        sound[at] = (label, v / np.linalg.norm(v))
    links = {at: [b for b in sound if b != at and sound[b][0] == label and len(sound[b][1]) == len(v) and sound[b][1] @ v >= threshold]
             for at, (label, v) in sound.items()}
    out = []
    for at, row in enumerate(rows):
        seen, todo = {at}, [at]
        while todo:
            todo += [x for x in links.get(todo.pop(), []) if x not in seen and not seen.add(x)]
        component = min((rows[x][0] for x in seen), default=None) if row[0] is not None else None
        out.append((row[0], len(links.get(at, [])), component, row[0] == component))
    return sorted(out, key=repr)


def run(spark, rows, threshold=0.93, **more):
    out = vectors.near_vectors(spark.createDataFrame(rows, SCHEMA), threshold, **more)
    return sorted(map(tuple, out.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


def test_nulls_ties_repeats_and_lengths(spark):
    one = [1.0, 0.0, 0.5]
    rows = [
        (1, one, 0, "x", 1), (2, one, 0, None, None), (3, [1.0, -0.0, 0.5], 0, None, None), (4, one, 1, None, None), (5, one, None, None, None),
        (6, [2.0, 0.0, 1.0], 0, None, None), (7, [0.0, 0.0, 0.0], 0, None, None), (8, None, 0, None, None), (9, [1.0, None, 0.5], 0, None, None),
        (10, [float("nan"), 0.0, 1.0], 0, None, None), (11, [float("inf"), 0.0, 1.0], 0, None, None), (12, [], 0, None, None),
        (13, [1.0, 0.0], 0, None, None), (14, [1.0, 0.01], 0, None, None), (None, one, 0, None, None), (15, [-1.0, 0.0, -0.5], 0, None, None),
        (16, one, 0, None, None), (16, one, 0, None, None),
    ]
    assert run(spark, rows) == brute(rows, 0.93)


def clustered(rng, groups, size, dim, noise):
    rows, at = [], 0
    for _ in range(groups):
        centre = rng.standard_normal(dim)
        for _ in range(size):
            rows.append((at, [float(np.float32(x)) for x in centre + noise * rng.standard_normal(dim)], at % 2, None, None))
            at += 1
    return rows


@pytest.mark.parametrize("groups, size, noise", [(60, 4, 0.15), (2, 150, 0.1), (5, 40, 0.28)])
def test_against_all_pairs(spark, groups, size, noise):
    rows = clustered(np.random.default_rng(groups), groups, size, 32, noise)
    got, expected = run(spark, rows), brute(rows, 0.93)
    found, every = sum(r[1] for r in got), sum(r[1] for r in expected)
    assert found >= 0.99 * every
    assert all(a[1] <= b[1] for a, b in zip(got, expected))


def test_links_are_whole_beyond_the_window(spark):
    rows = clustered(np.random.default_rng(1), 1, 120, 16, 0.01)
    assert run(spark, rows, window=4) == brute(rows, 0.93)


def test_blocks_and_runs_are_joined(spark, monkeypatch):
    monkeypatch.setattr(vectors, "RUN", 40)
    monkeypatch.setattr(vectors, "BLOCK", 16)
    rows = clustered(np.random.default_rng(2), 3, 50, 16, 0.02)
    assert run(spark, rows) == brute(rows, 0.93)


def test_empty_and_lonely(spark):
    assert run(spark, []) == []
    assert run(spark, [(5, [1.0], 0, None, None)]) == [(5, 0, 5, True)]


def test_more_vectors_need_more_passes():
    assert vectors.passes_for(10, 0.93) == 1
    assert vectors.passes_for(5_000, 0.93) < vectors.passes_for(5_000_000, 0.93)


def pair_rows(rng, base, singles, pairs, dense, cosine=0.935, dim=64):
    """Vectors whose cosine to each other is about ``base``, each pair at ``cosine``; ``dense`` more close to one centre."""
    def unit(x):
        return x / np.linalg.norm(x, axis=-1, keepdims=True)

    def off(x):
        y = rng.standard_normal(x.shape)
        return unit(y - (x * y).sum(-1, keepdims=True) * x)

    centre = unit(rng.standard_normal(dim))
    every = unit(np.sqrt(base) * centre + np.sqrt(1 - base) * off(np.tile(centre, (singles + pairs, 1))))
    mates = cosine * every[:pairs] + np.sqrt(1 - cosine ** 2) * off(every[:pairs])
    hot = 0.985 * centre + np.sqrt(1 - 0.985 ** 2) * off(np.tile(centre, (dense, 1)))
    return [(at, [float(np.float32(x)) for x in v], 0, None, None) for at, v in enumerate(np.vstack([every, mates, hot]))]


@pytest.mark.parametrize("base, dense", [(0.0, 0), (0.8, 0), (0.85, 0), (0.75, 700)])
def test_pairs_among_vectors_that_lie_close_are_found(spark, base, dense):
    rows = pair_rows(np.random.default_rng(7), base, 1400, 150, dense)
    got, expected = run(spark, rows, window=4), brute(rows, 0.93)
    assert sum(r[1] > 0 for r in expected) >= 300
    missed = sum(a != b for a, b in zip(got, expected))
    assert missed <= 0.005 * sum(r[1] > 0 for r in expected)


def test_full_ranges_are_compared_by_pass_where_that_is_less(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    rng = np.random.default_rng(8)
    rows = pair_rows(rng, 0.85, 60, 20, 0)
    rows += [(1000 + at, [float(x) for x in rng.standard_normal(64).astype(np.float32)], 0, None, None) for at in range(1500)]
    assert run(spark, rows, window=4) == brute(rows, 0.93)
