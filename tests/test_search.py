import math
import random
from statistics import median

from leadpanel.plans import search as S


def judge(params, at):
    return params["a"] + 0.1 * at * math.sin(50 * params["b"])


SPACE = {"a": S.Real(0.01, 10.0, log=True), "b": S.Real(0.3, 1.0), "n": S.Whole(100, 500, 50), "kind": S.Choice(("x", "y"))}


def plain(trials, folds, startup, seed):
    """One trial after the other, each held against those before it at every fold."""
    done = []
    for n in range(trials):
        params, lifts, ended = S.draw(SPACE, n, seed), [], None
        for at in range(folds):
            lifts.append(judge(params, at))
            reached = [sum(o[:at + 1]) / (at + 1) for o, _ in done if len(o) > at]
            if at < folds - 1 and len(done) >= startup and reached and sum(lifts) / len(lifts) < median(reached):
                ended = at
                break
        done.append((lifts, ended))
    return done


def test_draws_lie_in_their_ranges_and_follow_the_seed():
    drawn = [S.draw(SPACE, n) for n in range(400)]
    assert drawn == [S.draw(SPACE, n) for n in range(400)] != [S.draw(SPACE, n, seed=1) for n in range(400)]
    assert {d["n"] for d in drawn} == set(range(100, 501, 50)) and {d["kind"] for d in drawn} == {"x", "y"}
    assert all(0.3 <= d["b"] <= 1 and 0.01 <= d["a"] <= 10 for d in drawn)
    assert 0.4 < sum(d["a"] < math.sqrt(0.1) for d in drawn) / 400 < 0.6  # half of them below the middle of the logarithm


def test_forty_draws_over_the_ranges():
    for space in (S.FOREST_SPACE, S.BOOST_SPACE):
        drawn = [S.draw(space, n) for n in range(40)]
        assert len({str(d) for d in drawn}) == 40
        assert all(isinstance(d["maxDepth"], int) and space["maxDepth"].low <= d["maxDepth"] <= space["maxDepth"].high for d in drawn)


def test_the_median_rule_does_not_depend_on_which_fit_ends_first():
    def shuffled(work, items):
        order = list(enumerate(items))
        random.Random(1).shuffle(order)
        found = {at: work(item) for at, item in order}
        return [found[at] for at in range(len(items))]

    got = S.search(SPACE, 40, 4, judge, run=shuffled)
    assert [(t.lifts, t.ended_at) for t in got] == plain(40, 4, S.STARTUP, 42)
    ended = [t for t in got if t.ended_at is not None]
    assert ended and all(t.number >= S.STARTUP and len(t.lifts) == t.ended_at + 1 for t in ended)
    assert max(got, key=lambda t: t.mean).ended_at is None


def test_a_search_over_models(spark):
    from leadpanel.plans import models as M

    rng = random.Random(2)
    rows = []
    for home in range(200):
        x = rng.random()
        for year in range(2000, 2006):
            rows.append((f"h{home}", year, f"{home}-{year}", int(rng.random() < 0.05 + 0.5 * (x > 0.8)), x, rng.random()))
    panel = spark.createDataFrame(rows, "strap string, year int, row_id string, solar_next_year int, x double, noise double")
    job = M.Job(panel, ("x", "noise"), (), 2000, 2006)
    space = {"numTrees": S.Whole(2, 4), "maxDepth": S.Whole(1, 3), "featureSubsetStrategy": S.Real(0.3, 1.0)}
    run = lambda: S.random_search(job, M.forest, space, [1990, 2004, 2005], trials=4, startup=1, calibrate=False).collect()
    found = run()
    assert [tuple(r) for r in found] == [tuple(r) for r in run()]
    assert sorted(r["place"] for r in found if r["status"] == "done") == list(range(1, 1 + sum(r["status"] == "done" for r in found)))
    assert all((r["ended_at"] is None) == (r["folds"] == 2) and r["ended_at"] in (None, 2004) for r in found)
    best = min((r for r in found if r["place"]), key=lambda r: r["place"])
    assert best["mean_lift"] == max(r["mean_lift"] for r in found if r["place"]) > 1
