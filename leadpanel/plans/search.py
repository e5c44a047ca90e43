"""Random search over parameters, with trials that fall behind ended early.

All trials that are left run one fold side by side; then the median rule is
applied in the order of the trials. So the result depends on the seed alone and
not on which fit ends first.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from statistics import median
from typing import Any

from pyspark.sql import DataFrame, functions as F

from leadpanel.plans.models import Job, calibrated, fold, lift_at, rows, scored, side_by_side
from leadpanel.session import held

c = F.col


@dataclass(frozen=True)
class Whole:
    """Whole numbers from ``low`` to ``high``, both included."""

    low: int
    high: int
    step: int = 1

    def draw(self, rng: random.Random) -> int:
        return self.low + self.step * rng.randrange((self.high - self.low) // self.step + 1)


@dataclass(frozen=True)
class Real:
    """Numbers from ``low`` to ``high``, even in their logarithm if asked."""

    low: float
    high: float
    log: bool = False

    def draw(self, rng: random.Random) -> float:
        if self.log:
            return math.exp(rng.uniform(math.log(self.low), math.log(self.high)))
        return rng.uniform(self.low, self.high)


@dataclass(frozen=True)
class Choice:
    values: tuple

    def draw(self, rng: random.Random) -> Any:
        return rng.choice(self.values)


Space = Mapping[str, Whole | Real | Choice]

# ---- fixed values: searched ranges ------------------------------------------------------
FOREST_SPACE: Space = {
    "numTrees": Whole(100, 500, 50), "maxDepth": Whole(5, 20), "minInstancesPerNode": Whole(5, 50), "featureSubsetStrategy": Real(0.3, 1.0),
}
BOOST_SPACE: Space = {
    "maxIter": Whole(100, 500, 50), "maxDepth": Whole(3, 8), "stepSize": Real(0.01, 0.3, log=True), "subsamplingRate": Real(0.6, 1.0),
    "minInstancesPerNode": Whole(10, 100),
}
#: Trials before any is ended early.
STARTUP = 10


def draw(space: Space, trial: int, seed: int = 42) -> dict[str, Any]:
    """The parameters of one trial; those of a trial do not depend on how many there are."""
    rng = random.Random(f"{seed}/{trial}")
    return {name: values.draw(rng) for name, values in space.items()}


@dataclass
class Trial:
    number: int
    params: dict[str, Any]
    lifts: list[float]
    ended_at: int | None = None  # place of the fold after which it was ended

    @property
    def mean(self) -> float:
        return sum(self.lifts) / len(self.lifts) if self.lifts else 0.0


def falls_behind(trial: Trial, before: Sequence[Trial], startup: int = STARTUP) -> bool:
    """Whether the mean so far lies below the median of the earlier trials' means over as many folds."""
    n = len(trial.lifts)
    means = [sum(t.lifts[:n]) / n for t in before if len(t.lifts) >= n]
    return len(before) >= startup and bool(means) and trial.mean < median(means)


def search(space: Space, trials: int, folds: int, judge: Callable[[dict[str, Any], int], float], seed: int = 42,
           startup: int = STARTUP, run: Callable = side_by_side) -> list[Trial]:
    """All trials with their lifts; ``judge`` gives the lift of some parameters on a fold."""
    every = [Trial(n, draw(space, n, seed), []) for n in range(trials)]
    left = every
    for at in range(folds):
        for trial, lift in zip(left, run(lambda t, at=at: judge(t.params, at), left)):
            trial.lifts.append(lift)
        if at < folds - 1:
            for trial in left:
                if falls_behind(trial, every[:trial.number], startup):
                    trial.ended_at = at
            left = [t for t in left if t.ended_at is None]
    return every


def random_search(job: Job, make: Callable, space: Space, years: Sequence[int], trials: int = 40, seed: int = 42,
                  calibrate: bool = True, startup: int = STARTUP) -> DataFrame:
    """``trial, params, status, ended_at, folds, mean_lift, place`` of every trial, by mean top-10 % lift over the years.

    ``ended_at`` is the install year after which a trial was ended; ended
    trials have no place.
    """
    with held(job.panel):
        kept = [(y, f) for y, f in zip(years, side_by_side(lambda y: fold(job, y), years)) if f is not None]
    if not kept:
        raise ValueError("no install year has a fold")

    def judge(params: dict[str, Any], at: int) -> float:
        train, test, _ = kept[at][1]
        own = {k: str(v) if k == "featureSubsetStrategy" else v for k, v in params.items()}
        found = calibrated(lambda: make(**own), train, test) if calibrate else scored(make(**own).fit(train), test)
        return float(lift_at(found.select(c("strap").alias("id"), c("label").alias("y"), "score")) or 0.0)

    with held(*[df for _, (train, test, _) in kept for df in (train, test)]):
        found = search(space, trials, len(kept), judge, seed, startup)
    best = sorted((t for t in found if t.ended_at is None), key=lambda t: (-t.mean, t.number))
    place = {t.number: i + 1 for i, t in enumerate(best)}
    return rows(job.panel.sparkSession, [
        (t.number, json.dumps(t.params, sort_keys=True), "done" if t.ended_at is None else "ended",
         None if t.ended_at is None else kept[t.ended_at][0], len(t.lifts), t.mean, place.get(t.number)) for t in found],
        "trial bigint, params string, status string, ended_at bigint, folds bigint, mean_lift double, place bigint")
