"""Mutual information of numbers with a class, from nearest neighbours in one dimension.

For each value the distance to its k-th neighbour of its own class is taken, and
all values nearer than that are counted. In one dimension both need only sorted
runs: the k-th neighbour stands among the k rows on either side, and the count
is the difference of two places in the run. No pairs are formed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from leadpanel.operators.runs import scan, sorted_runs, summaries
from leadpanel.session import pin

c = F.col

NEIGHBOURS = 3
#: Share of a feature's deviation by which equal values are moved apart.
NOISE = 1e-10
#: Coefficients of the asymptotic series of the digamma function in 1 / z**2.
_SERIES = (-1 / 12, 1 / 120, -1 / 252, 1 / 240, -1 / 132)


def digamma(n: Column | float) -> Column | float:
    """Logarithmic derivative of the gamma function, for numbers from 1."""
    z = n + 6.0
    log = F.log(z) if isinstance(n, Column) else math.log(z)
    return log - 0.5 / z + sum(k / _power(z, 2 * i) for i, k in enumerate(_SERIES, 1)) - sum(1.0 / (n + i) for i in range(6))


def _power(z, n: int):
    out = z
    for _ in range(n - 1):
        out = out * z
    return out


def unpivoted(data: DataFrame, features: Sequence[str], label: str, key: str, noise: float = NOISE, seed: int = 42) -> DataFrame:
    """``f, y, x``: one row per feature and row; with noise, values are scaled and equal ones moved apart by a hash of the key.

    ``f`` is the feature's place; rows without a label or value are left out.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("f"), c(n).cast("double").alias("x")) for i, n in enumerate(features)])
    long = data.where(c(label).isNotNull()).select(c(label).cast("bigint").alias("y"), c(key).alias("_key"), F.explode(pairs).alias("p")).select(
        "y", "_key", "p.*").where("x IS NOT NULL AND NOT isnan(x)")
    if not noise:
        return long.select("f", "y", "x")
    spread = long.groupBy("f").agg(F.stddev_pop("x").alias("_s"), F.avg(F.abs("x")).alias("_m"))
    scale = F.when(c("_s") > 0, c("_s")).otherwise(1.0)
    # Two uniform numbers from hashes of key and feature make a normal one.
    uniform = lambda n: (F.shiftrightunsigned(F.xxhash64(c("_key"), c("f"), F.lit(seed + n)), 11) + 1) / float(2**53 + 1)
    normal = F.sqrt(-2 * F.log(uniform(0))) * F.cos(2 * math.pi * uniform(1))
    moved = c("x") / scale + noise * F.greatest(F.lit(1.0), c("_m") / scale) * normal
    return long.join(F.broadcast(spread), "f").select("f", "y", moved.alias("x"))  # one row per feature


@dataclass
class Group:
    """The rows of one feature and class in one run."""

    n: int
    first: float
    last: float
    head: list[float]
    tail: list[float]
    before: list[float] = field(default_factory=list)
    after: list[float] = field(default_factory=list)


Key = tuple[int, int]  # feature and class
Bound = tuple[int, float, bool]  # feature, value, and whether rows of that value count too


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Feature, classes and values of the stretches of one feature."""
    f, y, x = (batch.column(n).to_numpy() for n in ("f", "y", "x"))
    cuts = np.flatnonzero(f[1:] != f[:-1]) + 1
    for low, high in zip([0, *cuts], [*cuts, len(f)]):
        yield int(f[low]), y[low:high], x[low:high]


def _groups(runs: DataFrame, k: int) -> dict[int, dict[Key, Group]]:
    """What each run holds of each feature and class, with up to k values of that class that stand before and after the run."""

    def summary(batches: Iterator[pa.RecordBatch]) -> dict:
        found: dict[Key, Group] = {}
        for batch in batches:
            for f, y, x in _chunks(batch):
                for of in np.unique(y):
                    own = x[y == of]
                    group = found.setdefault((f, int(of)), Group(0, float(own[0]), 0.0, [], []))
                    group.n += len(own)
                    group.last = float(own[-1])
                    group.head = [*group.head, *own[:k].tolist()][:k]
                    group.tail = [*group.tail, *own[-k:].tolist()][-k:]
        return {"groups": [{"f": f, "y": y, "n": g.n, "first": g.first, "last": g.last, "head": g.head, "tail": g.tail} for (f, y), g in found.items()]}

    rows = summaries(runs, summary, "groups array<struct<f int, y bigint, n bigint, first double, last double, head array<double>, tail array<double>>>")
    out = {row["_run"]: {(g["f"], g["y"]): Group(g["n"], g["first"], g["last"], g["head"], g["tail"]) for g in row["groups"]} for row in rows}
    for numbers, near, held in ((sorted(out), "tail", "before"), (sorted(out, reverse=True), "head", "after")):
        seen: dict[Key, list[float]] = {}
        for run in numbers:
            for key, group in out[run].items():
                setattr(group, held, seen.get(key, []))
                both = [*seen.get(key, []), *group.tail][-k:] if near == "tail" else [*group.head, *seen.get(key, [])][:k]
                seen[key] = both
    return out


def neighbour_bounds(x: np.ndarray, own: slice, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The open interval around each own value that ends at its k-th neighbour's distance; ``x`` is sorted."""
    at = np.arange(len(x))[own]
    here = x[own]
    near = np.full(len(here), np.inf)
    low, high = np.full(len(here), -np.inf), np.full(len(here), np.inf)
    for left in range(k + 1):
        a, b = at - left, at + k - left
        fits = (a >= 0) & (b < len(x))
        start, end = x[np.clip(a, 0, None)], x[np.clip(b, None, len(x) - 1)]
        distance = np.where(fits, np.maximum(here - start, end - here), np.inf)
        better = distance < near
        near = np.where(better, distance, near)
        # The farther side ends at the neighbour itself, the other one as far away.
        low = np.where(better, np.where(here - start >= end - here, start, here - distance), low)
        high = np.where(better, np.where(end - here >= here - start, end, here + distance), high)
    return low, high


def _ranges(groups: dict[Key, Group]) -> dict[int, tuple[float, float]]:
    """First and last value of each feature in a run, of all classes."""
    out: dict[int, tuple[float, float]] = {}
    for (f, _), g in groups.items():
        low, high = out.get(f, (g.first, g.last))
        out[f] = min(low, g.first), max(high, g.last)
    return out


def _settled(runs: DataFrame, held: dict[int, dict[Key, Group]], counts: dict[Key, int], k: int) -> DataFrame:
    """``f, m, n``: how many rows have how many values within reach, as far as the run itself holds all of these.

    Others have a null ``m`` and their interval in ``low, high``, ``same`` where it is one value. For each
    class these are at most k different intervals from either end of a run and one that is a single value.
    """
    names = ["f", "low", "high", "same", "m", "n"]
    kinds = [pa.int32(), pa.float64(), pa.float64(), pa.bool_(), pa.int64(), pa.int64()]
    at = {f: [] for f, _ in counts}
    for run in sorted(held):
        for f in _ranges(held[run]):
            at.setdefault(f, []).append(run)
    ends = {f: (numbers[0], numbers[-1]) for f, numbers in at.items() if numbers}

    def step(batches: Iterator[pa.RecordBatch], own: tuple[int, dict[Key, Group], dict]) -> Iterator[pa.RecordBatch]:
        run, groups, run_ends = own
        ranges = _ranges(groups)

        def out(f: int, y: np.ndarray, x: np.ndarray) -> Iterator[pa.RecordBatch]:
            classes = [of for of in np.unique(y) if (f, int(of)) in counts]
            x_all = x if len(classes) == len(np.unique(y)) else x[np.isin(y, classes)]
            low_end, high_end = ranges[f]
            first, last = run == run_ends[f][0], run == run_ends[f][1]
            for of in classes:
                mine, group = x[y == of], groups[f, int(of)]
                line = np.concatenate([group.before, mine, group.after])
                low, high = neighbour_bounds(line, slice(len(group.before), len(group.before) + len(mine)), min(k, counts[f, int(of)] - 1))
                same = low == high  # the k-th neighbour has the same value: count all that have it
                m = np.where(same, np.searchsorted(x_all, high, "right") - np.searchsorted(x_all, low, "left"),
                             np.searchsorted(x_all, high, "left") - np.searchsorted(x_all, low, "right"))
                inside = (first | (low > low_end) | (~same & (low == low_end))) & (last | (high < high_end) | (~same & (high == high_end)))
                found, n = np.unique(m[inside], return_counts=True)
                none = [None] * len(found)
                rest, times = np.unique(np.stack([low[~inside], high[~inside]]), axis=1, return_counts=True)
                both = [[f] * (len(found) + len(times)), [*none, *rest[0]], [*none, *rest[1]], [*none, *(rest[0] == rest[1])],
                        [*found, *[None] * len(times)], [*n, *times]]
                yield pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in zip(both, kinds)], names)

        of, ys, xs = None, [], []
        for batch in batches:
            for f, y, x in _chunks(batch):
                if f != of and ys:
                    yield from out(of, np.concatenate(ys), np.concatenate(xs))
                    ys, xs = [], []
                of = f
                ys.append(y)
                xs.append(x)
        if ys:
            yield from out(of, np.concatenate(ys), np.concatenate(xs))

    carried = {run: (run, groups, {f: ends[f] for f in _ranges(groups)}) for run, groups in held.items()}
    return scan(runs, carried, step, "f int, low double, high double, same boolean, m bigint, n bigint")


def _values_below(runs: DataFrame, held: dict[int, dict[Key, Group]], counts: dict[Key, int], bounds: set[Bound]) -> dict[Bound, int]:
    """How many values of its feature lie below each bound; only runs in which a bound lies are read."""
    below = dict.fromkeys(bounds, 0)
    asked: dict[int, list[Bound]] = {}
    of: dict[int, list[Bound]] = {}
    for bound in bounds:
        of.setdefault(bound[0], []).append(bound)
    for run, groups in held.items():
        for f, (first, last) in _ranges(groups).items():
            n = sum(g.n for (o, y), g in groups.items() if o == f and (f, y) in counts)
            for bound in of.get(f, []):
                _, v, too = bound
                if last < v or (too and last == v):
                    below[bound] += n
                elif first < v or (too and first == v):
                    asked.setdefault(run, []).append(bound)
    if not asked:
        return below

    def step(batches: Iterator[pa.RecordBatch], wanted: list[Bound]) -> Iterator[pa.RecordBatch]:
        found = dict.fromkeys(wanted, 0)
        for batch in batches:
            for f, y, x in _chunks(batch):
                x = x[np.isin(y, [o for of, o in counts if of == f])]
                for bound in wanted:
                    if bound[0] == f:
                        found[bound] += int(np.searchsorted(x, bound[1], "right" if bound[2] else "left"))
        columns = [*zip(*((*bound, n) for bound, n in found.items()))]
        kinds = [pa.int32(), pa.float64(), pa.bool_(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in zip(columns, kinds)], ["f", "v", "too", "n"])

    some = runs.where(c("_run").isin(list(asked)))
    for r in scan(some, asked, step, "f int, v double, too boolean, n bigint").collect():  # a few bounds of each run
        below[r["f"], r["v"], r["too"]] += r["n"]
    return below


def neighbour_information(long: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """``f, mi`` in nats, never below 0, from ``f, y, x``; a class of one row counts for nothing.

    All classes of a feature are sorted together once. A row's neighbours and what lies nearer stand in its own
    run, but for a few rows of each class at either end of a run; those are counted over the runs they reach.
    """
    runs = sorted_runs(long, c("f"), c("x"), c("y"))
    held = _groups(runs, k)
    counts: dict[Key, int] = {}
    for groups in held.values():
        for key, group in groups.items():
            counts[key] = counts.get(key, 0) + group.n
    counts = {key: n for key, n in counts.items() if n > 1}  # one entry per feature and class
    found = pin(_settled(runs, held, counts, k))
    open_rows = found.where("m IS NULL").collect()  # a few per class and run
    bounds = {b for r in open_rows for b in ((r["f"], r["low"], not r["same"]), (r["f"], r["high"], r["same"]))}
    below = _values_below(runs, held, counts, bounds) if bounds else {}
    near = {r["f"]: r["near"] for r in found.where("m IS NOT NULL").groupBy("f").agg(F.sum(c("n") * digamma(c("m"))).alias("near")).collect()}
    for r in open_rows:
        m = below[r["f"], r["high"], r["same"]] - below[r["f"], r["low"], not r["same"]]
        near[r["f"]] = near.get(r["f"], 0.0) + r["n"] * digamma(m)
    sizes: dict[int, list[int]] = {}
    for (f, _), n in sorted(counts.items()):
        sizes.setdefault(f, []).append(n)
    out = []
    for f, ns in sizes.items():
        total = sum(ns)
        own = sum(n * (digamma(min(k, n - 1)) - digamma(n)) for n in ns)
        out.append((f, max(0.0, digamma(total) + (own - near[f]) / total)))
    return long.sparkSession.createDataFrame(out, "f int, mi double")
