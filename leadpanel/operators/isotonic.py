"""Exact isotonic regression (pool adjacent violators) over sorted runs, and its value at any score.

Equal scores are summed first. Each run pools its own rows into blocks of rising
means; a block is final unless a block of another run pools with it, which only
happens from the run's ends inwards. So the driver gets a few blocks from either
end of each run, pools across the ends, and asks for more of a run only where
pooling went through all it has. The rest of the curve stays where it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leadpanel.operators.ranking import add_position
from leadpanel.operators.runs import scan, sorted_runs, summaries
from leadpanel.session import pin, small

#: Blocks from either end of a run that are asked for at first; twice as many each time they do not do.
ENDS = 8

c = F.col


@dataclass
class Block:
    """Scores from ``low`` to ``high`` with one mean; ``at`` is its place in its run, None once pooled across runs."""

    low: float
    high: float
    weight: float
    total: float
    run: int | None = None
    at: int | None = None

    def above(self, other: Block) -> bool:
        """Whether this block's mean is not below the other's, which follows it."""
        return self.total * other.weight >= other.total * self.weight

    def with_before(self, other: Block) -> Block:
        return Block(other.low, self.high, self.weight + other.weight, self.total + other.total)


@dataclass
class RunEnds:
    """The blocks of a run that are known here: some from either end."""

    run: int
    size: int
    blocks: dict[int, Block] = field(default_factory=dict)


@dataclass
class Gap:
    """Blocks of a run between its known ends."""

    run: int
    first: int
    last: int


def pool_run(rows: Iterator[tuple[float, float, float]]) -> list[Block]:
    """Blocks of one run from ``(score, weight, weighted sum)`` in order of the score."""
    out: list[Block] = []
    for x, weight, total in rows:
        block = Block(x, x, weight, total)
        while out and out[-1].above(block):
            block = block.with_before(out.pop())
        out.append(block)
    return out


def pool_ends(runs: list[RunEnds]) -> tuple[list[Block | Gap], int | None]:
    """The curve from the runs' ends, and None; or what there is so far and the run of which more is needed."""
    out: list[Block | Gap] = []
    for run in runs:
        known = sorted(run.blocks)
        for place, at in enumerate(known):
            block = run.blocks[at]
            if place and known[place - 1] != at - 1:
                last = out[-1]
                if not (isinstance(last, Block) and last.at == at_before):
                    return out, run.run  # the block before the gap has changed, and what follows it is not known
                out.append(Gap(run.run, at_before + 1, at - 1))
            at_before = at
            while out:
                last = out[-1]
                if isinstance(last, Gap):
                    if block.at is None:
                        return out, last.run
                    break  # the run's own next block: its mean is larger
                if not last.above(block):
                    break
                block = block.with_before(out.pop())
            out.append(block)
    return out, None


def _blocks(points: DataFrame, group: str) -> DataFrame:
    """``group, _run, at, size, low, high, weight, total``: the blocks of each run and group."""
    runs = sorted_runs(points, c(group), c("x"))
    names = [group, "_run", "at", "size", "low", "high", "weight", "total"]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, rows, run = None, [], None

        def out() -> pa.RecordBatch:
            pooled = pool_run(iter(rows))
            n = len(pooled)
            columns = [[of] * n, [run] * n, list(range(n)), [n] * n, [b.low for b in pooled], [b.high for b in pooled],
                       [b.weight for b in pooled], [b.total for b in pooled]]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.float64()] * 4]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], names)

        for batch in batches:
            for g, *row, run_of in zip(*(batch.column(n).to_pylist() for n in (group, "x", "w", "wy", "_run"))):
                if g != of and rows:
                    yield out()
                    rows = []
                of, run = g, run_of
                rows.append(row)
        if rows:
            yield out()

    return runs.mapInArrow(step, f"{group} bigint, _run int, at bigint, size bigint, low double, high double, weight double, total double")


def isotonic_curve(points: DataFrame, group: str = "fold", ends: int = ENDS) -> DataFrame:
    """``group, low, high, value`` from ``group, x, y, w``: the rising step curve of least weighted squares, per group.

    Rows without score, label or positive weight count for nothing.
    """
    summed = points.where("x IS NOT NULL AND NOT isnan(x) AND y IS NOT NULL AND w > 0").groupBy(
        c(group).cast("bigint").alias(group), c("x").cast("double").alias("x")).agg(
        F.sum(c("w").cast("double")).alias("w"), F.sum(c("w").cast("double") * c("y")).alias("wy"))
    blocks = pin(_blocks(summed, group))
    known: dict[int, dict[int, RunEnds]] = {}

    def fetch(where, n: int) -> None:
        for r in blocks.where(where & ((c("at") < n) | (c("at") >= c("size") - n))).collect():  # a few blocks a run
            run = known.setdefault(r[group], {}).setdefault(r["_run"], RunEnds(r["_run"], r["size"]))
            run.blocks[r["at"]] = Block(r["low"], r["high"], r["weight"], r["total"], r["_run"], r["at"])

    fetch(F.lit(True), ends)
    kept, made = [], []
    for of, runs in known.items():
        asked = {run: ends for run in runs}
        while True:
            curve, missing = pool_ends([runs[run] for run in sorted(runs)])
            if missing is None:
                break
            asked[missing] *= 2
            fetch((c(group) == of) & (c("_run") == missing), asked[missing])
        places: dict[int, list[int]] = {}
        for part in curve:
            if isinstance(part, Gap):
                places.setdefault(part.run, []).extend([part.first, part.last])
            elif part.at is not None:
                places.setdefault(part.run, []).append(part.at)
            else:
                made.append((of, part.low, part.high, part.total / part.weight))
        kept += [(of, run, min(at), max(at)) for run, at in places.items()]
    spark = points.sparkSession
    # What is left of a run lies between two of its blocks; one row per run and group.
    bounds = small(spark.createDataFrame(kept, f"{group} bigint, _run int, _from bigint, _to bigint"))
    own = blocks.join(bounds, [group, "_run"]).where("at BETWEEN _from AND _to").select(
        group, "low", "high", (c("total") / c("weight")).alias("value"))
    return own.unionByName(spark.createDataFrame(made, f"{group} bigint, low double, high double, value double"))


def isotonic_values(curve: DataFrame, scores: DataFrame, group: str = "fold") -> DataFrame:
    """``scores`` (``group, x`` and more) with ``value``: the curve at ``x``, straight between steps, level beyond its ends.

    Scores and steps are sorted together, and each score meets the last step at or before it.
    Without a score or a curve the value is null.
    """
    placed = pin(add_position(curve, [c("low")], [group], "_at", "_n"))
    following = placed.select(group, (c("_at") - 1).alias("_at"), c("low").alias("next_low"), c("value").alias("next_value"))
    told = ["high", "value", "next_low", "next_value"]
    steps = placed.join(following, [group, "_at"], "left").select(
        group, F.when(c("_at") == 1, float("-inf")).otherwise(c("low")).alias("x"), F.lit(0).alias("kind"), *told)
    wanted = scores.select(c(group).cast("bigint").alias(group), c("x").cast("double").alias("x")).where("x IS NOT NULL AND NOT isnan(x)").distinct()
    runs = sorted_runs(
        steps.unionByName(wanted.select(group, "x", F.lit(1).alias("kind")), allowMissingColumns=True), c(group), c("x"), c("kind"))

    def summary(batches: Iterator[pa.RecordBatch]) -> dict:
        last = None
        for batch in batches:
            at = [i for i, kind in enumerate(batch.column("kind").to_pylist()) if kind == 0]
            if at:
                last = tuple(batch.column(n)[at[-1]].as_py() for n in (group, *told))
        return {"step": None if last is None else dict(zip(("of", *told), last))}

    carried, before = {}, None
    for row in summaries(runs, summary, "step struct<of bigint, high double, value double, next_low double, next_value double>"):
        carried[row["_run"]] = before
        before = tuple(row["step"]) if row["step"] is not None else before

    def step(batches: Iterator[pa.RecordBatch], carry: tuple | None) -> Iterator[pa.RecordBatch]:
        last = carry
        for batch in batches:
            out: list[tuple] = []
            for of, x, kind, *own in zip(*(batch.column(n).to_pylist() for n in (group, "x", "kind", *told))):
                if kind == 0:
                    last = (of, *own)
                elif last is not None and last[0] == of:
                    _, high, value, next_low, next_value = last
                    if x > high and next_low is not None:
                        value = value + (x - high) * (next_value - value) / (next_low - high)
                    out.append((of, x, value))
            columns = list(zip(*out)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.float64())], [group, "x", "value"])

    found = scan(runs, carried, step, f"{group} bigint, x double, value double")
    return scores.join(found, [group, "x"], "left")


#: Steps of all curves up to which scores meet them by binary search, without being sorted.
FEW_STEPS = 200_000


def few_steps(curve: DataFrame, group: str = "fold", most: int = FEW_STEPS) -> dict[int, np.ndarray] | None:
    """``low, high, value`` of each group's steps in order, one row each; None where there are too many to be sent around."""
    found = curve.select(c(group).cast("bigint"), "low", "high", "value").limit(most + 1).toPandas()
    if len(found) > most:
        return None
    found = found.sort_values([group, "low"])
    return {int(of): own[["low", "high", "value"]].to_numpy(float).T for of, own in found.groupby(group)}


def value_of_steps(x: np.ndarray, steps: np.ndarray | None) -> np.ndarray:
    """The curve at ``x``, straight between steps, level beyond its ends; NaN without a score or a curve."""
    if steps is None:
        return np.full(len(x), np.nan)
    low, high, value = steps
    at = np.maximum(np.searchsorted(low, x, side="right") - 1, 0)
    after = np.minimum(at + 1, len(low) - 1)
    between = (x > high[at]) & (after > at)
    run = np.where(between, low[after] - high[at], 1.0)
    out = np.where(between, value[at] + (x - high[at]) * (value[after] - value[at]) / run, value[at])
    return np.where(np.isnan(x), np.nan, out)


def values_of_steps(scores: DataFrame, steps: dict[int, np.ndarray], of: dict[int, str]) -> DataFrame:
    """``scores`` with the column of each group in ``of`` replaced by its curve's value; null without a score or a curve."""
    columns = {name: group for group, name in of.items()}
    sent = scores.sparkSession.sparkContext.broadcast(steps)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = []
            for n in batch.schema.names:
                column = batch.column(n)
                if n in columns:
                    found = value_of_steps(column.to_numpy(zero_copy_only=False).astype(float), sent.value.get(columns[n]))
                    column = pa.array(found, pa.float64(), from_pandas=True)
                arrays.append(column)
            yield pa.RecordBatch.from_arrays(arrays, batch.schema.names)

    return scores.mapInArrow(step, scores.schema)
