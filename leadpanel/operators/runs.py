"""Sequential scans over a sorted table, run by run.

Rows are range partitioned and sorted into runs. A scan that needs what came
before its run (a trie path, a running hash) is done twice: once to give one
summary per run, which the driver folds in the order of the runs, and once more
with what the fold hands to each run. Nothing but the summaries, one per
partition, passes the driver, and no key has to lie in one run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from leadpanel.session import partitions, pin


def sorted_runs(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with its run in ``_run``; pinned, so that a retry meets the same runs."""
    dealt = df.repartitionByRange(partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    return pin(dealt.withColumn("_run", F.spark_partition_id()))


def summaries(runs: DataFrame, summary: Callable[[Iterator[pa.RecordBatch]], dict[str, Any] | None], schema: str) -> list[dict[str, Any]]:
    """``summary`` of each run that has rows, in the order of the runs."""

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: list[int] = []

        def seen() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    run[:] = [batch.column("_run")[0].as_py()]
                    yield batch

        found = summary(seen())
        if run:
            yield pa.RecordBatch.from_pylist([{"_run": run[0], **found}], target)

    types = runs.sparkSession.createDataFrame([], f"_run int, {schema}")
    target = types.toArrow().schema
    rows = runs.mapInArrow(one, types.schema).collect()  # one row per partition
    return sorted((r.asDict() for r in rows), key=lambda r: r["_run"])


def scan(runs: DataFrame, carried: Mapping[int, Any], step: Callable[[Iterator[pa.RecordBatch], Any], Iterator[pa.RecordBatch]],
         schema: str) -> DataFrame:
    """``step`` over the batches of each run, with what was carried to it."""
    handed = runs.sparkSession.sparkContext.broadcast(dict(carried))  # one entry per partition

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = (batch for batch in batches if batch.num_rows)
        first = next(full, None)
        if first is not None:
            yield from step(_again(first, full), handed.value[first.column("_run")[0].as_py()])

    return runs.mapInArrow(one, schema)


def _again(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest
