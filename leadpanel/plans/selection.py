"""Feature selection jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def consensus(picks: list[DataFrame], column: str, votes: int) -> DataFrame:
    """Values picked by at least ``votes`` of the lists."""
    every = reduce(lambda a, b: a.unionByName(b), picks)
    return every.groupBy(column).agg(F.count(F.lit(1)).alias("_v")).where(F.col("_v") >= votes).drop("_v")
