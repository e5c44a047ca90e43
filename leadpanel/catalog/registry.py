"""Query registration and the views that map the given tables to the data model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leadpanel.session import spread_rows
from leadpanel.sources.views import VIEWS, table_names, view_order

# Views whose rows get CPU-heavy text or geometry work next.
WIDE_WORK = {"permits", "payloads"}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Reads tables of one folder and the derived views, each as a DataFrame."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            text, needs = VIEWS[name]
            inputs = {n: getattr(self, n) for n in needs}
            if name in WIDE_WORK:
                inputs = {n: spread_rows(df) for n, df in inputs.items()}
            return self.spark.sql(text, **inputs)
        if name in table_names():
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        raise AttributeError(name)


def query(name: str, oracle: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def oracle(views: str, select: str, **ctes: str) -> str:
    """SQL text over the given tables: needed views, then extra CTEs, then the select."""
    parts = []
    for name in view_order(views.split()):
        text, needs = VIEWS[name]
        parts.append(f"{name} AS ({text.format(**{n: n for n in needs})})")
    parts += [f"{name} AS ({text})" for name, text in ctes.items()]
    return ("WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else "") + select
