"""Keyed joins with the duplicate and miss rules of each use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leadpanel.session import small


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key in the given order; a null order value comes after all others.

    ``min`` of a struct keeps one candidate per task and key, so a hot key costs
    one row per task in the shuffle, unlike a window over the whole group.
    """
    rest = [n for n in df.columns if n not in keys]
    # Nulls sort first in a struct, so a mark in front of each value puts them last.
    marked = [x for i, o in enumerate(order) for x in (o.isNull().alias(f"_m{i}"), o.alias(f"_o{i}"))]
    ranked = F.struct(*marked, *[F.col(n) for n in rest])
    return df.groupBy(*keys).agg(F.min(ranked).alias("_r")).select(
        *[n if n in keys else F.col(f"_r.{n}").alias(n) for n in df.columns]
    )


def add_dimension(facts: DataFrame, dimension: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of a dimension; broadcast only after its rows were counted."""
    return facts.join(small(dimension), keys, "left")


def known_only(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return df.join(known.select(key), key, "left_semi")


def unseen_only(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    return df.join(seen.select(key), key, "left_anti")


def append_unseen(stored: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Stored rows as they are (with later-filled columns) plus the batch rows with new keys."""
    return stored.unionByName(unseen_only(batch, stored, key), allowMissingColumns=True)


def continue_series(feed: DataFrame, stored: DataFrame, series: str, period: str) -> DataFrame:
    """Feed rows after each series' last stored period; a series not stored yet comes whole."""
    last = stored.groupBy(series).agg(F.max(period).alias("_last"))
    return feed.join(last, series, "left").where(
        F.col("_last").isNull() | (F.col(period) > F.col("_last"))
    ).drop("_last")


def map_keys(df: DataFrame, lookup: DataFrame, key: str, target: str) -> DataFrame:
    """Translate a key; rows without a match are dropped. The last value per key wins, by value."""
    unique = lookup.groupBy(key).agg(F.max(target).alias(target))
    return df.join(unique, key)


def fill_missing(target: DataFrame, source: DataFrame, key: str, column: str) -> DataFrame:
    """Fill null targets from the source; known targets stay."""
    values = source.select(key, F.col(column).alias("_fill"))
    return target.join(values, key, "left").withColumn(column, F.coalesce(column, "_fill")).drop("_fill")


def label_from_lists(df: DataFrame, yes: DataFrame, no: DataFrame, key: str, label: str) -> DataFrame:
    """Blank labels become "No" or "Yes" by list membership; the no list is asked first."""
    def listed(keys: DataFrame, flag: str) -> DataFrame:
        return keys.select(key).distinct().withColumn(flag, F.lit(True))

    blank = F.col(label).isNull() | (F.trim(label) == "")
    found = F.when(F.col("_no"), "No").when(F.col("_yes"), "Yes")
    return (
        df.join(listed(no, "_no"), key, "left").join(listed(yes, "_yes"), key, "left")
        .withColumn(label, F.when(blank, F.coalesce(found, label)).otherwise(F.col(label)))
        .drop("_no", "_yes")
    )


def join_with_suffix(left: DataFrame, right: DataFrame, key: str, order: list[Column], suffix: str) -> DataFrame:
    """Left join on a number-read key; the right side deduplicated, its clashing columns suffixed."""
    as_number = lambda df: df.withColumn(key, F.col(key).try_cast("bigint"))
    clash = {n: n + suffix for n in right.columns if n in left.columns and n != key}
    first = first_per_key(as_number(right).where(F.col(key).isNotNull()), [key], order)
    return as_number(left).join(first.withColumnsRenamed(clash), key, "left")


def group_under(parent: DataFrame, children: DataFrame, key: str, columns: list[str], name: str) -> DataFrame:
    """Children of each parent as one sorted array; parents hold few children by nature."""
    lists = children.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(name))
    return parent.join(lists, key, "left")
