"""Ordered pages, most-complete rows and ranked listings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from leadpanel.operators.joins import first_per_key

c = F.col
COMPLETENESS = ["area_building", "num_bedrooms", "num_bath", "numrooms"]


def most_complete(df: DataFrame, address: str = "address", tie: str = "original_index",
                  columns: list[str] = COMPLETENESS) -> DataFrame:
    """One row per address with the most known columns; rows without an address collapse into one."""
    known = reduce(lambda a, b: a + b, [c(n).isNotNull().cast("int") for n in columns])
    return first_per_key(df, [address], [-known, c(tie)])


def page(df: DataFrame, sort: str, key: str, limit: int, offset: int = 0) -> DataFrame:
    """Highest score first, unknown last, then by key."""
    return df.orderBy(c(sort).desc_nulls_last(), c(key).asc()).offset(offset).limit(limit)


def recent_events(events: DataFrame, date: str, as_of, days: int, types: list[str], key: str,
                  limit: int, type_column: str = "permit_type") -> DataFrame:
    """Events of the wanted types in the days up to ``as_of``, newest first."""
    first = F.date_sub(F.lit(as_of).cast("date"), days)
    return (
        events.where((c(date) >= first) & c(type_column).isin(types))
        .orderBy(c(date).desc(), c(key)).limit(limit)
    )


def rank_images(images: DataFrame, scores: DataFrame, key: str = "home_id") -> DataFrame:
    """Images by score: the "yes" folder is preferred per home, homes without a score count zero."""
    chosen = first_per_key(images, [key], [(c("folder") != "yes").cast("int"), c("name")])
    return (
        chosen.join(scores, key, "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
        .orderBy(c("score").desc(), c(key))
    )
