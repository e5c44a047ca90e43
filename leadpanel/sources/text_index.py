"""Substring search over cards by a table of their trigrams, written once.

A text that contains the query contains all its trigrams. So the postings of
those trigrams, read from their buckets alone, give the candidates; the cards
are then read from the candidates' buckets, and only candidates' texts are
held against the query itself. Shorter queries have no trigram and are held
against every card, as without the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leadpanel.functions.once import once
from leadpanel.operators.filters import card_text, search
from leadpanel.session import pin, small
from leadpanel.sources import versions as V

GRAM = 3
#: Parts of a bucket of postings, by card: a trigram that most cards have is written by several tasks.
PARTS = 8


def grams(text: Column) -> Column:
    """The distinct trigrams of a text; none for shorter ones."""
    return F.when(F.length(text) >= GRAM, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(text) - (GRAM - 1)), lambda at: F.substring(text, at, GRAM)))).otherwise(F.array().cast("array<string>"))


def query_grams(query: str) -> list[str]:
    text = query.strip().lower()
    return sorted({text[at:at + GRAM] for at in range(len(text) - GRAM + 1)})


def write_index(cards: DataFrame, path: str, key: str, columns: Sequence[str], buckets: int) -> None:
    """The cards by key and the postings of their joined columns by trigram, both in buckets; ``key`` is unique and not null."""
    V.create_keyed(cards, f"{path}/cards", [key], buckets)
    spark = cards.sparkSession
    postings = once(cards.select(key, *columns), {"_text": card_text(*columns)}, keep=[key]).select(key, F.explode(grams(F.col("_text"))).alias("gram"))
    placed = postings.withColumn(V.BUCKET, V.bucket_of(["gram"], buckets))
    before = V.manifest(spark, f"{path}/grams")
    version = 1 if before is None else before.version + 1
    folder = V._fresh(f"{path}/grams", version)
    part = F.pmod(F.xxhash64(key), F.lit(PARTS))
    placed.repartition(V.BUCKET, part).sortWithinPartitions(V.BUCKET, "gram").write.partitionBy(V.BUCKET).parquet(folder)
    found = spark.read.option("basePath", folder).parquet(folder) if placed.limit(1).count() else None
    used = [] if found is None else [r[V.BUCKET] for r in found.select(V.BUCKET).distinct().collect()]  # at most one row per bucket
    V.publish(spark, f"{path}/grams", V.Manifest(
        version, postings.schema.json(), {str(b): f"{folder}/{V.BUCKET}={b}" for b in used}, ["gram"], buckets))


def candidates(spark: SparkSession, path: str, key: str, query: str) -> DataFrame:
    """Keys of the cards that have all trigrams of the query, from the buckets of these trigrams."""
    wanted = query_grams(query)
    asked = spark.createDataFrame([(g,) for g in wanted], "gram string")  # as long as the query
    rows = V.lookup(asked, f"{path}/grams")
    return rows.groupBy(key).agg(F.count_distinct("gram").alias("_n")).where(F.col("_n") == len(wanted)).select(key)


def indexed_search(spark: SparkSession, path: str, key: str, columns: Sequence[str], query: str) -> DataFrame:
    """The cards whose joined columns contain the query, ignoring case and outer blanks."""
    if not query_grams(query):
        return V.read_version(spark, f"{path}/cards").where(search(query, *columns))
    found = pin(candidates(spark, path, key, query))
    cards = V.lookup(found, f"{path}/cards").join(small(found), key, "left_semi")
    # Behind a generated column, so that the texts of other cards are never joined and searched.
    texts = once(cards, {"_text": card_text(*columns)})
    return texts.where(F.col("_text").contains(query.strip().lower())).drop("_text")
