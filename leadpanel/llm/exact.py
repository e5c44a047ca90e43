"""Exact text deduplication that takes the frequent texts out of the shuffle.

A Misra-Gries pass names every digest that could hold more than ``support`` of
the rows; its bounded candidates are counted exactly, and the true winners are
broadcast, so their rows are settled where they lie. All other digests are
below that share of the rows and go through an ordinary shuffle.

Cases: null text is empty text; texts are compared unchanged; a null id never
wins against a number, and a group without any id keeps all its rows; rows that
repeat both id and text all carry the same flags; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from leadpanel.session import pin

#: Share of all rows above which a digest is settled map-side; at most 1 / SUPPORT digests are broadcast.
SUPPORT = 0.001


def text_digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id and the SHA-256 of its whole text."""
    return docs.select(
        F.col(id_column).alias("doc_id"),
        F.sha2(F.coalesce(F.col(text_column), F.lit("")).cast("binary"), 256).alias("digest"),
    )


def frequent_digests(digests: DataFrame, support: float = SUPPORT) -> DataFrame:
    """``(digest, keep_id, group_size)`` of each digest with more than ``support`` of the rows.

    The Misra-Gries candidates hold every such digest and at most 1 / support
    in all; the exact count removes those that are not frequent.
    """
    floor = support * digests.count()
    candidates = digests.stat.freqItems(["digest"], support).select(F.explode("digest_freqItems").alias("digest"))
    return (
        digests.join(F.broadcast(candidates), "digest")
        .groupBy("digest")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where(F.col("group_size") > floor)
    )


def mark_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    support: float = SUPPORT) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``; the largest id of a group stays."""
    digests = pin(text_digests(docs, id_column, text_column))
    winners = pin(frequent_digests(digests, support))
    heavy = digests.join(F.broadcast(winners), "digest")
    light = digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    groups = light.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    settled = heavy.unionByName(light.join(groups, "digest"))
    return settled.select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    kept = mark_duplicates(docs, id_column, text_column).where("kept").select("doc_id").distinct()
    row = docs.select(F.col(id_column).alias("doc_id"), F.struct("*").alias("row"))
    return row.join(kept, row["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi").select("row.*")


ORACLE = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
