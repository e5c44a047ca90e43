"""The corpus pipeline: each stage is one operator of ``leadpanel.llm`` over the documents its predecessor kept.

1. quality classifier: documents that it rejects go.
2. line dedup: repetitions of recurring lines leave the texts; a document of
   which nothing is left (all of its lines stand in documents with smaller ids) goes.
3. MinHash near-dedup: one document of each group stays.
4. packing: pieces of power-of-two length.

All stages but the last return the columns of ``documents``, with any further
columns as they came; ``n_chars`` follows the text. Null and empty texts pass
every stage. An empty table gives no rows.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from leadpanel.llm import lines, minhash, packing, quality
from leadpanel.session import ensure_checkpoint_dir

TOKENIZER = "byte_bpe_50k.json"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from ``labels``, does not reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repetitions of recurring lines."""
    found = lines.drop_recurring_lines(docs)
    left = found.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"\S"))
    fresh = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        fresh["n_chars"] = F.when(F.col("n_dropped") > 0, n_chars).otherwise(F.col("row.n_chars"))
    return left.select(*[fresh.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near duplicates: five words, similarity 0.8."""
    return minhash.drop_near_duplicates(docs, shingle=5, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), with_ids=False)


STAGES = [("quality", keep_good), ("lines", drop_lines), ("near_duplicates", drop_near_duplicates), ("packing", pack)]

#: Votes of neighbours and tokens cannot be made in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4()}"
    for step, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{step}")
        docs = spark.read.parquet(f"{base}/{step}")
    return docs
