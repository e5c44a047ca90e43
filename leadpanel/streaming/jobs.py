"""Structured Streaming forms of the incremental jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from leadpanel.operators.permits import classify, explode_types
from leadpanel.sources.io import latest_per_key

c = F.col


def file_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None, pattern: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format("parquet")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def run_available(query) -> StreamingQuery:
    """Start with ``availableNow`` and wait until the input is used up."""
    running = query.trigger(availableNow=True).start()
    running.awaitTermination()
    return running


# ---- keyed upsert ------------------------------------------------------------------
def upsert_log(keys: list[str], version: str, path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer: the batch's newest row per key goes to its own folder.

    Only the batch is written, never the whole table; a repeated batch overwrites its own
    folder, so a retry after a lost executor or driver changes nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        newest = latest_per_key(batch, keys, [c(version)])
        newest.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def _base_path(path: str) -> str:
    return f"{path.rstrip('/')}-base"


def _bases(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(_base_path(path))
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _log(spark: SparkSession, path: str) -> DataFrame:
    """The newest compacted table and the batches after it; earlier folders are pruned, not read."""
    log = spark.read.option("basePath", path).parquet(path)
    bases = _bases(spark, path)
    newest = None if bases is None else bases.agg(F.max("upto")).first()[0]
    if newest is None:
        return log.drop("batch_id")
    return log.where(c("batch_id") > newest).drop("batch_id").unionByName(bases.where(c("upto") == newest).drop("upto"))


def compact(spark: SparkSession, path: str, keys: list[str], order: list[str]) -> int | None:
    """Write the current table once, so that later reads skip the batches up to now; returns the last of them.

    The table goes to a folder of its own and counts once it is whole; old folders are
    left for whoever keeps the storage, and a repeated run overwrites only its own folder.
    """
    last = spark.read.option("basePath", path).parquet(path).agg(F.max("batch_id")).first()[0]
    if last is None:
        return None
    table = latest_per_key(_log(spark, path), keys, [c("_batch"), *[c(o) for o in order]])
    table.write.mode("overwrite").parquet(f"{_base_path(path)}/upto={last}")
    return last


def read_upserts(spark: SparkSession, path: str, keys: list[str], version: str) -> DataFrame:
    """Current table: the latest batch wins per key."""
    return latest_per_key(_log(spark, path), keys, [c("_batch"), c(version)]).drop("_batch")


def permit_feed(stream: DataFrame, version: str, path: str, checkpoint: str, tasks: int | None = None) -> StreamingQuery:
    """Classify arriving permits, expand their types and upsert by (home, number, type).

    ``tasks`` spreads the text work when batches arrive as a few large files.
    """
    stream = stream.repartition(tasks) if tasks else stream
    rows = explode_types(classify(stream)).select(
        "strap", "permit_num", "permit_type", "description", "estimated_value", version)
    sink = upsert_log(["strap", "permit_num", "permit_type"], version, path)
    return run_available(rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint))


# ---- windowed counts -----------------------------------------------------------------
def rolling_counts(stream: DataFrame, time: str, kind: str, days: int, slide_days: int, late_days: int) -> DataFrame:
    """Events per type in sliding windows; rows later than the watermark are dropped."""
    # A time without zone is taken as UTC whatever the session's zone, so windows do not move with it.
    at = stream.withColumn(time, F.from_utc_timestamp(c(time).cast("timestamp"), F.current_timezone()))
    return (
        at.withWatermark(time, f"{late_days} days")
        .groupBy(F.window(time, f"{days} days", f"{slide_days} days"), kind)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(c("window.start").alias("start"), c("window.end").alias("end"), kind, "n")
    )


def first_event(stream: DataFrame, key: str, condition: Column, time: str) -> DataFrame:
    """Running first event per key; state holds one time per key, for ever: any later event may be earlier."""
    return stream.where(condition).groupBy(key).agg(F.min(time).alias("first_at"))


def _batch_folders(path: str) -> Callable[[DataFrame, int], None]:
    """Each batch goes to its own folder, which a repeated batch overwrites."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def write_updates(stream: DataFrame, keys: list[str], path: str, checkpoint: str) -> StreamingQuery:
    """``update`` mode: each batch's changed keys are written as files, any number of them."""
    return run_available(
        stream.writeStream.outputMode("update").foreachBatch(_batch_folders(path)).option("checkpointLocation", checkpoint))


def write_appends(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """``append`` mode: every row of a batch is a row of the table."""
    return run_available(stream.writeStream.outputMode("append").foreachBatch(_batch_folders(path)).option("checkpointLocation", checkpoint))


def read_appends(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path).drop("batch_id", "_batch")


def read_updates(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    return latest_per_key(_log(spark, path), keys, [c("_batch")]).drop("_batch")
