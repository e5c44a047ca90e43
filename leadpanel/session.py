"""Session settings, reliable checkpoints and size-checked broadcasts."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

# Settings a cluster session should carry; tests and bench use the same ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# A dimension this small is safe to ship to every executor (rows, after a count).
BROADCAST_ROWS = 200_000

# Rows that one task works on where each row takes many regexes: a few seconds.
ROWS_A_TASK = 100_000


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "12g") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName("leadpanel")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, as the session names it.

    A cluster must name ``spark.checkpoint.dir``; only a local master, where
    driver and executors share one disk, falls back to a scratch folder.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if named:
        if current is None:
            sc.setCheckpointDir(named)
        return named
    if current is None:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="leadpanel-checkpoint-"))
    return sc.getCheckpointDir()


def pin(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def held(*pinned: DataFrame) -> Iterator[None]:
    """Keep pinned tables in columns (memory, then disk) while a job reads them many times.

    A checkpoint is read row by row with all of its columns. Partitions and the order of rows stay as
    they are; what is read later comes from the checkpoint again. Tables that are kept already stay kept.
    """
    fresh = [df for df in pinned if not (df.storageLevel.useMemory or df.storageLevel.useDisk)]
    for df in fresh:
        df.persist()
    try:
        yield
    finally:
        for df in fresh:
            df.unpersist()


def small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Pin ``df`` and mark it for broadcast only if it has at most ``max_rows`` rows.

    Larger inputs come back unmarked, so the join falls back to a shuffle.
    """
    pinned = pin(df)
    fits = pinned.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(pinned) if fits else pinned


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame) -> DataFrame:
    """Give a scan with fewer splits than cores enough partitions for CPU-heavy columns.

    A table of many files already has them and passes through unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def spread_rows(table: DataFrame, rows: int = ROWS_A_TASK) -> DataFrame:
    """Deal the rows of a stored table out evenly for CPU-heavy columns, over tasks whose number grows with the rows.

    Its splits do not tell: of a file of a few large row groups only the splits in which a
    row group lies have rows. Counting a stored table reads none of its columns.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(max(cores, -(-table.count() // rows)))
