"""Tables in versions: data in folders of its own, and one small manifest, written last, that names what counts.

A reader takes the newest manifest and sees the folders it names, whole. A run
that breaks before its manifest leaves the old table as it was; a table can be
rebuilt from itself. A keyed table lays its rows out in hash buckets of the key,
so an upsert reads and writes only the buckets that its batch touches; the
others stay in the folders where they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from leadpanel.session import pin
from leadpanel.sources.io import latest_per_key, upsert, upsert_columns

MANIFESTS, DATA, BUCKET = "_manifests", "data", "_bucket"


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


class VersionConflict(RuntimeError):
    """Another writer has made this version meanwhile."""


@dataclass
class Manifest:
    """What one version of a table consists of; ``folders`` by bucket, or under one name for a plain table."""

    version: int
    schema: str
    folders: dict[str, str] = field(default_factory=dict)
    keys: list[str] = field(default_factory=list)
    buckets: int = 0
    order: list[str] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


def versions(spark: SparkSession, path: str) -> list[int]:
    fs, where = _fs(spark, f"{path}/{MANIFESTS}")
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))


def manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest | None:
    """The newest manifest, or that of a version; None where there is no table yet."""
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        return None
    version = known[-1] if version is None else version
    fs, where = _fs(spark, f"{path}/{MANIFESTS}/{version:020d}.json")
    stream = fs.open(where)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return Manifest(**json.loads(text))


def publish(spark: SparkSession, path: str, new: Manifest) -> None:
    """The swap: the manifest is written beside its place and renamed into it, once; an existing version is not replaced."""
    fs, folder = _fs(spark, f"{path}/{MANIFESTS}")
    fs.mkdirs(folder)
    draft, final = _path(spark, f"{path}/{MANIFESTS}/_{uuid.uuid4()}"), _path(spark, f"{path}/{MANIFESTS}/{new.version:020d}.json")
    stream = fs.create(draft)
    stream.write(bytearray(json.dumps(new.__dict__).encode()))
    stream.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise VersionConflict(f"version {new.version} of {path} exists")


def _fresh(path: str, version: int) -> str:
    return f"{path}/{DATA}/v{version}-{uuid.uuid4()}"


def _read(spark: SparkSession, found: Manifest, folders: Sequence[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], found.struct)
    return spark.read.schema(found.struct).parquet(*folders)


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The table as the newest manifest, or that of a version, names it; None where there is none."""
    found = manifest(spark, path, version)
    return None if found is None else _read(spark, found, list(found.folders.values()))


def reload(df: DataFrame, path: str) -> int:
    """The table's new content, whole; readers see the old one until the manifest is there. Returns the version."""
    spark = df.sparkSession
    before = manifest(spark, path)
    version = 1 if before is None else before.version + 1
    folder = _fresh(path, version)
    df.write.parquet(folder)
    publish(spark, path, Manifest(version, df.schema.json(), {"all": folder}))
    return version


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Deletes manifests before the newest ``keep`` and the folders that none of the kept ones names; returns how many.

    Folders of a run that is still writing are not named yet: run it when nothing writes.
    """
    known = versions(spark, path)
    named = {folder for v in known[-keep:] for folder in manifest(spark, path, v).folders.values()}
    fs, data = _fs(spark, f"{path}/{DATA}")
    gone = 0
    for v in known[:-keep]:
        gone += fs.delete(_path(spark, f"{path}/{MANIFESTS}/{v:020d}.json"), False)
    for status in fs.listStatus(data) if fs.exists(data) else []:
        folder = status.getPath()
        parts = [p.getPath() for p in fs.listStatus(folder) if p.getPath().getName().startswith(f"{BUCKET}=")]
        whole = f"{path}/{DATA}/{folder.getName()}"
        used = [p for p in parts if f"{whole}/{p.getName()}" in named]
        if not used and whole not in named:
            gone += fs.delete(folder, True)
        else:
            gone += sum(fs.delete(p, True) for p in parts if p not in used)
    return gone


# ---- keyed tables --------------------------------------------------------------------------
def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write_buckets(df: DataFrame, folder: str, keys: Sequence[str]) -> None:
    """One sorted file per bucket, with a Bloom filter on the keys for lookups."""
    writer = df.repartition(BUCKET).sortWithinPartitions(BUCKET, *keys).write.partitionBy(BUCKET)
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.parquet(folder)


def create_keyed(df: DataFrame, path: str, keys: Sequence[str], buckets: int, version: str | None = None) -> int:
    """A keyed table of ``df``; of rows with one key the one with the greatest ``version`` is kept (then by the other columns)."""
    spark = df.sparkSession
    newest = latest_per_key(df, list(keys), [F.col(version)] if version else [])
    before = manifest(spark, path)
    number = 1 if before is None else before.version + 1
    folder = _fresh(path, number)
    placed = pin(newest.withColumn(BUCKET, bucket_of(keys, buckets)))
    _write_buckets(placed, folder, keys)
    used = [r[BUCKET] for r in placed.select(BUCKET).distinct().collect()]  # at most one row per bucket
    publish(spark, path, Manifest(number, newest.schema.json(), {str(b): f"{folder}/{BUCKET}={b}" for b in used}, list(keys), buckets))
    return number


def _touched(batch: DataFrame, found: Manifest) -> tuple[DataFrame, list[str]]:
    placed = pin(batch.withColumn(BUCKET, bucket_of(found.keys, found.buckets)))
    return placed, [str(r[BUCKET]) for r in placed.select(BUCKET).distinct().collect()]  # at most one row per bucket


def _keyed(spark: SparkSession, path: str) -> Manifest:
    found = manifest(spark, path)
    if found is None or not found.buckets:
        raise ValueError(f"{path} is no keyed table")
    return found


def lookup(keys: DataFrame, path: str) -> DataFrame:
    """Rows of the table whose key is in ``keys``; only the buckets of those keys are read."""
    found = _keyed(keys.sparkSession, path)
    placed, touched = _touched(keys.select(*found.keys), found)
    rows = _read(keys.sparkSession, found, [found.folders[b] for b in touched if b in found.folders])
    return rows.join(placed.drop(BUCKET).distinct(), found.keys, "left_semi")


def merge_buckets(batch: DataFrame, path: str, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
    """Merges a batch into the buckets it touches and leaves the others where they are; returns the version.

    ``merge`` gets the stored rows of those buckets and the batch. Columns that it adds are null in other buckets.
    """
    spark = batch.sparkSession
    found = _keyed(spark, path)
    placed, touched = _touched(batch, found)
    if not touched:
        return found.version
    stored = _read(spark, found, [found.folders[b] for b in touched if b in found.folders])
    merged = merge(stored, placed.drop(BUCKET))
    folder = _fresh(path, found.version + 1)
    _write_buckets(merged.withColumn(BUCKET, bucket_of(found.keys, found.buckets)), folder, found.keys)
    folders: dict[str, Any] = {**found.folders, **{b: f"{folder}/{BUCKET}={b}" for b in touched}}
    publish(spark, path, Manifest(found.version + 1, merged.schema.json(), folders, found.keys, found.buckets))
    return found.version + 1


def upsert_keyed(batch: DataFrame, path: str, version: str) -> int:
    """Insert or replace by key: the batch wins over stored rows, the greatest version within it."""
    keys = _keyed(batch.sparkSession, path).keys
    return merge_buckets(batch, path, lambda stored, new: upsert(stored, new, keys, version))


def upsert_columns_keyed(batch: DataFrame, path: str, keep_old: Sequence[str] = ()) -> int:
    """Merge by key with a rule per column: old first for ``keep_old``, new first elsewhere; a batch has a key once."""
    keys = _keyed(batch.sparkSession, path).keys
    return merge_buckets(batch, path, lambda stored, new: upsert_columns(stored, new, keys, list(keep_old)))


# ---- ranked tables ---------------------------------------------------------------------------
RUN = "_run"


def page_order(sort: str, key: str) -> list[Column]:
    """Highest first, unknown last, then by key."""
    return [F.col(sort).desc_nulls_last(), F.col(key).asc()]


def write_ranked(df: DataFrame, path: str, sort: str, key: str, runs: int) -> int:
    """``df`` in runs by rank, with a directory of their sizes in the manifest; ``key`` is unique. Returns the version."""
    spark = df.sparkSession
    before = manifest(spark, path)
    version = 1 if before is None else before.version + 1
    folder = _fresh(path, version)
    order = page_order(sort, key)
    df.repartitionByRange(runs, *order).sortWithinPartitions(*order).withColumn(RUN, F.spark_partition_id()).write.partitionBy(RUN).parquet(folder)
    written = spark.read.schema(T.StructType([*df.schema.fields, T.StructField(RUN, T.IntegerType())])).option("basePath", folder).parquet(folder)
    sizes = {r[RUN]: r["n"] for r in written.groupBy(RUN).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per run
    names = {str(r): f"{folder}/{RUN}={r}" for r in sorted(sizes)}
    publish(spark, path, Manifest(version, df.schema.json(), names, order=[sort, key], counts={str(r): sizes[r] for r in sorted(sizes)}))
    return version


def _matching_per_run(spark: SparkSession, found: Manifest, where: Column) -> dict[str, int]:
    """Rows of each run that match; only the columns of the condition are read."""
    if not found.folders:
        return {}
    base = next(iter(found.folders.values())).rsplit("/", 1)[0]
    schema = T.StructType([*found.struct.fields, T.StructField(RUN, T.IntegerType())])
    rows = spark.read.schema(schema).option("basePath", base).parquet(*found.folders.values()).where(where)
    return {str(r[RUN]): r["n"] for r in rows.groupBy(RUN).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per run


def read_page(spark: SparkSession, path: str, limit: int, offset: int = 0, where: Column | None = None) -> DataFrame:
    """One page in rank order with ``total_count``, the number of all rows that match.

    The directory tells in which runs the page lies, and only those are read; with a condition, the matching
    rows of each run are counted first.
    """
    found = manifest(spark, path)
    if found is None or not found.order:
        raise ValueError(f"{path} is no ranked table")
    counts = found.counts if where is None else _matching_per_run(spark, found, where)
    total, first, wanted = sum(counts.values()), None, []
    at = 0
    for run in sorted(found.folders, key=int):
        n = counts.get(run, 0)
        if at + n > offset and at < offset + limit:
            first = at if first is None else first
            wanted.append(found.folders[run])
        at += n
    rows = _read(spark, found, wanted)
    rows = rows if where is None else rows.where(where)
    page = rows.orderBy(*page_order(*found.order)).offset(offset - (first or 0) if wanted else 0).limit(limit)
    return page.withColumn("total_count", F.lit(total).cast("bigint"))
