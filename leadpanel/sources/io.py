"""Readers, writers and keyed upserts over ordinary tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from leadpanel.functions.text import parcel_id


@dataclass(frozen=True)
class PermitSource:
    """One permit feed: its label and how its columns are named (standard -> source)."""

    label: str
    columns: dict[str, str] = field(default_factory=dict)
    numeric_key: bool = False


STANDARD = {
    "strap": "string", "permit_num": "string", "issue_dt": "string", "permit_category": "string",
    "description": "string", "estimated_value": "double",
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with header under a declared schema; declared text keeps leading zeros."""
    return spark.read.option("header", True).schema(schema).csv(path)


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None, limit: int | None = None,
               key: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    df = df.select(*columns) if columns else df
    return df.orderBy(key).limit(limit) if limit is not None else df


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, parts: int, **options) -> DataFrame:
    """Database table read by key range in parallel."""
    return spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=key, lowerBound=lower, upperBound=upper,
        numPartitions=parts, **options
    ).load()


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def ensure_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add the missing columns as typed nulls."""
    return df.withColumns({n: F.lit(None).cast(t) for n, t in columns.items() if n not in df.columns})


def load_source(df: DataFrame, source: PermitSource) -> DataFrame:
    """A raw feed in standard columns with its label; rows without a usable parcel id are dropped."""
    renamed = df.withColumnsRenamed({src: std for std, src in source.columns.items()})
    known = [c for c in STANDARD if c in renamed.columns]
    return (
        renamed.select(*known)
        .withColumn("strap", parcel_id(F.col("strap"), source.numeric_key))
        .where(F.col("strap").isNotNull())
        .withColumn("_source", F.lit(source.label))
    )


def union_sources(parts: list[DataFrame]) -> DataFrame:
    """All rows by column name; columns a feed lacks are null."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


# ---- upserts ------------------------------------------------------------------------
def latest_per_key(df: DataFrame, keys: list[str], version: list[Column]) -> DataFrame:
    """The row with the greatest version per key, combined map-side before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[v.alias(f"_v{i}") for i, v in enumerate(version)], *[F.col(c) for c in rest])
    return df.groupBy(*keys).agg(F.max(rank).alias("_r")).select(
        *[c if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns]
    )


def upsert(existing: DataFrame, batch: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Insert or replace by key: the batch wins over stored rows, the greatest version within it."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(batch.withColumn("_new", F.lit(1)))
    return latest_per_key(both, keys, [F.col("_new"), F.col(version)]).drop("_new")


def upsert_columns(existing: DataFrame, batch: DataFrame, keys: list[str], keep_old: list[str]) -> DataFrame:
    """Full outer merge with a rule per column: old first for ``keep_old``, new first elsewhere."""
    values = [c for c in dict.fromkeys(existing.columns + batch.columns) if c not in keys]

    def merged(name: str) -> Column:
        sides = [F.col(f"{s}.{name}") for s, df in (("n", batch), ("o", existing)) if name in df.columns]
        return F.coalesce(*(reversed(sides) if name in keep_old else sides)).alias(name)

    joined = existing.alias("o").join(batch.alias("n"), keys, "full_outer")
    return joined.select(*keys, *[merged(v) for v in values])


def validation_report(spark: SparkSession, tables: dict[str, DataFrame], required: dict[str, list[str]]) -> DataFrame:
    """One row per missing table, missing column or column without any value (one pass per table)."""
    errors = []
    for name, columns in required.items():
        if name not in tables:
            errors.append((name, "table not found"))
            continue
        df = tables[name]
        known = [c for c in columns if c in df.columns]
        errors += [(name, f"missing column {c}") for c in columns if c not in known]
        if known:
            filled = df.agg(*[F.count(c).alias(c) for c in known]).first()  # one row of counts
            errors += [(name, f"no value in column {c}") for c in known if filled[c] == 0]
    return spark.createDataFrame(errors, "check string, error string")
