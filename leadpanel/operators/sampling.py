"""Reproducible samples, splits and folds keyed by hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from leadpanel.operators.permits import explode_types

c = F.col


def hash_order(key: str, seed: int):
    """A number of 48 bits from the key and the seed; any engine with MD5 gives the same one."""
    return F.conv(F.substring(F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(seed)).cast("binary")), 1, 12), 16, 10).cast("bigint")


def stratified_by_type(classified: DataFrame, n: int, key: str = "permit_num", seed: int = 42) -> DataFrame:
    """Up to ``n`` permits per type; a multi-type permit may enter under any of its types, once.

    ``row_number() <= n`` is cut per task before the shuffle, so a large type stays cheap.
    """
    types = explode_types(classified.select(key, F.col("permit_type").alias("_t")), "_t")
    by_hash = Window.partitionBy("_t").orderBy(hash_order(key, seed), key)
    chosen = types.withColumn("_rn", F.row_number().over(by_hash)).where(F.col("_rn") <= n)
    return classified.join(chosen.select(key).distinct(), key, "left_semi")


#: Ranges of hashes that are counted at a time; so many rows reach the driver in each round.
RANGES_BITS = 12
HASH_BITS = 48


def first_in_hash_order(df: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """The ``k`` rows that come first by the hash of their key, then by key, with no sort.

    Rows are counted by ranges of their hash; the range that holds the k-th one is counted again in finer
    ranges until single keys are left. What stays is a filter on the hash found, cut inside the last key
    only where that key repeats.
    """
    if k <= 0:
        return df.limit(0)
    h = hash_order(key, seed)
    low, bits, before = 0, HASH_BITS, 0
    while True:
        finer = max(0, bits - RANGES_BITS)
        inside = df.where(h.between(low, low + (1 << bits) - 1))
        counts = inside.groupBy(F.shiftright(h - low, finer).alias("_at")).agg(F.count(F.lit(1)).alias("n")).collect()  # 4096 ranges at most
        for at, n in sorted((r["_at"], r["n"]) for r in counts):
            if before + n >= k:
                break
            before += n
        else:
            return df  # fewer than k rows
        low, bits = low + (at << finer), finer
        if bits == 0 or n <= 1 << RANGES_BITS:
            break
    # Rows of a key that repeats are one row here.
    last = df.where(h.between(low, low + (1 << bits) - 1)).groupBy(h.alias("_h"), c(key).alias("_k")).agg(F.count(F.lit(1)).alias("n"))
    for row in sorted(last.collect(), key=lambda r: (r["_h"], r["_k"] is not None, r["_k"])):
        if before + row["n"] >= k:
            break
        before += row["n"]
    at_key = c(key).isNull() if row["_k"] is None else c(key) == row["_k"]
    less = F.lit(False) if row["_k"] is None else c(key).isNull() | (c(key) < row["_k"])
    whole = df.where((h < row["_h"]) | ((h == row["_h"]) & less))
    rest = df.where((h == row["_h"]) & at_key)
    return whole.unionByName(rest if before + row["n"] == k else rest.limit(k - before))


def other_only(classified: DataFrame, n: int, key: str = "permit_num", seed: int = 42) -> DataFrame:
    """Five times ``n`` unclassified permits."""
    return first_in_hash_order(explode_types(classified).where(F.col("permit_type") == "other"), key, 5 * n, seed)


def class_aware(df: DataFrame, label: str, key: str, cap: int, min_positives: int = 500,
                positive_share: float = 0.5, seed: int = 42) -> DataFrame:
    """At most ``cap`` rows: positives first (up to max(min_positives, cap * share)), negatives to the cap."""
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    positives = min(counts.get(1, 0), max(min_positives, int(cap * positive_share)))
    negatives = min(counts.get(0, 0), max(0, cap - positives))
    chosen = lambda value, k: first_in_hash_order(df.where(F.col(label) == value), key, k, seed)
    return chosen(1, positives).unionByName(chosen(0, negatives))


def fold_of(key: str, folds: int, seed: int = 42):
    """Fold number of an entity; every row of one entity lands in the same fold."""
    return F.pmod(hash_order(key, seed), F.lit(folds))


def in_test(key: str, test_share: float = 0.2, seed: int = 42):
    """Whether an entity is in the test part of an entity-level split."""
    return F.pmod(hash_order(key, seed), F.lit(1000)) < int(round(1000 * test_share))


def split_by_group(df: DataFrame, key: str, test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Entity-level train/test split."""
    test = in_test(key, test_share, seed)
    return df.where(~test), df.where(test)
