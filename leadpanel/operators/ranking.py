"""Exact global order without a single-task sort.

A window without partition keys, or with one huge group, sends the group to one
task. Here rows are range partitioned on the full order (ties included), each
partition is sorted, and only one small row per (partition, group) is combined
to turn local positions and sums into global ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadpanel.session import partitions, pin

_LOCAL_BITS = 33  # monotonically_increasing_id = partition << 33 | row


def _sorted_runs(df: DataFrame, groups: Sequence[str], order: Sequence[Column]) -> DataFrame:
    keys = [F.col(g) for g in groups] + list(order)
    runs = (
        df.repartitionByRange(partitions(df.sparkSession), *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_m", F.monotonically_increasing_id())
    )
    # Pinned: the partition layout that the offsets below describe must not change on a retry.
    return (
        pin(runs)
        .withColumn("_run", F.shiftright("_m", _LOCAL_BITS))
        .withColumn("_at", F.col("_m").bitwiseAND((1 << _LOCAL_BITS) - 1))
        .drop("_m")
    )


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names],
    )


def _with_offsets(runs: DataFrame, groups: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """Join each row with its group's totals in the runs before its own."""
    per_run = runs.groupBy("_run", *groups).agg(
        F.min("_at").alias("_first"), *[expr.alias(f"_s_{n}") for n, expr in sums.items()]
    )
    before = Window.partitionBy(*groups).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*groups)
    offsets = per_run.select(
        "_run", *groups, "_first",
        *[F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums],
        *[F.sum(f"_s_{n}").over(everything).alias(f"_t_{n}") for n in sums],
    )
    if not groups:  # one row per run: bounded by the number of shuffle partitions
        offsets = F.broadcast(offsets)
    joined = runs.alias("r").join(offsets.alias("o"), _same("r", "o", ["_run", *groups]))
    return joined.select(
        *[F.col(f"r.{c}").alias(c) for c in runs.columns],
        *[F.col(f"o.{c}").alias(c) for c in offsets.columns if c not in ("_run", *groups)],
    )


def add_position(
    df: DataFrame,
    order: Sequence[Column],
    groups: Sequence[str] = (),
    position: str = "position",
    total: str = "n_rows",
) -> DataFrame:
    """Add the 1-based position of each row in its group's order, and the group size.

    ``order`` must end in a unique key so that ties are broken the same way every time.
    """
    cols = df.columns
    runs = _sorted_runs(df, groups, order)
    placed = _with_offsets(runs, groups, {"n": F.count(F.lit(1))})
    return placed.select(
        *cols,
        (F.col("_o_n") + F.col("_at") - F.col("_first") + 1).alias(position),
        F.col("_t_n").alias(total),
    )


def add_running_sums(
    df: DataFrame, order: Sequence[Column], values: Sequence[str], groups: Sequence[str] = ()
) -> DataFrame:
    """Add ``cum_<v>`` (inclusive) and ``total_<v>`` for each value column, in exact global order."""
    cols = df.columns
    runs = _sorted_runs(df, groups, order)
    placed = _with_offsets(runs, groups, {v: F.sum(v) for v in values})
    within = (
        Window.partitionBy("_run", *groups).orderBy("_at")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return placed.select(
        *cols,
        *[(F.col(f"_o_{v}") + F.sum(v).over(within)).alias(f"cum_{v}") for v in values],
        *[F.col(f"_t_{v}").alias(f"total_{v}") for v in values],
    )


def tie_ranks(df: DataFrame, score: str, groups: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """One row per (group, score): tie count, average rank and group size.

    Rows are combined per score value before anything is ordered, so a value
    shared by a third of the rows is one row here.
    """
    per_score = df.where(F.col(score).isNotNull()).groupBy(*groups, score).agg(
        F.count(F.lit(1)).alias("n_tied")
    )
    key = F.col(score).desc() if descending else F.col(score).asc()
    cum = add_running_sums(per_score, [key], ["n_tied"], groups)
    return cum.select(
        *groups, score, "n_tied",
        (F.col("cum_n_tied") - (F.col("n_tied") - 1) / 2).alias("avg_rank"),
        F.col("total_n_tied").alias("n_ranked"),
    )


def percentile_rank(
    df: DataFrame, score: str, groups: Sequence[str] = (), out: str = "pct_rank"
) -> DataFrame:
    """Average-tie percentile rank in (0, 1]; rows without a score get null."""
    ranks = tie_ranks(df, score, groups).select(
        *groups, score, (F.col("avg_rank") / F.col("n_ranked")).alias(out)
    )
    if not groups:
        return df.join(ranks, score, "left")
    on = _same("l", "r", groups) & (F.col(f"l.{score}") == F.col(f"r.{score}"))
    return df.alias("l").join(ranks.alias("r"), on, "left").select("l.*", f"r.{out}")


def exact_quantiles(
    df: DataFrame, values: Sequence[str], probs: Sequence[float], groups: Sequence[str] = ()
) -> DataFrame:
    """Exact linear-interpolated quantiles: (groups..., column, prob, quantile).

    Values are counted first and located by running counts; no group's value map
    has to fit in one aggregation buffer.
    """
    long = df.select(
        *groups, F.explode(F.array(*[
            F.struct(F.lit(v).alias("column"), F.col(v).cast("double").alias("value")) for v in values
        ])).alias("_cv")
    ).select(*groups, "_cv.column", "_cv.value").where(F.col("value").isNotNull())
    # Pinned: range partitioning reads its input twice, and this one is far smaller than ``df``.
    counted = pin(long.groupBy(*groups, "column", "value").agg(F.count(F.lit(1)).alias("n")))
    keys = [*groups, "column"]
    cum = add_running_sums(counted, [F.col("value").asc()], ["n"], keys)
    # 0-based ranks first..last share one value; the wanted rank is p * (n - 1).
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob")
    spots = cum.select(
        *keys, "value", (F.col("cum_n") - F.col("n")).alias("_lo"), (F.col("cum_n") - 1).alias("_hi"),
        F.col("total_n").alias("_n"), wanted,
    ).withColumn("_at", F.col("prob") * (F.col("_n") - 1))
    low, high = F.floor("_at"), F.ceil("_at")
    picked = spots.where((high >= F.col("_lo")) & (low <= F.col("_hi")))
    return (
        picked.groupBy(*keys, "prob")
        .agg(
            F.min(F.when(low.between(F.col("_lo"), F.col("_hi")), F.col("value"))).alias("_a"),
            F.min(F.when(high.between(F.col("_lo"), F.col("_hi")), F.col("value"))).alias("_b"),
            F.first(F.col("_at") - F.floor("_at")).alias("_f"),
        )
        .select(*keys, "prob", (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_f")).alias("quantile"))
    )


def exact_medians(df: DataFrame, values: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """Wide exact medians: one row per group, one column per value column."""
    q = exact_quantiles(df, values, [0.5], groups)
    return q.groupBy(*groups).pivot("column", list(values)).agg(F.first("quantile"))


#: Error of the sketch that medians are looked for beside, as one part in so many; values beside one that the driver takes.
SKETCH, BESIDE = 20_000, 1_000_000


def median_scalars(df: DataFrame, values: Sequence[str]) -> dict[str, float | None]:
    """Whole-table medians as driver scalars (one row).

    A sketch gives two values that a median lies between; a second look counts the rows below and the values between them.
    Columns for which that does not settle it are ordered whole.
    """
    values = list(dict.fromkeys(values))
    if not values:
        return {}
    x = {v: F.col(v).cast("double") for v in values}
    sides = [F.lit(0.5 - 2 / SKETCH), F.lit(0.5 + 2 / SKETCH)]
    told = df.agg(*[
        F.struct(F.count(x[v]).alias("n"), F.count(F.when(F.isnan(x[v]), 1)).alias("nan"), F.percentile_approx(x[v], F.array(*sides), SKETCH).alias("at")).alias(f"_{i}")
        for i, v in enumerate(values)]).first()
    out = {v: None for v in values}
    bounds = {i: tuple(told[i]["at"]) for i in range(len(values)) if told[i]["n"] and not told[i]["nan"]}
    left = {v for i, v in enumerate(values) if told[i]["nan"]}
    if bounds:
        # Rows below are one row of a column here, and those above are none.
        place = lambda i: F.when(x[values[i]] < bounds[i][0], F.struct(F.lit(i).alias("i"), F.lit(None).cast("double").alias("value"))).when(
            x[values[i]] <= bounds[i][1], F.struct(F.lit(i).alias("i"), x[values[i]].alias("value")))
        beside = df.select(F.explode(F.array_compact(F.array(*[place(i) for i in bounds]))).alias("p")).groupBy("p.i", "p.value").agg(F.count(F.lit(1)).alias("k"))
        found = beside.limit(BESIDE + 1).toPandas()
        for i in bounds:
            own = found[found["i"] == i].sort_values("value")
            below = int(own.loc[own["value"].isna(), "k"].sum())
            own = own[own["value"].notna()]
            upto, wanted = below + own["k"].cumsum().to_numpy(), 0.5 * (told[i]["n"] - 1)
            low, high = int(wanted), -int(-wanted // 1)
            if len(found) > BESIDE or not len(own) or low < below or high >= upto[-1]:
                left.add(values[i])
                continue
            a, b = (float(own["value"].iloc[int((upto <= rank).sum())]) for rank in (low, high))
            out[values[i]] = a + (b - a) * (wanted - low)
    if left:
        rows = exact_medians(df, sorted(left)).collect()
        out |= {v: (rows[0][v] if rows else None) for v in left}
    return out
