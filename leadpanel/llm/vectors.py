"""Near-duplicate vectors by sorted projection passes.

Vectors that are equal are one class. In each pass a class gets the signs of
its products with random directions as one number; classes are sorted by it,
and each is compared with the ``window`` next ones. Verified pairs of all
passes are united. Classes that share the leading signs of a pass are a range;
where a range holds more classes than a window and still several components,
its classes are compared across components in blocks. Inside each component
found that way, all pairs are then compared in blocks, so the number of links
of a vector is whole even where more vectors are alike than a window holds.

The number of passes follows from the number of classes: it takes some leading
bits to part evenly spread classes into windows, a pass finds every pair that
agrees in them, and passes are added until the chance that all miss a pair at
the threshold is below ``miss``. Vectors that lie close to each other fill
ranges beyond a window, so this holds for them, too; a label whose full ranges
take as many comparisons as the label itself is compared as one range.

Cases: only vectors with equal labels and equal lengths are compared; null
labels, null ids, null or zero vectors, and vectors with null or non-finite
components link with nothing; rows that repeat an id are vectors of their own;
an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leadpanel.llm.components import components
from leadpanel.operators.ranking import add_position
from leadpanel.session import pin

#: Neighbours that follow in the order and are compared.
WINDOW = 32
#: Classes whose windows one task compares at a time.
RUN = 1024
#: Members of a component that are compared with as many others in one task.
BLOCK = 512
#: Chance that no pass finds a pair exactly at the threshold.
MISS = 1e-3
BITS, SEED = 62, 4711


def passes_for(classes: int, threshold: float, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes after which a pair at the threshold is missed with probability ``miss`` at most."""
    agree = 1 - math.acos(threshold) / math.pi
    found = agree ** max(0.0, math.log2(max(classes, 1) / window))
    return 1 if found >= 1 else max(1, math.ceil(math.log(miss) / math.log1p(-found)))


def range_bits(classes: int, window: int = WINDOW) -> int:
    """Leading bits whose ranges are compared whole, no more than ``passes_for`` counts on."""
    return min(BITS, max(0, math.floor(math.log2(max(classes, 1) / window))))


def _unit_rows(column: pa.ListArray, dim: int) -> np.ndarray:
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def vector_classes(vectors: DataFrame) -> DataFrame:
    """``label, embedding, rep, copies`` for each distinct vector that can link."""
    sound = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ) & F.exists("embedding", lambda x: x != 0)
    usable = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & sound)
    # Adding zero makes -0.0 and 0.0 one value.
    plain = usable.select("vec_id", "label", F.transform("embedding", lambda x: x + F.lit(0).cast("float")).alias("embedding"))
    return plain.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))


def projected(classes: DataFrame, passes: int) -> DataFrame:
    """Each class once per pass, with its ``dim`` and that pass's ``key``: its signs along random directions, as one number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            column = batch.column("embedding")
            keys = np.zeros((batch.num_rows, passes), np.int64)
            sizes = np.diff(column.offsets.to_numpy())
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                unit = _unit_rows(column.take(pa.array(rows)), int(dim))
                for number in range(passes):
                    directions = np.random.default_rng((SEED, number, int(dim))).standard_normal((int(dim), BITS))
                    keys[rows, number] = (unit @ directions > 0) @ weights
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("cid", "label", "embedding")), pa.array(list(keys), pa.list_(pa.int64()))],
                ["cid", "label", "embedding", "keys"],
            )

    label = classes.schema["label"].dataType.simpleString()
    keyed = classes.select("cid", "label", "embedding").mapInArrow(
        run, f"cid bigint, label {label}, embedding {classes.schema['embedding'].dataType.simpleString()}, keys array<bigint>"
    )
    return keyed.select("cid", "label", "embedding", F.size("embedding").alias("dim"), F.posexplode("keys").alias("pass", "key"))


def window_links(keyed: DataFrame, threshold: float, window: int = WINDOW) -> DataFrame:
    """``a, b``: links that join the classes which verified pairs of a pass connect, one per class and run at most."""
    placed = add_position(
        keyed, [F.col(c) for c in ("pass", "label", "dim", "key", "cid")], position="place", total="all_places"
    ).withColumn("place", F.col("place") - 1)
    # The first rows of a run also end the run before it.
    run = F.expr(f"cast(place div {RUN} as bigint)")
    runs = F.when((F.col("place") % RUN < window) & (run > 0), F.array(run, run - 1)).otherwise(F.array(run))
    rows = placed.select("place", "pass", "label", "dim", "cid", "embedding", F.explode(runs).alias("run"))

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("place").combine_chunks()
        cid = table.column("cid").to_numpy()
        dims = table.column("dim").to_numpy()
        group = np.zeros(len(cid), np.int64)
        for name in ("pass", "label", "dim"):
            values = table.column(name)
            group[1:] |= np.asarray([a != b for a, b in zip(values[1:].to_pylist(), values[:-1].to_pylist())], bool)
        group = np.cumsum(group)
        a, b = [], []
        for one in np.unique(group):
            rows = np.flatnonzero(group == one)
            unit = _unit_rows(table.column("embedding").chunk(0).take(pa.array(rows)), int(dims[rows[0]]))
            own = np.arange(len(rows))
            for step in range(1, min(window, len(rows) - 1) + 1):
                close = np.flatnonzero(np.einsum("ij,ij->i", unit[:-step], unit[step:]) >= threshold)
                for x in close:
                    if own[x] != own[x + step]:
                        a.append(cid[rows[x]])
                        b.append(cid[rows[x + step]])
                        own[own == own[x + step]] = own[x]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("run").applyInArrow(compare, "a bigint, b bigint").distinct()


def range_links(keyed: DataFrame, classes: DataFrame, parts: DataFrame, bits: int, threshold: float, window: int = WINDOW) -> DataFrame:
    """``a, b``: links between classes of a range that its windows do not cover and ``parts`` (``node, component``) leaves apart.

    A range is the classes of a label and length that agree in ``bits`` leading
    signs of a pass. Its classes are put in order of their component and cut
    into blocks; two blocks meet in one task unless both lie in one component.
    """
    group = ["pass", "label", "dim", "head"]
    heads = keyed.select("pass", "label", "dim", F.shiftright("key", BITS - bits).alias("head"), "cid")
    members = heads.join(parts.select(F.col("node").alias("cid"), "component"), "cid", "left").withColumn(
        "component", F.coalesce("component", "cid"))
    one = members.where("pass = 0").withColumn("pass", F.lit(-1)).withColumn("head", F.lit(0).cast("long"))  # the label as one range
    members = pin(members.unionByName(one))
    apart = (
        members.groupBy(*group, "component").agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*group).agg(F.sum("n").alias("size"), F.sum(F.col("n").cast("double") * F.col("n")).alias("same"))
        .withColumn("pairs", F.col("size").cast("double") * F.col("size") - F.col("same"))
    )
    full = pin(apart.where((F.col("size") > window + 1) & (F.col("pairs") > 0)))
    # Passes or the whole label, whichever takes fewer comparisons.
    ways = full.groupBy("label", "dim").agg(
        F.sum(F.when(F.col("pass") >= 0, F.col("pairs")).otherwise(0)).alias("passes"),
        F.max(F.when(F.col("pass") < 0, F.col("pairs"))).alias("all"),
    ).select("label", "dim", (F.col("passes") >= F.col("all")).alias("whole"))
    ranges = full.join(ways, ["label", "dim"]).where((F.col("pass") < 0) == F.col("whole")).select(*group)

    placed = pin(add_position(
        pin(members.join(ranges, group, "left_semi")), [F.col("component"), F.col("cid")], group, position="place", total="size"
    ).select(*group, "cid", "component", F.expr(f"cast((place - 1) div {BLOCK} as int)").alias("block")))
    blocks = placed.groupBy(*group, "block").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    i, j = (blocks.select(*group, *[F.col(c).alias(f"{c}_{n}") for c in ("block", "low", "high")]) for n in "ij")
    mixed = (F.col("low_i") != F.col("high_i")) | (F.col("low_j") != F.col("high_j")) | (F.col("low_i") != F.col("low_j"))
    tiles = i.join(j, group).where((F.col("block_i") <= F.col("block_j")) & mixed).select(*group, "block_i", "block_j")
    sides = F.array_distinct(F.array("block_i", "block_j"))
    rows = (
        tiles.withColumn("block", F.explode(sides)).join(placed, [*group, "block"])
        .join(classes.select("cid", "embedding"), "cid")
        .select(*group, "block_i", "block_j", "block", "cid", "component", "embedding")
    )

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        cid, component, block = (table.column(c).to_numpy() for c in ("cid", "component", "block"))
        column = table.column("embedding").chunk(0)
        unit = _unit_rows(column, len(column[0]))
        first, second = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
        close = unit[first] @ unit[second].T >= threshold
        close &= component[first][:, None] != component[second][None, :]
        own = np.unique(component, return_inverse=True)[1]
        a, b = [], []
        for x, y in np.argwhere(close):
            x, y = first[x], second[y]
            if own[x] != own[y]:
                a.append(cid[x])
                b.append(cid[y])
                own[own == own[y]] = own[x]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy(*group, "block_i", "block_j").applyInArrow(compare, "a bigint, b bigint").distinct()


def link_counts(classes: DataFrame, parts: DataFrame, threshold: float) -> DataFrame:
    """``cid, linked``: vectors of other classes within each component that are close enough, all pairs compared in blocks."""
    members = classes.join(parts.select(F.col("node").alias("cid"), "component"), "cid").select(
        "cid", "embedding", "copies", "component"
    )
    placed = pin(add_position(pin(members.drop("embedding")), [F.col("cid")], ["component"], position="place", total="size").select(
        "cid", "copies", "component", F.expr(f"cast((place - 1) div {BLOCK} as int)").alias("block"),
        F.expr(f"cast((size - 1) div {BLOCK} as int)").alias("last"),
    ))
    others = F.transform(F.sequence(F.lit(0), F.col("last")), lambda n: F.struct(
        F.least(n, F.col("block")).alias("i"), F.greatest(n, F.col("block")).alias("j")))
    rows = placed.join(members.select("cid", "embedding"), "cid").select(
        "cid", "copies", "component", "block", "embedding", F.explode(others).alias("tile")
    ).select("cid", "copies", "component", "block", "embedding", "tile.i", "tile.j")

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        cid, copies, block = (table.column(c).to_numpy() for c in ("cid", "copies", "block"))
        column = table.column("embedding").chunk(0)
        unit = _unit_rows(column, len(column[0]))
        i = table.column("i")[0].as_py()
        first, second = np.flatnonzero(block == i), np.flatnonzero(block != i)
        linked = np.zeros(len(cid), np.int64)
        if len(second):
            close = unit[first] @ unit[second].T >= threshold
            linked[first], linked[second] = close @ copies[second], close.T @ copies[first]
        elif i == table.column("j")[0].as_py():
            close = unit @ unit.T >= threshold
            np.fill_diagonal(close, False)
            linked = close @ copies
        return pa.table({"cid": pa.array(cid, pa.int64()), "linked": pa.array(linked, pa.int64())})

    tiles = rows.groupBy("component", "i", "j").applyInArrow(compare, "cid bigint, linked bigint")
    return tiles.groupBy("cid").agg(F.sum("linked").alias("linked"))


def near_vectors(vectors: DataFrame, threshold: float, window: int = WINDOW) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per vector; the smallest id of a component stays."""
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    classes = pin(vector_classes(vectors).withColumn("cid", F.monotonically_increasing_id()))
    number = classes.count()
    keyed = pin(projected(classes, passes_for(number, threshold, window)))
    near = pin(window_links(keyed, threshold, window))
    rest = range_links(keyed, classes, pin(components(near)), range_bits(number, window), threshold, window)
    parts = pin(components(near.unionByName(rest)))
    linked = link_counts(classes, parts, threshold)

    known = pin(classes.join(parts.withColumnRenamed("node", "cid"), "cid", "left").join(linked, "cid", "left").select(
        "label", "embedding", "rep", F.coalesce("component", "cid").alias("part"),
        (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
    ))
    lowest = known.groupBy("part").agg(F.min("rep").alias("component_id"))
    known = known.join(lowest, "part").select("label", "embedding", "n_links", "component_id")
    plain = F.transform("embedding", lambda x: x + F.lit(0).cast("float"))
    rows = vectors.select("vec_id", "label", plain.alias("embedding"))
    out = rows.join(known, ["label", "embedding"], "left").select(
        "vec_id", F.when(F.col("vec_id").isNotNull(), F.col("n_links")).alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


ORACLE = """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93
), counts AS (
  SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
), reach(vec_id, other) AS (
  SELECT a, b FROM links UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.other = links.a
), component AS (
  SELECT vec_id, min(other) AS low FROM reach GROUP BY vec_id
)
SELECT v.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(v.vec_id, coalesce(low, v.vec_id)) AS component_id,
       v.vec_id = least(v.vec_id, coalesce(low, v.vec_id)) AS kept
FROM embeddings v LEFT JOIN counts USING (vec_id) LEFT JOIN component USING (vec_id)
"""
