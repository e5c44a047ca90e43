"""The trie of conversation prefixes, with count-min screening.

A prefix is known by its depth and a 127-bit digest: a polynomial in the digests
of its turns modulo the prime 2**127 - 1, which can be carried from one sorted
run to the next. All prefixes go into a count-min sketch of bounded size. An
estimate of one proves that a prefix is in one conversation alone; so are all
longer ones of that conversation, and their nodes are written where they are.
Only prefixes that may be shared are shuffled and grouped exactly. A sketch too
small for its table screens less; the rows stay the same.

A node's smallest member holds it. The nodes that one conversation holds are
the end of its path, so what lies below a node is a sum over its members of
what each of them holds, and needs no walk from level to level.

Cases: rows without a conversation id are left out; null role or text is
empty; null turns come first; ties of a turn go by role, then by the text's
SHA-256; rows that repeat are turns of their own; a conversation is no row of
its own anywhere, so it may have any number of turns; without conversations
there is no node, not even a root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from leadpanel.operators.runs import scan, sorted_runs, summaries
from leadpanel.operators.ranking import add_position, add_running_sums
from leadpanel.session import pin

#: The prefix digest: a polynomial of this base modulo this prime (both are public; turns enter as SHA-256).
PRIME = 2**127 - 1
BASE = int.from_bytes(hashlib.sha256(b"prefix trie").digest()[:15]) | 1
#: Counters a row of the sketch has for each prefix, at most this many in all (two bits each), and its rows.
PER_PREFIX, MAX_WIDTH, DEPTH = 4, 1 << 24, 4
#: Counters of a block, the unit in which sketches are added up.
BLOCK = 1 << 16
#: Ids that are joined into one piece of text before a node's pieces are hashed.
PIECE = 4096
EMPTY = hashlib.sha256(b"").hexdigest()

c = F.col


# ---- turns -----------------------------------------------------------------------------
def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, at, n_turns, digest, bytes``: each turn's place from 1, the digest of role and text, and the text's size."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    told = conversations.where("conv_id IS NOT NULL").select(
        c("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), F.sha2(text.cast("binary"), 256).alias("said"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    placed = add_position(told, [c("turn").asc_nulls_first(), c("role"), c("said")], ["conv_id"], "at", "n_turns")
    # The digest of the role has one length, so the two cannot run into each other.
    digest = F.unhex(F.sha2(F.concat(F.sha2(c("role").cast("binary"), 256), c("said")).cast("binary"), 256))
    return placed.select("conv_id", "at", "n_turns", digest.alias("digest"), "bytes")


def borrowed(conv_id: Column) -> Column:
    """How many turns a rebuilt conversation takes from the first of its five."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 9).cast("bigint")


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns ``conv_id, depth, digest, bytes, size`` and ``conv_id, size`` of every conversation, turnless ones too."""
    sizes = turns.where("at = 1").select("conv_id", "n_turns", borrowed(c("conv_id")).alias("h"))
    sizes = sizes.withColumn("source", c("conv_id") - c("conv_id") % 5)
    sources = sizes.select(c("conv_id").alias("source"), c("n_turns").alias("_first"))
    plans = pin(sizes.join(sources, "source", "left").select(
        "conv_id", "source", "h", F.least("h", F.coalesce("_first", F.lit(0))).alias("head"), "n_turns",
    ).withColumn("size", c("head") + F.greatest(c("n_turns") - c("h"), F.lit(0))))
    heads = turns.where("at <= 8 AND conv_id % 5 = 0").withColumnRenamed("conv_id", "source").join(
        plans.select("conv_id", "source", "head", "size"), "source").where("at <= head")
    own = turns.join(plans.select("conv_id", "h", "head", "size"), "conv_id").where("at > h")
    out = heads.select("conv_id", c("at").alias("depth"), "digest", "bytes", "size").unionByName(
        own.select("conv_id", (c("head") + c("at") - c("h")).alias("depth"), "digest", "bytes", "size"))
    return out, plans.select("conv_id", "size")


# ---- prefix digests ----------------------------------------------------------------------
def _number(digest: bytes) -> int:
    return int.from_bytes(digest[:15])


def prefixes(rebuilt: DataFrame) -> DataFrame:
    """Rebuilt turns with ``parent`` and ``prefix``, the digests of the path before and with each turn; sorted runs."""
    runs = sorted_runs(rebuilt, c("conv_id"), c("depth"))

    def summary(batches: Iterator[pa.RecordBatch]) -> dict:
        first = last = None
        value = turns = 0
        for batch in batches:
            for conv_id, digest in zip(batch.column("conv_id").to_pylist(), batch.column("digest").to_pylist()):
                if conv_id != last:
                    first = conv_id if first is None else first
                    last, value, turns = conv_id, 0, 0
                value, turns = (value * BASE + _number(digest)) % PRIME, turns + 1
        return {"first": first, "last": last, "value": value.to_bytes(16), "turns": turns}

    carried, open_conv, open_value = {}, None, 0
    for row in summaries(runs, summary, "first bigint, last bigint, value binary, turns bigint"):
        before = open_value if row["first"] == open_conv else 0
        carried[row["_run"]] = before
        value = int.from_bytes(row["value"])
        if row["first"] == row["last"]:  # the whole run goes on with what came before
            value = (before * pow(BASE, row["turns"], PRIME) + value) % PRIME
        open_conv, open_value = row["last"], value

    def step(batches: Iterator[pa.RecordBatch], value: int) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            parents, found = [], []
            for conv_id, digest in zip(batch.column("conv_id").to_pylist(), batch.column("digest").to_pylist()):
                if conv_id != last:
                    value = value if last is None else 0
                    last = conv_id
                parents.append(value.to_bytes(16))
                value = (value * BASE + _number(digest)) % PRIME
                found.append(value.to_bytes(16))
            kept = ["conv_id", "depth", "bytes", "size"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in kept), pa.array(parents, pa.binary()), pa.array(found, pa.binary())], [*kept, "parent", "prefix"])

    return scan(runs, carried, step, "conv_id bigint, depth bigint, bytes bigint, size bigint, parent binary, prefix binary")


# ---- screening -----------------------------------------------------------------------------
def sketch_width(n: int, per_prefix: int = PER_PREFIX, most: int = MAX_WIDTH) -> int:
    """Counters in a row of the sketch: a power of two, bounded however many prefixes there are."""
    return max(BLOCK // DEPTH, min(most, 1 << max(0, per_prefix * n - 1).bit_length()))


def cells(found: pa.Array, width: int) -> np.ndarray:
    """The counter of each prefix in each row of the sketch, (prefixes, DEPTH)."""
    words = np.frombuffer(b"".join(found.to_pylist()), ">u8").reshape(-1, 2).astype(np.uint64)
    with np.errstate(over="ignore"):
        mixed = (words[:, :1] + words[:, 1:] * (2 * np.arange(1, DEPTH + 1, dtype=np.uint64) + 1)) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(24)) & np.uint64(width - 1)).astype(np.int64) + width * np.arange(DEPTH)


def added(counts: np.ndarray, at: np.ndarray) -> None:
    """Counts up each cell by how often it occurs, to two at most: more is told apart by the exact grouping."""
    places, n = np.unique(at, return_counts=True)
    counts[places] = np.minimum(2, counts[places] + np.minimum(n, 2)).astype(np.uint8)


def count_min(found: DataFrame, width: int) -> np.ndarray:
    """The sketch of all prefixes: each task's own, added up block by block."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(width * DEPTH, np.uint8)
        for batch in batches:
            if batch.num_rows:
                for row in cells(batch.column("prefix"), width).T:
                    added(counts, row)
        used = [b for b in range(0, len(counts), BLOCK) if counts[b:b + BLOCK].any()]
        for b in used:
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([counts[b:b + BLOCK].tobytes()], pa.binary())], ["block", "counts"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts")):
                more = np.frombuffer(counts.as_buffer(), np.uint8)
                if block != at:
                    if at is not None:
                        yield packed(at, total)
                    at, total = block, more.copy()
                else:
                    total = np.minimum(2, total + more)
        if at is not None:
            yield packed(at, total)

    def packed(block: int, counts: np.ndarray) -> pa.RecordBatch:
        """Two bits a counter: seen, and seen again."""
        bits = np.packbits(np.concatenate([counts > 0, counts > 1])).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([bits], pa.binary())], ["block", "bits"])

    parts = found.select("prefix").mapInArrow(partial, "block bigint, counts binary")
    rows = parts.repartition("block").sortWithinPartitions("block").mapInArrow(summed, "block bigint, bits binary").collect()  # bounded by MAX_WIDTH
    out = np.zeros(width * DEPTH, np.uint8)
    for row in rows:
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8))
        half = len(bits) // 2
        out[row["block"]:row["block"] + half] = bits[:half] + bits[half:]
    return out


def screened(found: DataFrame, per_prefix: int = PER_PREFIX, max_width: int = MAX_WIDTH) -> DataFrame:
    """``found`` with ``shared`` and ``top``.

    ``shared`` is false only where a prefix is proven to be in one conversation alone, and for what follows it there;
    ``top`` marks the first such row of a conversation in its run.
    """
    width = sketch_width(found.count(), per_prefix, max_width)
    sent = found.sparkSession.sparkContext.broadcast(np.packbits(count_min(found, width) > 1))

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        again = sent.value
        alone_in, last = False, None  # a conversation goes on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            at = cells(batch.column("prefix"), width)
            maybe = ((again[at >> 3] >> (7 - (at & 7))) & 1).all(axis=1)
            conv = batch.column("conv_id").to_numpy()
            starts = np.append(True, conv[1:] != conv[:-1])
            starts[0] = conv[0] != last
            # Once alone, alone to the conversation's end: the last place at or before each row that starts one or is alone.
            place = np.arange(len(conv))
            since = np.maximum.accumulate(np.where(starts, place, -1))
            first_alone = np.maximum.accumulate(np.where(~maybe, place, -1))
            alone = np.where(since >= 0, first_alone >= since, alone_in | (first_alone >= 0))
            top = alone & (starts | ~np.append(alone_in, alone[:-1]))
            alone_in, last = bool(alone[-1]), conv[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(~alone), pa.array(top)], [*batch.schema.names, "shared", "top"])

    schema = ", ".join(f"{name} {kind}" for name, kind in found.dtypes) + ", shared boolean, top boolean"
    return found.mapInArrow(screen, schema)


# ---- nodes -----------------------------------------------------------------------------------
def end_digests(ends: DataFrame) -> DataFrame:
    """``prefix, depth, ends_sha256`` of the ids that end at a node, joined by commas in numeric order.

    Runs join their ids into pieces first, so a node where very many conversations end is hashed from few rows.
    """
    runs = sorted_runs(ends.select("depth", "prefix", "conv_id"), c("depth"), c("prefix"), c("conv_id"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, number = None, [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"depth": node[0], "prefix": node[1], "run": run, "piece": number, "ids": ",".join(map(str, ids))}], target)

        for batch in batches:
            for *key, run, conv_id in zip(*(batch.column(x).to_pylist() for x in ("depth", "prefix", "_run", "conv_id"))):
                if key != node or len(ids) >= PIECE:
                    if ids:
                        yield out()
                    node, ids, number = key, [], number + 1
                ids.append(conv_id)
        if ids:
            yield out()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            for *key, ids in zip(*(batch.column(x).to_pylist() for x in ("depth", "prefix", "ids"))):
                if key != node:
                    if node:
                        yield pa.RecordBatch.from_pylist([{"depth": node[0], "prefix": node[1], "ends_sha256": digest.hexdigest()}], result)
                    node, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
        if node:
            yield pa.RecordBatch.from_pylist([{"depth": node[0], "prefix": node[1], "ends_sha256": digest.hexdigest()}], result)

    target = pa.schema([("depth", pa.int64()), ("prefix", pa.binary()), ("run", pa.int32()), ("piece", pa.int64()), ("ids", pa.string())])
    result = pa.schema([("depth", pa.int64()), ("prefix", pa.binary()), ("ends_sha256", pa.string())])
    cut = runs.mapInArrow(pieces, "depth bigint, prefix binary, run int, piece bigint, ids string")
    return cut.repartition("depth", "prefix").sortWithinPartitions("depth", "prefix", "run", "piece").mapInArrow(
        hashed, "depth bigint, prefix binary, ends_sha256 string")


#: Digest of the empty path.
ROOT = (0).to_bytes(16)


def prefix_trie(conversations: DataFrame, per_prefix: int = PER_PREFIX, max_width: int = MAX_WIDTH) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    turns, sizes = rebuild(pin(ordered_turns(conversations)))
    found = pin(prefixes(turns))
    rows = pin(screened(found, per_prefix, max_width))

    # Every conversation starts at the root, which is grouped with the prefixes that may be shared.
    root = sizes.select("conv_id", F.lit(0).cast("bigint").alias("depth"), F.lit(0).cast("bigint").alias("bytes"), "size",
                        F.lit(None).cast("binary").alias("parent"), F.lit(ROOT).alias("prefix"))
    shared = rows.where("shared").drop("shared", "top").unionByName(root)
    tails = rows.where("NOT shared")

    grouped = pin(shared.groupBy("depth", "prefix").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.first("bytes").alias("bytes"), F.first("parent").alias("parent")))
    tops = pin(tails.where("top").select("conv_id", "depth", "parent"))
    below = grouped.where("depth > 0").select("depth", "parent").unionByName(tops.select("depth", "parent"))
    children = below.groupBy((c("depth") - 1).alias("depth"), c("parent").alias("prefix")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = grouped.join(children, ["depth", "prefix"], "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)), "value": (c("n_convs") - 1) * c("bytes")})
    # What each conversation holds: the values of its nodes, and its end if nothing follows there.
    nodes = pin(add_running_sums(nodes, [c("depth")], ["value"], ["conv_id"]).withColumnsRenamed({"cum_value": "upto", "total_value": "held"}))
    ends = nodes.select("conv_id", "depth", "n_children", "held").join(sizes, "conv_id")
    holds = ends.groupBy("conv_id").agg(
        F.first("held").alias("held"), F.max((c("depth") == c("size")) & (c("n_children") == 0)).cast("bigint").alias("leaf"))
    holds = holds.join(tops.select("conv_id", F.lit(1).alias("_tail")).distinct(), "conv_id", "full_outer").select(
        "conv_id", F.coalesce("held", F.lit(0)).alias("held"), F.greatest(F.coalesce("leaf", F.lit(0)), F.coalesce("_tail", F.lit(0))).alias("leaf"))
    # A node's subtree is what its members hold, less what its own holder holds above it.
    sums = shared.select("depth", "prefix", "conv_id").join(holds, "conv_id").groupBy("depth", "prefix").agg(
        F.sum("held").alias("_held"), F.sum("leaf").alias("n_leaves"))
    digests = end_digests(shared.where("depth = size"))
    parents = grouped.select((c("depth") + 1).alias("depth"), c("prefix").alias("parent"), c("conv_id").alias("parent_conv_id"))
    inner = nodes.join(sums, ["depth", "prefix"], "left").join(digests, ["depth", "prefix"], "left").join(parents, ["depth", "parent"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"),
        (F.coalesce("_held", F.lit(0)) - (c("upto") - c("value"))).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))

    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    last = c("depth") == c("size")
    # The parent of a top is grouped, unless the conversation's tail began in the run before.
    hung = tails.where("top").join(parents, ["depth", "parent"], "left").select(
        "conv_id", "depth", "size", F.coalesce("parent_conv_id", "conv_id").alias("parent_conv_id"))
    lone = tails.where("NOT top").select("conv_id", "depth", "size", c("conv_id").alias("parent_conv_id")).unionByName(hung)
    outer = lone.select(
        "conv_id", "depth", "parent_conv_id", one.alias("n_convs"), F.when(last, none).otherwise(one).alias("n_children"), one.alias("n_leaves"),
        none.alias("saved_tokens"), F.when(last, F.sha2(c("conv_id").cast("string").cast("binary"), 256)).otherwise(EMPTY).alias("ends_sha256"))
    return inner.unionByName(outer)


#: Paths as lists of turns, every node's ancestors written out: another way to the same rows.
ORACLE = r"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), told AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS source, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ord(ch) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM told), crc_table
), rebuilt AS (
  SELECT c.conv_id, 0 AS part, place, role, text FROM convs c JOIN told t ON t.conv_id = c.source AND t.place <= c.h
  UNION ALL SELECT c.conv_id, 1, place, role, text FROM convs c JOIN told t ON t.conv_id = c.conv_id AND t.place > c.h
), numbered AS (
  SELECT conv_id, row_number() OVER w AS depth, octet_length(encode(text)) AS bytes,
         md5(role) || sha256(text) AS turn FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, place)
), paths AS (
  SELECT conv_id, depth, bytes, string_agg(turn, ' ') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM numbered
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), hashed AS (
  SELECT conv_id, CAST(depth AS BIGINT) AS depth, bytes, sha256(path) AS node,
         lag(sha256(path)) OVER (PARTITION BY conv_id ORDER BY depth) AS parent, depth = max(depth) OVER (PARTITION BY conv_id) AS ended FROM paths
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, any_value(parent) AS parent, count(*) AS n_convs, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256
  FROM hashed GROUP BY node, depth
), families AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes k WHERE k.parent = n.node AND k.depth = n.depth + 1) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.node = n.parent AND p.depth = n.depth - 1
), below AS (
  SELECT a.node, a.depth, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((f.n_convs - 1) * f.bytes) AS saved_tokens
  FROM families f JOIN hashed a ON a.conv_id = f.conv_id AND a.depth <= f.depth GROUP BY 1, 2
)
SELECT f.conv_id, f.depth, f.parent_conv_id, f.n_convs, f.n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
       CAST(b.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM families f JOIN below b USING (node, depth)
"""
