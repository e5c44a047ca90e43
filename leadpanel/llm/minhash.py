"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document's set holds its distinct shingles of words. Its sketch has ``bins``
coordinates: in round i each element is thrown into one bin, and a bin keeps the
smallest value of the first round that reached it; from round ``bins`` on,
round i fills bin i - bins by itself, so every coordinate is filled, and two
sketches agree in a coordinate with the sets' Jaccard similarity, concentrated
as with independent hashes. Bands of coordinates name candidates.

Documents with equal sets are one class. Inside a bucket each class is first
paired with the smallest; where a bucket still holds several components after
that, its members are compared across components until no pair is left. Each
link is confirmed on the full sets.

Cases: words are runs without ASCII white space, ``A-Z`` lower-cased; a text
with fewer words than a shingle is one shingle; null, empty and blank texts
have empty sets and link with nothing; a null id is kept and links with
nothing; rows that repeat an id are one document, which has the links of all
its texts; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from leadpanel.llm.components import components
from leadpanel.llm.tokens import WordNumbers, hold
from leadpanel.operators.ranking import add_position
from leadpanel.session import pin

#: Coordinates of a sketch, in bands of ``ROWS``. A pair of similarity 0.85 shares no band with probability
#: (1 - 0.85**6)**24 = 1e-5; of 0.8, 7e-4.
BANDS, ROWS = 24, 6
SEED = 20170

_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_SHIFT = np.uint64(33)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads all of them."""
    x = (x ^ (x >> _SHIFT)) * _MIX[0]
    x = (x ^ (x >> _SHIFT)) * _MIX[1]
    return x ^ (x >> _SHIFT)


_words = WordNumbers(xxhash.xxh3_64_intdigest)


def shingles(text: bytes, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of one UTF-8 text."""
    words = text.lower().split()  # both as the contract has them: A-Z only, and bytes 9 to 13 and 32
    if not words:
        return np.empty(0, np.uint64)
    found = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for at in range(size):
        out = _mix(out) + found[at:len(found) - size + 1 + at]
    return np.unique(_mix(out))


def set_hash(elements: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(elements.tobytes())


@lru_cache(maxsize=4)
def _round_seeds(bins: int) -> np.ndarray:
    return np.random.default_rng(SEED).integers(1, 1 << 63, 2 * bins, dtype=np.uint64)


def sketch(elements: np.ndarray, bins: int) -> np.ndarray:
    """The sketch of a set that is not empty: one value per bin, round and hash in one number."""
    seeds = _round_seeds(bins)
    out = np.zeros(bins, np.uint64)
    empty = np.ones(bins, bool)
    low = np.uint64((1 << 48) - 1)
    for number in range(2 * bins):
        hashed = _mix(elements ^ seeds[number])
        if number < bins:
            # The bin in front of 48 bits of hash: sorting brings each bin's smallest value first.
            bin_of = ((hashed >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
            keyed = np.sort((bin_of << np.uint64(48)) | (_mix(hashed) & low))
            hit = (keyed >> np.uint64(48)).astype(np.int64)
            first = np.flatnonzero(np.diff(hit, prepend=-1))
            fresh = first[empty[hit[first]]]
            out[hit[fresh]] = (keyed[fresh] & low) + (np.uint64(number) << np.uint64(48))
            empty[hit[fresh]] = False
        elif empty[number - bins]:
            out[number - bins] = (hashed.min() & low) + (np.uint64(number) << np.uint64(48))
            empty[number - bins] = False
        if not empty.any():
            break
    return out


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band, different for each band number."""
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for column in values.reshape(bands, rows).T:
        keys = _mix(keys ^ column) + np.uint64(0x9E3779B97F4A7C15)
    return _mix(keys)


def sketch_documents(docs: DataFrame, shingle: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, set_hash, keys`` of each document; ``keys`` is null for an empty set."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("minhash", _words.clear)
        for batch in batches:
            sizes, hashes, keys = [], [], []
            for text in batch.column("text").cast(pa.binary()):
                found = shingles(text.as_py() or b"", shingle)
                sizes.append(len(found))
                hashes.append(set_hash(found))
                keys.append(band_keys(sketch(found, bands * rows), bands, rows).astype(np.int64) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(hashes, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_hash", "keys"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_shingles bigint, set_hash binary, keys array<bigint>"
    )


def _classes(sketched: DataFrame) -> DataFrame:
    """One row per distinct set: ``cid`` (its number), ``rep`` (smallest id), ``n_shingles, set_hash, keys``."""
    linkable = sketched.where(F.col("doc_id").isNotNull() & F.col("keys").isNotNull())
    grouped = linkable.groupBy("set_hash").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys")
    )
    return pin(grouped.withColumn("cid", F.monotonically_increasing_id()))  # pinned: the numbers stay


def _shared_buckets(classes: DataFrame) -> DataFrame:
    """``bucket, cid, n_shingles, hub`` for all classes in buckets of more than one."""
    rows = classes.select("cid", "n_shingles", F.explode("keys").alias("bucket"))
    hubs = rows.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("members"), F.min(F.struct("cid", "n_shingles")).alias("hub")
    ).where("members > 1").select("bucket", "hub")
    return rows.join(hubs, "bucket")


def _class_texts(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``cid, rep, set_hash, text`` of the wanted classes; where rows share an id, every text of it."""
    named = classes.join(wanted, "cid", "left_semi").select("cid", "rep", "set_hash")
    return named.join(docs.select(F.col("doc_id").alias("rep"), "text"), "rep")


def _hub_links(buckets: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``rep_a, rep_b`` of the links between each class and the smallest one of each of its buckets."""
    fits = 100 * F.least("n_shingles", "hub.n_shingles") >= percent * F.greatest("n_shingles", "hub.n_shingles")
    pairs = buckets.where((F.col("cid") != F.col("hub.cid")) & fits).select(F.col("hub.cid").alias("a"), F.col("cid").alias("b")).distinct()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("minhash", _words.clear)
        last: tuple = (None, None, None)
        for batch in batches:
            columns = {name: batch.column(name) for name in ("set_a", "set_b")}
            text_a, text_b = batch.column("text_a").cast(pa.binary()), batch.column("text_b").cast(pa.binary())
            keep = []
            for row in range(batch.num_rows):
                one = text_a[row].as_py() or b""
                if last[0] != one:  # rows come in the order of a: its set is made once
                    mine = shingles(one, shingle)
                    last = (one, mine, set_hash(mine))
                mine, other = last[1], shingles(text_b[row].as_py() or b"", shingle)
                asked = last[2] == columns["set_a"][row].as_py() and set_hash(other) == columns["set_b"][row].as_py()
                union = len(np.union1d(mine, other))
                keep.append(asked and 100 * (len(mine) + len(other) - union) >= percent * union)
            yield batch.select(["rep_a", "rep_b"]).filter(pa.array(keep, pa.bool_()))

    def side(name: str) -> DataFrame:
        return texts.select(F.col("cid").alias(name), *[F.col(c).alias(f"{short}_{name}") for c, short in (("rep", "rep"), ("set_hash", "set"), ("text", "text"))])

    return pairs.join(side("b"), "b").join(side("a"), "a").select(
        "rep_a", "rep_b", "set_a", "set_b", "text_a", "text_b"
    ).mapInArrow(check, "rep_a bigint, rep_b bigint").distinct()


#: Members of a bucket that are compared with as many others in one task.
BLOCK = 128
_COLUMNS = 8192


def _common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of the sets share, by products of blocks of the incidence matrix."""
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    shared = np.bincount(column, minlength=len(values)) > 1  # an element of one set alone counts for no pair
    number = np.cumsum(shared) - 1
    use = shared[column]
    row, column = row[use], number[column[use]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for low in range(0, int(shared.sum()), _COLUMNS):
        first, last = np.searchsorted(column, [low, low + _COLUMNS])
        block = np.zeros((len(sets), _COLUMNS), np.float32)
        block[row[first:last], column[first:last] - low] = 1
        out += block @ block.T
    return out


def _tile_links(buckets: DataFrame, texts: DataFrame, parts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``rep_a, rep_b`` of links between members of a bucket that ``parts`` (``node, component``) leaves apart.

    A bucket's members are put in order of their component and cut into blocks;
    two blocks meet in one task unless both lie in one component. Only links
    that join components come out, fewer than there are members.
    """
    reps = texts.select("cid", "rep").distinct()
    members = buckets.select("bucket", "cid").join(reps, "cid").join(
        parts.select(F.col("node").alias("rep"), "component"), "rep", "left"
    ).select("bucket", "cid", F.coalesce("component", "rep").alias("component"))
    members = pin(members)
    split = members.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.count(F.lit(1)).alias("size"), F.sum(F.xxhash64("cid").cast("decimal(20,0)")).alias("content"),
    ).where("low <> high")
    once = split.groupBy("size", "content").agg(F.min("bucket").alias("bucket"))  # bands often agree on a bucket
    left = members.join(once.select("bucket"), "bucket", "left_semi")
    placed = pin(add_position(left, [F.col("component"), F.col("cid")], ["bucket"], position="place", total="all_places")
                 .select("bucket", "cid", "component", F.expr(f"cast((place - 1) div {BLOCK} as int)").alias("block")))
    blocks = placed.groupBy("bucket", "block").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    i, j = (blocks.select("bucket", *[F.col(c).alias(f"{c}_{n}") for c in ("block", "low", "high")]) for n in "ij")
    apart = (F.col("low_i") != F.col("high_i")) | (F.col("low_j") != F.col("high_j")) | (F.col("low_i") != F.col("low_j"))
    tiles = i.join(j, "bucket").where((F.col("block_i") <= F.col("block_j")) & apart).select("bucket", "block_i", "block_j")
    sides = F.array_distinct(F.array("block_i", "block_j"))
    rows = (
        tiles.select("bucket", "block_i", "block_j", F.explode(sides).alias("block"))
        .join(placed, ["bucket", "block"])
        .join(texts, "cid")
        .select("bucket", "block_i", "block_j", "component", "rep", "set_hash", "text")
    )

    def compare(table: pa.Table) -> pa.Table:
        hold("minhash", _words.clear)
        component, rep, hashes = (table.column(c).to_pylist() for c in ("component", "rep", "set_hash"))
        sets = [shingles(text.as_py() or b"", shingle) for text in table.column("text").cast(pa.binary())]
        for at, (found, asked) in enumerate(zip(sets, hashes)):
            if set_hash(found) != asked:  # another text of the same id
                sets[at] = np.empty(0, np.uint64)
        sizes = np.array([len(x) for x in sets], np.float64)
        common = _common_counts(sets)
        union = sizes[:, None] + sizes[None, :] - common
        own = np.unique(component, return_inverse=True)[1]
        close = (100 * common >= percent * union) & (common > 0) & (own[:, None] != own[None, :])
        links = []
        for x, y in np.argwhere(np.triu(close, 1)):
            if own[x] != own[y]:
                links.append((rep[x], rep[y]))
                own[own == own[y]] = own[x]
        return pa.table({"rep_a": pa.array([x for x, _ in links], pa.int64()), "rep_b": pa.array([y for _, y in links], pa.int64())})

    return rows.groupBy("bucket", "block_i", "block_j").applyInArrow(compare, "rep_a bigint, rep_b bigint").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per document: the smallest id of each component stays."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = pin(sketch_documents(docs, shingle, bands, rows))
    classes = _classes(sketched)
    same = sketched.where("doc_id is not null and keys is not null").select("doc_id", "set_hash").join(
        classes.select("set_hash", "rep"), "set_hash"
    ).where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct()
    buckets = pin(_shared_buckets(classes))
    texts = pin(_class_texts(docs, classes, buckets.select("cid").distinct()))
    near = pin(_hub_links(buckets, texts, shingle, percent))
    parts = pin(components(near, "rep_a", "rep_b"))
    rest = _tile_links(buckets, texts, parts, shingle, percent)
    links = same.unionByName(
        near.unionByName(rest).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))
    )
    found = components(links).select(F.col("node").alias("doc_id"), "component")
    component = F.coalesce("component", "doc_id")
    return sketched.select("doc_id", "n_shingles").join(found, "doc_id", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, with all its columns; rows that repeat an id that stays all stay."""
    kept = near_duplicates(docs, shingle, percent).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    rows = docs.select(F.struct("*").alias("row"))
    return rows.join(kept, F.col("row.doc_id").cast("long").eqNullSafe(F.col("kept_id")), "left_semi").select("row.*")


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[ 	-
]+'), lambda w: w <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                      WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
                 END AS s
  FROM words
), elements AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS e FROM sets
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) + any_value(b.n) - count(*) AS either, count(*) AS both_
  FROM elements a JOIN elements b ON a.e = b.e AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM common WHERE 100 * both_ >= 85 * either
  UNION ALL SELECT b, a FROM common WHERE 100 * both_ >= 85 * either
), reach(doc_id, other) AS (
  SELECT a, b FROM links UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a
), component AS (
  SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(low, d.doc_id)) AS kept
FROM sets d LEFT JOIN component USING (doc_id)
"""
