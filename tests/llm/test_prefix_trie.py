import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leadpanel.llm import prefix_trie as T

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, prefix int, size double"


def brute(rows):
    """The trie as a dictionary of paths, every subtree walked."""
    turns = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            turns[conv_id].append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    turns = {k: [(role, text) for *_, role, _, text in sorted(v)] for k, v in turns.items()}
    members = defaultdict(list)
    for conv_id in sorted(turns):
        h = zlib.crc32(str(conv_id).encode()) % 9
        path = tuple(turns.get(conv_id - conv_id % 5, [])[:h] + turns[conv_id][h:])
        for depth in range(len(path) + 1):
            members[path[:depth]].append((conv_id, depth == len(path)))
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    total = {}
    for path in sorted(members, key=len, reverse=True):
        below = children[path]
        cost = (len(members[path]) - 1) * (len(path[-1][1].encode()) if path else 0)
        total[path] = (sum(total[p][0] for p in below) or 1, cost + sum(total[p][1] for p in below))
    return sorted((
        members[path][0][0], len(path), members[path[:-1]][0][0] if path else None, len(members[path]), len(children[path]), *total[path],
        hashlib.sha256(",".join(str(c) for c, ended in members[path] if ended).encode()).hexdigest()) for path in members)


def nodes(spark, rows, partitions=5, **settings):
    out = T.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(partitions), **settings)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=lambda r: r[:2])


def conversations(seed, n, longest, texts):
    rng = random.Random(seed)
    rows = []
    for conv_id in rng.sample(range(4 * n), n):
        for turn in range(rng.randrange(1, longest)):
            rows.append((conv_id, turn, rng.choice(["user", "assistant"]), rng.choice(texts), "x", 1, 2.0))
    return rows


@pytest.mark.parametrize("settings", [{}, {"per_prefix": 1, "max_width": 1}], ids=["wide", "saturated"])
def test_every_node_by_brute_force(spark, settings):
    """Few texts, so that prefixes are shared by chance at every depth; a sketch too small for its table changes nothing."""
    rows = conversations(1, 150, 14, ["a", "b", "é😀"])
    assert nodes(spark, rows, **settings) == brute(rows)


def test_copies_and_tails(spark):
    """Hundreds of copies of one conversation beside long ones that share nothing."""
    rows = [(c, t, "user", f"copy {t}", None, None, None) for c in range(300) for t in range(9)]
    rows += [(1000 + c, t, "user", f"own {c} {t}", None, None, None) for c in range(20) for t in range(40)]
    assert nodes(spark, rows) == brute(rows)


def test_one_conversation_holds_most_turns(spark):
    """It lies in several runs; digests, places and tails go on from run to run."""
    rows = [(3, t, "user", f"turn {t}", None, None, None) for t in range(4000)] + conversations(2, 30, 6, ["a", "b"])
    want = brute(rows)
    assert nodes(spark, rows) == want
    rows += [(4000 + 5 * k, t, "user", f"turn {t}", None, None, None) for k in range(3) for t in range(300)]
    assert nodes(spark, rows) == brute(rows)


def test_nulls_ties_repeats_and_gaps(spark):
    rows = [
        (None, 0, "user", "nobody", None, None, None), (5, None, "user", "first", None, None, None), (5, None, None, None, None, None, None),
        (5, 1, "b", "tie", None, None, None), (5, 1, "a", "tie", None, None, None), (5, 1, "a", "tie", None, None, None), (5, 1, "a", "other", None, None, None),
        (6, 2**40, "user", "", None, None, None), (6, -3, None, "early", None, None, None), (7, 0, "user", "x" * 200_000, None, None, None),
        (8, 0, "", "", None, None, None), (8, 0, "", "", None, None, None),
    ]
    assert nodes(spark, rows) == brute(rows)


def test_a_turnless_conversation_is_a_member_of_the_root(spark):
    alone = next(c for c in range(1, 999) if c % 5 and zlib.crc32(str(c).encode()) % 9)
    assert nodes(spark, [(alone, 0, "user", "gone", None, None, None)]) == [
        (alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "a", None, None, None)]])
def test_empty_tables(spark, rows):
    assert T.prefix_trie(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_the_sketch_never_counts_too_little(spark):
    rng = np.random.default_rng(3)
    keys = [rng.bytes(16) for _ in range(3000)]
    table = spark.createDataFrame([(k,) for k in keys + keys[:500]], "prefix binary").repartition(6)
    for width in (T.BLOCK // T.DEPTH, 1 << 17):
        counts = T.count_min(table, width)
        estimate = counts[T.cells(pa.array(keys, pa.binary()), width)].min(axis=1)
        assert (estimate[:500] == 2).all() and (estimate >= 1).all()
    assert (estimate[500:] == 1).mean() > 0.99


def test_tails_are_not_shuffled_for_grouping(spark):
    """Only what may be shared is grouped: with own turns everywhere, no row but the roots."""
    rows = [(c, t, "user", f"{c} {t}", None, None, None) for c in range(1, 400) for t in range(6)]
    turns, _ = T.rebuild(T.pin(T.ordered_turns(spark.createDataFrame(rows, SCHEMA))))
    kept = T.screened(T.pin(T.prefixes(turns)))
    singles = kept.groupBy("depth", "prefix").count().where(F.col("count") == 1).count()
    assert kept.where("NOT shared").count() > 0.95 * singles
