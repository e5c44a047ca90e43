import random
import re

import numpy as np
import pytest

from leadpanel.llm import minhash

SCHEMA = "doc_id bigint, text string, rep string, keys int"


def set_of(text, size):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def brute(rows, size=3, percent=85):
    sets = [set_of(text, size) for _, text, *_ in rows]
    near = [[j for j, b in enumerate(sets) if a and b and j != i and rows[i][0] is not None and rows[j][0] is not None
             and (100 * len(a & b) >= percent * len(a | b))] for i, a in enumerate(sets)]
    same = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            same.setdefault(row[0], []).append(i)
    out = []
    for i, row in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            x = todo.pop()
            todo += [y for y in near[x] + same.get(rows[x][0], []) if y not in seen and not seen.add(y)]
        component = None if row[0] is None else min(rows[x][0] for x in seen)
        out.append((row[0], len(sets[i]), component, row[0] == component))
    return sorted(out, key=repr)


def run(spark, rows, **more):
    out = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), **({"shingle": 3, "percent": 85} | more))
    return sorted(map(tuple, out.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def family(rng, at, copies, words, edits):
    base = [f"w{rng.randrange(10_000)}" for _ in range(words)]
    rows = []
    for _ in range(copies):
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(words)] = f"x{rng.randrange(10_000)}"
        rows.append((at, " ".join(text), None, None))
        at += 1
    return rows


def test_nulls_short_texts_ties_and_repeats(spark):
    rows = [
        (1, "One two THREE four", "x", 1), (2, "one  two\nthree\tfour", None, None), (2, "one two three four", None, None), (3, None, None, None),
        (4, "", None, None), (5, " \n\t ", None, None), (6, "one", None, None), (7, "ONE", None, None), (8, "one two", None, None),
        (None, "one two three four", None, None), (9, "É two three", None, None), (10, "é two three", None, None),
        (11, "two one", None, None), (-1, "one two", None, None), (12, "a\x1cb c d", None, None), (13, "a b c d", None, None),
        (14, "x\x00y z", None, None),
    ]
    assert run(spark, rows) == brute(rows)


def test_an_id_with_two_texts_joins_their_groups(spark):
    rows = [(5, "a b c d", None, None), (5, "e f g h", None, None), (3, "a b c d", None, None), (2, "e f g h", None, None)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("seed", range(3))
def test_families_at_the_threshold(spark, seed):
    rng = random.Random(seed)
    rows = []
    for copies, words, edits in ((60, 120, 4), (30, 60, 3), (10, 300, 12), (4, 20, 1), (80, 40, 1)):
        rows += family(rng, len(rows), copies, words, edits)
    rows += [(len(rows) + i, " ".join(f"z{rng.randrange(500)}" for _ in range(50)), None, None) for i in range(50)]
    assert run(spark, rows) == brute(rows)


def test_large_buckets_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rows = family(random.Random(7), 0, 90, 60, 4)
    assert run(spark, rows) == brute(rows)


def test_long_text_and_other_parameters(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, long, None, None), (2, long + " more", None, None), (3, long[: len(long) // 2], None, None)]
    assert run(spark, rows, shingle=5, percent=80) == brute(rows, 5, 80)


def test_sketches_fill_and_agree_with_the_similarity():
    rng = np.random.default_rng(1)
    for size in (1, 2, 5, 100, 5_000):
        assert (minhash.sketch(rng.integers(0, 1 << 63, size, dtype=np.uint64), 144) > 0).all()
    agree = []
    for _ in range(30):
        shared, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (300, 50, 50))
        x, y = (minhash.sketch(np.concatenate([shared, own]), 144) for own in (a, b))
        agree.append((x == y).mean())
    assert abs(np.mean(agree) - 300 / 400) < 0.03


def test_one_of_each_group_stays_with_its_columns(spark):
    rows = [(1, "a b c d", "x", 1), (2, "a b c d", "y", 2), (3, None, "z", 3), (4, None, None, None), (None, "a b c d", "n", 4)]
    out = minhash.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "rep", "keys"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([rows[0], *rows[2:]], key=repr)


def test_empty_table(spark):
    assert run(spark, []) == []
