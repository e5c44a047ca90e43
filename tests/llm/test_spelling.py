import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from leadpanel.llm import spelling
from leadpanel.operators import runs

SCHEMA = "doc_id bigint, text string, word string, n int, id string, form double"
TARGETS = "word string, n bigint"


def brute_words(docs, min_length, min_count, every):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(words, ratio):
    near = {w: [v for v in words if is_near(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def collected(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = df.collect()
    out = {r["word"]: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_every_pair_by_brute_force(spark):
    """Words over three letters, so that runs of one letter, hubs and chains of forms are common."""
    rng = random.Random(3)
    texts = []
    for doc_id in range(120):
        words = ["".join(rng.choice("abé") for _ in range(rng.choice([3, 4, 5, 6, 7]))) for _ in range(60)]
        words += ["abbaé", "abbaa"] * rng.randrange(9)
        texts.append((doc_id, " ".join(w.upper() if rng.random() < 0.1 else w for w in words)))
    texts += [(None, "abbaé×abbaé 日abbaé日"), (7, None), (8, ""), (9, "  \n"), (5, texts[5][1]), (5, texts[5][1])]
    docs = spark.createDataFrame([(i, t, "x", 1, "y", 1.0) for i, t in texts], SCHEMA).repartition(5)
    want = brute(brute_words(texts, 3, 2, 7), 2)
    assert collected(spelling.spelling_variants(docs, 3, 2, 2, 7)) == want
    assert any(form and form != root for form, root, *_ in want.values()) and max(v[3] for v in want.values()) > 10


def test_trie_numbers_across_runs(spark):
    """Each distinct beginning has one number, in however many runs its words lie."""
    rng = random.Random(4)
    words = {"a" * k + "".join(rng.choice("ab") for _ in range(rng.randrange(12))) for k in range(40) for _ in range(8)} - {""}
    words |= {"a" * 300, "a" * 300 + "b", "a" * 299 + "c"}
    table = spark.createDataFrame([(w, 1) for w in words], TARGETS)
    out = spelling.number_prefixes(table).collect()
    number = {}
    for row in out:
        assert len(row["prefixes"]) == len(row["word"]) and row["id"] == row["prefixes"][-1]
        for depth, node in enumerate(row["prefixes"], 1):
            assert number.setdefault(row["word"][:depth], node) == node
    assert len(set(number.values())) == len(number)
    assert [r["word"] for r in sorted(out, key=lambda r: r["id"])] == sorted(words)
    assert len({r["_run"] for r in runs.sorted_runs(table, F.col("word")).select("_run").distinct().collect()}) > 1


def test_one_letter_words_of_any_length(spark):
    """Runs of one letter: each length has one near word on either side, and no pair counts twice."""
    docs = spark.createDataFrame([(i, " ".join("z" * k for k in range(1, 12)), None, None, None, None) for i in range(6)], SCHEMA)
    got = collected(spelling.spelling_variants(docs, every=10**9))
    assert {w: v[3] for w, v in got.items()} == {"z" * k: 1 if k in (6, 11) else 2 for k in range(6, 12)}


def test_very_long_word(spark):
    long = "ab" * 20_000
    docs = spark.createDataFrame([(i, long if i % 2 else long[:-1], None, None, None, None) for i in range(40)], SCHEMA)
    got = collected(spelling.spelling_variants(docs, every=10**9))
    assert {(len(w), v[3]) for w, v in got.items()} == {(40_000, 1), (39_999, 1)}


def test_ties_and_ratio(spark):
    """Equal counts go to the smaller word; five times as many is just enough."""
    text = "wordab " * 25 + "wordac " * 25 + "wordad " * 5 + "abcdef " * 24 + "abcdeg " * 5
    docs = spark.createDataFrame([(1, text, None, None, None, None)], SCHEMA)
    got = collected(spelling.spelling_variants(docs, every=10**9))
    assert got["wordad"] == ("wordab", "wordab", 5, 2, 25) and got["wordab"] == (None, "wordab", 25, 2, None)
    assert got["abcdeg"] == (None, "abcdeg", 5, 1, None)


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None, None)]])
def test_empty_tables(spark, rows):
    assert spelling.spelling_variants(spark.createDataFrame(rows, SCHEMA)).count() == 0

