import hashlib
from collections import defaultdict

from leadpanel.llm import exact

SCHEMA = "doc_id bigint, text string, kept string, keep_id int"


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), i == keep, digest) for i in ids]
    return sorted(out, key=repr)


def run(spark, rows, **more):
    df = exact.mark_duplicates(spark.createDataFrame(rows, SCHEMA), **more)
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [
        (1, "a", "x", 1), (2, "a", None, None), (2, "a", "x", 1), (None, "a", None, 2), (3, None, None, None), (4, "", "", 0),
        (None, "only", None, None), (None, "only", None, None), (5, "long " * 50_000, None, None), (6, "A", None, None),
        (-7, "a ", None, None),
    ]
    assert run(spark, rows) == brute(rows)


def test_heavy_and_light_digests_agree(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"text {i % 40}", None, None) for i in range(600)]
    for support in (0.001, 0.1, 0.5):
        assert run(spark, rows, support=support) == brute(rows)


def test_frequent_digests_are_verified(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"text {i}", None, None) for i in range(300)]
    digests = exact.text_digests(spark.createDataFrame(rows, SCHEMA))
    found = exact.frequent_digests(digests, 0.05).collect()
    assert [(r["keep_id"], r["group_size"]) for r in found] == [(297, 100)]


def test_no_python_in_the_plan(spark):
    df = exact.mark_duplicates(spark.createDataFrame([(1, "a", None, None)], SCHEMA))
    assert not any(word in df._jdf.queryExecution().toString() for word in ("Python", "Arrow", "Pandas"))


def test_empty_table(spark):
    assert run(spark, []) == []


def test_documents_that_stay_keep_their_columns(spark):
    rows = [(1, "a", "x", 1), (2, "a", "y", 2), (None, "b", "z", 3)]
    out = exact.drop_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "kept", "keep_id"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(rows[1:], key=repr)
