import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadpanel.llm import quality

DOCS = "doc_id bigint, text string, row string, score int"
LABELS = "doc_id bigint, quality int, toxic int"


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def corpus(n=120):
    docs, labels = [], []
    for at in range(n):
        good = at % 2
        words = [f"{'abcdefg'[(at + i) % 7]}{'tion ing ly ed er'.split()[i % 5]}" for i in range(20 + at % 9)]
        docs.append((at, " ".join(words) + "." if good else "!! ".join(w.upper() for w in words), "x", 1))
        labels.append((at, good, 0))
    return docs, labels


def run(spark, docs, labels):
    out = quality.classify(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    return out.collect()


def test_separates_held_out_rows(spark):
    docs, labels = corpus()
    docs += [(1_000, None, None, None), (1_001, "", None, None), (None, "aTION!! BING!! CLY!!", None, None), (3, docs[3][1], None, None),
             (1_002, "word " * 200_000, None, None), (1_003, "é", None, None)]
    labels += [(5, None, None), (None, 1, 0), (7, 0, 0), (7, 1, 0), (99_999, 1, 0), (9, 3, 0)]
    out = run(spark, docs, labels)
    assert len(out) == len(docs)
    for r in out:
        assert r["held_out"] == is_held_out(r["doc_id"]) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        if r["doc_id"] is not None and r["doc_id"] < 1_000:
            assert r["predicted"] == r["doc_id"] % 2


def test_held_out_labels_change_nothing(spark):
    docs, labels = corpus()
    flipped = [(i, 1 - q if is_held_out(i) else q, t) for i, q, t in labels]
    key = lambda rows: sorted((r["doc_id"], r["score"]) for r in rows)
    assert key(run(spark, docs, labels)) == key(run(spark, docs, flipped))


def test_no_labels_and_no_documents(spark):
    docs, labels = corpus(6)
    assert {r["score"] for r in run(spark, docs, [])} == {0.5}
    assert run(spark, [], labels) == []
    assert run(spark, [], []) == []


def test_sample_is_bounded_per_label(spark):
    docs, labels = corpus()
    d, l = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    rows = quality.training_sample(d, l, 7).groupBy("quality").count().collect()
    assert {r["quality"]: r["count"] for r in rows} == {0: 7, 1: 7}


def test_votes_match_a_plain_loop():
    rng = np.random.default_rng(4)
    unit = lambda n: (x := rng.standard_normal((n, 8)).astype(np.float32)) / np.linalg.norm(x, axis=1, keepdims=True)
    model = quality.Model(np.ones(1, np.float32), np.ones((1, 8), np.float32), unit(60), rng.integers(0, 2, 60).astype(float))
    rows = unit(20)
    expected = []
    for row in rows:
        cosines = sorted(((float(row @ v), y) for v, y in zip(model.vectors, model.labels)), reverse=True)[:quality.NEIGHBOURS]
        weights = [(max(c, 0) ** quality.SHARPNESS, y) for c, y in cosines]
        expected.append(sum(w * y for w, y in weights) / sum(w for w, _ in weights))
    assert np.allclose(model.scores(rows), expected, atol=1e-5)
    assert model.scores(np.zeros((1, 8), np.float32))[0] == model.labels.mean()


def test_document_frequencies_cover_all_documents(spark):
    docs = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(["a b", "a a", "", None, "c"])], DOCS)
    found, rows = quality.document_frequencies(docs)
    assert rows == 5
    assert found[quality._bins[b"a"]] == 2 and found[quality._bins[b"c"]] == 1


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_accuracy_on_the_table(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.classify(docs, labels).join(labels, "doc_id").where("held_out")
    right, rows = out.agg(F.sum((F.col("predicted") == F.col("quality")).cast("int")), F.count(F.lit(1))).first()
    assert rows > 50 and right / rows >= 0.95


def test_directions_without_a_dense_matrix():
    import tracemalloc

    random = np.random.default_rng(5)
    rows = [(np.sort(random.choice(40_000, 60, replace=False)), random.integers(1, 9, 60)) for _ in range(1200)]
    idf = random.uniform(1, 9, quality.TERMS).astype(np.float32)
    tracemalloc.start()
    directions = quality.latent_directions(rows, idf)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    used = np.unique(np.concatenate([found for found, _ in rows]))
    dense = np.zeros((len(rows), len(used)), np.float32)
    assert peak < 0.8 * dense.nbytes
    for row, (found, counts) in enumerate(rows):
        dense[row, np.searchsorted(used, found)] = np.log1p(counts) * idf[found]
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    wide = quality.DIRECTIONS + 16
    basis = dense @ np.random.default_rng(0).standard_normal((len(used), wide)).astype(np.float32)
    for _ in range(4):
        basis = np.linalg.qr(dense @ (dense.T @ np.linalg.qr(basis)[0]))[0]
    right = np.linalg.svd(basis.T @ dense, full_matrices=False)[2][:quality.DIRECTIONS]
    want = np.zeros_like(directions)
    want[used] = right.T
    assert np.abs(np.abs(directions) - np.abs(want)).max() < 1e-3
