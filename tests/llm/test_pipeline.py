import pytest

import corpus_pipeline
from leadpanel.llm import lines, quality

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, keys int, kept string, score int, drop int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "x", 1, "k", 2, 3) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    good, bad = "An ordinary line of plain words, number {}.", "SHOUTED!! WORDS!! ONLY!! {}!!"
    docs = [(at, "\n".join((good if at % 2 else bad).format(f"{'abcde'[i % 5]}{at}{i}") for i in range(6))) for at in range(120)]
    frame(spark, docs).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame([(at, at % 2, 0) for at in range(120)], "doc_id bigint, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    return str(path)


EDGES = [
    (None, "no id"), (1, None), (2, ""), (3, " \n "), (4, "word " * 30_000), (5, "twice the same text of a document"),
    (5, "twice the same text of a document"), (6, "twice the same text of a document"), (7, "é😀"),
]


@pytest.mark.parametrize("step", range(4))
def test_stages_take_odd_rows(spark, folder, step):
    name, stage = corpus_pipeline.STAGES[step]
    docs = frame(spark, EDGES)
    out = stage(spark, docs, folder)
    rows = out.collect()
    if name != "packing":
        assert out.schema.simpleString() == docs.schema.simpleString()
        assert {r["doc_id"] for r in rows} >= {None, 1, 2, 3}
        assert all(r["row"] == "x" and r["keys"] == 1 for r in rows)
    if name == "near_duplicates":
        assert sorted(r["doc_id"] or 0 for r in rows) == [0, 1, 2, 3, 4, 5, 5, 7]
    if name == "packing":
        assert sum(r["length"] for r in rows if r["start"] == 0 and r["doc_id"] in (1, 2)) == 2


@pytest.mark.parametrize("step", range(4))
def test_stages_take_no_rows(spark, folder, step):
    assert corpus_pipeline.STAGES[step][1](spark, frame(spark, []), folder).count() == 0


def test_the_classifiers_rejections_go(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.keep_good(spark, docs, folder).collect()}
    scored = quality.classify(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()
    assert kept == {r["doc_id"] for r in scored if r["predicted"] == 1} == set(range(1, 120, 2))


def test_emptied_documents_go_and_clean_ones_stay(spark, folder):
    footer = "The same footer of the same site"
    rows = [(at, f"{' '.join(chr(97 + at) * n for n in range(1, 7))}\n{footer}") for at in range(15)] + [(100, footer), (101, f"{footer}\n"), (102, "clean text, left alone")]
    out = {r["doc_id"]: r for r in corpus_pipeline.drop_lines(spark, frame(spark, rows), folder).collect()}
    assert set(out) == set(range(15)) | {102}
    assert out[0]["text"].endswith(footer) and out[1]["text"] == "b bb bbb bbbb bbbbb bbbbbb"
    assert all(r["n_chars"] == len(r["text"]) for r in out.values())
    found = {r["doc_id"]: r["text"] for r in lines.deduplicate(frame(spark, rows)).collect()}
    assert all(found[i] == r["text"] for i, r in out.items())


def test_runs_end_to_end(spark):
    folder = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, folder)
    docs = {r["doc_id"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id").collect()}
    rows = out.collect()
    assert {r["doc_id"] for r in rows} <= docs
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows)))


def test_stages_are_named_functions():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "packing"]


def test_copies_with_only_blank_lines_left_go(spark):
    rows = [(at, "One footer on every page\n\n \t\n\n") for at in range(12)] + [(100, "\n\n"), (101, None)]
    left = corpus_pipeline.drop_lines(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "")
    assert sorted(r["doc_id"] for r in left.collect()) == [0, 100, 101]


def test_all_stages_by_brute_force(spark):
    """The classifier's own decisions, then plain loops for lines, near duplicates and packing over what is left."""
    import zlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    import test_lines
    import test_minhash
    from leadpanel.llm import packing

    folder = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{folder}/documents.parquet")
    scored = quality.classify(table, spark.read.parquet(f"{folder}/labels.parquet"))
    good = {r["doc_id"] for r in scored.where("predicted = 1").select("doc_id").collect()}
    texts = [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect() if r["doc_id"] in good]
    left = [(i, text) for i, text, _, dropped in test_lines.brute(texts) if not dropped or text.strip()]
    kept = {i for i, _, _, stays in test_minhash.brute(left, 5, 80) if stays}
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want = []
    for doc_id, text in left:
        if doc_id in kept:
            ids, start = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID], "<u4"), 0
            for size in packing.piece_lengths(len(ids)):
                want.append((doc_id, start, size, zlib.crc32(ids[start:start + size].tobytes()), len(ids)))
                start += size
    rows = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == sorted(want)
    assert 0 < len(kept) < len(texts)
    by_sequence = sorted(rows, key=lambda r: r["sequence_id"])
    assert [r["sequence_id"] for r in by_sequence] == list(range(len(rows))) and all(r["offset"] == 0 for r in rows)
    assert [r["length"] for r in by_sequence] == sorted((r["length"] for r in rows), reverse=True)
