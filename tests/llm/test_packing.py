import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from leadpanel.llm import packing

FILE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string, start string, bucket int"
TEXTS = [
    "", None, " ", "a", "a ", " a", "  a  b \n c", "a \n b", "a\tb\n\n  c", "\x1c a", "a\x1c b ", "don't  it's", "<|endoftext|> a <|endoftext|>",
    "日本語 テキスト 😀 x", "word " * 3000, "1 22 333", "nbsp  x   y", "tail\n", "\n\n", "a" * 5000, " <|endoftext|>", "b <|endoftext|>c",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_units_give_the_ids_of_the_text(tokenizer):
    texts = [t or "" for t in TEXTS]
    assert [x.tolist() for x in packing._encoder(FILE).texts(texts)] == [ids_of(tokenizer, t)[:-1] for t in texts]


def test_control_strings(tokenizer):
    text = "a <|endoftext|> b<|endoftext|><|endoftext|>  c"
    assert ids_of(tokenizer, text)[:4] == [64, 220, 50256, 275]
    assert [x.tolist() for x in packing._encoder(FILE).texts([text])] == [ids_of(tokenizer, text)[:-1]]
    ordinary = Tokenizer.from_file(FILE)
    ordinary.encode_special_tokens = True
    assert [x.tolist() for x in packing._encoder(FILE, False).texts([text])] == [ids_of(ordinary, text)[:-1]]


def test_other_kinds_of_tokenizer_encode_whole_texts():
    file = public_tokenizers.path("word_bpe_49k.json")
    assert packing.splits_before_spaces(FILE) and not packing.splits_before_spaces(file)
    texts = [t or "" for t in TEXTS] + ["Two  WORDS, it's 12"]
    own = Tokenizer.from_file(file)
    assert [x.tolist() for x in packing._encoder(file).texts(texts)] == [own.encode(t, add_special_tokens=False).ids for t in texts]


def test_units_share_their_pieces(tokenizer):
    marks = [".", ",", "!", ".\nNext", "'s", "é", "12", "\n\n", "&&&", "<|endoftext|>"]
    texts = [" ".join(f"word{mark}" for mark in marks), " ".join(f"other{mark}" for mark in marks)]
    encoder = packing._encoder(FILE)
    encoder.forget()
    assert [x.tolist() for x in encoder.texts(texts)] == [ids_of(tokenizer, t)[:-1] for t in texts]
    assert {" word", " other", ".", "\n", "Next", "'s", "12"} <= set(encoder.parts.index)
    assert not {" word.", " word,", " word12"} & set(encoder.parts.index)
    encoder.forget()
    assert not encoder.index and not encoder.parts.index


def test_each_character_beside_plain_ones(tokenizer):
    texts = [f"a{chr(c)}1 {chr(c)}'s!{chr(c)} b\n {chr(c)}{chr(c)}" for c in range(0x2100)]
    assert [x.tolist() for x in packing._encoder(FILE).texts(texts)] == [ids_of(tokenizer, t)[:-1] for t in texts]


@pytest.mark.parametrize("tokens, pieces", [(1, [1]), (7, [4, 2, 1]), (16, [16]), (37, [16, 16, 4, 1]), (31, [16, 8, 4, 2, 1])])
def test_piece_lengths(tokens, pieces):
    assert packing.piece_lengths(tokens, 16) == pieces


def test_packs_each_document_whole(spark, tokenizer):
    rows = [(at, text, "x", 1) for at, text in enumerate(TEXTS)]
    out = packing.pack(spark.createDataFrame(rows, SCHEMA), FILE, max_tokens=64).collect()
    pieces = defaultdict(list)
    for row in out:
        pieces[row["doc_id"]].append(row)
    for doc_id, text, *_ in rows:
        expected, at = ids_of(tokenizer, text), 0
        for row in sorted(pieces[doc_id], key=lambda r: r["start"]):
            part = expected[row["start"]:row["start"] + row["length"]]
            assert row["start"] == at and row["ids"] == part and row["doc_tokens"] == len(expected)
            assert row["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += row["length"]
        assert at == len(expected)
    # One piece per sequence, powers of two only, numbers of a bucket in a row.
    by_id = sorted(out, key=lambda r: r["sequence_id"])
    assert [r["sequence_id"] for r in by_id] == list(range(len(out)))
    assert all(r["offset"] == 0 and r["length"] == 1 << r["bucket"] for r in out)
    assert [r["bucket"] for r in by_id] == sorted((r["bucket"] for r in out), reverse=True)


def test_nulls_repeats_and_empty_table(spark):
    rows = [(None, "a b", None, None), (1, "a b", None, None), (1, "a b", None, None), (1, None, None, None)]
    out = packing.pack(spark.createDataFrame(rows, SCHEMA), FILE, with_ids=False)
    assert "ids" not in out.columns
    assert sorted((r["doc_id"] or 0, r["length"], r["doc_tokens"]) for r in out.collect()) == [
        (0, 1, 3), (0, 2, 3), (1, 1, 1), (1, 1, 3), (1, 1, 3), (1, 2, 3), (1, 2, 3)]
    assert packing.pack(spark.createDataFrame([], SCHEMA), FILE).count() == 0


def test_forgetting_units_changes_nothing(tokenizer):
    from leadpanel.llm.tokens import UnitEncoder

    whole = packing._encoder(FILE)
    forgetful = UnitEncoder(whole.split, whole.encode, units_kept=6)
    forgetful.chunk_chars = 40
    texts = [f"one two three {i} " * 3 for i in range(50)]
    for _ in range(2):
        assert [x.tolist() for x in forgetful.texts(texts)] == [x.tolist() for x in whole.texts(texts)]


def test_written_buckets_read_back(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b c d e", None, None), (2, "x y", None, None)], SCHEMA)
    packing.write_buckets(packing.pack(docs, FILE), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert all(len(r["ids"]) == 1 << r["bucket"] for r in back.collect())
    assert sum(r["length"] for r in back.collect()) == 6 + 3


def test_max_tokens_is_a_power_of_two(spark):
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([], SCHEMA), FILE, max_tokens=1000)


def test_operators_do_not_add_up_their_memories():
    from leadpanel.llm import tokens

    left, right = tokens.WordNumbers(len), tokens.WordNumbers(len, limit=2)
    tokens.hold("left", left.clear)
    assert left[b"abc"] == 3 and left
    tokens.hold("left", left.clear)
    assert left
    tokens.hold("right", right.clear)
    assert not left and [right[w] for w in (b"a", b"bb", b"ccc", b"a")] == [1, 2, 3, 1] and len(right) <= 2
    tokens.hold("none", dict().clear)
