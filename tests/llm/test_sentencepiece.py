import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from leadpanel.llm import sentencepiece_codec as codec

FILE = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, ids string, parity int"
TEXTS = [
    "", None, " ", "  ", "a", "a ", " a", "  a  b \n c", "plain words here", "日本語 テキスト", "😀 \x00 ☃", "<s> </s> <unk> <0x0A>", "tab\tx",
    "word " * 3000, "▁ mark ▁x", "a" * 3000, "Ünï cödé",
]


@pytest.fixture(scope="module")
def original():
    return sentencepiece.SentencePieceProcessor(model_file=FILE)


def test_same_ids_as_sentencepiece(spark, original):
    rows = [(at, text, "x", 1) for at, text in enumerate(TEXTS)] + [(0, "again", None, None), (None, "no id", None, None)]
    out = codec.encode_documents(spark.createDataFrame(rows, SCHEMA), FILE).collect()
    expected = sorted((r[0] if r[0] is not None else -1, original.encode(r[1] or "")) for r in rows)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["ids"]) for r in out) == expected
    assert all(r["parity"] and r["n_tokens"] == len(r["ids"]) for r in out)
    assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in out)


def test_decoding_gives_the_text(spark):
    rows = [(at, text, None, None) for at, text in enumerate(TEXTS) if "▁" not in (text or "")]
    encoded = codec.encode_documents(spark.createDataFrame(rows, SCHEMA), FILE)
    assert all(r["decodes"] for r in encoded.collect())
    back = codec.decode_documents(encoded, FILE).collect()
    assert sorted((r["doc_id"], r["text"]) for r in back) == sorted((at, text or "") for at, text, *_ in rows)


def test_documents_of_the_table(spark, original):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r["doc_id"]: r["ids"] for r in codec.encode_documents(docs, FILE).collect()}
    assert got == {r["doc_id"]: original.encode(r["text"]) for r in docs.collect()}


def test_empty_table(spark):
    empty = codec.encode_documents(spark.createDataFrame([], SCHEMA), FILE)
    assert empty.count() == 0 and codec.decode_documents(empty, FILE).count() == 0


def _field(number, value):
    if isinstance(value, bytes):
        return _int(number << 3 | 2) + _int(len(value)) + value
    if isinstance(value, float):
        return _int(number << 3 | 5) + struct.pack("<f", value)
    return _int(number << 3) + _int(value)


def _int(value):
    out = b""
    while value > 127:
        out, value = out + bytes([value & 127 | 128]), value >> 7
    return out + bytes([value])


def unigram_model(remove_extra):
    """A small unigram model written by hand: letters, some words, byte pieces."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    pieces += [(c, -8.0 - at / 8, 1) for at, c in enumerate("▁abcdefghijklmnopqrstuvwxyz")]
    pieces += [(w, -4.0 - at / 16, 1) for at, w in enumerate(["▁the", "▁th", "he", "in", "er", "▁a", "ing", "▁cat", "at", "▁in", "the"])]
    data = b"".join(_field(1, _field(1, p.encode()) + _field(2, s) + _field(3, kind)) for p, s, kind in pieces)
    data += _field(2, _field(3, 1) + _field(35, 1))
    return data + _field(3, _field(3, 1) + _field(4, int(remove_extra)) + _field(5, 1))


@pytest.mark.parametrize("remove_extra", [False, True])
def test_unigram_models(remove_extra):
    data = unigram_model(remove_extra)
    original = sentencepiece.SentencePieceProcessor(model_proto=data)
    model = codec.parse_model(data)
    assert model.kind == codec.UNIGRAM and model.byte_fallback and model.remove_extra_spaces == remove_extra
    tokenizer = codec.build_tokenizer(model)
    rng = random.Random(5)
    texts = ["the cat in", " the  cat ", "é☃", "", "thing being", *("".join(rng.choices("abcthein é", k=40)) for _ in range(50))]
    assert [tokenizer.encode(t, add_special_tokens=False).ids for t in texts] == [original.encode(t) for t in texts]


def test_merges_follow_scores():
    model = codec.Model(pieces=[("a", -9.0, 1), ("b", -9.0, 1), ("ab", -1.0, 1), ("aab", -0.5, 1), ("<s>", 0.0, 3)], kind=codec.BPE)
    assert codec.merges_of(model) == [("a", "ab"), ("a", "b")]
