import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from leadpanel.llm import bpe

FILE = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, ids string, n_tokens int"
TEXTS = [
    "", None, " ", "a", "It's  a TEST, isn't it?", "x" * 5000, "ab" * 700 + " " + "the" * 333, "\n\n\t", "a\x1cb\x1f c",
    "<|endoftext|>", "one<|startoftext|>Two <|endoftext|> <|ENDOFTEXT|>", "日本語 テキスト 😀 x", "ΣΑΣ ΣΊΣΥΦΟΣ İstanbul ẞ", "nbsp  x   y z\x85w",
    "éte ́ Å", "1 22 333 4,5.6", "'s 't 're 've 'm 'll 'd 'S", "don't<|endoftext|>'t", "﻿ zero​width", "word " * 3000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def plain_merges(word, ranks):
    """Lowest rank first, leftmost among equals, one merge at a time."""
    word = list(word)
    while True:
        found = [(ranks[pair], at) for at, pair in enumerate(zip(word, word[1:])) if pair in ranks]
        if not found:
            return word
        (_, made), at = min(((rank, made), at) for (rank, made), at in found)
        word[at:at + 2] = [made]


def test_trees_merge_like_a_plain_loop():
    """Random merges over few symbols, so that ranks compete and pairs overlap."""
    rng = np.random.default_rng(5)
    for _ in range(30):
        pairs, made, names = [], [], list(range(3))
        while len(pairs) < 25:
            pair = tuple(int(x) for x in rng.choice(names, 2))
            if pair not in pairs:
                pairs.append(pair)
                made.append(len(names))
                names.append(len(names))
        merges = bpe.Merges(pairs, made, len(names))
        ranks = {pair: (rank, new) for rank, (pair, new) in enumerate(zip(pairs, made))}
        words = [rng.integers(0, 3, n) for n in [0, 1, 2, 3, 4, 5, 8, 9, 16, 17, 40, 100] * 3]
        assert [w.tolist() for w in merges.merge(words)] == [plain_merges(w.tolist(), ranks) for w in words]


def test_ids_and_texts_are_the_librarys(spark, library):
    rows = [(at, text, "x", 1) for at, text in enumerate(TEXTS)]
    out = {r["doc_id"]: r for r in bpe.encode_documents(spark.createDataFrame(rows, SCHEMA), FILE).collect()}
    for at, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert out[at]["ids"] == ids and out[at]["n_tokens"] == len(ids), text
        assert out[at]["decoded"] == decoded
        assert out[at]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert out[at]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_query_over_all_documents(spark, library):
    folder = "/root/testdata/sf0.001"
    from leadpanel.llm.queries import QUERIES

    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    out = QUERIES["op12_segment_tree_bpe"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(texts)
    for row in out:
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids) and row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_another_tokenizer_file(library):
    """A byte-level file keeps white space, so whole texts are its units; its decoder gives the text again."""
    file = public_tokenizers.path("byte_bpe_50k.json")
    own, other = bpe.Bpe(file), Tokenizer.from_file(file)
    assert not own.drops_space and bpe.Bpe(FILE).drops_space
    texts = [t or "" for t in TEXTS]
    got = list(own.encode(texts))
    assert [x.tolist() for x in got] == [other.encode(t, add_special_tokens=False).ids for t in texts]
    assert [own.decode(x) for x in got] == [other.decode(x.tolist(), skip_special_tokens=False) for x in got]


def test_nulls_repeats_empty_table_and_decoding(spark, library):
    rows = [(None, "a b", None, None), (1, "a b", None, None), (1, "a b", None, None), (1, None, None, None)]
    encoded = bpe.encode_documents(spark.createDataFrame(rows, SCHEMA), FILE, with_text=False)
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in encoded.collect()) == [(0, 2), (1, 0), (1, 2), (1, 2)]
    back = bpe.decode_documents(encoded, FILE).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in back) == [(0, "a</w> b</w>"), (1, ""), (1, "a</w> b</w>"), (1, "a</w> b</w>")]
    assert bpe.encode_documents(spark.createDataFrame([], SCHEMA), FILE).count() == 0
    none = spark.createDataFrame([(1, None)], "doc_id bigint, ids array<int>")
    assert bpe.decode_documents(none, FILE).first()["text"] is None


def test_forgetting_units_changes_nothing(library):
    own = bpe.Bpe(FILE)
    own.units.units_kept, own.units.chunk_chars = 6, 40
    texts = [f"one two three {i} " * 3 for i in range(50)]
    for _ in range(2):
        assert [x.tolist() for x in own.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
