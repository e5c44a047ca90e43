"""Byte-pair encoding by a segment tree over the ranks of adjacent pairs, and decoding.

A word's symbols are leaves of a tree; each leaf holds the rank and the place of
the pair that begins there, each inner node the smaller of its children. The
root is the leftmost pair of the lowest rank. Merging it changes three leaves,
and so a logarithmic number of nodes, until the root holds no pair any more.
The trees of many words of about one length stand side by side in numpy arrays
and merge in step. The library's own normaliser and pre-tokeniser cut a text
into words; each distinct unit of a text is encoded once per worker.

Cases: null text is empty and has no ids; a control string in a text gives its
control id, as the library's plain call does; rows that repeat an id are
encoded each; a null id is kept; a very long word is one tree; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from leadpanel.llm.tokens import UnitEncoder, hold

#: Leaf of a place where no pair begins.
NONE = np.int64(2**63 - 1)
#: Low bits of a leaf are the pair's place, the others its rank.
PLACE_BITS = 32
#: Leaves of all trees that merge at a time; bounds the memory of a step.
CELLS = 1 << 18
#: Distinct units a worker remembers, characters and rows it takes at a time.
UNITS_KEPT, CHUNK_CHARS, ROWS = 400_000, 500_000, 256


class Merges:
    """Ranked pairs of symbols, looked up for many pairs at a time."""

    def __init__(self, pairs: list[tuple[int, int]], made: list[int], symbols: int):
        self.symbols = symbols
        keys = np.array([a * symbols + b for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = np.append(keys[order], NONE), np.append(order, 0).astype(np.int64)
        self.made = np.array([*made, 0], np.int64)

    def leaves(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank and place of each pair as one number; ``NONE`` for pairs that never merge or lack a side (below 0)."""
        wanted = left * self.symbols + right
        found = np.searchsorted(self.keys, wanted)
        known = (self.keys[found] == wanted) & (left >= 0) & (right >= 0)
        return np.where(known, self.ranks[found] << PLACE_BITS | at, NONE)

    def merge(self, words: list[np.ndarray]) -> list[np.ndarray]:
        """The symbols of each word after all its merges."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(words)
        by_width: dict[int, list[int]] = {}
        for number, word in enumerate(words):
            by_width.setdefault(max(4, 1 << (max(len(word), 1) - 1).bit_length()), []).append(number)
        for width, numbers in by_width.items():
            step = max(1, CELLS // width)
            for low in range(0, len(numbers), step):
                part = numbers[low:low + step]
                for number, symbols in zip(part, self._merge_alike([words[n] for n in part], width)):
                    out[number] = symbols
        return out

    def _merge_alike(self, words: list[np.ndarray], width: int) -> Iterator[np.ndarray]:
        """Words of at most ``width`` symbols, a power of two, one tree each."""
        n, span = len(words), width + 1
        # Row by row and flat; the last place of a row stands for "no neighbour".
        symbols = np.full((n, span), -1, np.int64)
        for row, word in enumerate(words):
            symbols[row, :len(word)] = word
        places = np.arange(width)
        tree = np.full((n, 2 * width), NONE, np.int64)
        tree[:, width:] = self.leaves(symbols[:, :-1], symbols[:, 1:], places)
        size = width
        while size > 1:
            size //= 2
            tree[:, size:2 * size] = np.minimum(tree[:, 2 * size:4 * size:2], tree[:, 2 * size + 1:4 * size:2])
        after = np.tile(np.append(places + 1, width), (n, 1)).astype(np.int64).ravel()
        before = np.tile(np.append(places - 1, width), (n, 1)).astype(np.int64)
        before[:, 0] = width
        before, symbols, tree = before.ravel(), symbols.ravel(), tree.ravel()
        rows = np.arange(n, dtype=np.int64)
        while True:
            root = tree[rows * (2 * width) + 1]
            live = root != NONE
            if not live.all():
                rows, root = rows[live], root[live]
                if not len(rows):
                    break
            at, rank = root & ((1 << PLACE_BITS) - 1), root >> PLACE_BITS
            base, leaf = rows * span, rows * (2 * width) + width
            right = after[base + at]
            following, previous = after[base + right], before[base + at]
            symbols[base + at], symbols[base + right] = self.made[rank], -1
            after[base + at] = following
            before[base + following] = at
            symbols[base + width] = -1
            tree[leaf + right] = NONE
            tree[leaf + at] = self.leaves(symbols[base + at], symbols[base + following], at)
            has = previous != width
            tree[(leaf + previous)[has]] = self.leaves(symbols[base + previous], symbols[base + at], previous)[has]
            node = np.stack([at, right, np.where(has, previous, at)]) + width
            own = rows * (2 * width)
            while node[0, 0] > 1:
                node >>= 1
                tree[own + node] = np.minimum(tree[own + 2 * node], tree[own + 2 * node + 1])
        for row in symbols.reshape(n, span):
            yield row[row >= 0]


class Bpe:
    """One tokenizer file: cuts texts into words, encodes words by trees, decodes ids."""

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        with open(file) as f:
            spec = json.load(f)
        model = spec["model"]
        for odd in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"):
            if model.get(odd):
                raise ValueError(f"{odd} is not supported")
        if model.get("type") != "BPE" or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("only BPE models with plain control tokens are supported")
        library = Tokenizer.from_file(file)
        self.normalizer, self.cutter, self.decoder = library.normalizer, library.pre_tokenizer, library.decoder
        self.vocab, self.suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        known = [(a, b) for a, b in pairs if a in self.vocab and b in self.vocab and a + b in self.vocab]
        self.merges = Merges([(self.vocab[a], self.vocab[b]) for a, b in known], [self.vocab[a + b] for a, b in known], max(self.vocab.values()) + 1)
        self.controls = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.control = re.compile("|".join(map(re.escape, sorted(self.controls, key=len, reverse=True)))) if self.controls else None
        by_id = {at: token for token, at in (self.vocab | self.controls).items()}
        self.tokens = [by_id.get(at, "") for at in range(max(by_id) + 1)]
        # White space only parts words when the normaliser and the pre-tokeniser both drop it.
        probe = [w for w, _ in self.cutter.pre_tokenize_str(self._normal("a b\n\tc"))] if self.cutter else []
        self.drops_space = probe == ["a", "b", "c"] and not any(set(t) & set(" \t\n\r\x0b\x0c") for t in self.controls)
        self.units = UnitEncoder(self._units, self._learn, UNITS_KEPT, CHUNK_CHARS)

    def _normal(self, text: str) -> str:
        return self.normalizer.normalize_str(text) if self.normalizer else text

    def _units(self, text: str) -> list[bytes]:
        """What is encoded once: parts between ASCII white space where that is dropped, else the whole text."""
        data = text.encode()
        return data.split() if self.drops_space else [data] if data else []

    def words(self, text: str) -> list[str | int]:
        """Words as the model sees them, and the ids of control strings between them."""
        if self.control is None:
            return self._plain_words(text)
        out: list[str | int] = []
        at = 0
        for found in self.control.finditer(text):
            out += self._plain_words(text[at:found.start()])
            out.append(self.controls[found.group()])
            at = found.end()
        return out + self._plain_words(text[at:])

    def _plain_words(self, text: str) -> list[str]:
        normal = self._normal(text) if text else ""
        if not normal:
            return []
        return [word for word, _ in self.cutter.pre_tokenize_str(normal)] if self.cutter else [normal]

    def symbols(self, word: str) -> np.ndarray:
        """A word's characters as symbols; a character that the vocabulary lacks has none."""
        parts = [*word[:-1], word[-1] + self.suffix]
        return np.array([self.vocab[p] for p in parts if p in self.vocab], np.int64)

    def _learn(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        numbers: dict[str | int, int] = {}
        cut = [[numbers.setdefault(w, len(numbers)) for w in self.words(unit.decode())] for unit in units]
        merged: list[np.ndarray] = [np.zeros(0, np.int64)] * len(numbers)
        own = [(at, word) for word, at in numbers.items() if isinstance(word, str)]
        for (at, _), ids in zip(own, self.merges.merge([self.symbols(word) for _, word in own])):
            merged[at] = ids
        for word, at in numbers.items():
            if isinstance(word, int):
                merged[at] = np.array([word], np.int64)
        flat = [merged[at] for at in chain.from_iterable(cut)]
        sizes = np.array([sum(len(merged[at]) for at in unit) for unit in cut], np.int64)
        return (np.concatenate(flat) if flat else np.zeros(0, np.int64)).astype(np.uint32), sizes

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        return self.units.texts(texts)

    def decode(self, ids: np.ndarray) -> str:
        """The tokens under the file's decoder; without one, a space between each two."""
        tokens = list(map(self.tokens.__getitem__, ids.tolist()))
        return self.decoder.decode(tokens) if self.decoder else " ".join(tokens)


@lru_cache(maxsize=2)
def bpe(file: str) -> Bpe:
    return Bpe(file)


def encode_documents(docs: DataFrame, file: str, with_ids: bool = True, with_text: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``, and, unless left out, ``ids`` and the ``decoded`` text.

    The digests are of all ids as little-endian 32-bit numbers, and of the text decoded from them.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * with_ids + ", decoded string" * with_text

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe(file)
        hold("bpe", own.units.forget)
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                sizes, digests, digests_back, kept, back = [], [], [], [], []
                for ids in own.encode([text or "" for text in part.column("text").to_pylist()]):
                    text = own.decode(ids)
                    sizes.append(len(ids))
                    digests.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                    digests_back.append(hashlib.sha256(text.encode()).hexdigest())
                    if with_ids:
                        kept.append(ids.astype(np.int32))
                    if with_text:
                        back.append(text)
                out = {"doc_id": part.column("doc_id"), "n_tokens": pa.array(sizes, pa.int64()),
                       "ids_sha256": pa.array(digests, pa.string()), "decoded_sha256": pa.array(digests_back, pa.string())}
                if with_ids:
                    out["ids"] = pa.array(kept, pa.list_(pa.int32()))
                if with_text:
                    out["decoded"] = pa.array(back, pa.string())
                yield pa.RecordBatch.from_pydict(out)

    return docs.select("doc_id", "text").mapInArrow(encode, schema)


def decode_documents(encoded: DataFrame, file: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give a null text."""
    id_type = encoded.schema["doc_id"].dataType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe(file)
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                texts = [None if ids is None else own.decode(np.array(ids, np.int64)) for ids in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, f"doc_id {id_type}, text string")
