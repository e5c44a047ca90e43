"""SentencePiece models in the tokenizers library.

The model's protobuf is read field by field; its normaliser, white-space mark,
piece scores and byte fallback are rebuilt as a ``tokenizers`` pipeline, which
encodes batches in several threads. The result is held against the
sentencepiece library itself, text by text or for each distinct unit.

Cases: null text is empty and has no ids; control pieces inside a text are
ordinary text; characters outside the vocabulary become byte pieces; rows that
repeat an id are encoded each; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from leadpanel.llm.tokens import UnitEncoder, flatten, hold

MARK = "▁"
#: Threads a task's encoder uses.
THREADS = 2
# Piece types and model types of the format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def protobuf_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """``(number, value)`` of each field of one message; numbers as int, the rest as bytes."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at:at + size], at + size
        else:
            size = {1: 8, 5: 4}[kind]
            value, at = data[at:at + size], at + size
        yield tag >> 3, value


@dataclass
class Model:
    """What a SentencePiece file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra_spaces: bool = True
    escape_spaces: bool = True

    @property
    def unknown(self) -> int:
        return next(i for i, (_, _, kind) in enumerate(self.pieces) if kind == UNKNOWN)


def parse_model(data: bytes) -> Model:
    model = Model()
    for number, value in protobuf_fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for inner, x in protobuf_fields(value):
                if inner == 1:
                    piece = x.decode()
                elif inner == 2:
                    (score,) = struct.unpack("<f", x)
                elif inner == 3:
                    kind = x
            model.pieces.append((piece, score, kind))
        elif number == 2:
            for inner, x in protobuf_fields(value):
                if inner == 3:
                    model.kind = x
                elif inner == 35:
                    model.byte_fallback = bool(x)
        elif number == 3:
            for inner, x in protobuf_fields(value):
                if inner == 2:
                    model.charsmap = x
                elif inner == 3:
                    model.dummy_prefix = bool(x)
                elif inner == 4:
                    model.remove_extra_spaces = bool(x)
                elif inner == 5:
                    model.escape_spaces = bool(x)
    return model


def merges_of(model: Model) -> list[tuple[str, str]]:
    """Pairs in the order in which a BPE model joins them: best score of the joined piece first."""
    joined = {piece: (score, at) for at, (piece, score, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED)}
    found = []
    for piece, (score, at) in joined.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in joined and right in joined:
                found.append((-score, at, joined[left][1], joined[right][1], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def build_tokenizer(model: Model):
    """The model as a ``tokenizers`` pipeline."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

    if model.kind == BPE:
        core = models.BPE(
            {piece: at for at, (piece, _, _) in enumerate(model.pieces)}, merges_of(model),
            unk_token=model.pieces[model.unknown][0], fuse_unk=True, byte_fallback=model.byte_fallback,
        )
    elif model.kind == UNIGRAM:
        # Only normal pieces may be found in a text; the others keep their ids with a score that never wins.
        worst = min(score for _, score, _ in model.pieces) - 1e6
        scored = [(piece, score if kind in (NORMAL, USER_DEFINED) else worst) for piece, score, kind in model.pieces]
        core = models.Unigram(scored, model.unknown, model.byte_fallback)
    else:
        raise ValueError("only unigram and BPE models are supported")
    tokenizer = Tokenizer(core)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.remove_extra_spaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    mark = MARK if model.escape_spaces else " "
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(mark))
    steps.append(normalizers.Replace(" ", mark))
    tokenizer.normalizer = normalizers.Sequence(steps)
    own = [piece for piece, _, kind in model.pieces if kind == USER_DEFINED]
    tokenizer.add_tokens([AddedToken(piece, normalized=False) for piece in own])
    undo = [decoders.Replace(mark, " "), decoders.ByteFallback(), decoders.Fuse()]
    tokenizer.decoder = decoders.Sequence(undo + ([decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []))
    return tokenizer


def splits_at_spaces(model: Model) -> bool:
    """Whether a text's ids are those of its units: no normaliser across units, and no piece past a space."""
    plain = not model.charsmap and not model.remove_extra_spaces and model.dummy_prefix and model.escape_spaces
    inside = any(MARK in piece.lstrip(MARK) for piece, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED))
    return plain and not inside and not any(kind == USER_DEFINED for *_, kind in model.pieces)


_EDGE = re.compile(r"(?<=[^ ]) (?!\Z)")


def split_units(text: str) -> list[str]:
    """Cuts at each space after another character; the space itself comes back as the next unit's prefix."""
    if not text:
        return []
    if "  " in text or text[0] == " " or text[-1] == " ":
        return _EDGE.split(text)
    return text.split(" ")


@dataclass
class Codec:
    """One model in both libraries."""

    file: str

    def __post_init__(self):
        import sentencepiece

        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        with open(self.file, "rb") as f:
            self.model = parse_model(f.read())
        self.tokenizer = build_tokenizer(self.model)
        self.original = sentencepiece.SentencePieceProcessor(model_file=self.file)
        self.by_unit = splits_at_spaces(self.model)
        self.units = UnitEncoder(split_units if self.by_unit else lambda text: [text], self._learn)

    def _learn(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [x.ids for x in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]
        expected = self.original.encode(units, num_threads=THREADS)
        # A unit whose ids differ is marked by one number past the vocabulary in front.
        return flatten([a if a == b else [len(self.model.pieces), *b] for a, b in zip(found, expected)])

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, bool]]:
        """Ids of each text and whether both libraries agree on all of it; where they do not, sentencepiece's ids."""
        odd = len(self.model.pieces)
        for ids in self.units.texts(texts):
            agreed = not (ids == odd).any()
            yield (ids if agreed else ids[ids != odd]), agreed

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)


@lru_cache(maxsize=2)
def codec(file: str) -> Codec:
    return Codec(file)


#: Documents decoded at a time.
_ROWS = 64


def encode_documents(docs: DataFrame, model_file: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids_crc32, parity, decodes`` and, unless left out, ``ids``.

    ``parity``: both libraries give these ids. ``decodes``: decoding them gives the text again.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens bigint, ids_crc32 bigint, parity boolean, decodes boolean"
    if with_ids:
        schema += ", ids array<int>"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_file)
        hold("sentencepiece", own.units.forget)
        for batch in batches:
            for low in range(0, batch.num_rows, _ROWS):
                part = batch.slice(low, _ROWS)
                texts = [text or "" for text in part.column("text").to_pylist()]
                ids, parity = zip(*own.encode(texts))
                back = own.decode([x.tolist() for x in ids])
                out = [
                    part.column("doc_id"), pa.array(list(map(len, ids)), pa.int64()),
                    pa.array([zlib.crc32(x.astype("<u4")) for x in ids], pa.int64()), pa.array(parity, pa.bool_()),
                    pa.array([a == b for a, b in zip(back, texts)], pa.bool_()),
                ]
                if with_ids:
                    out.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "n_tokens", "ids_crc32", "parity", "decodes", "ids"][:len(out)])

    return docs.select("doc_id", "text").mapInArrow(encode, schema)


def decode_documents(encoded: DataFrame, model_file: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give a null text."""
    id_type = encoded.schema["doc_id"].dataType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_file)
        for batch in batches:
            for low in range(0, batch.num_rows, _ROWS):
                part = batch.slice(low, _ROWS)
                ids = part.column("ids").to_pylist()
                texts = own.decode([x or [] for x in ids])
                out = [None if x is None else text for x, text in zip(ids, texts)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, f"doc_id {id_type}, text string")
