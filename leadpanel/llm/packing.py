"""Packing by power-of-two decomposition: no sequence crosses documents and none is padded.

A document's ids, closed by the end id, are cut into full sequences and then
into the binary pieces of what is left, longest first. Each piece is one
sequence; sequences of one length form a bucket and have consecutive numbers,
so a reader draws batches of equal length.

Cases: null text is empty and gives the end id alone; rows that repeat an id
are packed each on their own; a null id is kept; a control string in a text
gives its control id, as the library's plain call does, or is ordinary text
when ``control_tokens`` is false; an empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leadpanel.llm.tokens import UnitEncoder, flatten, hold
from leadpanel.operators.ranking import add_position
from leadpanel.session import pin

#: Longest sequence; a power of two.
MAX_TOKENS = 1024
#: Closes every document.
END_ID = 0

_EDGE = re.compile(r"(?<=\S)(?= )")
_SPACES = re.compile(r"\s ")


def split_units(text: str) -> list[str | tuple[str]]:
    """Units of a byte-level BPE text, which breaks before every space after a character other than white space.

    The space is left out; the first unit, which has none, stands in a tuple.
    """
    if _SPACES.search(text) or text[:1] == " ":
        units = [unit[1:] if at else unit for at, unit in enumerate(_EDGE.split(text))]
    else:
        units = text.split(" ")
        if len(units) > 1 and not units[-1]:  # a space at the end stays with the unit before it
            units.pop()
            units[-1] += " "
    return [(units[0],), *units[1:]] if text else []


#: Plain characters, Latin-1 without those whose kind is not the same to all regex engines, and the pieces of
#: byte-level BPE in them. Units stand in one text with a character between them that is a piece of its own, and its id none of the vocabulary.
_LETTERS, _MARKS = "a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", r"!-/:-@\[-`{-~"
_ODD = re.compile(rf"[^{_LETTERS} \n0-9{_MARKS}]+")
_PIECE = re.compile(rf" ?[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_MARKS}]+| ?[0-9]+|[ \n]+(?![^ \n\0])|[ \n]+|\0")
_GAP, _GAP_ID = "\0", 2**32 - 1
#: Bytes that stand for themselves in a byte-level vocabulary; the others are spelled with letters from 256 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTERS = {byte: byte for byte in _SHOWN} | {byte: 256 + at for at, byte in enumerate(sorted({*range(256)} - {*_SHOWN}))}


def byte_letters(pieces: list[str]) -> list[str]:
    """Pieces without tabs, as a byte-level vocabulary spells them."""
    letters = "\t".join(pieces).encode().decode("latin-1").translate(_BYTE_LETTERS)
    return letters.split(chr(_BYTE_LETTERS[9]))


#: Units encoded as one text, with a control token between them, and such texts encoded at a time.
_JOINED, _AT_A_TIME = 512, 4
#: Distinct units and pieces a worker remembers, and characters it splits at a time: tens of MB.
UNITS_KEPT, PIECES_KEPT, CHUNK_CHARS = 400_000, 400_000, 500_000
#: Rows of a batch that are turned into Python strings at a time.
_ROWS = 256


def splits_before_spaces(tokenizer_file: str) -> bool:
    """Whether a text's ids are those of its units: byte-level pieces that begin at spaces, no normaliser, plain control tokens."""
    with open(tokenizer_file) as f:
        spec = json.load(f)
    cut = spec.get("pre_tokenizer") or {}
    plain = not any(spec.get(step) for step in ("normalizer", "truncation", "padding"))
    odd = any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or not t["special"] for t in spec["added_tokens"])
    return plain and bool(spec["added_tokens"]) and not odd and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")


@lru_cache(maxsize=4)
def _encoder(tokenizer_file: str, control_tokens: bool = True) -> UnitEncoder:
    """Units share their pieces (words without the marks after them), so the library's model merges each distinct piece once.

    Units with characters that are not plain are encoded by the library many at a time: the vocabulary's
    control token parts them and is an id of its own. A tokenizer file of another kind encodes whole texts.
    """
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    tokenizer = Tokenizer.from_file(tokenizer_file)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def alone(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        tokenizer.encode_special_tokens = not control_tokens
        found = [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
        tokenizer.encode_special_tokens = False
        return flatten(found)

    if not splits_before_spaces(tokenizer_file):
        return UnitEncoder(lambda text: [text] if text else [], alone, UNITS_KEPT // 100, CHUNK_CHARS)
    controls = {added.content: at for at, added in tokenizer.get_added_tokens_decoder().items()}
    mark, mark_id = next(iter(controls.items()))
    control = re.compile("(" + "|".join(map(re.escape, sorted(controls, key=len, reverse=True))) + ")")

    def split(text: str) -> list[str | tuple[str]]:
        if not control_tokens or not any(c in text for c in controls):
            return split_units(text)
        # Controls stand at the odd places; what lies between them is cut like a text of its own.
        return [unit for at, part in enumerate(control.split(text)) for unit in ([(part,)] if at % 2 else split_units(part))]

    model = tokenizer.model

    def merge(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, ends = [], []
        for piece, letters in zip(pieces, byte_letters(pieces)):
            if piece == _GAP:
                ids.append(_GAP_ID)
            else:
                ids.extend(map(attrgetter("id"), model.tokenize(letters)))
            ends.append(len(ids))
        return np.array(ids, np.uint32), np.diff(ends, prepend=0)

    by_piece = UnitEncoder(_PIECE.findall, merge, PIECES_KEPT, CHUNK_CHARS)

    def encode(units: list[str | tuple[str]]) -> tuple[np.ndarray, np.ndarray]:
        units = [unit[0] if isinstance(unit, tuple) else f" {unit}" for unit in units]
        whole = "\n".join(units)
        ends = np.cumsum(np.fromiter(map(len, units), np.int64, len(units)) + 1)
        odd = np.zeros(len(units), bool)
        odd[np.searchsorted(ends, [found.start() for found in _ODD.finditer(whole)], "right")] = True
        for control in controls:
            if control in whole:
                odd |= [control in unit for unit in units]
        if not odd.any():
            return by_pieces(units)
        sizes, (plain_ids, sizes_plain), (odd_ids, sizes_odd) = np.zeros(len(units), np.int64), *(
            way([units[at] for at in np.flatnonzero(own)]) for way, own in ((by_pieces, ~odd), (by_library, odd)))
        sizes[~odd], sizes[odd] = sizes_plain, sizes_odd
        owner = np.repeat(odd, sizes)
        ids = np.zeros(len(owner), np.uint32)
        ids[~owner], ids[owner] = plain_ids, odd_ids
        return ids, sizes

    def parted(ids: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids without the gaps between units, and how many each unit has."""
        ends = np.append(np.flatnonzero(ids == gap), len(ids))
        return ids[ids != gap], np.diff(ends, prepend=-1) - 1

    def by_pieces(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return parted(next(by_piece.texts([_GAP.join(units)])), _GAP_ID) if units else flatten([])

    def by_library(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = [units[low:low + _JOINED] for low in range(0, len(units), _JOINED)]
        joined = [mark.join(part) for part in parts]
        flat, sizes = [], []
        # A few at a time: the library's encodings are many times as large as the ids.
        encoded = chain.from_iterable(
            tokenizer.encode_batch_fast(joined[low:low + _AT_A_TIME], add_special_tokens=False) for low in range(0, len(joined), _AT_A_TIME))
        for part, text, found in zip(parts, joined, encoded):
            if any(text.count(control) != (len(part) - 1) * (control == mark) for control in controls):
                ids, counts = alone(part)  # a unit that holds a control string itself
            else:
                ids, counts = parted(np.array(found.ids, np.uint32), mark_id)
            flat.append(ids)
            sizes.append(counts)
        return np.concatenate(flat), np.concatenate(sizes)

    return UnitEncoder(split, encode, UNITS_KEPT, CHUNK_CHARS, by_piece)


def piece_lengths(tokens: int, max_tokens: int = MAX_TOKENS) -> list[int]:
    """Full sequences, then the powers of two that make up the rest, longest first."""
    full, rest = divmod(tokens, max_tokens)
    bits = [1 << b for b in range(max_tokens.bit_length() - 1, -1, -1) if rest >> b & 1]
    return [max_tokens] * full + bits


def cut_documents(docs: DataFrame, tokenizer_file: str, max_tokens: int = MAX_TOKENS, with_ids: bool = True,
                  control_tokens: bool = True) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens`` and, unless left out, its ``ids``."""
    if max_tokens < 1 or max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    if with_ids:
        schema += ", ids array<int>"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_file, control_tokens)
        hold("packing", encoder.forget)
        for batch in batches:
            for low in range(0, batch.num_rows, _ROWS):
                yield pieces_of(batch.slice(low, _ROWS), encoder)

    def pieces_of(batch: pa.RecordBatch, encoder: UnitEncoder) -> pa.RecordBatch:
        names, texts = batch.column("doc_id"), batch.column("text").to_pylist()
        rows, start, length, crc, tokens, ids = [], [], [], [], [], []
        for row, found in enumerate(encoder.texts(text or "" for text in texts)):
            whole = np.append(found, np.uint32(END_ID)).astype("<u4")
            at = 0
            for size in piece_lengths(len(whole), max_tokens):
                piece = whole[at:at + size]
                rows.append(row)
                start.append(at)
                length.append(size)
                crc.append(zlib.crc32(piece))
                tokens.append(len(whole))
                if with_ids:
                    ids.append(piece.astype(np.int32))
                at += size
        out = [names.take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, tokens))]
        columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        if with_ids:
            out.append(pa.array(ids, pa.list_(pa.int32())))
            columns.append("ids")
        return pa.RecordBatch.from_arrays(out, columns)

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def number_sequences(pieces: DataFrame) -> DataFrame:
    """Adds ``bucket`` (log2 of the length), ``sequence_id`` and ``offset``; ids of one bucket are consecutive."""
    order = [F.col("length").desc(), F.col("doc_id"), F.col("start"), F.col("doc_tokens"), F.col("ids_crc32")]
    placed = add_position(pin(pieces), order, position="_place", total="_all")
    return placed.select(
        *pieces.columns,
        F.log2("length").cast("int").alias("bucket"),
        (F.col("_place") - 1).cast("long").alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, tokenizer_file: str, max_tokens: int = MAX_TOKENS, with_ids: bool = True,
         control_tokens: bool = True) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return number_sequences(cut_documents(docs, tokenizer_file, max_tokens, with_ids, control_tokens))


def write_buckets(packed: DataFrame, path: str) -> None:
    """Parquet with one folder per length, sequences of equal length together."""
    packed.repartition("bucket", F.expr("sequence_id div 65536")).sortWithinPartitions("bucket", "sequence_id").write.partitionBy("bucket").parquet(path)
