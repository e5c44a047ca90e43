"""Quality scores by nearest-neighbour voting in a latent-semantic space.

A text's terms are its words (hashed) and the trigrams of its bytes' classes,
with graded terms for the share of words that repeat the one before. Document
frequencies cover all documents. A sample of labelled training rows, bounded by
``LABELLED`` per label, gives the latent directions; its vectors are broadcast.
Every document is projected, its cosine with each labelled vector comes from an
exact product of blocks, and the nearest ones vote, weighted by similarity.

Cases: null and empty texts have no terms and get the share of label 1 among
the votes; rows without a usable label are not learned; with no labelled row
every score is 0.5; rows that repeat an id are scored each; a null id is scored
and is not held out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from leadpanel.llm.tokens import WordNumbers, give_back, hold
from leadpanel.session import pin

#: Labelled rows per label in the fitted sample.
LABELLED = 1024
#: Latent directions; neighbours that vote; power of the similarity that weighs a vote.
DIRECTIONS, NEIGHBOURS, SHARPNESS = 64, 15, 4
#: A document is predicted to be good from this score on.
THRESHOLD = 0.3
#: Words fall into 2**14 bins, class trigrams into 2**15; the last terms grade how many words repeat the one before.
WORD_BINS, CLASS_BINS, REPEAT_BINS = 1 << 14, 1 << 15, 16
TERMS = WORD_BINS + CLASS_BINS + REPEAT_BINS

_BLOCK = 256
#: Cells of the sample's matrix that are dense at a time: 16 MB.
_CELLS = 1 << 22


def _byte_classes() -> np.ndarray:
    """One of 32 classes per byte: letters by case, digits, other bytes above 127, white space, and each common mark."""
    classes = np.full(256, 31, np.uint32)
    classes[ord("a"):ord("z") + 1], classes[ord("A"):ord("Z") + 1], classes[ord("0"):ord("9") + 1] = 0, 1, 2
    classes[128:] = 3
    classes[[9, 10, 11, 12, 13]], classes[32] = 4, 5
    for at, mark in enumerate(".,;:!?'\"-()[]{}<>/|#$%&*_"):
        classes[ord(mark)] = 6 + at
    return classes


_CLASSES = _byte_classes()


_bins = WordNumbers(lambda word: xxhash.xxh3_64_intdigest(word) % WORD_BINS)


def terms(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms of a text, and how often each occurs."""
    words = text.split()
    bins = np.fromiter(map(_bins.__getitem__, words), np.int64, len(words))
    classes = _CLASSES[np.frombuffer(text, np.uint8)]
    trigrams = (classes[:-2] << 10 | classes[1:-1] << 5 | classes[2:]) if len(classes) > 2 else classes[:0]
    shape = np.bincount(trigrams, minlength=CLASS_BINS)
    used = np.flatnonzero(shape)
    word, count = np.unique(bins, return_counts=True)
    share = (bins[1:] == bins[:-1]).mean() if len(bins) > 1 else 0.0
    grades = np.arange(int(np.ceil(share * REPEAT_BINS)))
    found = np.concatenate([word, used + WORD_BINS, grades + (WORD_BINS + CLASS_BINS)])
    return found, np.concatenate([count, shape[used], np.full(len(grades), len(bins))])


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each term occurs, and the number of documents; the terms are bounded by ``TERMS``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("quality", _bins.clear)
        seen, rows = np.zeros(TERMS + 1, np.int64), 0
        for batch in batches:
            for text in batch.column("text").cast(pa.binary()):
                seen[terms(text.as_py() or b"")[0]] += 1
            rows += batch.num_rows
        seen[TERMS] = rows
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(seen[used], pa.int64())], ["term", "docs"])

    sums = docs.select("text").mapInArrow(count, "term bigint, docs bigint").groupBy("term").agg(F.sum("docs").alias("docs"))
    out = np.zeros(TERMS + 1, np.int64)
    found = sums.toArrow()
    out[found.column("term").to_numpy()] = found.column("docs").to_numpy()
    return out[:TERMS], int(out[TERMS])


@dataclass
class Model:
    """What is broadcast: term weights, latent directions, and labelled vectors; bounded by the parameters."""

    idf: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def project(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The latent unit vector of one document; zero without terms."""
        weights = np.log1p(counts).astype(np.float32) * self.idf[found]
        latent = weights @ self.directions[found]
        norm = np.linalg.norm(latent)
        return latent / norm if norm > 0 else latent

    def scores(self, latent: np.ndarray) -> np.ndarray:
        """The neighbours' vote for label 1 of each row."""
        if not len(self.labels):
            return np.full(len(latent), 0.5)
        cosines = latent @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weights = np.maximum(np.take_along_axis(cosines, near, axis=1), 0).astype(np.float64) ** SHARPNESS
        total = weights.sum(axis=1)
        votes = (weights * self.labels[near]).sum(axis=1)
        return np.where(total > 0, votes / np.maximum(total, 1e-300), self.labels.mean())


class SampleMatrix:
    """A matrix kept as its cells other than zero; products make a block of it dense at a time."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, shape: tuple[int, int]):
        """``rows`` ascend."""
        self.shape = shape
        order = np.argsort(columns, kind="stable")
        self.values = values.astype(np.float32)
        self.by_row, self.by_column = (rows, columns, slice(None)), (columns[order], rows[order], order)

    def _blocks(self, cells: tuple, along: int, across: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """Each run of rows (or columns), and where its cells lie in it with their values."""
        at, other, order = cells
        step = max(1, _CELLS // max(across, 1))
        values = self.values[order]
        for low in range(0, along, step):
            high = min(low + step, along)
            first, last = np.searchsorted(at, [low, high])
            yield slice(low, high), at[first:last] - low, other[first:last], values[first:last]

    def row_blocks(self) -> Iterator[tuple[slice, np.ndarray]]:
        for part, row, column, values in self._blocks(self.by_row, *self.shape):
            block = np.zeros((part.stop - part.start, self.shape[1]), np.float32)
            block[row, column] = values
            yield part, block

    def column_blocks(self) -> Iterator[tuple[slice, np.ndarray]]:
        for part, column, row, values in self._blocks(self.by_column, *self.shape[::-1]):
            block = np.zeros((self.shape[0], part.stop - part.start), np.float32)
            block[row, column] = values
            yield part, block

    def scale_rows(self) -> None:
        """Rows become unit vectors."""
        norms = np.concatenate([np.linalg.norm(block, axis=1) for _, block in self.row_blocks()])
        self.values /= np.maximum(norms, 1e-12)[self.by_row[0]]

    def times(self, right: np.ndarray) -> np.ndarray:
        return np.concatenate([block @ right for _, block in self.row_blocks()])

    def transposed_times(self, right: np.ndarray) -> np.ndarray:
        return np.concatenate([block.T @ right for _, block in self.column_blocks()])

    def left_times(self, left: np.ndarray) -> np.ndarray:
        return np.concatenate([left @ block for _, block in self.column_blocks()], axis=1)


def latent_directions(rows: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray) -> np.ndarray:
    """The leading right singular directions of the sample's weighted unit rows, by randomised subspace iteration.

    The matrix is never dense as a whole, which would be hundreds of MB on the driver.
    """
    sizes = [len(found) for found, _ in rows]
    columns, at = np.unique(np.concatenate([found for found, _ in rows]), return_inverse=True)
    weights = np.concatenate([np.log1p(counts) for _, counts in rows]) * idf[columns[at]]
    matrix = SampleMatrix(np.repeat(np.arange(len(rows)), sizes), at, weights, (len(rows), len(columns)))
    matrix.scale_rows()
    wide = min(DIRECTIONS + 16, *matrix.shape)
    basis = matrix.times(np.random.default_rng(0).standard_normal((len(columns), wide)).astype(np.float32))
    for _ in range(4):
        basis = np.linalg.qr(matrix.times(matrix.transposed_times(np.linalg.qr(basis)[0])))[0]
    _, _, right = np.linalg.svd(matrix.left_times(basis.T), full_matrices=False)
    directions = np.zeros((TERMS, min(DIRECTIONS, wide)), np.float32)
    directions[columns] = right[:DIRECTIONS].T
    return directions


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id's text divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, per_label: int = LABELLED) -> DataFrame:
    """``quality, text`` of at most ``per_label`` rows of each label, chosen by a hash of the id."""
    order = F.xxhash64("doc_id", F.lit(1))
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("_other")).where("quality = _other")
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "quality")
    chosen = [known.where(F.col("quality") == label).orderBy(order, "doc_id").limit(per_label) for label in (0, 1)]
    picked = pin(chosen[0].unionByName(chosen[1]))  # at most 2 * per_label rows
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return texts.groupBy("doc_id", "quality").agg(F.max("text").alias("text")).select("quality", "text")


def fit(docs: DataFrame, labels: DataFrame, per_label: int = LABELLED) -> Model:
    """Document frequencies over all documents, then the latent space of the labelled sample."""
    frequencies, rows = document_frequencies(docs)
    idf = np.log((1 + rows) / (1 + frequencies)).astype(np.float32) + 1

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms(text.as_py() or b"") for text in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("quality"), pa.array([x for x, _ in found], pa.list_(pa.int64())),
                 pa.array([y for _, y in found], pa.list_(pa.int64()))], ["quality", "terms", "counts"])

    label = labels.schema["quality"].dataType.simpleString()
    found = training_sample(docs, labels, per_label).mapInArrow(
        weigh, f"quality {label}, terms array<bigint>, counts array<bigint>"
    ).toArrow()
    # Views of the table's own memory: as Python numbers the sample would take ten times as much.
    sample = [(quality.as_py(), used.values.to_numpy(), counts.values.to_numpy())
              for quality, used, counts in zip(*(found.column(c) for c in ("quality", "terms", "counts"))) if len(used)]
    if not sample:
        return Model(idf, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
    directions = latent_directions([(found, counts) for _, found, counts in sample], idf)
    model = Model(idf, directions, np.zeros((0, directions.shape[1]), np.float32), np.zeros(0))
    model.vectors = np.stack([model.project(found, counts) for _, found, counts in sample])
    model.labels = np.array([quality for quality, *_ in sample], np.float64)
    del sample, found
    give_back()
    return model


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of the documents as struct ``row``, with ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct("*").alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("quality", _bins.clear)
        own = shared.value
        for batch in batches:
            texts, scores = batch.column("row").field("text").cast(pa.binary()), []
            for low in range(0, batch.num_rows, _BLOCK):
                latent = np.stack([own.project(*terms(text.as_py() or b"")) for text in texts[low:low + _BLOCK]])
                scores.append(own.scores(latent))
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(scores, pa.float64()), pa.array(scores >= threshold).cast(pa.int32())],
                ["row", "score", "predicted"])

    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return rows.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per document."""
    plain = docs.select("doc_id", "text")
    scored = score_documents(plain, fit(plain, labels))
    return scored.select(
        F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id")).alias("held_out"), "score", "predicted"
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are predicted to be good, with all their columns."""
    return score_documents(docs, fit(docs.select("doc_id", "text"), labels)).where("predicted = 1").select("row.*")
