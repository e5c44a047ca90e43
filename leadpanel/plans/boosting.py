"""Boosted trees of Spark ML's ``GBTClassifier``, many fits over the same rows at a time.

The rows are binned once into blocks of bytes; each level of a tree is one pass that makes the
histograms of all fits in numpy, and features of two values share a byte. Splits, bags, residuals and
ties are those of ``GBTClassifier``: the same sample for the thresholds, the same draws for the bags.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

c = F.col

#: Rows in a block.
BLOCK = 1 << 16
#: Trees whose bags share a word.
WORD = 32
#: Partitions from which histograms are summed in two steps instead of on the driver.
DIRECT = 64
#: Spark ML's bound for the rows that thresholds are found in, and for rounding.
SAMPLE, EPSILON = 10_000, 2.0 ** -52


@dataclass(frozen=True)
class Bins:
    """How feature values become bytes: ``(column, shift, mask)`` per feature, thresholds of the numeric ones."""

    places: list[tuple[int, int, int]]
    thresholds: list[np.ndarray | None]  # None: two values
    columns: int

    def of(self, x: np.ndarray) -> np.ndarray:
        """A byte per column and row."""
        out = np.zeros((self.columns, len(x)), np.uint8)
        for f, ((column, shift, _), cuts) in enumerate(zip(self.places, self.thresholds)):
            if cuts is None:
                out[column] |= x[:, f].astype(np.uint8) << shift
            else:
                out[column] = np.searchsorted(cuts, x[:, f])
        return out


@dataclass
class Tree:
    """Splits by level and the values of the leaves; a node that is not split hands its rows to its left child."""

    column: list[np.ndarray] = field(default_factory=list)
    shift: list[np.ndarray] = field(default_factory=list)
    mask: list[np.ndarray] = field(default_factory=list)
    above: list[np.ndarray] = field(default_factory=list)
    leaves: np.ndarray | None = None

    def node(self, bins: np.ndarray) -> np.ndarray:
        """The node of each row at the level that the tree has grown to."""
        at, rows = np.zeros(bins.shape[1], np.intp), np.arange(bins.shape[1])
        for column, shift, mask, above in zip(self.column, self.shift, self.mask, self.above):
            if len(column) == 1:
                found = (bins[column[0]] >> shift[0]) & mask[0]
                at = (found > above[0]).astype(np.intp)
            else:
                found = (bins[column[at], rows] >> shift[at]) & mask[at]
                at = 2 * at + (found > above[at])
        return at


@dataclass(frozen=True)
class Boosted:
    """A fitted model: its features as places in the vector, the trees and their weights."""

    bins: Bins
    trees: list[Tree]
    weights: list[float]

    def score(self, bins: np.ndarray) -> np.ndarray:
        """The probability of class 1."""
        margin = np.zeros(bins.shape[1])
        for tree, weight in zip(self.trees, self.weights):
            margin += weight * tree.leaves[tree.node(bins)]
        return 1.0 - 1.0 / (1.0 + np.exp(2.0 * margin))


def supported(estimator, train: DataFrame) -> bool:
    """Whether fits go this way: boosting of the logistic loss over numbers and features of two values."""
    if not isinstance(estimator, GBTClassifier):
        return False
    get = estimator.getOrDefault
    plain = (get("lossType") == "logistic" and get("featureSubsetStrategy") == "all" and get("maxBins") <= 128
             and not estimator.isDefined("validationIndicatorCol") and get("minWeightFractionPerNode") == 0 and not estimator.isDefined("thresholds"))
    nominal = _attributes(estimator, train).get("nominal")
    return bool(plain and not nominal)


def _attributes(estimator, train: DataFrame) -> dict:
    return train.schema[estimator.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})


def thresholds_of(values: np.ndarray, weights: np.ndarray, fraction: float, all_weight: float, n_splits: int) -> np.ndarray:
    """Spark ML's thresholds of one feature from a sample: zeros are what the sample's other rows leave of its expected weight."""
    some = values != 0
    count = int(some.sum())
    found, at = np.unique(values[some], return_inverse=True)
    if not count:
        return np.zeros(0)
    n = np.bincount(at, weights[some], len(found))
    expected = fraction * all_weight
    zeros = expected - n.sum()
    if zeros > EPSILON * count * 100:
        place = np.searchsorted(found, 0.0)
        found, n = np.insert(found, place, 0.0), np.insert(n, place, zeros)
    between = (found[:-1] + found[1:]) / 2.0
    if len(between) <= n_splits:
        return between
    stride, out = expected / (n_splits + 1), []
    target, now = stride, n[0]
    for i in range(1, len(found)):
        before, now = now, now + n[i]
        if abs(before - target) < abs(now - target):
            out.append(between[i - 1])
            target += stride
    return np.array(out)


def _sampled(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """The rows that Spark ML samples: by RDD, which draws other rows than a DataFrame does."""
    spark = df.sparkSession
    draw = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    rows = df._jdf.toJavaRDD().sample(False, fraction, draw)
    return DataFrame(spark._jsparkSession.createDataFrame(rows, df._jdf.schema()), spark)


def find_bins(estimator: GBTClassifier, train: DataFrame) -> Bins:
    """Thresholds of all features, from at most about ``SAMPLE`` rows."""
    rows = train.select(vector_to_array(estimator.getFeaturesCol()).alias("x"), c(estimator.getWeightCol()).cast("double").alias("w"))
    n, all_weight, width = train.agg(
        F.count(F.lit(1)), F.sum(c(estimator.getWeightCol()).cast("double")), F.max(F.size(vector_to_array(estimator.getFeaturesCol())))).first()
    most = min(estimator.getMaxBins(), n)
    wanted = max(most * most, SAMPLE)
    fraction = wanted / n if wanted < n else 1.0
    sample = (rows if fraction == 1 else _sampled(rows, fraction, estimator.getSeed())).toPandas()
    x, w = np.array(sample["x"].tolist(), float).reshape(-1, width), sample["w"].to_numpy(float)
    binary = {a["idx"] for a in _attributes(estimator, train).get("binary", [])}
    shared = most.bit_length() - 1  # features of two values in a byte
    places, cuts, columns, packed = [], [], 0, []
    for f in range(width):
        if f in binary:
            if len(packed) % shared == 0:
                column, columns = columns, columns + 1
            places.append((column, len(packed) % shared, 1))
            cuts.append(None)
            packed.append(f)
        else:
            places.append((columns, 0, 255))
            cuts.append(thresholds_of(x[:, f], w, fraction, all_weight, most - 1))
            columns += 1
    return Bins(places, cuts, columns)


@dataclass
class Block:
    """Some rows: bytes by column, labels -1 and 1, weights (None: all 1), bags by word, margins by fit."""

    bins: np.ndarray
    y: np.ndarray
    w: np.ndarray | None
    bags: np.ndarray | None
    margins: np.ndarray | None = None


def _blocks(estimator: GBTClassifier, train: DataFrame, bins: Bins) -> RDD:
    rate, seed, trees = estimator.getSubsamplingRate(), estimator.getSeed(), estimator.getMaxIter()
    words = -(-trees // WORD) if rate < 1 else 0
    # The draws of a bag are those of ``rand``, which starts with the seed and the partition as Spark ML does, but for 1.
    drawn = lambda m: F.shiftleft((F.rand(seed + m + 1) < rate).cast("bigint"), m % WORD)
    bags = [sum((drawn(m) for m in range(k * WORD + 1, min(trees, (k + 1) * WORD))), drawn(k * WORD)) for k in range(words)]
    rows = train.select(
        vector_to_array(estimator.getFeaturesCol()).alias("x"), c(estimator.getLabelCol()).cast("double").alias("y"),
        c(estimator.getWeightCol()).cast("double").alias("w"), *[b.alias(f"b{k}") for k, b in enumerate(bags)])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        kept, size = [], 0

        def out() -> pa.RecordBatch:
            whole = [np.concatenate([k[i] for k in kept], axis=-1) for i in range(4)]
            w = None if (whole[2] == 1).all() else whole[2]
            block = Block(whole[0], whole[1], w, whole[3] if words else None)
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block, 5)], pa.binary())], ["block"])

        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            y, w = (batch.column(n).to_numpy(zero_copy_only=False) for n in "yw")
            bag = np.array([batch.column(f"b{k}").to_numpy(zero_copy_only=False) for k in range(words)], np.uint32).reshape(words, len(y))
            kept.append((bins.of(x), (2 * y - 1).astype(np.int8), w, bag))
            size += len(y)
            if size >= BLOCK:
                yield out()
                kept, size = [], 0
        if kept:
            yield out()

    def unpacked(row) -> Block:
        import pickle

        return pickle.loads(row["block"])

    return rows.mapInArrow(packed, "block binary").rdd.map(unpacked)


def _residual(margin: np.ndarray | None, y: np.ndarray) -> np.ndarray:
    y = y.astype(float)
    return y if margin is None else 4.0 * y / (1.0 + np.exp(2.0 * y * margin))


def histograms(blocks: Iterator[Block], m: int, trees: Sequence[Tree], uses: Sequence[Sequence[int]], stride: int) -> np.ndarray | None:
    """Weight, weighted sum, weighted squares and count by fit, node, column and bin, of the rows in the bag of tree ``m``."""
    out = None
    for block in blocks:
        bins, y, w, margins = block.bins, block.y, block.w, block.margins
        if block.bags is not None:
            rows = np.flatnonzero(block.bags[m // WORD] >> np.uint32(m % WORD) & np.uint32(1))
            bins, y = np.ascontiguousarray(bins[:, rows]), y[rows]
            w = None if w is None else w[rows]
            margins = None if margins is None else margins[:, rows]
        if out is None:
            nodes = 1 << len(trees[0].column)
            out = np.zeros((len(trees), len(bins), nodes, stride, 4))
        for v, (tree, columns) in enumerate(zip(trees, uses)):
            r = _residual(None if margins is None else margins[v], y)
            base = tree.node(bins) * stride
            wr = r if w is None else w * r
            wrr = wr * r
            for column in columns:
                key = base + bins[column]
                sums = lambda values=None: np.bincount(key, values, nodes * stride).reshape(nodes, stride)
                n = sums()
                for k, found in enumerate((n if w is None else sums(w), sums(wr), sums(wrr), n)):
                    out[v, column, :, :, k] += found
    return out


def _impurity(s: np.ndarray) -> np.ndarray:
    n = np.where(s[..., 0] == 0, 1.0, s[..., 0])
    return np.where(s[..., 0] == 0, 0.0, (s[..., 2] - s[..., 1] * s[..., 1] / n) / n)


def best_split(stats: np.ndarray, bins: Bins, features: Sequence[int], parent: np.ndarray | None, least: int, least_gain: float):
    """``(gain, feature, bin, left, right)`` of a node from its sums by column and bin; None without a valid split.

    The first of equal gains, by feature and bin, wins.
    """
    lefts, totals, of = [], [], []
    for f in features:
        column, shift, _ = bins.places[f]
        if bins.thresholds[f] is None:
            one = (np.arange(stats.shape[1]) >> shift & 1).astype(bool)
            two = np.stack([stats[column][~one].sum(0), stats[column][one].sum(0)])
            mean = [s[1] / s[0] if s[0] else np.finfo(float).max for s in two]
            lefts.append(two[[int(mean[1] < mean[0])]])
            totals.append(np.broadcast_to(lefts[-1] + two[[int(mean[1] >= mean[0])]], lefts[-1].shape))
            of.append((f, 0, int(mean[1] < mean[0])))
        elif n := len(bins.thresholds[f]):
            running = np.cumsum(stats[column][: n + 1], axis=0)
            lefts.append(running[:-1])
            totals.append(np.broadcast_to(running[-1:], running[:-1].shape))
            of += [(f, k, 0) for k in range(n)]
    if not of:
        return None
    left, total = np.concatenate(lefts), np.concatenate(totals)
    right = total - left
    whole = left[0] + right[0] if parent is None else parent
    n = left[:, 0] + right[:, 0]
    share = np.where(n == 0, 1.0, n)
    gain = _impurity(whole) - left[:, 0] / share * _impurity(left) - right[:, 0] / share * _impurity(right)
    gain[(left[:, 3] < least) | (right[:, 3] < least) | (gain < least_gain)] = -np.inf
    best = int(np.argmax(gain))
    if not gain[best] > 0:
        return None
    f, k, swapped = of[best]
    pair = (right[best], left[best]) if swapped else (left[best], right[best])
    return gain[best], f, k, *pair


class Growing:
    """One tree while it grows: its splits so far and the sums of the nodes of its last level."""

    def __init__(self) -> None:
        self.tree = Tree()
        self.sums: list[np.ndarray | None] = [None]  # by node; the root's come with its first histogram
        self.open = [True]

    def grow(self, stats: np.ndarray, bins: Bins, features: Sequence[int], columns: Sequence[int], least: int, least_gain: float) -> None:
        """Splits the nodes of the last level: ``stats`` by column, node and bin."""
        n = len(self.open)
        column, shift, mask, above = np.zeros(n, np.intp), np.zeros(n, np.uint8), np.zeros(n, np.uint8), np.full(n, 255, np.uint8)
        sums, open_ = [], []
        for i in range(n):
            found = best_split(stats[:, i], bins, features, self.sums[i], least, least_gain) if self.open[i] else None
            if found is None:
                own = stats[columns[0], i].sum(0) if self.sums[i] is None else self.sums[i]
                sums += [own, own]
                open_ += [False, False]
            else:
                _, f, above[i], left, right = found
                column[i], shift[i], mask[i] = bins.places[f]
                sums += [left, right]
                open_ += [abs(float(_impurity(s))) >= EPSILON for s in (left, right)]
        for kept, now in zip((self.tree.column, self.tree.shift, self.tree.mask, self.tree.above), (column, shift, mask, above)):
            kept.append(now)
        self.sums, self.open = sums, open_

    def done(self) -> Tree:
        self.tree.leaves = np.array([s[1] / s[0] if s[0] else 0.0 for s in self.sums])
        return self.tree


def _moved(block: Block, trees: Sequence[Tree], weight: float) -> Block:
    steps = np.array([weight * tree.leaves[tree.node(block.bins)] for tree in trees])
    return Block(block.bins, block.y, block.w, block.bags, steps if block.margins is None else block.margins + steps)


def fit_together(estimator: GBTClassifier, train: DataFrame, features: Sequence[Sequence[int] | None]) -> list[Boosted]:
    """One model per list of places in the feature vector (None: all), all fitted in the same passes over ``train``."""
    depth, least, least_gain = estimator.getMaxDepth(), estimator.getMinInstancesPerNode(), estimator.getMinInfoGain()
    bins = find_bins(estimator, train)
    features = [range(len(bins.places)) if own is None else own for own in features]
    # A sample that came out larger than expected gives a threshold more.
    stride = max([estimator.getMaxBins(), *(len(cuts) + 1 for cuts in bins.thresholds if cuts is not None)])
    uses = [sorted({bins.places[f][0] for f in own}) for own in features]
    blocks = _blocks(estimator, train, bins).persist(StorageLevel.MEMORY_AND_DISK)
    direct, before = blocks.getNumPartitions() <= DIRECT, None
    forests: list[list[Tree]] = [[] for _ in features]
    weights = [1.0] + [estimator.getStepSize()] * (estimator.getMaxIter() - 1)
    try:
        for m in range(estimator.getMaxIter()):
            growing = [Growing() for _ in features]
            for _ in range(depth):
                if not any(any(g.open) for g in growing):
                    break
                trees = [g.tree for g in growing]
                parts = blocks.mapPartitions(lambda b, m=m, trees=trees: [h for h in [histograms(b, m, trees, uses, stride)] if h is not None])
                stats = parts.reduce(np.add) if direct else parts.treeReduce(np.add)
                for v, g in enumerate(growing):
                    g.grow(stats[v], bins, features[v], uses[v], least, least_gain)
                if before is not None:
                    before = before.unpersist() and None
            trees = [g.done() for g in growing]
            for forest, tree in zip(forests, trees):
                forest.append(tree)
            before, blocks = blocks, blocks.map(lambda b, trees=trees, weight=weights[m]: _moved(b, trees, weight)).persist(StorageLevel.MEMORY_AND_DISK)
    finally:
        for kept in (before, blocks):
            if kept is not None:
                kept.unpersist()
    return [Boosted(bins, forest, weights) for forest in forests]


def scores_together(models: Sequence[Boosted], df: DataFrame, keep: Sequence[str], names: Sequence[str] = ("score",), features: str = "features") -> DataFrame:
    """``keep`` and the score of each model as a column."""
    rows = df.select(*keep, vector_to_array(features).alias("_x"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(models[0].bins.places))
            bins = {}  # models fitted together share theirs
            scores = [model.score(bins[id(model.bins)] if id(model.bins) in bins else bins.setdefault(id(model.bins), model.bins.of(x))) for model in models]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in keep], *map(pa.array, scores)], [*keep, *names])

    kinds = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in keep)
    return rows.mapInArrow(scored, ", ".join(filter(None, [kinds, *[f"`{n}` double" for n in names]])))
