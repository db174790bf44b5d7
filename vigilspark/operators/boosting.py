"""Gradient boosting over rows kept as bytes, with Spark ML's parameters and Spark ML's model."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .columns import named

# Rows of a block; a task's memory does not depend on how many blocks it has.
BLOCK_ROWS = 65_536
# Rows of a task's blocks, where there are enough for all cores: a pass over fewer takes less time than to start it.
TASK_ROWS = 2_000_000
# Up to so many rows, or the square of the bins, are looked at for the thresholds, as Spark ML does.
THRESHOLD_ROWS = 10_000
# Variance below this share of the mean square is what rounding leaves of equal values.
ROUNDING = 1e-10
# Gains that differ by less are equal; the first feature and threshold wins.
EQUAL_GAINS = 1e-9

Block = tuple[np.ndarray, np.ndarray, np.ndarray]  # bins by feature and row, label as -1 or 1, margin


@dataclass
class Tree:
    """A tree over bins; children follow their parent. A leaf's feature is -1. ``stats``: rows, sum and sum of squares."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    stats: list[np.ndarray] = field(default_factory=list)

    def add(self, stats: np.ndarray) -> int:
        for values, empty in ((self.feature, -1), (self.bin, 0), (self.left, -1), (self.gain, 0.0), (self.stats, stats)):
            values.append(empty)
        return len(self.feature) - 1

    def value(self, node: int) -> float:
        return float(self.stats[node][1] / self.stats[node][0])

    def impurity(self, node: int) -> float:
        rows, total, squares = self.stats[node]
        return float(max(squares / rows - (total / rows) ** 2, 0.0))

    def is_pure(self, node: int) -> bool:
        rows, _, squares = self.stats[node]
        return self.impurity(node) <= ROUNDING * squares / rows

    def places(self, bins: np.ndarray) -> dict[int, np.ndarray]:
        """The rows that have come to each leaf."""
        at = {0: np.arange(bins.shape[1])}
        for node, feature in enumerate(self.feature):  # children come after their parent
            if feature >= 0:
                rows = at.pop(node)
                below = bins[feature, rows] <= self.bin[node]
                at[self.left[node]], at[self.left[node] + 1] = rows[below], rows[~below]
        return at


def thresholds_of(values: np.ndarray, bins: int) -> np.ndarray:
    """Where a feature may be split: between all its values if they are few, else so that the parts have about equal rows."""
    distinct, counts = np.unique(values, return_counts=True)
    between = (distinct[:-1] + distinct[1:]) / 2
    if len(between) <= bins - 1:
        return between
    stride = len(values) / bins
    cuts, target, seen = [], stride, counts[0]
    for i in range(1, len(distinct)):
        before, seen = seen, seen + counts[i]
        if abs(before - target) < abs(seen - target):
            cuts.append(between[i - 1])
            target += stride
    return np.array(cuts)


def blocks(rows: DataFrame, thresholds: list[np.ndarray]) -> RDD:
    """The rows' bins, a byte a feature, with label and a margin of 0; ``rows`` has ``y`` and the array ``x``."""
    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.uint8 if max((len(t) for t in thresholds), default=0) < 256 else np.uint16
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def block() -> pa.RecordBatch:
            x, y = (np.concatenate(parts, axis=-1) for parts in zip(*held))
            held.clear()
            return pa.RecordBatch.from_pydict({"bins": [np.ascontiguousarray(x).tobytes()], "labels": [y.tobytes()], "wide": [kind is np.uint16]})

        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(thresholds))
            y = batch.column("y").to_numpy(zero_copy_only=False)
            held.append((np.stack([np.searchsorted(t, x[:, i]) for i, t in enumerate(thresholds)]).astype(kind), (2 * y - 1).astype(np.int8)))
            if sum(len(y) for _, y in held) >= BLOCK_ROWS:
                yield block()
        if held:
            yield block()

    def arrays(row: Any) -> Block:
        labels = np.frombuffer(row.labels, dtype=np.int8)
        bins = np.frombuffer(row.bins, dtype=np.uint16 if row.wide else np.uint8).reshape(len(thresholds), len(labels))
        return bins, labels, np.zeros(len(labels))

    return rows.mapInArrow(binned, "bins binary, labels binary, wide boolean").rdd.map(arrays)


def targets(labels: np.ndarray, margin: np.ndarray, first: bool) -> np.ndarray:
    """What a tree is fitted to: the labels, later the negative gradients of the log loss."""
    if first:
        return labels.astype(np.float64)
    with np.errstate(over="ignore"):  # an infinite exponential is a gradient of 0
        return 4.0 * labels / (1.0 + np.exp(2.0 * labels * margin))


def sums(parts: Iterable[Block], tree: Tree, level: list[int], bins: int, first: bool) -> np.ndarray | None:
    """Rows, sum and sum of squares of the targets by feature, node of the level and bin."""
    out = None
    for x, labels, margin in parts:
        if out is None:
            out = np.zeros((3, len(x), len(level) * bins))
        target, base = targets(labels, margin, first), np.zeros(len(labels), dtype=np.int64)
        if level != [0]:
            places = tree.places(x)
            kept = np.concatenate([places[n] for n in level])
            x, target = x[:, kept], target[kept]
            base = np.repeat(np.arange(len(level)) * bins, [len(places[n]) for n in level])
        squares = target * target
        for f, values in enumerate(x):
            key = base + values
            for k, weights in enumerate((None, target, squares)):
                out[k, f] += np.bincount(key, weights, len(level) * bins)
    return out


def _split(tree: Tree, node: int, found: np.ndarray, cuts: list[int], least: int, least_gain: float) -> tuple[int, ...]:
    """Give the node the split with the highest gain in variance, if there is one. Returns the new nodes."""
    below = found.cumsum(axis=2)
    whole = below[:, :1, -1:]
    left, right = below[:, :, :-1], whole - below[:, :, :-1]
    possible = (np.arange(left.shape[2]) < np.array(cuts)[:, None]) & (left[0] >= least) & (right[0] >= least)
    if not possible.any():
        return ()
    with np.errstate(divide="ignore", invalid="ignore"):
        gains = left[0] * right[0] / whole[0] ** 2 * (left[1] / left[0] - right[1] / right[0]) ** 2
    gains = np.where(possible, gains, -1.0)
    best = int(np.argmax(gains >= gains.max() * (1 - EQUAL_GAINS)))
    feature, cut = divmod(best, gains.shape[1])
    gain = float(gains[feature, cut])
    if gain <= 0 or gain < least_gain:
        return ()
    tree.feature[node], tree.bin[node], tree.gain[node] = feature, cut, gain
    tree.left[node] = tree.add(left[:, feature, cut])
    return tree.left[node], tree.add(right[:, feature, cut])


def grow(state: RDD, cuts: list[int], depth: int, least: int, least_gain: float, first: bool) -> Tree:
    """One tree over all rows, a pass for each level that has nodes to split. The driver gets sums, not rows."""
    bins, tree, level = max(cuts, default=0) + 1, Tree(), [0]
    tree.add(np.zeros(3))
    rounds = 1 if state.getNumPartitions() <= 64 else 2
    for _ in range(depth):
        def summed(parts: Iterator[Block], tree: Tree = tree, level: list[int] = level) -> list[np.ndarray]:
            out = sums(parts, tree, level, bins, first)
            return [] if out is None else [out]

        found = state.mapPartitions(summed).treeReduce(np.add, rounds).reshape(3, len(cuts), len(level), bins)
        if level == [0]:
            tree.stats[0] = found[:, 0, 0].sum(axis=1)
        split, level = level, []
        for place, node in enumerate(split):
            if not tree.is_pure(node):
                level += [n for n in _split(tree, node, found[:, :, place], cuts, least, least_gain) if not tree.is_pure(n)]
        if not level:
            break
    return tree


def moved(state: RDD, tree: Tree, weight: float) -> RDD:
    """The blocks with the tree's values added to their margins."""
    def add(block: Block) -> Block:
        x, labels, margin = block
        margin = margin.copy()
        for node, rows in tree.places(x).items():
            margin[rows] += weight * tree.value(node)
        return x, labels, margin

    return state.map(add)


def forget(state: RDD) -> None:
    """Free the blocks, and their checkpoint if they have one."""
    state.unpersist()
    if file := state.getCheckpointFile():
        path = state.ctx._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(state.ctx._jsc.hadoopConfiguration()).delete(path, True)


def model_tree(spark: SparkSession, tree: Tree, thresholds: list[np.ndarray]) -> Any:
    """The root of the tree as Spark ML has it."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    ml, kinds = jvm.org.apache.spark.ml.tree, jvm.org.apache.spark.mllib.tree.impurity
    made: dict[int, Any] = {}
    for node in reversed(range(len(tree.feature))):  # children come after their parent
        numbers = gateway.new_array(gateway.jvm.double, 3)
        for i, v in enumerate(tree.stats[node]):
            numbers[i] = float(v)
        stats = kinds.VarianceCalculator(numbers, int(tree.stats[node][0]))
        if tree.feature[node] < 0:
            made[node] = ml.LeafNode(tree.value(node), tree.impurity(node), stats)
            continue
        left, split = tree.left[node], ml.ContinuousSplit(tree.feature[node], float(thresholds[tree.feature[node]][tree.bin[node]]))
        made[node] = ml.InternalNode(
            tree.value(node), tree.impurity(node), tree.gain[node], made[left], made[left + 1], split, stats)
    return made[0]


class BlockGBTClassifier(GBTClassifier):
    """``GBTClassifier`` whose rows stay in memory as a byte a feature, with label and margin, instead of objects.

    Loss, rounds, candidate thresholds and choice of splits are those of Spark ML, and so is the model. Every round reads all
    rows, once for each level of its tree; nodes whose targets are equal but for rounding are not split. Input and settings
    that this class does not know, such as weights or subsamples, are left to Spark ML.
    """

    def _known_settings(self) -> bool:
        return (self.getSubsamplingRate() == 1.0 and self.getFeatureSubsetStrategy() == "all" and self.getLossType() == "logistic"
                and self.getMinWeightFractionPerNode() == 0.0 and self.getMaxDepth() > 0 and self.getMaxBins() <= 65_536
                and not any(self.isSet(p) for p in ("weightCol", "validationIndicatorCol")))

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        kinds = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
        if not self._known_settings() or {"nominal", "binary"} & kinds.keys():
            return super()._fit(dataset)
        rows = dataset.select(named(self.getLabelCol()).cast("double").alias("y"), vector_to_array(named(self.getFeaturesCol())).alias("x"))
        odd = ~F.coalesce(F.col("y").isin(0.0, 1.0) & ~F.exists("x", F.isnan), F.lit(False))
        facts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(odd).alias("odd"), F.min(F.size("x")).alias("least"),
                         F.max(F.size("x")).alias("features")).first()
        if not facts.n or facts.odd or facts.least != facts.features:
            return super()._fit(dataset)  # which also says what is wrong with the rows
        spark, n, most = dataset.sparkSession, facts.n, max(self.getMaxBins() ** 2, THRESHOLD_ROWS)
        some = rows.select("x") if n <= most else rows.select("x").sample(most / n, self.getSeed())
        seen = np.array([r.x for r in some.collect()]).reshape(-1, facts.features)  # as many rows as Spark ML takes
        thresholds = [thresholds_of(seen[:, i], min(self.getMaxBins(), n)) for i in range(facts.features)]
        cuts = [len(t) for t in thresholds]
        trees: list[Tree] = []
        cores = spark.sparkContext.defaultParallelism
        tasks = cores * -(-n // (cores * TASK_ROWS))
        held = state = blocks(rows, thresholds).coalesce(tasks).persist(StorageLevel.MEMORY_AND_DISK)
        keeps = self.getCheckpointInterval() > 0 and spark.sparkContext.getCheckpointDir() is not None
        last = None
        try:
            for turn in range(self.getMaxIter()):
                # The first pass also makes the blocks with the margins of the last round.
                trees.append(grow(state, cuts, self.getMaxDepth(), self.getMinInstancesPerNode(), self.getMinInfoGain(), turn == 0))
                if last is not None:
                    last.unpersist()
                if state.isCheckpointed():  # what came before is no longer needed to make lost blocks anew
                    forget(held)
                    held = state
                last, state = state, moved(state, trees[-1], self._weight(turn)).persist(StorageLevel.MEMORY_AND_DISK)
                if keeps and (turn + 1) % self.getCheckpointInterval() == 0:
                    state.checkpoint()
        finally:
            for one in (held, last, state):
                if one is not None:
                    forget(one)
        return self._copyValues(self._create_model(self._assembled(spark, trees, thresholds)))

    def _weight(self, turn: int) -> float:
        return self.getStepSize() if turn else 1.0

    def _assembled(self, spark: SparkSession, trees: list[Tree], thresholds: list[np.ndarray]) -> Any:
        gateway, ml = spark.sparkContext._gateway, spark.sparkContext._jvm.org.apache.spark.ml
        made = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
        weights = gateway.new_array(gateway.jvm.double, len(trees))
        for i, tree in enumerate(trees):
            made[i] = ml.regression.DecisionTreeRegressionModel(f"{self.uid}_tree{i}", model_tree(spark, tree, thresholds), len(thresholds))
            weights[i] = self._weight(i)
        return ml.classification.GBTClassificationModel(self.uid, made, weights, len(thresholds))
