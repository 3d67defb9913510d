"""Fitting of boosted regression trees on rows packed into blocks of bytes.

The trees are those of Spark ML's GBTRegressor with squared loss: the same row samples,
feature samples, split rules and weights, and the result is a GBTRegressionModel. Only
the way to them differs. Spark ML holds each row as objects (a few hundred bytes) and
visits them one by one at each level of each tree. Here thousands of rows are one cached
value, a byte for each feature, and a level is counted by arrays. Small tables are left
to Spark ML.

A level counts rows and label sums by (node, feature, value) in each task. The driver gets
the counts of all tasks, or their total from Catalyst if they are large together, so what
it holds does not depend on the number of rows. Only the smaller child of a split is counted, the other one is the difference.
Labels are rounded to whole multiples of a power of two that is so small that sums stay
exact: results depend neither on the order of tasks nor on how rows lie in blocks.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, cloudpickle
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.errors import ContractError, ParameterError
from hourgrid.session import shuffle_partitions

# Values of a feature are whole numbers below this.
BINS = 128
# Rows of a block, and rounds whose samples one word holds.
BLOCK_ROWS = 1 << 14
WORD_ROUNDS = 62
# Sums of rounded labels are below this, where doubles are exact.
EXACT = 52
# Counts of all tasks are added up by the driver up to this many cells.
COLLECTED = 1 << 21
# With fewer rows Spark ML's own fit is faster, as a level here costs a job with Python.
SMALL_ROWS = 1 << 20
# A gain below this share of a node's squared sum is rounding.
ROUNDING = 1e-13

# Workers get the functions below by value, so they need not find this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = "n int, x binary, y binary, sampled binary"
HISTOGRAM = "key int, n long, s double"


@dataclass
class Tree:
    """Nodes of a growing tree, the root first. Nodes without a split point to themselves.

    follows gives the next node for each value of the node's feature.
    """

    rows: list[float] = field(default_factory=list)
    sums: list[float] = field(default_factory=list)
    feature: list[int] = field(default_factory=list)
    left: list[np.ndarray | None] = field(default_factory=list)
    bound: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    children: list[tuple[int, int] | None] = field(default_factory=list)

    def add(self, rows: float, total: float) -> int:
        self.rows.append(rows)
        self.sums.append(total)
        self.feature.append(0)
        self.left.append(None)
        self.bound.append(math.nan)
        self.gain.append(0.0)
        self.children.append(None)
        return len(self.rows) - 1

    def routes(self) -> tuple[np.ndarray, np.ndarray]:
        """Feature of each node, and the node that follows for each of its values."""
        follows = np.repeat(np.arange(len(self.rows)), BINS).reshape(-1, BINS)
        for node, left in enumerate(self.left):
            if left is not None:
                follows[node] = np.where(left, *self.children[node])
        return np.array(self.feature), follows.ravel()


def feature_kinds(rows: DataFrame, column: str) -> list[int]:
    """Number of values of each nominal feature of a vector column, 0 for ordered ones."""
    described = rows.schema[column].metadata.get("ml_attr", {})
    kinds = [0] * described["num_attrs"]
    for kind, found in described["attrs"].items():
        for one in found:
            if kind == "nominal":
                kinds[one["idx"]] = one.get("num_vals") or len(one["vals"])
            elif kind == "binary":
                kinds[one["idx"]] = 2
    if max(kinds) > BINS:
        raise ParameterError(f"a nominal feature has more than {BINS} values")
    return kinds


def samples(rounds: int, rate: float, seed: int) -> list[Column]:
    """Words whose bits say in which rounds a row is sampled.

    Numbers are drawn as Spark ML draws them: a generator for each round and partition.
    """
    words = []
    for first in range(0, rounds, WORD_ROUNDS):
        word = F.lit(0).cast("long")
        for k in range(first, min(first + WORD_ROUNDS, rounds)):
            taken = F.lit(True) if rate >= 1 else F.rand(seed + k + 1) < rate
            word = word + F.when(taken, F.lit(1 << (k - first)).cast("long")).otherwise(0)
        words.append(word)
    return words


def planned_anew(held: DataFrame) -> DataFrame:
    """The rows of a persisted frame as a leaf of a plan.

    Each tree's blocks come from those of the tree before; without this, plans grow with
    the trees and planning soon takes longer than counting. The lineage stays whole, so
    lost blocks are made again.
    """
    spark, java = held.sparkSession, held._jdf
    rows = java.queryExecution().toRdd()
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(rows, java.schema(), False), spark)


def _packer(features: int, words: int):
    def block(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        values = np.concatenate([p[0] for p in parts])
        x = values.astype(np.uint8)
        if not np.array_equal(x, values) or (x >= BINS).any():
            raise ValueError(f"features are not whole numbers from 0 to {BINS - 1}")
        y = np.concatenate([p[1] for p in parts])
        if not np.isfinite(y).all():
            raise ValueError("a label is missing or not finite")
        sampled = np.concatenate([p[2] for p in parts], axis=1)
        return pa.record_batch(
            [
                pa.array([len(y)], pa.int32()),
                pa.array([np.ascontiguousarray(x.T).tobytes()], pa.binary()),
                pa.array([y.tobytes()], pa.binary()),
                pa.array([sampled.tobytes()], pa.binary()),
            ],
            names=["n", "x", "y", "sampled"],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, features)
            y = batch["label"].to_numpy(zero_copy_only=False).astype(float)
            drawn = [batch[f"word_{k}"].to_numpy(zero_copy_only=False) for k in range(words)]
            parts.append((x, y, np.stack(drawn)))
            held += len(y)
            if held >= BLOCK_ROWS:
                yield block(parts)
                parts, held = [], 0
        if parts:
            yield block(parts)

    return pack


def _blocks(batches: Iterator[pa.RecordBatch], features: int):
    """Each block as arrays: values by feature, labels, words by sample."""
    for batch in batches:
        for k in range(batch.num_rows):
            n = batch["n"][k].as_py()
            x = np.frombuffer(batch["x"][k].as_buffer(), np.uint8).reshape(features, n)
            y = np.frombuffer(batch["y"][k].as_buffer(), np.float64)
            words = np.frombuffer(batch["sampled"][k].as_buffer(), np.int64).reshape(-1, n)
            yield x, y, words


def _counted(features: int):
    """Rows of each value of each feature, the number of rows and the largest label."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows, largest = np.zeros((features, BINS), np.int64), 0, 0.0
        for x, y, _ in _blocks(batches, features):
            for f in range(features):
                seen[f] += np.bincount(x[f], minlength=BINS)
            rows, largest = rows + len(y), max(largest, float(np.abs(y).max()))
        keys = np.flatnonzero(seen)
        yield pa.record_batch(
            [
                pa.array([-1, *keys.tolist()], pa.int32()),
                pa.array([rows, *seen.ravel()[keys].tolist()], pa.int64()),
                pa.array([largest] + [0.0] * len(keys), pa.float64()),
            ],
            names=["key", "n", "s"],
        )

    return count


def _nodes(x: np.ndarray, feature: np.ndarray, follows: np.ndarray, depth: int) -> np.ndarray:
    """The node that each row of a block has reached after so many splits."""
    n = x.shape[1]
    flat, place, start = x.ravel(), np.arange(n), feature * n
    node = np.zeros(n, np.int64)
    for _ in range(depth):
        node = follows[node * BINS + flat[start[node] + place]]
    return node


def _histogram(features, live, routes, depth, slots, k, scale):
    """Rows and rounded label sums by slot, live feature and value, of the rows of round k.

    slots gives the slot of each node, or -1 for nodes that are not counted.
    """
    word, bit, cells = k // WORD_ROUNDS, k % WORD_ROUNDS, (int(slots.max()) + 1) * BINS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros((len(live), cells), np.int64), np.zeros((len(live), cells))
        for x, y, words in _blocks(batches, features):
            slot = slots[_nodes(x, *routes, depth)]
            rows = np.flatnonzero(((words[word] >> bit) & 1).astype(bool) & (slot >= 0))
            base, q = slot[rows] * BINS, np.rint(y[rows] * scale)
            for at, f in enumerate(live):
                cell = base + x[f][rows]
                n[at] += np.bincount(cell, minlength=cells)
                s[at] += np.bincount(cell, q, minlength=cells)
        keys = np.flatnonzero(n)
        yield pa.record_batch(
            [
                pa.array(keys.astype(np.int32)),
                pa.array(n.ravel()[keys]),
                pa.array(s.ravel()[keys]),
            ],
            names=["key", "n", "s"],
        )

    return count


def _without(features, routes, depth, taken):
    """Blocks whose labels are what a tree leaves of them; taken has a value for each node."""

    def lessen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = [
                (y - taken[_nodes(x, *routes, depth)]).tobytes()
                for x, y, _ in _blocks([batch], features)
            ]
            yield batch.set_column(2, "y", pa.array(y, pa.binary()))

    return lessen


def split_gains(n, s, nominal):
    """Every split of a node: the order of values, rows and sums to the left, and the gains.

    n and s are rows and label sums by feature and value. A split is a place in a feature's
    order of values; those of nominal features are ordered by their mean.
    """
    rows, total = n[0].sum(), s[0].sum()
    order = np.tile(np.arange(BINS), (len(n), 1))
    means = np.divide(s, n, out=np.full(n.shape, np.inf), where=n > 0)
    order[nominal] = np.argsort(means[nominal], axis=1, kind="stable")
    left_n = np.cumsum(np.take_along_axis(n, order, 1), axis=1)[:, :-1]
    left_s = np.cumsum(np.take_along_axis(s, order, 1), axis=1)[:, :-1]
    right_n, right_s = rows - left_n, total - left_s
    squares = left_s**2 / np.maximum(left_n, 1) + right_s**2 / np.maximum(right_n, 1)
    gains = (squares - total**2 / rows) / rows
    gains[gains <= ROUNDING * (total / rows) ** 2] = 0.0
    return order, left_n, left_s, gains


class Numbers:
    """Spark's generators, so that features are sampled as Spark ML samples them."""

    def __init__(self, seed: int):
        jvm = SparkContext._active_spark_context._jvm
        self.generator = jvm.org.apache.spark.util.random.XORShiftRandom
        self.random = jvm.java.util.Random(seed)

    def features(self, count: int, all_features: int) -> list[int]:
        """A reservoir sample of the features, for the next node."""
        kept = list(range(count))
        if count < all_features:
            draw = self.generator(self.random.nextLong())
            for f in range(count, all_features):
                place = int(draw.nextDouble() * (f + 1))
                if place < count:
                    kept[place] = f
        return kept


@dataclass
class Boosting:
    """What GBTRegressor(lossType="squared", ...) with these settings fits, see above.

    Features are whole numbers from 0 to BINS - 1. Every value of an ordered feature may
    be a bound; Spark ML looks for values in a sample of the rows.
    """

    rounds: int
    max_depth: int
    step_size: float
    min_rows_per_leaf: int
    row_rate: float
    feature_rate: float
    seed: int
    features: str = "features"
    label: str = "label"
    prediction: str = "prediction_raw"

    def fit(self, rows: DataFrame) -> GBTRegressionModel:
        self.kinds = feature_kinds(rows, self.features)
        words = samples(self.rounds, self.row_rate, self.seed)
        spark = rows.sparkSession
        # Samples follow the partitions of the rows; after that, many small tasks cost more
        # than they bring.
        tasks = max(spark.sparkContext.defaultParallelism, shuffle_partitions(spark) // 8)
        held = [
            rows.select(
                vector_to_array(self.features).alias("x"),
                F.col(self.label).cast("double").alias("label"),
                *[word.alias(f"word_{k}") for k, word in enumerate(words)],
            )
            .mapInArrow(_packer(len(self.kinds), len(words)), BLOCK)
            .coalesce(tasks)
            .persist()
        ]
        trees, weights = [], []
        try:
            blocks = planned_anew(held[-1])
            count, largest = self._look(blocks)
            if count < SMALL_ROWS:
                return self._by_spark(rows)
            for k in range(self.rounds):
                weight = self.step_size if k else 1.0
                # Rounds after the first one fit the gradient, twice what is left.
                factor = 2.0 if k else 1.0
                bits = EXACT - math.ceil(math.log2(count + 1))
                scale = 2.0 ** (bits - math.ceil(math.log2(largest))) if largest else 1.0
                tree, depth = self._grow(blocks, k, scale)
                values = factor / scale * np.array(tree.sums) / np.maximum(tree.rows, 1)
                trees.append((tree, values, factor / scale))
                weights.append(weight)
                # The blocks of this tree have been filled, those before are done with.
                for old in held[:-1]:
                    old.unpersist()
                if k + 1 < self.rounds:
                    taken = weight * values
                    largest += float(np.abs(taken).max())
                    less = _without(len(self.kinds), tree.routes(), depth, taken)
                    held = [held[-1], blocks.mapInArrow(less, BLOCK).persist()]
                    blocks = planned_anew(held[-1])
        finally:
            for old in held:
                old.unpersist()
        return self._model(trees, weights)

    def _by_spark(self, rows: DataFrame) -> GBTRegressionModel:
        return GBTRegressor(
            featuresCol=self.features,
            labelCol=self.label,
            predictionCol=self.prediction,
            lossType="squared",
            maxDepth=self.max_depth,
            stepSize=self.step_size,
            minInstancesPerNode=self.min_rows_per_leaf,
            subsamplingRate=self.row_rate,
            featureSubsetStrategy=str(self.feature_rate),
            maxBins=BINS,
            maxIter=self.rounds,
            seed=self.seed,
            cacheNodeIds=False,
            maxMemoryInMB=512,
        ).fit(rows)

    def _look(self, blocks: DataFrame) -> tuple[int, float]:
        """Which values occur; the number of rows and the largest label in size."""
        found = blocks.mapInArrow(_counted(len(self.kinds)), HISTOGRAM).toArrow()
        key, n, s = (found[name].to_numpy() for name in ("key", "n", "s"))
        self.tasks = int((key < 0).sum())
        self.present = np.zeros((len(self.kinds), BINS), bool)
        self.present.ravel()[key[key >= 0]] = True
        if not n[key < 0].sum():
            raise ContractError("there are no rows to fit")
        # A feature with one value alone splits nothing.
        self.live = np.flatnonzero(self.present.sum(axis=1) > 1)
        return int(n[key < 0].sum()), float(s[key < 0].max())

    def _histograms(self, blocks, tree, depth, counted, k, scale):
        """Rows and sums by feature and value for each of the nodes."""
        slots = np.full(len(tree.rows) or 1, -1)
        slots[counted] = np.arange(len(counted))
        live = self.live if len(self.live) else np.array([0])
        routes = tree.routes() if tree.rows else (np.zeros(1, np.int64), np.zeros(BINS, np.int64))
        shape = (len(live), len(counted), BINS)
        found = blocks.mapInArrow(
            _histogram(len(self.kinds), live, routes, depth, slots, k, scale), HISTOGRAM
        )
        if self.tasks * math.prod(shape) > COLLECTED:
            found = found.groupBy("key").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        found = found.toArrow()
        key = found["key"].to_numpy()
        n, s = (
            np.bincount(key, found[name].to_numpy(), math.prod(shape)).reshape(shape)
            for name in ("n", "s")
        )
        out = []
        for slot in range(len(counted)):
            whole_n, whole_s = np.zeros((2, len(self.kinds), BINS))
            whole_n[live], whole_s[live] = n[:, slot], s[:, slot]
            for f in set(range(len(self.kinds))) - set(live.tolist()):
                one = int(np.argmax(self.present[f]))
                whole_n[f, one], whole_s[f, one] = n[0, slot].sum(), s[0, slot].sum()
            out.append((whole_n, whole_s))
        return out

    def _grow(self, blocks: DataFrame, k: int, scale: float) -> tuple[Tree, int]:
        """The tree of round k in rounded labels, and its depth."""
        tree, numbers = Tree(), Numbers(self.seed + k)
        chosen = math.ceil(self.feature_rate * len(self.kinds))
        [root] = self._histograms(blocks, tree, 0, [0], k, scale)
        level = {tree.add(root[0][0].sum(), root[1][0].sum()): root}
        for depth in range(self.max_depth):
            split = []
            for node, (n, s) in level.items():
                if self._split(tree, node, n, s, chosen, numbers):
                    split.append(node)
            if not split or depth + 1 == self.max_depth:
                return tree, depth + bool(split)
            smaller = {node: min(tree.children[node], key=lambda c: tree.rows[c]) for node in split}
            found = self._histograms(blocks, tree, depth + 1, list(smaller.values()), k, scale)
            below = {}
            for (node, child), (n, s) in zip(smaller.items(), found, strict=True):
                [other] = set(tree.children[node]) - {child}
                below[child], below[other] = (n, s), (level[node][0] - n, level[node][1] - s)
            # Spark ML puts children on a stack.
            level = {c: below[c] for node in reversed(split) for c in reversed(tree.children[node])}
        return tree, 0

    def _split(self, tree, node, n, s, chosen, numbers) -> bool:
        """Split a node by the largest gain of some features, if there is any."""
        if not tree.rows[node]:
            return False
        order, left_n, left_s, gains = split_gains(n, s, np.array(self.kinds) > 0)
        right_n = tree.rows[node] - left_n
        # A node whose labels are all equal takes no numbers.
        if not (gains[(left_n > 0) & (right_n > 0)] > 0).any():
            return False
        some = numbers.features(chosen, len(self.kinds))
        least = self.min_rows_per_leaf
        gains = np.where((left_n >= least) & (right_n >= least), gains, 0.0)[some]
        # Of equal gains the first one counts.
        which, at = np.unravel_index(np.argmax(gains), gains.shape)
        f, at, gain = some[which], int(at), float(gains[which, at])
        if gain <= 0:
            return False
        goes_left = np.zeros(BINS, bool)
        goes_left[order[f, : at + 1]] = True
        tree.gain[node], tree.feature[node], tree.left[node] = gain, f, goes_left
        if not self.kinds[f]:
            following = at + 1 + int(np.argmax(self.present[f, at + 1 :]))
            tree.bound[node] = (at + following) / 2
        rows, total = int(left_n[f, at]), float(left_s[f, at])
        tree.children[node] = (
            tree.add(rows, total),
            tree.add(tree.rows[node] - rows, tree.sums[node] - total),
        )
        return True

    def _model(self, trees, weights) -> GBTRegressionModel:
        """The trees as Spark's model. Impurities of nodes are not known and left out."""
        context = SparkContext._active_spark_context
        jvm, gateway = context._jvm, context._gateway
        # Each name is looked up in the JVM once, as every look costs a call.
        package, ml = jvm.org.apache.spark.ml.regression, jvm.org.apache.spark.ml.tree
        whole, leaf_node, inner_node = package.DecisionTreeRegressionModel, ml.LeafNode, ml.InternalNode
        nominal_split, ordered_split = ml.CategoricalSplit, ml.ContinuousSplit
        variance = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
        slice_of = jvm.java.util.Arrays.copyOfRange
        count = len(self.kinds)
        made = gateway.new_array(whole, len(trees))
        rates = gateway.new_array(jvm.double, len(trees))
        for place, (tree, values, unit) in enumerate(trees):
            # Statistics and values to the left of all nodes are sent in one call.
            parts = []
            for node, left in enumerate(tree.left):
                parts.append([tree.rows[node], unit * tree.sums[node], math.nan])
                parts.append([] if left is None else np.flatnonzero(left))
            held = _py2java(context, DenseVector(np.concatenate(parts))).toArray()
            ends = np.cumsum([0, *map(len, parts)]).tolist()

            def part(k, held=held, ends=ends):
                return slice_of(held, ends[k], ends[k + 1])

            nodes = [None] * len(tree.rows)
            leaf = [children is None for children in tree.children]
            for node in reversed(range(len(tree.rows))):
                value = float(values[node])
                stats = variance(part(2 * node), int(tree.rows[node]))
                if not leaf[node]:
                    low, high = tree.children[node]
                    leaf[node] = leaf[low] and leaf[high] and values[low] == values[high]
                if leaf[node]:
                    nodes[node] = leaf_node(value, math.nan, stats)
                    continue
                f = tree.feature[node]
                if self.kinds[f]:
                    split = nominal_split(f, part(2 * node + 1), self.kinds[f])
                else:
                    split = ordered_split(f, float(tree.bound[node]))
                nodes[node] = inner_node(
                    value, math.nan, tree.gain[node] * unit**2, nodes[low], nodes[high], split, stats
                )
            made[place] = whole(nodes[0], count)
            rates[place] = float(weights[place])
        uid = jvm.org.apache.spark.ml.util.Identifiable.randomUID("gbtr")
        java = package.GBTRegressionModel(uid, made, rates, count)
        model = GBTRegressionModel(java)
        return model.setFeaturesCol(self.features).setPredictionCol(self.prediction)
