"""Spark's gradient-boosted trees from a table of equal rows.

The trees see bins alone, and all rows of the same bins and label have the same residual in every round. So a table is merged to its
different bins with the numbers of rows of either label, once, and all trees are grown from that by one task: a fit takes as long as there are
different bins, not rows, and starts a few jobs instead of some three a tree. Splits, gains, leaves and pruning are those
of ``GBTClassifier``, and so is the model; tables of more than ``MOST_CELLS`` different bins go through Spark's own fit.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatlane.session import durable

#: Most different bins that one task grows trees from.
MOST_CELLS = 1 << 20
#: Least number of rows from which Spark draws the thresholds.
_SAMPLE = 10_000
_EPSILON = 2.0**-52
_NODES = "tree int, node int, feature int, bin int, left int, right int, prediction double, impurity double, gain double, n long, s double, ss double"


def thresholds(values: np.ndarray, expected: float, most: int) -> np.ndarray:
    """Where the splits of a feature can lie, as Spark chooses them from a sample that was expected to have ``expected`` rows."""
    found, counts = np.unique(values[values != 0], return_counts=True)
    if not len(found):
        return found
    zeros = expected - counts.sum()
    if zeros > _EPSILON * expected * 100:
        at = int(np.searchsorted(found, 0.0))
        found, counts = np.insert(found, at, 0.0), np.insert(counts.astype(float), at, zeros)
    middle = (found[:-1] + found[1:]) / 2
    if len(middle) <= most:
        return middle
    stride = expected / (most + 1)
    seen, target, chosen = np.cumsum(counts).tolist(), stride, []
    for i in range(1, len(found)):
        if abs(seen[i - 1] - target) < abs(seen[i] - target):
            chosen.append(middle[i - 1])
            target += stride
    return np.array(chosen)


class _Listed:
    """Different bins one by one, with their rows of either class, their scores and their node; the root is 1, a node's children are 2 i and 2 i + 1."""

    def __init__(self, bins: np.ndarray, n0: np.ndarray, n1: np.ndarray, widths: list[int]):
        self.columns, self.widths, self.n0, self.n1 = [np.ascontiguousarray(c).astype(np.intp) for c in bins.T], widths, n0, n1
        self.score = np.zeros(n0.shape)

    def start(self) -> None:
        self.place = np.ones(len(self.n0), dtype=np.intp)

    def sums(self, stats: np.ndarray, active: list[int], level: int) -> list[np.ndarray]:
        """Per feature the (statistic, node, bin) sums; those of other nodes are counted beside and left out."""
        of = np.full(1 << (level + 1), len(active), dtype=np.intp)
        of[active] = np.arange(len(active))
        slots, n = of[self.place], len(active) + 1
        made = []
        for column, w in zip(self.columns, self.widths, strict=True):
            key = slots * w + column
            made.append(np.stack([np.bincount(key, x, n * w).reshape(n, w)[:-1] for x in stats]))
        return made

    def split(self, node: int, f: int, at: int) -> None:
        here = np.flatnonzero(self.place == node)
        self.place[here] = 2 * node + (self.columns[f][here] > at)

    def add(self, value: np.ndarray) -> None:
        self.score += value[self.place]


class _Grid(_Listed):
    """The same where most bins that can be are there: one array with a dimension per feature, of which a node is a box."""

    def __init__(self, bins: np.ndarray, n0: np.ndarray, n1: np.ndarray, widths: list[int]):
        self.widths, self.score = widths, np.zeros(widths)
        self.n0, self.n1 = np.zeros(widths), np.zeros(widths)
        self.n0[tuple(bins.T)], self.n1[tuple(bins.T)] = n0, n1

    def start(self) -> None:
        self.boxes = {1: tuple(slice(0, w) for w in self.widths)}

    def sums(self, stats: np.ndarray, active: list[int], level: int) -> list[np.ndarray]:
        made = [np.zeros((len(stats), len(active), w)) for w in self.widths]
        for k, node in enumerate(active):
            inside = stats[(slice(None), *self.boxes[node])]
            for f, out in enumerate(made):
                out[:, k, self.boxes[node][f]] = inside.sum(axis=tuple(i + 1 for i in range(len(made)) if i != f))
        return made

    def split(self, node: int, f: int, at: int) -> None:
        box = self.boxes.pop(node)
        for child, part in ((2 * node, slice(box[f].start, at + 1)), (2 * node + 1, slice(at + 1, box[f].stop))):
            self.boxes[child] = (*box[:f], part, *box[f + 1 :])

    def add(self, value: np.ndarray) -> None:
        for node, box in self.boxes.items():
            self.score[box] += value[node]


def grown(bins: np.ndarray, n0: np.ndarray, n1: np.ndarray, widths: list[int], depth: int, rounds: int, step: float, least: int, least_gain: float):
    """Rows (tree, node, feature, bin, left, right, prediction, impurity, gain, n, s, ss) of the trees over different ``bins`` with ``n0`` rows of
    class 0 and ``n1`` of class 1."""
    table = (_Grid if math.prod(widths) <= max(4 * len(bins), 1 << 12) else _Listed)(bins, n0, n1, widths)
    n0, n1 = table.n0, table.n1
    counts = (n0 + n1).astype(float)
    for tree in range(rounds):
        stats = np.stack([counts, n1 - n0, counts])
        if tree:
            with np.errstate(over="ignore"):
                up, down = 4 / (1 + np.exp(2 * table.score)), -4 / (1 + np.exp(-2 * table.score))
            stats = np.stack([counts, n1 * up + n0 * down, n1 * up * up + n0 * down * down])
        sums = [float(x.sum()) for x in stats]
        nodes, splits, active = {1: [*sums, _variance(*sums)]}, {}, [1]
        table.start()
        for level in range(depth):
            if not active:
                break
            best = _best([nodes[n][3] for n in active], table.sums(stats, active, level), least, least_gain)
            following = []
            for node, (gain, f, at, *sides) in zip(active, best, strict=True):
                if gain == -np.inf:
                    nodes[node][3] = -1.0  # as Spark marks leaves without a valid split
                if gain <= 0:
                    continue
                splits[node] = (gain, f, at)
                for c, side in enumerate(sides):
                    nodes[2 * node + c] = [*side, _variance(*side)]
                    if level + 1 < depth and not abs(nodes[2 * node + c][3]) < _EPSILON:
                        following.append(2 * node + c)
                table.split(node, f, at)
            active = following
        value = np.zeros(1 << (depth + 1))
        for node, (n, s, *_) in nodes.items():
            value[node] = s / n if n else 0.0
        table.add(value * (step if tree else 1.0))
        _prune(splits, value, 1)
        kept = [1]
        for node in kept:  # grows while it is read
            n, s, ss, impurity = nodes[node]
            if node in splits:
                gain, f, at = splits[node]
                kept += [2 * node, 2 * node + 1]
                yield tree, node, f, at, 2 * node, 2 * node + 1, float(value[node]), impurity, gain, int(n), s, ss
            else:
                yield tree, node, None, None, None, None, float(value[node]), impurity, None, int(n), s, ss


def _best(impurities: list[float], sums: list[np.ndarray], least: int, least_gain: float) -> list[list]:
    """[gain, feature, bin, sums on the left, sums on the right] of each node's best split; the first of equal gains."""
    best, impurity = [[-np.inf, 0, 0] for _ in impurities], np.array(impurities)[:, None]
    for f, found in enumerate(sums):
        if found.shape[2] < 2:
            continue
        left = found.cumsum(axis=2)
        left, right = left[:, :, :-1], left[:, :, -1:] - left[:, :, :-1]
        total = left[0] + right[0]
        gain = impurity - left[0] / total * _variances(left) - right[0] / total * _variances(right)
        gain = np.where((left[0] >= least) & (right[0] >= least) & (gain >= least_gain), gain, -np.inf)
        for k, at in enumerate(gain.argmax(axis=1).tolist()):
            if gain[k, at] > best[k][0]:
                best[k] = [float(gain[k, at]), f, at, left[:, k, at].tolist(), right[:, k, at].tolist()]
    return best


def _variance(n: float, s: float, ss: float) -> float:
    return (ss - s * s / n) / n if n else 0.0


def _variances(sums: np.ndarray) -> np.ndarray:
    n, s, ss = sums
    m = np.where(n == 0, 1, n)
    return np.where(n == 0, 0.0, (ss - s * s / m) / m)


def _prune(splits: dict, value: np.ndarray, node: int) -> bool:
    """Takes out splits of two leaves of equal predictions; whether ``node`` is a leaf then."""
    if node not in splits:
        return True
    leaves = [_prune(splits, value, c) for c in (2 * node, 2 * node + 1)]
    if all(leaves) and value[2 * node] == value[2 * node + 1]:
        value[node] = value[2 * node]
        del splits[node]
        return True
    return False


class MergedGBTClassifier(GBTClassifier):
    """``GBTClassifier``, fitted from merged rows where that gives the same trees: all rows and columns in each tree, no weights, no validation rows."""

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        fitted = self._merged(dataset) if self._plain() else None
        return super()._fit(dataset) if fitted is None else fitted

    def _plain(self) -> bool:
        given = [p for p in ("weightCol", "validationIndicatorCol", "thresholds") if self.isDefined(p)]
        columns = self.getFeatureSubsetStrategy() in ("all", "auto")
        return not given and columns and self.getSubsamplingRate() >= 1 and self.getMinWeightFractionPerNode() == 0 and self.getLossType() == "logistic"

    def _merged(self, dataset: DataFrame) -> GBTClassificationModel | None:
        """The model, or none if rows are not fit for it or too many of them differ."""
        rows = dataset.select(F.col(self.getLabelCol()).cast("double").alias("y"), vector_to_array(self.getFeaturesCol()).alias("x"))
        wrong = F.col("y").isNull() | ~F.col("y").isin(0.0, 1.0) | F.col("x").isNull() | F.exists("x", lambda v: F.isnan(v) | (F.abs(v) == float("inf")))
        seen = rows.agg(F.count(F.lit(1)), F.count(F.when(F.coalesce(wrong, F.lit(True)), 1)), F.min(F.size("x")), F.max(F.size("x"))).first()
        n, bad, size, widest = seen
        if not n or bad or size != widest or not size:
            return None
        cuts = self._cuts(rows, n, size)
        widths = [len(c) + 1 for c in cuts]
        if math.prod(widths) >= 1 << 62:
            return None
        cells = self._cells(rows, cuts, widths)
        if cells.count() > MOST_CELLS:
            return None
        found = self._nodes(cells, widths)
        return self._model(dataset, found, cuts, size)

    def _cuts(self, rows: DataFrame, n: int, size: int) -> list[np.ndarray]:
        """The thresholds of each feature from a sample of some ten thousand rows, the rows that Spark would draw."""
        most = min(self.getMaxBins(), n) - 1
        asked = max(self.getMaxBins() ** 2, _SAMPLE)
        share, sample = 1.0, rows.select("x")
        if asked < n:
            spark, share = rows.sparkSession, asked / n
            seed = spark._jvm.org.apache.spark.util.random.XORShiftRandom(self.getSeed()).nextInt()
            drawn = sample._jdf.toJavaRDD().sample(False, share, seed)
            sample = DataFrame(spark._jsparkSession.createDataFrame(drawn, sample._jdf.schema()), spark)
        values = np.array([r[0] for r in sample.collect()]).reshape(-1, size)
        return [thresholds(values[:, f], share * n, most) for f in range(size)]

    @staticmethod
    def _cells(rows: DataFrame, cuts: list[np.ndarray], widths: list[int]) -> DataFrame:
        """``cell`` (the bins of all features as one number), ``n0`` and ``n1``, the rows of either class; written."""

        def binned(batches):
            for batch in batches:
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                cell = np.zeros(batch.num_rows, dtype=np.int64)
                for f, (edges, w) in enumerate(zip(cuts, widths, strict=True)):
                    cell = cell * w + np.searchsorted(edges, x[:, f])
                yield pa.RecordBatch.from_arrays([pa.array(cell), batch.column(0)], ["cell", "y"])

        made = rows.mapInArrow(binned, "cell long, y double")
        return durable(made.groupBy("cell").agg(F.count(F.when(F.col("y") == 0, 1)).alias("n0"), F.count(F.when(F.col("y") == 1, 1)).alias("n1")), "cells")

    def _nodes(self, cells: DataFrame, widths: list[int]) -> list:
        given = (self.getMaxDepth(), self.getMaxIter(), self.getStepSize(), self.getMinInstancesPerNode(), self.getMinInfoGain())

        def grow(batches):
            table = pa.Table.from_batches(batches).sort_by("cell")
            cell, n0, n1 = (c.to_numpy() for c in table.columns)
            bins = np.stack(np.unravel_index(cell, widths), axis=1)
            made = list(zip(*grown(bins, n0, n1, widths, *given), strict=True))
            kinds = [pa.int32()] * 6 + [pa.float64()] * 3 + [pa.int64()] + [pa.float64()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(made, kinds, strict=True)], [c.split()[0] for c in _NODES.split(", ")])

        return cells.repartition(1).mapInArrow(grow, _NODES).collect()

    def _model(self, dataset: DataFrame, nodes: list, cuts: list[np.ndarray], size: int) -> GBTClassificationModel:
        """Spark's own model of the nodes."""
        context = dataset.sparkSession.sparkContext
        jvm, gateway = context._jvm, context._gateway
        ml, piece = jvm.org.apache.spark.ml, jvm.java.util.Arrays.copyOfRange  # classes are looked up once, each look costs a call
        leaf, inner, threshold, tree_model = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit, ml.regression.DecisionTreeRegressionModel
        variance = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
        stats = _py2java(context, Vectors.dense([v for r in nodes for v in (r["n"], r["s"], r["ss"])])).toArray()
        by_tree: list[dict] = []
        for i, r in enumerate(nodes):
            if r["node"] == 1:
                by_tree.append({})
            by_tree[-1][r["node"]] = (r, variance(piece(stats, 3 * i, 3 * i + 3), r["n"]))
        trees = gateway.new_array(tree_model, len(by_tree))
        weights = gateway.new_array(jvm.double, len(by_tree))
        for t, tree in enumerate(by_tree):
            made: dict = {}
            for node in sorted(tree, reverse=True):  # children first
                r, calculator = tree[node]
                if r["feature"] is None:
                    made[node] = leaf(r["prediction"], r["impurity"], calculator)
                else:
                    split = threshold(r["feature"], float(cuts[r["feature"]][r["bin"]]))
                    made[node] = inner(r["prediction"], r["impurity"], r["gain"], made[r["left"]], made[r["right"]], split, calculator)
            trees[t] = tree_model(f"dtr_{self.uid}_{t}", made[1], size)
            weights[t] = self.getStepSize() if t else 1.0
        model = GBTClassificationModel(ml.classification.GBTClassificationModel(self.uid, trees, weights, size, 2))
        return self._copyValues(model)
