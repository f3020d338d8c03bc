"""Forests and boosted trees of a whole grid from a few passes over the rows.

A tree learner sees a row's features only as bins, so rows in the same bins of all features
(a *cell*) always go the same way.  Of a cell, a tree needs the number of its rows and the
sum and sum of squares of their labels; a forest needs them once for each tree's bootstrap
sample.  Every row is read and draws its own Poisson(1) count for every tree, as in
``pyspark.ml``; what is shared is what the points of a grid have in common (bins, samples),
and that trees grow from cells, not from rows.

Thresholds, gains, leaves and boosting follow ``pyspark.ml`` (4.1).  Boosted trees are the
models that ``GBTRegressor`` gives, but for rounding (and splits whose gain is nothing else).
Forests draw other random numbers, as Spark's do too when the rows lie in other partitions.

``fit_points`` leaves out what this does not apply to, and the caller fits it with Spark:
forests of few rows, many cells for the rows, other parameters, labels or features that are
not finite.
"""

from __future__ import annotations

import json
import math
import os
import sys
import time
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.models.elastic import vector_names
from tessera.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # executors need not have this package

#: forests of fewer rows are fitted by Spark
FEW_ROWS = 100_000
#: a cell has so many rows on average, and there are so many cells, at most
ROWS_A_CELL, MOST_CELLS = 32, 1 << 19
#: tree x cell pairs that a task grows at once, trees of a task, entries of a histogram
BLOCK, BLOCK_TREES, HISTOGRAM = 1 << 18, 16, 1 << 20
#: row x tree draws made at once
DRAWS = 1 << 18
EPSILON = 2.0 ** -52
#: grid parameters that are understood; the others must have the value that Spark has by default
GRID = {"RF": {"numTrees", "maxDepth", "maxBins"}, "GBT": {"maxDepth", "maxBins", "maxIter"}}
PLAIN = {"minInstancesPerNode": 1, "minWeightFractionPerNode": 0.0, "minInfoGain": 0.0, "subsamplingRate": 1.0, "impurity": "variance"}
OWN = {"RF": {"featureSubsetStrategy": "auto", "bootstrap": True}, "GBT": {"featureSubsetStrategy": "all", "lossType": "squared"}}
TREE_PARAMS = ["cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins", "maxDepth", "maxMemoryInMB",
               "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol", "seed"]
NODE = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
                  ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
                  ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())]))])
OUT = pa.schema([("fit", pa.int32()), ("treeID", pa.int32()), ("nodeData", NODE), ("cell", pa.int64()), ("total", pa.float64())])
OUT_DDL = ("fit int, treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
           "gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, "
           "numCategories: int>>, cell long, total double")


# ---------------------------------------------------------------- thresholds

def thresholds(values: np.ndarray, bins: int, expected: float) -> np.ndarray:
    """Candidate thresholds of a feature, from a sample of its values (Spark's rule: zeros are
    counted as what the sample has less than expected)."""
    found, counts = np.unique(values[values != 0.0], return_counts=True)
    if not len(found):
        return np.empty(0)
    counts, missing = counts.astype(float), expected - counts.sum()
    if missing > EPSILON * counts.sum() * 100:
        at = int(np.searchsorted(found, 0.0))
        found, counts = np.insert(found, at, 0.0), np.insert(counts, at, missing)
    if len(found) <= bins:
        return (found[:-1] + found[1:]) / 2
    stride, out = expected / bins, []
    target, sums = stride, np.cumsum(counts)
    for i in range(1, len(found)):
        if abs(sums[i - 1] - target) < abs(sums[i] - target):
            out.append((found[i - 1] + found[i]) / 2)
            target += stride
    return np.array(out)


def sampled_thresholds(df: DataFrame, values: str, rows: int, bins: list, seed: int) -> dict:
    """{bins: [thresholds of each feature]}, from the rows that ``pyspark.ml`` samples."""
    spark, samples, out = df.sparkSession, {}, {}
    some = df.select(values).where(F.col(values).isNotNull())
    for b in bins:
        most = min(b, rows)
        wanted = max(most * most, 10_000)
        fraction = wanted / rows if wanted < rows else 1.0
        if fraction not in samples:
            taken = some
            if fraction < 1:
                draw = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
                rdd = some._jdf.javaRDD().sample(False, fraction, draw)
                taken = DataFrame(spark._jsparkSession.createDataFrame(rdd, some._jdf.schema()), spark)
            samples[fraction] = np.stack(taken.select(vector_to_array(values).alias("x")).toPandas()["x"].to_numpy())
        out[b] = [thresholds(x, most, fraction * rows) for x in samples[fraction].T]
    return out


# ---------------------------------------------------------------- cells

@dataclass
class Axes:
    """The common refinement of all thresholds of a feature, feature by feature."""
    cuts: list

    @property
    def widths(self) -> list:
        return [len(c) + 1 for c in self.cuts]

    def number(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        for i, (c, w) in enumerate(zip(self.cuts, self.widths)):
            out = out * w + np.searchsorted(c, x[:, i], side="left")
        return out

    def bins(self, cells: np.ndarray) -> np.ndarray:
        """(cell, feature): the feature's bin."""
        return np.stack(np.unravel_index(cells, self.widths), axis=1).astype(np.int32)

    def coarse(self, own: list) -> list:
        """For each feature, the bin among its ``own`` thresholds of each of the refined bins."""
        return [np.append(np.searchsorted(t, c, side="left"), len(t)) for c, t in zip(self.cuts, own)]


def cell_rows(df: DataFrame, axes: Axes, label: str, features: str, heavy=None) -> DataFrame:
    """(cell, piece, y); cell -1 if a value is not finite.  ``heavy``: (cells in order, into how
    many pieces the rows of each go in turn); the others are one piece."""
    k = len(axes.cuts)

    def number(batches):
        start = 0
        for b in batches:
            y = b.column(0).to_numpy(zero_copy_only=False).astype(float)
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            good = np.isfinite(y) & np.isfinite(x).all(axis=1)
            cell, piece = np.where(good, axes.number(x), -1), np.zeros(len(y), np.int64)
            if heavy is not None and len(heavy[0]):
                at = np.minimum(np.searchsorted(heavy[0], cell), len(heavy[0]) - 1)
                piece = np.where(heavy[0][at] == cell, np.arange(start, start + len(y)) % heavy[1][at], 0)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(piece), pa.array(np.where(good, y, 0.0))], ["cell", "piece", "y"])
            start += len(y)

    nan = F.lit(float("nan"))
    y, none = F.coalesce(F.col(label).cast("double"), nan), F.array_repeat(nan, k)
    x = F.when(F.col(features).isNull(), none).otherwise(vector_to_array(features))
    return df.select(y.alias("y"), x.alias("x")).mapInArrow(number, "cell long, piece long, y double")


def cell_moments(rows: DataFrame) -> DataFrame:
    """(cell, n, mean, m2) with m2 the sum of squares about the mean."""
    return rows.groupBy("cell").agg(F.count("y").alias("n"), F.avg("y").alias("mean"), (F.var_pop("y") * F.count("y")).alias("m2"))


def poisson_bounds() -> np.ndarray:
    """32-bit bounds of Poisson(1): a number's count is how many of them it reaches."""
    below, term, out = 0.0, math.exp(-1), []
    for k in range(1, 14):
        below += term
        term /= k
        if below * 2 ** 32 >= 2 ** 32 - 1:
            break
        out.append(math.ceil(below * 2 ** 32))
    return np.array(out, np.uint64).astype(np.uint32)


def bootstrap(rng: np.random.Generator, rows: int, trees: int, bounds: np.ndarray) -> np.ndarray:
    """(rows, trees): how often each tree's sample has each row, independent Poisson(1) counts."""
    drawn = np.frombuffer(rng.bytes(4 * rows * trees), np.uint32)
    counts = np.zeros(rows * trees, np.uint8)
    for b in bounds:
        counts += drawn >= b
    return counts.reshape(rows, trees).astype(float)


def bagged(groups: list, seed: int):
    """Of a partition's rows: for each unit of trees, the cells and their (count, sum, sum of
    squares) in each tree's sample.  ``groups``: (number of trees, [(unit, first, last tree)])."""
    def run(batches):
        parts = [(b.column("cell").to_numpy(), b.column("y").to_numpy()) for b in batches if b.num_rows]
        if not parts:
            return
        cell, y = (np.concatenate(p) for p in zip(*parts))
        order = np.lexsort((y, cell))       # a repeated task draws the same for the same rows
        cell, y = cell[order], y[order]
        first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        own, at = cell[first], np.append(first, len(cell))
        powers, bounds, here = np.stack([np.ones(len(y)), y, y * y]), poisson_bounds(), TaskContext.get().partitionId()
        for trees, units in groups:
            rng = np.random.Generator(np.random.SFC64([seed % 2 ** 64, trees, here]))
            stats = np.zeros((3, len(own), trees))
            step, c = max(1, DRAWS // trees), 0
            for low in range(0, len(y), step):
                high = min(low + step, len(y))
                counts = bootstrap(rng, high - low, trees, bounds)
                while True:
                    a, b = max(low, at[c]), min(high, at[c + 1])
                    stats[:, c] += powers[:, a:b] @ counts[a - low:b - low]
                    if at[c + 1] > high or c + 1 == len(own):
                        break
                    c += 1
                    if at[c] >= high:
                        break
            for unit, lo, hi in units:
                yield pa.RecordBatch.from_arrays([pa.array([unit], pa.int32()), pa.array([own.tobytes()], pa.binary()),
                                                  pa.array([np.ascontiguousarray(stats[:, :, lo:hi]).tobytes()], pa.binary())], ["unit", "cells", "stats"])
    return run


# ---------------------------------------------------------------- trees

def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64"""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chosen(seed: int, tree: np.ndarray, heap: np.ndarray, features: int, take: int) -> np.ndarray:
    """(node, take): the features that a node may split by, drawn by its tree and place."""
    if take >= features:
        return np.tile(np.arange(features), (len(tree), 1))
    key = _mix(_mix(_mix(np.array([seed % 2 ** 64], np.uint64)) + tree.astype(np.uint64)) + heap.astype(np.uint64))
    return np.argsort(_mix(key[:, None] + np.arange(features, dtype=np.uint64)), axis=1, kind="stable")[:, :take]


def _variance(n, s, q):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 0, (q - s * s / n) / n, 0.0)


@dataclass
class Trees:
    """Nodes of a few trees, level by level; roots first.  feature -1: a leaf."""
    tree: np.ndarray
    n: np.ndarray
    s: np.ndarray
    q: np.ndarray
    impurity: np.ndarray
    gain: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    level: np.ndarray

    @property
    def prediction(self) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.n > 0, self.s / self.n, 0.0)

    def reached(self, bins: np.ndarray, trees: int) -> np.ndarray:
        """(tree, row): the leaf that a row of bins ends in."""
        node = np.repeat(np.arange(trees)[:, None], len(bins), axis=1)
        rows = np.arange(len(bins))[None, :]
        for _ in range(int(self.level.max(initial=0))):
            f = self.feature[node]
            down = np.where(bins[rows, np.maximum(f, 0)] <= self.bin[node], self.left[node], self.right[node])
            node = np.where(f >= 0, down, node)
        return node

    def pruned(self) -> np.ndarray:
        """Which nodes stay when leaves of one parent that predict the same are joined; those
        parents become leaves."""
        keep, p = np.ones(len(self.tree), bool), self.prediction
        for level in range(int(self.level.max(initial=0)), -1, -1):
            at = np.flatnonzero((self.level == level) & (self.feature >= 0))
            a, b = self.left[at], self.right[at]
            same = (self.feature[a] < 0) & (self.feature[b] < 0) & (p[a] == p[b])
            keep[a[same]] = keep[b[same]] = False
            at = at[same]
            self.feature[at], self.gain[at], self.left[at], self.right[at] = -1, -1.0, -1, -1
        return keep


def _best(node, bins, n, s, q, features, take_n, take_s, take_q, impurity, width):
    """Best split of nodes whose elements come node by node: (gain, feature, bin)."""
    count = len(features)
    best, feature, cut = np.full(count, -np.inf), np.full(count, -1), np.full(count, -1)
    for slot in range(features.shape[1]):
        f = features[:, slot]
        key = node * width + bins[np.arange(len(node)), f[node]]
        n_l, s_l, q_l = (np.cumsum(np.bincount(key, w, count * width).reshape(count, width), axis=1)[:, :-1] for w in (n, s, q))
        n_r, s_r, q_r = take_n[:, None] - n_l, take_s[:, None] - s_l, take_q[:, None] - q_l
        gain = impurity[:, None] - n_l / take_n[:, None] * _variance(n_l, s_l, q_l) - n_r / take_n[:, None] * _variance(n_r, s_r, q_r)
        gain[(n_l < 1) | (n_r < 1)] = -np.inf
        at = np.argmax(gain, axis=1)
        found = gain[np.arange(count), at]
        better = found > best
        best[better], feature[better], cut[better] = found[better], f[better], at[better]
    return best, feature, cut


def grow(bins: np.ndarray, n: np.ndarray, s: np.ndarray, q: np.ndarray, depth: int, choose) -> Trees:
    """Trees over cells.  ``bins``: (cell, feature); n, s, q: (tree, cell); ``choose(tree, heap)``
    gives the features of nodes.  Nodes of a level split together."""
    trees, width = len(n), int(bins.max(initial=0)) + 1
    if width < 2:
        width = 2
    tree_of, cell = np.nonzero(n)
    n, s, q = n[tree_of, cell], s[tree_of, cell], q[tree_of, cell]
    node, tree, heap = tree_of, np.arange(trees), np.ones(trees, np.int64)
    levels, before = [], 0
    for level in range(depth + 1):
        count = len(tree)
        t_n, t_s, t_q = (np.bincount(node, w, count) for w in (n, s, q))
        impurity = _variance(t_n, t_s, t_q)
        gain, feature, cut = np.full(count, -np.inf), np.full(count, -1), np.full(count, -1)
        if level < depth:
            features, step = choose(tree, heap), max(1, HISTOGRAM // width)
            for low in range(0, count, step):
                high = min(low + step, count)
                a, b = np.searchsorted(node, [low, high])
                gain[low:high], feature[low:high], cut[low:high] = _best(
                    node[a:b] - low, bins[cell[a:b]], n[a:b], s[a:b], q[a:b], features[low:high],
                    t_n[low:high], t_s[low:high], t_q[low:high], impurity[low:high], width)
        split = (gain > 0) & ((level == 0) | (np.abs(impurity) >= EPSILON))
        below = np.cumsum(split) - 1
        left = np.where(split, before + count + 2 * below, -1)
        levels.append(Trees(tree, t_n, t_s, t_q, impurity, np.where(split, gain, -1.0), np.where(split, feature, -1), cut,
                            left, np.where(split, left + 1, -1), np.full(count, level)))
        before += count
        if not split.any():
            break
        on = split[node]
        node, cell, n, s, q = node[on], cell[on], n[on], s[on], q[on]
        right = bins[cell, feature[node]] > cut[node]
        node = 2 * below[node] + right
        order = np.argsort(node, kind="stable")
        node, cell, n, s, q = node[order], cell[order], n[order], s[order], q[order]
        tree, heap = np.repeat(tree[split], 2), np.repeat(2 * heap[split], 2)
        heap[1::2] += 1
    return Trees(*[np.concatenate([getattr(x, f) for x in levels]) for f in Trees.__dataclass_fields__])


@dataclass
class Fit:
    """A point of a grid: its place in the run, family, parameters, and its own thresholds."""
    index: int
    family: str
    trees: int
    depth: int
    own: list
    coarse: list = None         # Axes.coarse(own)

    def cells(self, bins: np.ndarray):
        """Cells of this fit's own bins: their bins, and which of them each refined cell is in."""
        mine = np.stack([m[bins[:, i]] for i, m in enumerate(self.coarse)], axis=1)
        return np.unique(mine, axis=0, return_inverse=True)


def _node_table(fit: Fit, trees: Trees, first: int) -> pa.Table:
    keep = trees.pruned()
    at = np.flatnonzero(keep)
    at = at[np.argsort(trees.tree[at], kind="stable")]
    tree = trees.tree[at]
    ident = np.full(len(keep) + 1, -1)
    ident[at] = np.arange(len(at)) - np.searchsorted(tree, tree)
    inner, count = trees.feature[at] >= 0, len(at)
    cuts = np.array([fit.own[f][c] for f, c in zip(trees.feature[at][inner], trees.bin[at][inner])])
    lists = lambda values, ends: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.float64()))
    stats = np.stack([trees.n[at], trees.s[at], trees.q[at]], axis=1).reshape(-1)
    split = pa.StructArray.from_arrays([pa.array(np.where(inner, trees.feature[at], -1), pa.int32()), lists(cuts, np.append(0, np.cumsum(inner))),
                                        pa.array(np.full(count, -1), pa.int32())], fields=list(NODE.field("split").type))
    node = pa.StructArray.from_arrays(
        [pa.array(ident[at], pa.int32()), pa.array(trees.prediction[at]), pa.array(trees.impurity[at]), lists(stats, np.arange(count + 1) * 3),
         pa.array(trees.n[at], pa.int64()), pa.array(trees.gain[at]), pa.array(ident[trees.left[at]], pa.int32()),
         pa.array(ident[trees.right[at]], pa.int32()), split], fields=list(NODE))
    none = pa.nulls(count)
    return pa.Table.from_arrays([pa.array(np.full(count, fit.index), pa.int32()), pa.array(tree + first, pa.int32()), node,
                                 none.cast(pa.int64()), none.cast(pa.float64())], schema=OUT)


def _score_table(fit: Fit, cells: np.ndarray, total: np.ndarray) -> pa.Table:
    count = len(cells)
    return pa.Table.from_arrays([pa.array(np.full(count, fit.index), pa.int32()), pa.nulls(count, pa.int32()), pa.nulls(count, NODE),
                                 pa.array(cells), pa.array(total)], schema=OUT)


def grow_forest(fit: Fit, bins: np.ndarray, stats: np.ndarray, first: int, seed: int, asked: np.ndarray, asked_bins: np.ndarray) -> list:
    """Some trees of a forest: their nodes, and their part of the prediction of the cells asked for."""
    own, into = fit.cells(bins)
    n, s, q = (np.stack([np.bincount(into.reshape(-1), w, len(own)) for w in stats[i].T]) for i in range(3))
    k = bins.shape[1]
    take = k if fit.trees == 1 else max(1, math.ceil(k / 3))
    trees = grow(own, n, s, q, fit.depth, lambda tree, heap: chosen(seed, tree + first, heap, k, take))
    mine = np.stack([m[asked_bins[:, i]] for i, m in enumerate(fit.coarse)], axis=1)
    total = trees.prediction[trees.reached(mine, len(n))].sum(axis=0) / fit.trees
    return [_node_table(fit, trees, first), _score_table(fit, asked, total)]


def grow_boosted(fit: Fit, bins: np.ndarray, moments: np.ndarray, rate: float, asked: np.ndarray, asked_bins: np.ndarray) -> list:
    """A boosted model: the first tree fits the label, the others twice what is left of it."""
    own, into = fit.cells(bins)
    into = into.reshape(-1)
    n = np.bincount(into, moments[0], len(own))
    mean = np.bincount(into, moments[0] * moments[1], len(own)) / n
    m2 = np.bincount(into, moments[2] + moments[0] * (moments[1] - mean[into]) ** 2, len(own))
    mine = np.stack([m[asked_bins[:, i]] for i, m in enumerate(fit.coarse)], axis=1)
    features = np.arange(bins.shape[1])
    now, total, out = np.zeros(len(own)), np.zeros(len(asked)), []
    for i in range(fit.trees):
        rest, scale, weight = mean - now, 2.0 if i else 1.0, rate if i else 1.0
        s, q = scale * n * rest, scale * scale * (m2 + n * rest * rest)
        trees = grow(own, n[None], s[None], q[None], fit.depth, lambda tree, heap: np.tile(features, (len(tree), 1)))
        now = now + weight * trees.prediction[trees.reached(own, 1)[0]]
        total = total + weight * trees.prediction[trees.reached(mine, 1)[0]]
        out.append(_node_table(fit, trees, i))
    return [*out, _score_table(fit, asked, total)]


# ---------------------------------------------------------------- models

class StoredModel:
    """A fitted point whose nodes lie in a table; read as a ``pyspark.ml`` model where one is
    asked for (``transform`` and whatever else such a model has)."""

    def __init__(self, spark: SparkSession, nodes: str, index: int, est, weights: list, features: int, path: str | None = None):
        self._spark, self._nodes, self._index, self._est, self._weights, self._features = spark, nodes, index, est, weights, features
        self._path, self._loaded = path, None
        if path:
            self.save(path)

    @property
    def _kind(self) -> str:
        return type(self._est).__name__.replace("Regressor", "RegressionModel")

    def _metadata(self, kind: str, uid: str, names=None, **more) -> str:
        given, default = ({p.name: v for p, v in m.items() if names is None or p.name in names} for m in (self._est._paramMap, self._est._defaultParamMap))
        return json.dumps({"class": f"org.apache.spark.ml.regression.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": self._spark.version,
                           "uid": uid, "paramMap": given, "defaultParamMap": default, **more})

    def save(self, path: str) -> None:
        """In the layout of ``pyspark.ml``: ``load`` of the model's class reads it."""
        spark = self._spark
        head = self._metadata(self._kind, self._est.uid, numFeatures=self._features, numTrees=len(self._weights))
        trees = [(i, self._metadata("DecisionTreeRegressionModel", f"dtr_{uuid.uuid4().hex[:12]}", TREE_PARAMS), float(w)) for i, w in enumerate(self._weights)]
        spark.createDataFrame([(head,)], "value string").coalesce(1).write.mode("overwrite").text(os.path.join(path, "metadata"))
        spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "treesMetadata"))
        nodes = spark.read.parquet(self._nodes).where((F.col("fit") == self._index) & F.col("treeID").isNotNull())
        nodes.select("treeID", "nodeData").write.mode("overwrite").parquet(os.path.join(path, "data"))

    def load(self):
        if self._loaded is None:
            from pyspark.ml import regression

            if not self._path:
                path = scratch_path(self._spark, "model")
                self.save(path)
                self._path = path
            self._loaded = getattr(regression, self._kind).load(self._path)
        return self._loaded

    def __getattr__(self, name):
        if name.startswith("_"):
            raise AttributeError(name)
        return getattr(self.load(), name)


def understood(family: str, est, given: set) -> bool:
    plain = {**PLAIN, **OWN[family]}
    return given <= GRID[family] and not est.isDefined("weightCol") and not (family == "GBT" and est.isDefined("validationIndicatorCol")) \
        and all(est.getOrDefault(p) == v for p, v in plain.items())


def fit_points(points: list, train: DataFrame, val: DataFrame, label: str, features: str, seed: int | None) -> dict:
    """``points``: (family, estimator, the point's parameters as ``ParamGridBuilder`` gives
    them).  {place in ``points``: (RMSE on ``val``, a function that makes its model, given a
    path or None)} of those that are fitted here, see above."""
    rows = train.count()
    mine = [i for i, (family, _, _) in enumerate(points) if family == "GBT" or rows >= FEW_ROWS]
    if not mine or not rows or seed is None:
        return {}
    points = [points[i] for i in mine]
    if not all(f in GRID and understood(f, e, {p.name for p in pm}) for f, e, pm in points):
        return {}
    points = [(f, e.copy(pm)) for f, e, pm in points]
    if any("vals" in a for kind in train.schema[features].metadata.get("ml_attr", {}).get("attrs", {}).values() for a in kind):
        return {}           # categories
    k = len(vector_names(train, features))
    cuts = sampled_thresholds(train, features, rows, sorted({e.getMaxBins() for _, e in points}), seed)
    axes = Axes([np.unique(np.concatenate([cuts[b][i] for b in cuts])) for i in range(k)])
    if not k or math.prod(axes.widths) >= 2 ** 62:
        return {}
    fits = []
    for i, (family, e) in enumerate(points):
        own = cuts[e.getMaxBins()]
        fits.append(Fit(i, family, e.getNumTrees() if family == "RF" else e.getMaxIter(), e.getMaxDepth(), own, axes.coarse(own)))

    spark = train.sparkSession
    known, asked = (cell_moments(cell_rows(x, axes, label, features)).persist(StorageLevel.MEMORY_AND_DISK) for x in (train, val))
    try:
        most = min(rows // ROWS_A_CELL, MOST_CELLS)
        if known.count() > most or not 0 < asked.count() <= most or known.where("cell < 0").count() or asked.where("cell < 0").count():
            return {}
        stats, want = known.toPandas(), asked.select("cell").toPandas()["cell"].to_numpy().copy()
        nodes = _grow_all(spark, lambda heavy: cell_rows(train, axes, label, features, heavy), fits, axes, stats, want, rows, seed,
                          {i: e.getStepSize() for i, (f, e) in enumerate(points) if f == "GBT"})
        found = spark.read.parquet(nodes).where("cell is not null").groupBy("fit", "cell").agg(F.sum("total").alias("p"))
        error = F.sum(F.col("m2") + F.col("n") * (F.col("p") - F.col("mean")) ** 2) / F.sum("n")
        # the order of sums is open: without the last digits equal models tie
        scores = {r.fit: float(f"{r.e:.13g}") for r in found.join(asked, "cell").groupBy("fit").agg(F.sqrt(error).alias("e")).collect()}
    finally:
        known.unpersist()
        asked.unpersist()

    def model(fit, e):
        weights = [1.0] * fit.trees if fit.family == "RF" else [1.0] + [e.getStepSize()] * (fit.trees - 1)
        return lambda path: StoredModel(spark, nodes, fit.index, e, weights, k, path)

    return {i: (scores[f.index], model(f, e)) for i, f, (_, e) in zip(mine, fits, points)}


def _grow_all(spark: SparkSession, lines_of, fits: list, axes: Axes, stats, want: np.ndarray, rows: int, seed: int, rates: dict) -> str:
    """All fits' trees, a few trees or a boosted model to a task; the table they are written to."""
    count = len(stats)
    block, units, groups = max(1, min(BLOCK_TREES, BLOCK // count)), [], []
    for trees in sorted({f.trees for f in fits if f.family == "RF"}):
        mine = []
        for low in range(0, trees, block):
            high = min(low + block, trees)
            mine.append((len(units), low, high))
            units.append(([f for f in fits if f.family == "RF" and f.trees == trees], low, high))
        groups.append((trees, mine))
    boosted = list(range(len(units), len(units) + len(rates)))
    units += [([f], 0, f.trees) for f in fits if f.family == "GBT"]

    lines = lines_of(None)
    parts = lines.rdd.getNumPartitions()
    if count * sum(t for t, _ in groups) * 24 > rows / parts * 16:      # else each task would have nearly all cells
        heavy = stats[stats["n"] * parts > rows].sort_values("cell")
        lines = lines_of((heavy["cell"].to_numpy().copy(), -(-heavy["n"].to_numpy() * parts // rows))).repartition(parts, "cell", "piece")
    schema = "unit int, cells binary, stats binary"
    given = spark.createDataFrame([(u, b"", b"") for u in boosted], schema)
    if groups:
        given = lines.select("cell", "y").mapInArrow(bagged(groups, seed), schema).union(given)
    cells, moments = stats["cell"].to_numpy().copy(), stats[["n", "mean", "m2"]].to_numpy(float).T.copy()

    def run(table):
        fitted, low, high = units[table.column("unit")[0].as_py()]
        want_bins, out = axes.bins(want), []
        if fitted[0].family == "GBT":
            out = [t for f in fitted for t in grow_boosted(f, axes.bins(cells), moments, rates[f.index], want, want_bins)]
        else:
            order = np.argsort(cells)
            total = np.zeros((3, len(cells), high - low))
            for c, s in zip(table.column("cells"), table.column("stats")):
                at = np.frombuffer(c.as_py(), np.int64)
                total[:, order[np.searchsorted(cells, at, sorter=order)]] += np.frombuffer(s.as_py()).reshape(3, len(at), high - low)
            out = [t for f in fitted for t in grow_forest(f, axes.bins(cells), total, low, seed, want, want_bins)]
        return pa.concat_tables(out)

    path = scratch_path(spark, "trees")
    given.repartition(max(4 * len(units), 1), "unit").groupBy("unit").applyInArrow(run, OUT_DDL).write.partitionBy("fit").parquet(path)
    return path
