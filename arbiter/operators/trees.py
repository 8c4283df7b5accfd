"""Regression trees grown on binned rows.

MLlib's trees see a feature through its candidate thresholds only, at most
``BINS`` - 1 of them, so rows of the same bins (a cell) go the same way in every
tree, and a split of least variance needs no more of them than their number,
the sum of their labels and of the labels' squares.  A pass over the cells, of
which there are no more than the bins allow and never more than rows, does what
a pass over all rows did.

Boosting takes every row once: MLlib trains on a cell's mean label, weighted by
its rows.  A forest draws rows: each row is in a tree's sample Poisson(1)
times, as in MLlib, so rows alike in bins and label are in it Poisson(number)
times.  The draws follow from (seed, tree, shard) and are repeated for each
level of the trees; only sums per node, feature and bin are shuffled.
"""

from __future__ import annotations

import math
import re
import uuid
from functools import partial
from operator import add

import numpy as np
from pyspark import SparkContext, TaskContext
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbiter.sources.materialize import checkpointed

BINS = 32                      # of a feature, MLlib's default
DEPTH = 5                      # of a tree, MLlib's default
QUANTILES = 10_000             # that candidate thresholds are taken from
POINTS_PER_PARTITION = 250_000
HISTOGRAM_BYTES = 64 << 20     # of the trees of one pass, in one task


def cut_points(values) -> list[float]:
    """Candidate thresholds, by MLlib's rule: between all neighbours where they
    are few, else between those nearest to equal shares of the values."""
    value, n = np.unique(np.asarray(values, float), return_counts=True)
    between = (value[:-1] + value[1:]) / 2
    if len(between) < BINS:
        return np.unique(between).tolist()
    stride, out = n.sum() / BINS, []
    have, target = n[0], stride
    for i in range(1, len(value)):
        before, have = have, have + n[i]
        if abs(before - target) < abs(have - target):
            out.append(between[i - 1])
            target += stride
    return np.unique(out).tolist()


def thresholds(rows: DataFrame, columns: list[str]) -> list[list[float]]:
    """Candidate thresholds of each column, from evenly spaced quantiles of all
    rows (MLlib takes as many rows by chance)."""
    grid = F.lit(np.linspace(0, 1, QUANTILES + 1))
    found = rows.agg(*[F.percentile_approx(c, grid, QUANTILES).alias(c) for c in columns]).first()
    return [cut_points(found[c]) for c in columns]


def bin_names(cuts: list) -> list[str]:
    return [f"_bin_{i}" for i in range(len(cuts))]


def binned(rows: DataFrame, columns: list[str], cuts: list[list[float]], label: str) -> DataFrame:
    """The rows' bins and label, with the number of rows alike in both as ``_n``.
    A value at a threshold is below it.  A value that is no finite number is an
    error, as it is to MLlib."""
    fine = F.lit(True)
    for c in (*columns, label):
        fine = fine & (F.abs(F.col(c)) < float("inf"))
    rows = rows.select(*columns, F.when(fine, F.col(label)).otherwise(
        F.raise_error(F.lit("features and label must not be NaN or infinite"))).alias(label))
    names = bin_names(cuts)
    points = with_bins(rows, columns, cuts).select(*names, label).groupBy(*names, label).agg(F.count(F.lit(1)).alias("_n"))
    return checkpointed(points, "binned-points")


def asked(model: PipelineModel) -> list[list[float]] | None:
    """The thresholds that a tree model of ``ml.fit_regressor`` compares each
    feature with; None for another model."""
    trees = [m for m in model.stages if isinstance(m, (RandomForestRegressionModel, GBTRegressionModel))]
    if not trees:
        return None
    out = [set() for _ in range(trees[0].numFeatures)]
    for m in trees:
        for f, at in re.findall(r"If \(feature (\d+) <= ([^)]+)\)", m.toDebugString):
            out[int(f)].add(float(at))
    return [sorted(x) for x in out]


def alike(model: PipelineModel, rows: DataFrame, label: str) -> DataFrame:
    """Rows that ``model`` answers alike as one of them, with their number
    ``_n``, those with a label ``_labelled``, and its ``_mean`` and variance
    ``_spread`` among these.  A model without thresholds keeps every row."""
    there = F.col(label).isNotNull()
    cuts = asked(model)
    if cuts is None:
        return rows.select("*", F.lit(1).alias("_n"), there.cast("int").alias("_labelled"),
                           F.col(label).cast("double").alias("_mean"), F.lit(0.0).alias("_spread"))
    fill = model.stages[0]
    features = fill.getInputCols()
    found = with_bins(fill.transform(rows), fill.getOutputCols(), cuts, "short")
    return found.groupBy(*bin_names(cuts)).agg(
        F.first(F.struct(*features)).alias("_one"), F.count(F.lit(1)).alias("_n"), F.count(label).alias("_labelled"),
        F.avg(label).alias("_mean"), F.var_pop(label).alias("_spread")).select(
            "_one.*", "_n", "_labelled", "_mean", "_spread")


def with_bins(rows: DataFrame, columns: list[str], cuts: list[list[float]], kind: str = "tinyint") -> DataFrame:
    """``rows`` with the number of the thresholds below each column's value."""
    split = [(c, b, k) for c, b, k in zip(columns, bin_names(cuts), cuts) if k]
    if split:
        rows = Bucketizer(inputCols=[c for c, _, _ in split], outputCols=[b for _, b, _ in split], splitsArray=[
            [-math.inf, *np.nextafter(k, math.inf).tolist(), math.inf] for _, _, k in split]).transform(rows)
    return rows.withColumns({b: (F.col(b) if k else F.lit(0)).cast(kind) for b, k in zip(bin_names(cuts), cuts)})


def partitions(points: DataFrame) -> int:
    cores = points.sparkSession.sparkContext.defaultParallelism
    return cores * max(1, -(-points.count() // (POINTS_PER_PARTITION * cores)))


def cells(points: DataFrame, cuts: list, label: str) -> DataFrame:
    """One row per cell: its bins, its rows as ``_weight``, their mean label."""
    n = F.sum("_n")
    out = points.groupBy(*bin_names(cuts)).agg(
        n.cast("double").alias("_weight"), (F.sum(F.col(label) * F.col("_n")) / n).alias(label))
    return out.repartition(partitions(points))


def shards(points: DataFrame, cuts: list, label: str) -> DataFrame:
    """The points in records of an Arrow batch each, cell after cell, written
    once: a record's number and content stay, so its draws can be repeated."""
    names = bin_names(cuts)

    def pack(batches):
        import pyarrow as pa
        for i, b in enumerate(batches):
            bins = np.stack([b.column(c).to_numpy().astype(np.uint8) for c in names])
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([TaskContext.get().partitionId() << 32 | i], pa.int64()),
                "bins": pa.array([bins.tobytes()], pa.binary()),
                "labels": pa.array([b.column(label).to_numpy().astype(np.float64).tobytes()], pa.binary()),
                "n": pa.array([b.column("_n").to_numpy().astype(np.int64).tobytes()], pa.binary())})

    # ranges, so that a cell of many labels is no task of its own
    dealt = points.repartitionByRange(partitions(points), *names, label).sortWithinPartitions(*names, label)
    return checkpointed(dealt.mapInArrow(pack, "shard long, bins binary, labels binary, n binary"), "binned-shards")


_CDF = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(19)])
_EDGES = np.floor(_CDF * 65536).astype(np.int64)
_TABLE = np.searchsorted(_CDF, np.arange(65536) / 65536, side="right").astype(np.float64)
_TABLE[_EDGES[_EDGES < 65536]] = -1  # a step of the distribution is within


def draws(rng: np.random.Generator, n: np.ndarray) -> np.ndarray:
    """How often the rows of each point are in a bootstrap sample: Poisson(n)."""
    u = rng.integers(0, 65536, len(n), dtype=np.uint16)
    out = _TABLE[u]
    open_ = np.flatnonzero(out < 0)
    out[open_] = np.searchsorted(_CDF, (u[open_] + rng.random(len(open_))) / 65536, side="right")
    many = np.flatnonzero(n > 1)
    out[many] = rng.poisson(n[many])
    return out


def histograms(records, level: int, seed: int, trees: list[int], feature: np.ndarray, cut: np.ndarray,
               asked: np.ndarray):
    """(tree, sums) of a partition: rows, labels and squares per node of the
    level, feature asked of the node and bin.  ``feature`` and ``cut`` hold the
    splits of the levels above by node (1 is the root, 2 i and 2 i + 1 the
    children of i), feature -1 where there is none."""
    base, n_asked = 1 << level, asked.shape[2]
    size, sums = base * n_asked * BINS, {}
    for r in records:
        label, n = np.frombuffer(r.labels), np.frombuffer(r.n, np.int64)
        bins = np.frombuffer(r.bins, np.uint8).reshape(-1, len(n))
        starts = np.flatnonzero(np.concatenate([[True], (bins[:, 1:] != bins[:, :-1]).any(axis=0)]))
        bins, all_cells = np.ascontiguousarray(bins[:, starts]), np.arange(len(starts))
        square = label * label
        for t in trees:
            w = draws(np.random.default_rng([seed, t, r.shard]), n)
            node = np.ones(len(starts), np.int64)
            for _ in range(level):
                f = feature[t][node]
                node = np.where(f >= 0, 2 * node + (bins[f, all_cells] > cut[t][node]), 0)
            at = np.flatnonzero(node)
            if not len(at):
                continue
            place = node[at] - base
            parts = [np.add.reduceat(x, starts)[at] for x in (w, w * label, w * square)]
            h = np.zeros((3, size))
            for j in range(n_asked):
                key = (place * n_asked + j) * BINS + bins[asked[t][place, j], at]
                h += [np.bincount(key, x, size) for x in parts]
            sums[t] = sums[t] + h if t in sums else h
    yield from sums.items()


def best_splits(h: np.ndarray, n_asked: int) -> list[tuple]:
    """(place, number of the feature asked, bin, gain, sums of the left rows,
    of the right rows, of all) for each node with rows; the rows go left up to
    the bin.  Bin -1: no split is better than none."""
    h = h.reshape(3, -1, n_asked, BINS)
    out = []
    for place in range(h.shape[1]):
        left = h[:, place].cumsum(axis=2)
        whole = left[:, :1, -1:]
        left, right = left[:, :, :-1], whole - left[:, :, :-1]
        n, total, _ = whole[:, 0, 0]
        if n < 1:
            continue
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (left[1] ** 2 / left[0] + right[1] ** 2 / right[0] - total ** 2 / n) / n
        gain = np.where((left[0] >= 1) & (right[0] >= 1), gain, -np.inf)
        j, b = np.unravel_index(np.argmax(gain), gain.shape)
        g = float(gain[j, b])
        out.append((place, int(j), int(b) if g > 0 else -1, g, left[:, j, b].tolist(), right[:, j, b].tolist(),
                    whole[:, 0, 0].tolist()))
    return out


def grow(records: DataFrame, n_features: int, seed: int, n_trees: int) -> list[dict]:
    """The trees of a forest, level by level, as {node: (sums, split)} with
    split (feature, bin, gain) or None.  A node is asked for a third of the
    features, drawn anew; the only tree of a forest for all (MLlib's "auto")."""
    n_asked = n_features if n_trees == 1 else -(-n_features // 3)
    seed &= (1 << 63) - 1
    per_pass = max(1, HISTOGRAM_BYTES // ((1 << DEPTH - 1) * n_asked * BINS * 24))
    feature = np.full((n_trees, 2 << DEPTH), -1, np.int64)
    cut = np.zeros((n_trees, 2 << DEPTH), np.int64)
    forest = [{} for _ in range(n_trees)]
    read = records.rdd
    for level in range(DEPTH):
        base = 1 << level
        asked = np.array([[np.random.default_rng([seed, t, base + i, 0]).permutation(n_features)[:n_asked]
                           for i in range(base)] for t in range(n_trees)])
        open_ = [t for t in range(n_trees) if not level or (feature[t, base // 2:base] >= 0).any()]
        for first in range(0, len(open_), per_pass):
            trees = open_[first:first + per_pass]
            found = read.mapPartitions(partial(
                histograms, level=level, seed=seed, trees=trees, feature=feature, cut=cut, asked=asked)).reduceByKey(
                    add, records.sparkSession.sparkContext.defaultParallelism).mapValues(
                    partial(best_splits, n_asked=n_asked)).collect()
            for t, splits in found:
                for place, j, b, gain, left, right, whole in splits:
                    node, f = base + place, int(asked[t, place, j])
                    forest[t].setdefault(node, (whole, None))
                    if b >= 0:
                        forest[t][node] = (forest[t][node][0], (f, b, gain))
                        forest[t][2 * node], forest[t][2 * node + 1] = (left, None), (right, None)
                        feature[t, node], cut[t, node] = f, b
    return forest


def _array(kind, items):
    out = SparkContext._active_spark_context._gateway.new_array(kind, len(items))
    for i, x in enumerate(items):
        out[i] = x
    return out


def _with_params(estimator, model):
    estimator._copyValues(model)._transfer_params_to_java()
    return model


def _classes() -> tuple:
    """MLlib's leaf, inner node, threshold and tree; a look-up of each costs calls."""
    ml = SparkContext._active_spark_context._jvm.org.apache.spark.ml
    return ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit, ml.regression.DecisionTreeRegressionModel


def forest_model(estimator, trees: list[dict], cuts: list[list[float]]) -> RandomForestRegressionModel:
    """MLlib's model of grown trees, with the parameters of ``estimator``."""
    jvm = SparkContext._active_spark_context._jvm
    leaf, inner, threshold, one = _classes()
    variance, double = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator, jvm.double

    def build(tree: dict, node: int):
        (n, total, squares), split = tree[node]
        mean = total / n
        spread, sums = max(0.0, squares / n - mean * mean), variance(_array(double, [n, total, squares]), int(n))
        if split is None:
            return leaf(mean, spread, sums)
        f, b, gain = split
        return inner(mean, spread, gain, build(tree, 2 * node), build(tree, 2 * node + 1),
                     threshold(f, cuts[f][b]), sums)

    made = _array(one, [one(f"dtr_{uuid.uuid4().hex[:12]}", build(t, 1), len(cuts)) for t in trees])
    return _with_params(estimator, RandomForestRegressionModel(
        jvm.org.apache.spark.ml.regression.RandomForestRegressionModel(f"rfr_{uuid.uuid4().hex[:12]}", made, len(cuts))))


def boosted_model(estimator, model: GBTRegressionModel, cuts: list[list[float]]) -> GBTRegressionModel:
    """``model``, trained on bins, as one of the features themselves."""
    jvm = SparkContext._active_spark_context._jvm
    leaf, inner, threshold, one = _classes()

    def build(node):
        if node.subtreeDepth() == 0:
            return node
        split = node.split()
        f = split.featureIndex()
        return inner(node.prediction(), node.impurity(), node.gain(), build(node.leftChild()), build(node.rightChild()),
                     threshold(f, cuts[f][math.floor(split.threshold())]), node.impurityStats())

    made = _array(one, [one(f"dtr_{uuid.uuid4().hex[:12]}", build(t._java_obj.rootNode()), len(cuts))
                        for t in model.trees])
    weights = _array(jvm.double, list(model.treeWeights))
    return _with_params(estimator, GBTRegressionModel(
        jvm.org.apache.spark.ml.regression.GBTRegressionModel(f"gbtr_{uuid.uuid4().hex[:12]}", made, weights, len(cuts))))
