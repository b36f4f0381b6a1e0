"""Trees that draw rows, grown from blocks of equally binned rows: the blocks, boosting, and the saved form; forests are in ``forests``.

MLlib passes over all rows, one object each, for every level of every tree. Here the rows are binned and counted by cell once and kept as
arrays, a task counts a level's bins of its blocks with numpy, and only those counts come to the driver, which chooses the splits by MLlib's
rules. Rows are drawn as MLlib draws them, each by itself: of a cell of n rows a binomial number.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rareflow.functions.columns import col, vector_item
from rareflow.operators.cells import values_or_quantiles, weight_of
from rareflow.session import small_table, stage_path

#: Smaller tables are left to MLlib, whose passes over them take less time than to start Python tasks; a boosting starts them once a level of each tree.
#: Rows of a forest count once for each tree of all candidates.
LEAST_ROWS = {GBTClassifier: 1_000_000, RandomForestClassifier: 40_000_000}
#: Cells of a block, and of a piece of it that is worked on at a time
BLOCK, PIECE = 500_000, 1 << 16
#: Of a tree that is compared split by split
FEW_SPLITS = 15
#: The rounds after which the margins are taken from the trees again, and not from the round before, are this number and its doubles.
FRESH = 20
EPSILON = np.finfo(float).eps


@dataclass
class Binned:
    """Blocks ``(number, bins, labels, rows)`` of cells, and each feature's thresholds; a bin holds what is at most its threshold.

    ``rows`` are the numbers of rows of both classes, ``weights`` what one row of them weighs.
    """

    blocks: RDD
    thresholds: list[list[float]]
    rows: tuple[int, int]
    weights: tuple[float, float]

    @property
    def most(self) -> int:
        return max(map(len, self.thresholds)) + 1

    def count(self) -> int:
        """The number of cells."""
        return self.blocks.map(lambda block: len(block[2])).sum()


@dataclass
class Tree:
    """Nodes as columns, children after their parent; a leaf is its own child. ``stats`` are the weight, sum and squares of a node's targets."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    gain: np.ndarray
    stats: np.ndarray
    depth: int

    @property
    def value(self) -> np.ndarray:
        return self.stats[:, 1] / self.stats[:, 0]


def boosts_drawn_rows(estimator) -> bool:
    """Whether it is a boosting as grown here: of drawn rows without weights, without a validation part, by all features."""
    if not isinstance(estimator, GBTClassifier) or not 0 < estimator.getSubsamplingRate() < 1 or weight_of(estimator):
        return False
    watched = estimator.isDefined(estimator.validationIndicatorCol) and estimator.getValidationIndicatorCol()
    return not watched and estimator.getFeatureSubsetStrategy() == "all" and 2 <= estimator.getMaxBins() <= 256


def forest_of_drawn_rows(estimator) -> bool:
    """Whether it is a forest as grown in ``forests``, whose trees draw rows."""
    if not isinstance(estimator, RandomForestClassifier) or not (estimator.getBootstrap() or 0 < estimator.getSubsamplingRate() < 1):
        return False
    return estimator.getImpurity() == "gini" and estimator.getFeatureSubsetStrategy() in ("auto", "all", "sqrt", "log2", "onethird") and 2 <= estimator.getMaxBins() <= 256


def binned_rows(scaled: DataFrame, width: int, estimators: Sequence) -> Binned | None:
    """The cells of the assembled and scaled rows, kept for all estimators; None where MLlib is to fit the rows themselves.

    Thresholds lie halfway between a feature's values or, where it has more than ``maxBins``, between as many approximate quantiles of all rows.
    Weights must follow from the label.
    """
    if not all(boosts_drawn_rows(e) or forest_of_drawn_rows(e) for e in estimators):
        return None
    used = {(type(e), e.getMaxBins(), e.getLabelCol(), e.getFeaturesCol(), weight_of(e)) for e in estimators}
    passes = sum(e.getNumTrees() for e in estimators if isinstance(e, RandomForestClassifier)) or 1
    if len(used) > 1 or scaled.count() * passes < LEAST_ROWS[type(estimators[0])]:
        return None
    (_, bins, label, features, weight), names = used.pop(), [f"_{i}" for i in range(width)]
    weighs = col(weight).cast("double") if weight else F.lit(1.0)
    rows = scaled.select(col(label).cast("double").alias("label"), weighs.alias("weight"), *[vector_item(features, i).alias(c) for i, c in enumerate(names)])
    figures = (F.count("*").alias("n"), F.count("weight").alias("known"), F.min("weight").alias("low"), F.max("weight").alias("high"))
    by_label = {r["label"]: r for r in rows.groupBy("label").agg(*figures).limit(3).collect()}
    if set(by_label) != {0.0, 1.0} or any(x["known"] < x["n"] or x["low"] != x["high"] or not 0 < x["low"] < math.inf for x in by_label.values()):
        return None
    seen = rows.agg(*[F.approx_count_distinct(c).alias(c) for c in names]).first()
    near = values_or_quantiles(rows, names, [seen[c] for c in names], bins)
    if near is None:
        return None
    thresholds = [sorted({(a + b) / 2 for a, b in zip(found, found[1:])}) for found, _ in near]
    cut = [i for i, found in enumerate(thresholds) if found]
    if not cut:
        return None
    edges = [[-math.inf, *[math.nextafter(t, math.inf) for t in thresholds[i]], math.inf] for i in cut]
    placed = Bucketizer(inputCols=[names[i] for i in cut], outputCols=[f"bin_{i}" for i in cut], splitsArray=edges).transform(rows)
    bin_of = [F.col(f"bin_{i}").cast("smallint").alias(c) if thresholds[i] else F.lit(0).cast("smallint").alias(c) for i, c in enumerate(names)]
    cells = placed.select(*bin_of, F.col("label").cast("smallint").alias("label")).groupBy(*names, "label").agg(F.count("*").alias("rows"))
    cores = scaled.sparkSession.sparkContext.defaultParallelism
    dealt = cells.repartition(cores, *names, "label").sortWithinPartitions(*names, "label")
    packed = dealt.mapInArrow(_packed, "bins binary, labels binary, rows binary").rdd
    blocks = packed.mapPartitionsWithIndex(partial(_unpacked, width)).persist(StorageLevel.MEMORY_AND_DISK)
    n, weights = (tuple(by_label[y][name] for y in (0.0, 1.0)) for name in ("n", "low"))
    return Binned(blocks, thresholds, n, weights)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole blocks as three buffers: the bins of all cells, their labels, their numbers of rows."""

    def block(some: list[pa.RecordBatch]) -> pa.RecordBatch:
        columns = [c.to_numpy(zero_copy_only=False) for c in pa.Table.from_batches(some).combine_chunks().itercolumns()]
        buffers = (np.stack(columns[:-2]).astype(np.uint8), columns[-2].astype(np.uint8), columns[-1].astype(np.int64))
        return pa.RecordBatch.from_arrays([pa.array([b.tobytes()], pa.binary()) for b in buffers], ["bins", "labels", "rows"])

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= BLOCK:
            yield block(held)
            held, size = [], 0
    if size:
        yield block(held)


def _unpacked(width: int, part: int, rows: Iterator) -> Iterator[tuple]:
    for i, row in enumerate(rows):
        bins, labels, n = (np.frombuffer(bytes(x), kind) for x, kind in zip(row, (np.uint8, np.uint8, np.int64)))
        yield (part, i), bins.reshape(width, -1), labels, n


def _pieces(size: int) -> Iterator[slice]:
    return (slice(at, min(at + PIECE, size)) for at in range(0, size, PIECE))


def _node_of(tree: Tree, bins: np.ndarray) -> np.ndarray:
    """The node that each cell falls to. A few splits are compared with all cells, which takes less time than looking up each cell's own."""
    size = len(tree.feature)
    inner = np.flatnonzero(tree.child[0::2] != np.arange(size))
    if len(inner) <= FEW_SPLITS:
        kind = np.uint8 if size <= 256 else np.uint16
        node = np.zeros(bins.shape[1], kind)
        for i in inner:
            step = (bins[tree.feature[i]] > tree.cut[i]).astype(kind)
            step += kind(tree.child[2 * i] - i)
            step *= node == i
            node += step
        return node
    first, flat = np.arange(bins.shape[1]), np.ascontiguousarray(bins).ravel()
    node = np.zeros(len(first), np.intp)
    for _ in range(tree.depth):
        node = tree.child[2 * node + (flat[tree.feature[node] * len(first) + first] > tree.cut[node])]
    return node


def draw(n: np.ndarray, share: float, rng: np.random.Generator) -> np.ndarray:
    """How many of a cell's rows are drawn, each with the probability ``share``."""
    drawn = (rng.random(len(n)) < share).astype(float)
    several = np.flatnonzero(n > 1)
    drawn[several] = rng.binomial(n[several], share)
    return drawn


def _with_margins(trees: Sequence[tuple[Tree, float]], block: tuple) -> tuple:
    """The block with the trees' values added to its margins."""
    number, bins, labels, n, *before = block
    margin = before[0].copy() if before else np.zeros(len(n))
    for at in _pieces(len(n)):
        for tree, weight in trees:
            margin[at] += (weight * tree.value)[_node_of(tree, bins[:, at])]
    return number, bins, labels, n, margin


def _drawn_targets(turn: int, seed: int, share: float, block: tuple) -> tuple:
    """What a round's tree grows from: the drawn cells' bins, their drawn rows (None for one each) and the sums of their targets.

    The targets are the labels -1 and 1 in the first round, then the negative gradients of the logistic loss.
    """
    number, bins, labels, n, margin = block
    sign = 2.0 * labels - 1.0
    target = sign if turn == 0 else 4.0 * sign / (1.0 + np.exp(np.minimum(2.0 * sign * margin, 700.0)))
    rows = draw(n, share, np.random.default_rng([seed % 2**64, turn, *number]))
    kept = np.flatnonzero(rows)
    rows, target = rows[kept], target[kept]
    return bins[:, kept], None if (n == 1).all() else rows, rows * target


def _level_counts(tree: Tree, slot_of: np.ndarray, most: int, last: bool, blocks: Iterator[tuple]) -> Iterator[tuple]:
    """Weight and sum of the drawn targets by feature, open node and bin, and their squares by open node, of all blocks of a task together.

    The squares of the last level are needed by bin too.
    """
    open_, total, below = slot_of.max() + 1, None, None
    for bins, rows, sums in blocks:
        if total is None:
            total, below = np.zeros((3 if last else 2, len(bins), open_ * most)), np.zeros(open_)
        for at in _pieces(len(sums)):
            slot = slot_of[_node_of(tree, bins[:, at])]
            mine, weight, value = bins[:, at], None if rows is None else rows[at], sums[at]
            if (slot < 0).any():
                kept = np.flatnonzero(slot >= 0)
                slot, mine, weight, value = slot[kept], mine[:, kept], None if weight is None else weight[kept], value[kept]
            squares = value * value if weight is None else value * value / weight
            below += np.bincount(slot, squares, open_)
            slot = slot * most
            for f, bin_ in enumerate(mine):
                key = slot + bin_
                total[0, f] += np.bincount(key, weight, open_ * most)
                total[1, f] += np.bincount(key, value, open_ * most)
                if last:
                    total[2, f] += np.bincount(key, squares, open_ * most)
    if total is not None:
        yield total, below


def _variance(stats: np.ndarray) -> np.ndarray:
    weight = np.where(stats[..., 0] > 0, stats[..., 0], 1.0)
    return np.where(stats[..., 0] > 0, (stats[..., 2] - stats[..., 1] ** 2 / weight) / weight, 0.0)


def grow(counts: Callable[[Tree, np.ndarray, bool], tuple[np.ndarray, np.ndarray]], splits: Sequence[int], rows: int, estimator) -> Tree:
    """A tree by MLlib's rules: level by level, each open node takes the first of its best splits, if that gains and leaves enough on both sides.

    ``counts`` has the figures of a level, as ``_level_counts``; ``splits`` are the numbers of thresholds, ``rows`` that of all rows.
    """
    depth, least, gains = estimator.getMaxDepth(), estimator.getMinInstancesPerNode(), estimator.getMinInfoGain()
    tree = Tree(np.zeros(1, np.intp), np.zeros(1, np.intp), np.zeros(2, np.intp), np.full(1, -1.0), np.zeros((1, 3)), 0)
    most, open_, fewest = max(splits) + 1, np.zeros(1, np.intp), max(least, estimator.getMinWeightFractionPerNode() * rows)
    possible = np.arange(most - 1) < np.asarray(splits)[:, None]
    for level in range(max(depth, 1)):
        slot_of = np.full(len(tree.feature), -1)
        slot_of[open_] = np.arange(len(open_))
        found, squares = counts(tree, slot_of, level + 1 == depth)
        upto = np.cumsum(found.reshape(len(found), len(splits), len(open_), most).transpose(2, 1, 3, 0), axis=2)
        left, all_ = upto[:, :, :-1], upto[:, :, -1:]
        right = all_ - left
        if level == 0:
            tree.stats[0, :2] = all_[0, 0, 0, :2]
        tree.stats[open_, 2] = squares
        if depth == 0:
            break
        mixed = np.abs(_variance(tree.stats[open_])) >= EPSILON
        weight, sums = tree.stats[open_, 0], tree.stats[open_, 1]
        halves = sum(x[..., 1] ** 2 / np.where(x[..., 0] > 0, x[..., 0], 1.0) for x in (left, right))
        gain = (halves - (sums**2 / weight)[:, None, None]) / weight[:, None, None]
        allowed = possible & (left[..., 0] >= fewest) & (right[..., 0] >= fewest) & (gain >= gains) & (gain > 0) & mixed[:, None, None]
        gain = np.where(allowed, gain, -np.inf).reshape(len(open_), -1)
        best = gain.argmax(axis=1)
        kept = np.flatnonzero(gain[np.arange(len(open_)), best] > -np.inf)
        if not len(kept):
            break
        feature, cut = np.divmod(best[kept], most - 1)
        parent, new = open_[kept], len(tree.feature) + np.arange(2 * len(kept))
        tree.feature[parent], tree.cut[parent], tree.gain[parent] = feature, cut, gain[kept, best[kept]]
        tree.child[2 * parent], tree.child[2 * parent + 1] = new[0::2], new[1::2]
        stats = np.zeros((len(new), 3))
        for side, x in enumerate((left, right)):
            stats[side::2, : x.shape[-1]] = x[kept, feature, cut]
        zeros = np.zeros(len(new), np.intp)
        tree = Tree(
            np.concatenate([tree.feature, zeros]),
            np.concatenate([tree.cut, zeros]),
            np.concatenate([tree.child, np.repeat(new, 2)]),
            np.concatenate([tree.gain, np.full(len(new), -1.0)]),
            np.concatenate([tree.stats, stats]),
            level + 1,
        )
        open_ = new
    return tree


def boost(binned: Binned, estimator) -> list[tuple[Tree, float]]:
    """The trees of a boosting and their weights."""
    splits, seed, share = list(map(len, binned.thresholds)), estimator.getSeed(), estimator.getSubsamplingRate()
    fitted, margins, fresh = [], binned.blocks, FRESH
    kept = StorageLevel.MEMORY_AND_DISK
    for turn in range(estimator.getMaxIter()):
        before, added = (binned.blocks, fitted) if turn == fresh else (margins, fitted[-1:])
        fresh *= 2 if turn == fresh else 1
        old, margins = margins, before.map(partial(_with_margins, tuple(added))).persist(kept)
        targets = margins.map(partial(_drawn_targets, turn, seed, share)).persist(kept)

        def counts(tree: Tree, slot_of: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
            found = targets.mapPartitions(partial(_level_counts, tree, slot_of, binned.most, last)).collect()
            return tuple(sum(x) for x in zip(*found))

        fitted.append((grow(counts, splits, sum(binned.rows), estimator), 1.0 if turn == 0 else estimator.getStepSize()))
        targets.unpersist()
        if old is not binned.blocks:
            old.unpersist()
    margins.unpersist()
    return fitted


def saved_nodes(tree: Tree, thresholds: Sequence[Sequence[float]], predicted: np.ndarray, impurity: np.ndarray, raw: np.ndarray, depth: int) -> pa.StructArray:
    """The nodes down to ``depth`` as MLlib saves them, in pre-order; leaves of one parent that predict the same are put together, as MLlib does."""
    size = len(tree.feature)
    left, right = tree.child[0::2], tree.child[1::2]
    leaf, level = left == np.arange(size), np.zeros(size, int)
    for i in np.flatnonzero(~leaf):
        level[[left[i], right[i]]] = level[i] + 1
    leaf |= level >= depth
    for i in np.flatnonzero(~leaf)[::-1]:
        leaf[i] = leaf[left[i]] and leaf[right[i]] and predicted[left[i]] == predicted[right[i]]
    order, todo = [], [0]
    while todo:
        i = todo.pop()
        order.append(i)
        todo += [] if leaf[i] else [right[i], left[i]]
    order = np.array(order)
    number = np.zeros(size, np.int32)
    number[order] = np.arange(len(order))
    leaf, feature, cut = leaf[order], tree.feature[order], tree.cut[order]
    values = [[] if end else [float(thresholds[f][c])] for end, f, c in zip(leaf, feature, cut)]
    split = {"featureIndex": np.where(leaf, -1, feature).astype(np.int32), "leftCategoriesOrThreshold": pa.array(values, pa.list_(pa.float64())), "numCategories": np.full(len(order), -1, np.int32)}
    nodes = {
        "id": np.arange(len(order), dtype=np.int32),
        "prediction": predicted[order].astype(float),
        "impurity": impurity[order],
        "impurityStats": pa.array(list(tree.stats[order]), pa.list_(pa.float64())),
        "rawCount": raw[order].astype(np.int64),
        "gain": np.where(leaf, -1.0, tree.gain[order]),
        "leftChild": np.where(leaf, -1, number[left[order]]).astype(np.int32),
        "rightChild": np.where(leaf, -1, number[right[order]]).astype(np.int32),
        "split": _struct(split),
    }
    return _struct(nodes)


def _struct(columns: dict) -> pa.StructArray:
    return pa.StructArray.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns))


def saved_model(spark: SparkSession, estimator, trees: Sequence[pa.StructArray], weights: Sequence[float], kinds: tuple, impurity: str, **more):
    """MLlib's model of the trees, by way of its saved form; ``kinds`` are the model's class and the names of it and of its trees."""
    model, whole, single = kinds

    own, defaults = ({p.name: v for p, v in params.items()} for params in (estimator._paramMap, estimator._defaultParamMap))
    of_trees = {name: estimator.getOrDefault(name) for name in ("featuresCol", "labelCol", "maxDepth", "seed")}

    def about(kind: str, uid: str, params: dict, defaults: dict, **more) -> str:
        return json.dumps({"class": f"org.apache.spark.ml.{kind}", "timestamp": 0, "sparkVersion": spark.version, "uid": uid, "paramMap": params, "defaultParamMap": defaults, **more})

    path = stage_path(spark, "trees")
    small_table(spark, [(about(whole, estimator.uid, own, defaults, numTrees=len(trees), **more),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    each = [(i, about(single, f"tree_{uuid.uuid4().hex[:12]}", of_trees, {"impurity": impurity}), float(weight)) for i, weight in enumerate(weights)]
    small_table(spark, each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    numbers = pa.array(np.repeat(np.arange(len(trees), dtype=np.int32), [len(t) for t in trees]))
    spark.createDataFrame(pa.table({"treeID": numbers, "nodeData": pa.concat_arrays(trees)})).coalesce(1).write.parquet(f"{path}/data")
    return estimator._copyValues(model.load(path))


BOOSTED = (GBTClassificationModel, "classification.GBTClassificationModel", "regression.DecisionTreeRegressionModel")


def fit_drawn(estimator: GBTClassifier, binned: Binned, spark: SparkSession) -> GBTClassificationModel:
    """``estimator.fit`` of the binned rows."""
    fitted = boost(binned, estimator)
    trees = [saved_nodes(t, binned.thresholds, t.value, _variance(t.stats), np.round(t.stats[:, 0]), estimator.getMaxDepth()) for t, _ in fitted]
    return saved_model(spark, estimator, trees, [weight for _, weight in fitted], BOOSTED, "variance", numFeatures=len(binned.thresholds))
