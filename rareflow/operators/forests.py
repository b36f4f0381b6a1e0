"""Forests whose trees draw rows, grown from blocks of equally binned rows.

A task keeps, for each tree, the drawn cells that are still in a node to split, with their numbers of drawn rows, and counts them by node, feature
and bin. The counts of a tree are put together in one task, which chooses the splits by MLlib's rules; only the splits come to the driver.
What a tree draws follows from its number, so a forest holds all smaller ones, and a tree those of less depth.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import SparkSession

from rareflow.operators.drawn import EPSILON, Binned, Tree, draw, saved_model, saved_nodes

#: Cells of all trees that are grown at a time
CELLS_AT_ONCE = 120_000_000
FOREST = (RandomForestClassificationModel, "classification.RandomForestClassificationModel", "classification.DecisionTreeClassificationModel")


@dataclass
class Rules:
    """When a node may be split: the least rows and weight of a child, the least gain, each feature's thresholds and the classes' weights."""

    least: int
    lightest: float
    gains: float
    splits: np.ndarray
    weights: np.ndarray


@dataclass
class Splits:
    """The open nodes of a tree that are split, by number: where, with what gain, and the rows of each class on both sides."""

    node: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    gain: np.ndarray
    sides: np.ndarray
    rows: np.ndarray


def features_of_a_node(estimator, width: int) -> int:
    """How many features a node chooses from, as in MLlib."""
    how = estimator.getFeatureSubsetStrategy()
    if how == "auto":
        how = "all" if estimator.getNumTrees() == 1 else "sqrt"
    return {"all": width, "sqrt": math.ceil(math.sqrt(width)), "log2": max(1, math.ceil(math.log2(width))), "onethird": math.ceil(width / 3)}[how]


def gini(stats: np.ndarray) -> np.ndarray:
    total = stats.sum(axis=-1, keepdims=True)
    return np.where(total[..., 0] > 0, 1.0 - ((stats / np.where(total > 0, total, 1.0)) ** 2).sum(axis=-1), 0.0)


def _drawn_cells(numbers: Sequence[int], seed: int, share: float, again: bool, block: tuple) -> tuple:
    """The block with each tree's drawn cells: which, how many rows of each, and the node that they are in."""
    number, bins, labels, n = block
    mine = {}
    for tree in numbers:
        rng = np.random.default_rng([seed % 2**64, tree, *number])
        if again:
            rows = rng.poisson(share, len(n))
            several = np.flatnonzero(n > 1)
            rows[several] = rng.poisson(share * n[several])
        else:
            rows = draw(n, share, rng).astype(np.int64)
        cells = np.flatnonzero(rows)
        rows = rows[cells]
        mine[tree] = cells.astype(np.int32), rows.astype(np.min_scalar_type(rows.max(initial=0))), np.zeros(len(cells), np.uint8)
    return bins, labels, mine


def _passed_on(splits: dict[int, tuple], block: tuple) -> tuple:
    """The cells in the open nodes of the next level; ``splits`` has by tree the features, cuts and next numbers of the nodes, -1 for none."""
    bins, labels, mine = block
    flat, size, moved = bins.ravel(), bins.shape[1], {}
    for tree, (feature, cut, following) in splits.items():
        cells, rows, slot = mine[tree]
        if len(feature) == 1:
            there = following[(bins[feature[0]][cells] > cut[0]).astype(np.intp)]
        else:
            there = following[2 * slot.astype(np.intp) + (flat[feature[slot] * size + cells] > cut[slot])]
        kept = np.flatnonzero(there >= 0)
        moved[tree] = cells[kept], rows[kept], there[kept].astype(np.min_scalar_type(max(following.max(), 0)))
    return bins, labels, moved


def _counts(asked: dict[int, np.ndarray], most: int, blocks: Iterator[tuple]) -> Iterator[tuple[int, np.ndarray]]:
    """Drawn rows of each class by tree, open node, feature asked and bin, of one block after the other; ``asked`` has each node's features."""
    for bins, labels, mine in blocks:
        flat, size = bins.ravel(), bins.shape[1]
        for tree, features in asked.items():
            cells, rows, slot = mine[tree]
            figures = np.zeros((len(features), features.shape[1], most, 2))
            base, label, weight = slot.astype(np.intp) * (2 * most), labels[cells], rows.astype(float)
            for k in range(features.shape[1]):
                bin_ = bins[features[0, k]][cells] if len(features) == 1 else flat[features[slot, k] * size + cells]
                key = base + 2 * bin_.astype(np.intp) + label
                figures[:, k] = np.bincount(key, weight, len(features) * most * 2).reshape(len(features), most, 2)
            yield tree, figures


def _best(asked: dict[int, np.ndarray], rules: Rules, one: tuple[int, Iterable[np.ndarray]]) -> tuple[int, Splits]:
    """The first of the best splits of each open node of a tree, for those that have one."""
    tree, features, rows = one[0], asked[one[0]], sum(one[1])
    upto = rows.cumsum(axis=2)
    left, all_ = upto[:, :, :-1], upto[:, :, -1:]
    right = all_ - left
    light, heavy, whole = (x * rules.weights for x in (left, right, all_[:, 0, 0]))
    weights = [x.sum(axis=-1) for x in (light, heavy)]
    total = np.maximum(weights[0] + weights[1], np.finfo(float).tiny)
    gain = gini(whole)[:, None, None] - weights[0] / total * gini(light) - weights[1] / total * gini(heavy)
    allowed = (np.arange(left.shape[2]) < rules.splits[features][:, :, None]) & (gain > 0) & (gain >= rules.gains)
    for side, weight in zip((left, right), weights):
        allowed &= (side.sum(axis=-1) >= rules.least) & (weight >= rules.lightest)
    allowed &= (np.abs(gini(whole)) >= EPSILON)[:, None, None]
    gain = np.where(allowed, gain, -np.inf).reshape(len(features), -1)
    best = gain.argmax(axis=1)
    node = np.flatnonzero(gain[np.arange(len(best)), best] > -np.inf)
    k, cut = np.divmod(best[node], left.shape[2])
    sides = np.stack([left[node, k, cut], right[node, k, cut]], axis=1)
    return tree, Splits(node, features[node, k], cut, gain[node, best[node]], sides, all_[:, 0, 0])


def _grown(binned: Binned, numbers: Sequence[int], estimator, depth: int, wanted: int) -> dict[int, tuple[Tree, np.ndarray]]:
    """The trees of these numbers, each with its nodes' drawn rows."""
    width, most, seed = len(binned.thresholds), binned.most, estimator.getSeed()
    weights = np.array(binned.weights)
    weight = float((np.array(binned.rows) * weights).sum())
    rules = Rules(max(estimator.getMinInstancesPerNode(), 1), estimator.getMinWeightFractionPerNode() * weight, estimator.getMinInfoGain(), np.array(list(map(len, binned.thresholds))), weights)
    level, kept = binned.blocks.map(partial(_drawn_cells, numbers, seed, estimator.getSubsamplingRate(), estimator.getBootstrap())), StorageLevel.MEMORY_AND_DISK
    nodes = {t: {"feature": [0], "cut": [0], "child": [0, 0], "gain": [-1.0], "rows": [np.zeros(2)]} for t in numbers}
    open_, before, tasks = {t: [0] for t in numbers}, None, max(1, min(len(numbers), binned.blocks.getNumPartitions()))
    for at in range(max(depth, 1)):
        level = level.persist(kept)
        asked = {}
        for t, mine in open_.items():
            order = np.random.default_rng([seed % 2**64, t, at, 2**32]).random((len(mine), width)).argsort(axis=1)
            asked[t] = np.sort(order[:, :wanted], axis=1)
        found = dict(level.mapPartitions(partial(_counts, asked, most)).groupByKey(tasks).map(partial(_best, asked, rules)).collect())
        if before is not None:
            before.unpersist()
        routes, following = {}, {}
        for t, x in found.items():
            mine = nodes[t]
            if at == 0:
                mine["rows"][0] = x.rows[0]
            if depth == 0 or not len(x.node):
                continue
            feature, cut, next_ = np.zeros(len(open_[t]), np.intp), np.zeros(len(open_[t]), np.intp), np.full(2 * len(open_[t]), -1)
            feature[x.node], cut[x.node] = x.feature, x.cut
            mixed = np.abs(gini(x.sides * weights)) >= EPSILON
            following[t] = []
            for i, slot in enumerate(x.node):
                parent = open_[t][slot]
                mine["feature"][parent], mine["cut"][parent], mine["gain"][parent] = x.feature[i], x.cut[i], x.gain[i]
                for side in (0, 1):
                    new = len(mine["feature"])
                    mine["child"][2 * parent + side] = new
                    for name, value in (("feature", [0]), ("cut", [0]), ("child", [new, new]), ("gain", [-1.0]), ("rows", [x.sides[i, side]])):
                        mine[name] += value
                    if mixed[i, side] and at + 1 < depth:
                        next_[2 * slot + side] = len(following[t])
                        following[t].append(new)
            if following[t]:
                routes[t] = feature, cut, next_
        open_ = {t: following[t] for t in routes}
        if not open_:
            break
        before, level = level, level.map(partial(_passed_on, routes))
    level.unpersist()
    trees = {}
    for t, x in nodes.items():
        rows = np.array(x["rows"])
        columns = [np.array(x[name], np.intp) for name in ("feature", "cut", "child")]
        trees[t] = Tree(*columns, np.array(x["gain"]), rows * weights, depth), rows.sum(axis=1)
    return trees


def fit_forests(estimators: Sequence, binned: Binned, spark: SparkSession) -> list[RandomForestClassificationModel]:
    """``fit`` of each estimator; of those that differ in the number of trees and the depth only, one with the most of both is grown."""
    width, cells = len(binned.thresholds), binned.count()

    def alike(e) -> tuple:
        own = {p.name: v for p, v in e.extractParamMap().items() if p.name not in ("numTrees", "maxDepth")}
        return repr(sorted(own.items())), features_of_a_node(e, width)

    groups = {}
    for e in estimators:
        groups.setdefault(alike(e), []).append(e)
    grown = {}
    for key, some in groups.items():
        most, depth, step = max(e.getNumTrees() for e in some), max(e.getMaxDepth() for e in some), max(1, CELLS_AT_ONCE // cells)
        trees = {}
        for first in range(0, most, step):
            trees |= _grown(binned, range(first, min(first + step, most)), some[0], depth, key[1])
        grown[key] = [trees[t] for t in range(most)]
    models = []
    for e in estimators:
        some = grown[alike(e)][: e.getNumTrees()]
        saved = [saved_nodes(t, binned.thresholds, t.stats.argmax(axis=1), gini(t.stats), rows, e.getMaxDepth()) for t, rows in some]
        models.append(saved_model(spark, e, saved, [1.0] * len(saved), FOREST, "gini", numFeatures=width, numClasses=2))
    return models
