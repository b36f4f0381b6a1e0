"""Rows that a tree cannot tell apart, put together as one weighted row before trees are fitted.

MLlib's trees see a feature by at most ``maxBins`` bins only, yet pass over all rows once a level. Where the bins of all features
together have far fewer cells than there are rows, the rows are counted by cell in one shuffle, and the trees are grown from the cells.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareflow.functions.columns import CAST_TO_DOUBLE, col, free_name
from rareflow.session import staged
from rareflow.sources.tables import spread

#: The rows must be at least so many times the possible cells.
ROWS_PER_CELL = 2
#: Of the approximate quantiles; a bin's share of the rows is off by at most two in so many.
ACCURACY = 10_000


def draws_no_rows(estimator) -> bool:
    """Whether the estimator grows trees from all rows, so that a row of weight n is the same as n rows."""
    if not isinstance(estimator, (GBTClassifier, RandomForestClassifier)) or estimator.getSubsamplingRate() < 1:
        return False
    if isinstance(estimator, GBTClassifier):
        return not (estimator.isDefined(estimator.validationIndicatorCol) and estimator.getValidationIndicatorCol())
    return not estimator.getBootstrap()


def weight_of(estimator) -> str | None:
    """The name of the estimator's weight column, if it has one."""
    named = estimator.hasParam("weightCol") and estimator.isDefined(estimator.weightCol)
    return (estimator.getWeightCol() or None) if named else None


def rows_by_cell(rows: DataFrame, features: Sequence[str], estimators: Sequence, by: Sequence[str] = ()) -> DataFrame | None:
    """The number of rows ``(*by, *features, label, weight, n)`` by cell, or None where trees need the rows themselves.

    A feature of at most ``maxBins`` values keeps them. One of more, which MLlib cuts at quantiles of some thousand rows, takes the
    nearest of ``maxBins`` approximate quantiles of all rows; MLlib's thresholds lie halfway between two of them, where the cells meet, so
    the fitted trees divide rows as they divide cells. Quantiles are not weighted, so such features stay as they are where rows have weights.

    It pays only if the cells that are possible are few, whatever the rows are; elsewhere, with missing values too, the answer is None.
    """
    bins, label, weight = ({get(e) for e in estimators} for get in (lambda e: e.getMaxBins() if draws_no_rows(e) else None, lambda e: e.getLabelCol(), weight_of))
    kinds = dict(rows.dtypes)
    if None in bins or len(bins) + len(label) + len(weight) > 3 or any(kinds.get(c) not in CAST_TO_DOUBLE for c in features):
        return None
    bins, label, weight = bins.pop(), label.pop(), weight.pop()
    kept = [*by, label, *([weight] if weight else [])]
    rows = rows.select(*[col(c) for c in kept if c not in features], *[col(c).cast("double").alias(c) for c in features])
    seen = rows.agg(
        F.count("*").alias("n"),
        F.approx_count_distinct(F.struct(*[col(c) for c in kept])).alias("kept"),
        *[F.struct(F.count(col(c)).alias("n"), F.approx_count_distinct(col(c)).alias("values")).alias(f"_{i}") for i, c in enumerate(features)],
    ).first()
    values = [seen[f"_{i}"]["values"] for i in range(len(features))]
    possible = max(seen["kept"], 1) * math.prod(min(v, bins) for v in values)
    if possible * ROWS_PER_CELL > seen["n"] or any(seen[f"_{i}"]["n"] < seen["n"] for i in range(len(features))):
        return None
    nearest = _nearest(rows, features, values, bins)
    if nearest is None or (weight and any(nearest)):
        return None
    cut = {c: near for c, near in zip(features, nearest) if near}
    placed = {c: free_name(rows, f"_bin_{i}") for i, c in enumerate(cut)}
    if cut:
        edges = [[-math.inf, *[math.nextafter((a + b) / 2, math.inf) for a, b in zip(near, near[1:])], math.inf] for near in cut.values()]
        rows = Bucketizer(inputCols=list(cut), outputCols=list(placed.values()), splitsArray=edges).transform(rows)
        rows = rows.withColumns({c: F.element_at(F.lit(near), col(placed[c]).cast("int") + 1) for c, near in cut.items()}).drop(*placed.values())
    number = free_name(rows, "n")
    return staged(rows.groupBy(*[col(c) for c in rows.columns]).agg(F.count("*").alias(number)), "cells")


def _nearest(rows: DataFrame, features: Sequence[str], values: Sequence[int], bins: int) -> list[list[float]] | None:
    """For each feature its approximate quantiles in ascending order, an empty list if it has at most ``bins`` values; None if one is not finite."""
    found = values_or_quantiles(rows, features, values, bins)
    return None if found is None else [[] if exact else near for near, exact in found]


def values_or_quantiles(rows: DataFrame, features: Sequence[str], values: Sequence[int], bins: int) -> list[tuple[list[float], bool]] | None:
    """For each feature its values in ascending order and True if it has at most ``bins``, else as many approximate quantiles and False.

    ``values`` are the numbers of values, about; None if a value is not finite.
    """
    shares = [(i + 0.5) / bins for i in range(bins)]
    few, many = ([i for i, v in enumerate(values) if fits(v)] for fits in (lambda v: v <= 2 * bins, lambda v: v > bins / 2))
    wanted = [F.collect_set(col(features[i])).alias(f"all_{i}") for i in few]
    wanted += [F.percentile_approx(col(features[i]), shares, ACCURACY).alias(f"some_{i}") for i in many]
    found = rows.agg(*wanted).first().asDict()
    near = []
    for i in range(len(features)):
        all_, some = (sorted(set(found.get(f"{name}_{i}") or [])) for name in ("all", "some"))
        exact = bool(all_) and len(all_) <= bins
        if not exact and len(some) < 2 or not all(map(math.isfinite, all_ + some)):
            return None
        near.append((all_ if exact else some, exact))
    return near


def weighted_rows(cells: DataFrame, estimator, least: int = 1) -> tuple[DataFrame, str]:
    """The cells as rows for one estimator, and the name of the column with their weights, which is the estimator's own if it has one.

    A cell of n rows becomes min(n, least) rows of equal weight: a node holds ``least`` of these exactly if it holds so many of the rows.
    """
    number, own = col(cells.columns[-1]), weight_of(estimator)
    name, copy = own or free_name(cells, "cell_weight"), free_name(cells, "cell_copy")
    copies = F.least(number, F.lit(least))
    rows = spread(cells.withColumns({name: number * (col(own) if own else F.lit(1.0)) / copies, copy: copies}).drop(cells.columns[-1]))
    return (rows if least == 1 else rows.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("bigint"), col(copy))))), name


def fit_cells(estimator, scaling: Transformer, cells: DataFrame):
    """The estimator's model of the cells' rows.

    Where a leaf needs several rows, trees are grown without that first. If they are whole, so that nothing was pruned, and every leaf has the rows, each
    split that was best is also the best of those allowed, and the trees are the same; otherwise they are grown again with the rows that count.
    """
    least = estimator.getMinInstancesPerNode()
    model = _fit_weighted(estimator.copy({estimator.minInstancesPerNode: 1}), scaling, cells, 1)
    if least == 1:
        return model
    if not _leaves_hold(model, scaling, cells, estimator.getMaxDepth(), least):
        return _fit_weighted(estimator, scaling, cells, least)
    model.set(model.minInstancesPerNode, least)
    return model


def _fit_weighted(estimator, scaling: Transformer, cells: DataFrame, least: int):
    rows, weight = weighted_rows(cells, estimator, least)
    model = estimator.copy({estimator.weightCol: weight}).fit(scaling.transform(rows))
    if weight_of(estimator) is None:
        model.clear(model.weightCol)
    return model


def _leaves_hold(model, scaling: Transformer, cells: DataFrame, depth: int, least: int) -> bool:
    """Whether all trees are whole down to ``depth`` and every leaf has at least so many rows."""
    if any(tree.numNodes != 2 ** (depth + 1) - 1 for tree in model.trees):
        return False
    if depth == 0:
        return True
    leaf = free_name(cells, "leaf")
    placed = model.copy({model.leafCol: leaf}).transform(scaling.transform(cells))
    leaves = placed.select(col(cells.columns[-1]).alias("n"), F.posexplode(vector_to_array(col(leaf))).alias("tree", "leaf"))
    return leaves.groupBy("tree", "leaf").agg(F.sum("n").alias("n")).agg(F.min("n")).first()[0] >= least
