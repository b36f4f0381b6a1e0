"""Class balance: undersampling, weights, union, and outliers among the positives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rareflow.functions.columns import class_weight, col
from rareflow.functions.hashing import hash_fraction
from rareflow.operators.profile import class_count_map
from rareflow.operators.quantiles import approximate_quantiles, exact_quantiles
from rareflow.schema import LABEL, WEIGHT
from rareflow.session import small_table

IQR_REACH = 1.5


def union_all(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both, duplicates kept, columns matched by name."""
    return first.unionByName(second)


def positive_ratio(df: DataFrame, label: str = LABEL) -> float:
    """Positives per negative."""
    counts = _two_classes(df, label)
    return counts[1] / counts[0]


def _two_classes(df, label):
    """Counts by class; any label but 0 and 1, a missing one too, is an error, as in the curves."""
    counts = class_count_map(df, label)
    if set(counts) != {0, 1}:
        raise ValueError(f"{label} needs rows of both classes 0 and 1 and no others, found {counts}")
    return counts


def undersample(df: DataFrame, h: Column, label: str = LABEL, fraction: float | None = None) -> DataFrame:
    """All positives, and each negative whose hash falls below positives/negatives.

    One count and one filter; the kept rows do not depend on the partitioning. With more positives than negatives
    every negative stays.
    """
    share = positive_ratio(df, label) if fraction is None else fraction
    return df.where((col(label) == 1) | ((col(label) == 0) & (hash_fraction(h) < share)))


def undersample_random(df: DataFrame, label: str = LABEL, seed: int = 42, by_rand: bool = True) -> DataFrame:
    """Undersampling by a seeded generator: ``rand`` in a filter, or ``sample``; depends on the partitioning."""
    share = positive_ratio(df, label)
    negatives = df.where(col(label) == 0)
    kept = negatives.where(F.rand(seed) < share) if by_rand else negatives.sample(fraction=share, seed=seed)
    return union_all(df.where(col(label) == 1), kept)


def with_class_weights(df: DataFrame, label: str = LABEL, weight: str = WEIGHT) -> tuple[DataFrame, dict]:
    """Weights that give both classes the same total, and the class counts."""
    counts = _two_classes(df, label)
    positives, total = counts[1], sum(counts.values())
    return df.withColumn(weight, class_weight(col(label), (total - positives) / total)), counts


def with_unit_weight(df: DataFrame, weight: str = WEIGHT) -> DataFrame:
    return df.withColumn(weight, F.lit(1.0))


def _outside(column: str, lower: float, upper: float) -> Column:
    return (col(column) > upper) | (col(column) < lower)


def iqr_fences(
    df: DataFrame, columns: Sequence[str], label: str = LABEL, exact: bool = True
) -> list[tuple[str, float, float, int, int]]:
    """``(column, lower, upper, removed, removed_missing)`` for the positives, one column after the other.

    Each column's quartiles are taken over the positives the columns before it have left. Only the positives and these
    columns are read, and kept between the steps.
    """
    positives = df.where(col(label) == 1).select(*[col(c) for c in columns]).persist()
    left, fences = positives, []
    try:
        for c in columns:
            if exact:
                quartiles = next(iter(exact_quantiles(left, [c], (0.25, 0.75), interpolate=False).values()), None)
            else:
                quartiles = approximate_quantiles(left, c, (0.25, 0.75)).first()
            if quartiles is None or quartiles[0] is None:
                raise ValueError(f"no positive has a value in {c}")
            q1, q3 = map(float, quartiles)
            lower, upper = q1 - IQR_REACH * (q3 - q1), q3 + IQR_REACH * (q3 - q1)
            outside = _outside(c, lower, upper)
            counts = left.agg(F.count_if(outside | col(c).isNull()), F.count_if(col(c).isNull())).first()
            fences.append((c, lower, upper, *counts))
            left = left.where(F.coalesce(~outside, F.lit(False)))
        return fences
    finally:
        positives.unpersist()


def drop_outside(df: DataFrame, fences: Sequence[tuple], label: str = LABEL) -> DataFrame:
    """Positives outside a fence, or without a value, are dropped; every negative stays. One narrow pass."""
    keep = F.lit(True)
    for column, lower, upper, *_ in fences:
        keep = keep & ~((col(label) == 1) & _outside(column, lower, upper))
    return df.where(keep)


def drop_positive_outliers(
    df: DataFrame, columns: Sequence[str], label: str = LABEL, exact: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The cleaned table, and the fences as rows."""
    fences = iqr_fences(df, columns, label, exact)
    report = small_table(
        df.sparkSession,
        fences,
        "column string, lower double, upper double, removed bigint, removed_missing bigint",
    )
    return drop_outside(df, fences, label), report
