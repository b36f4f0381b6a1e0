"""Projections and column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rareflow.schema import LABEL, WEIGHT

CAST_TO_DOUBLE = ("int", "bigint", "float", "double")


def col(name: str) -> Column:
    """A top-level column, also when its name holds a dot."""
    return F.col(f"`{name}`")


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not hold yet."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def join_groups(left: DataFrame, right: DataFrame, keys: Iterable[str], how: str = "inner") -> DataFrame:
    """A join on group keys in which NULL is a group like any other; the keys stand once, as in ``left``."""
    keys = list(keys)
    named = {k: f"_of_{k}" for k in keys}
    renamed = right.withColumnsRenamed(named)
    same = F.lit(True)
    for k, other in named.items():
        same = same & left[f"`{k}`"].eqNullSafe(renamed[f"`{other}`"])
    return left.join(renamed, same, how).drop(*named.values())


def cast_numbers(df: DataFrame, keep: Iterable[str] = (LABEL,)) -> DataFrame:
    """Every int, bigint, float and double column but ``keep`` as double, in one projection."""
    kept = set(keep)
    return df.select([
        col(name).cast("double").alias(name) if kind in CAST_TO_DOUBLE and name not in kept else col(name)
        for name, kind in df.dtypes
    ])


def feature_columns(df: DataFrame, exclude: Iterable[str] = (LABEL, WEIGHT)) -> list[str]:
    """All columns but the label, the weight and whatever else is excluded."""
    left_out = set(exclude)
    return [name for name in df.columns if name not in left_out]


def log_positive(value: Column) -> Column:
    """Natural logarithm; NULL where the value is not positive."""
    return F.when(value > 0, F.ln(value))


def class_weight(label: Column, ratio: float) -> Column:
    """``ratio`` for positives and its complement for the rest."""
    return F.when(label == 1, F.lit(ratio)).otherwise(F.lit(1.0 - ratio))


def vector_item(name: str, index: int = 1) -> Column:
    """One element of an ML vector column, e.g. the positive class of ``probability``."""
    return vector_to_array(col(name))[index]


def at_threshold(score: Column, threshold: float | Column) -> Column:
    """1.0 where the score reaches the threshold (equality counts), else 0.0."""
    return (score >= threshold).cast("double")
