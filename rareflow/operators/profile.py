"""Counts, summaries, correlations and box-plot figures of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rareflow.functions.columns import col
from rareflow.operators.comoments import CoMoments, co_moments
from rareflow.operators.quantiles import exact_quantiles
from rareflow.schema import LABEL
from rareflow.session import small_table

WHISKER = 1.5


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def class_counts(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows per class with the total; the second step only sees one row per class."""
    return (
        df.groupBy(label).agg(F.count("*").alias("n")).withColumn("total", F.sum("n").over(Window.partitionBy()))
    )


def class_count_map(df: DataFrame, label: str = LABEL) -> dict:
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}


def distinct_rows(df: DataFrame) -> DataFrame:
    """NULLs are equal to each other here, so are NaNs, and so are 0.0 and -0.0."""
    return df.dropDuplicates()


def describe_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per numeric column: count, mean, sample deviation, minimum and maximum as doubles, in one pass."""
    names = list(columns or numeric_columns(df))
    figures = {"n": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.agg(*[
        F.struct(
            F.lit(name).alias("column"),
            *[(f(col(name)) if k == "n" else f(col(name)).cast("double")).alias(k) for k, f in figures.items()],
        ).alias(f"_{i}")
        for i, name in enumerate(names)
    ])
    return wide.select(F.inline(F.array(*[f"_{i}" for i in range(len(names))])))


def describe_text(df: DataFrame) -> DataFrame:
    """The summary as text, string columns included."""
    return df.describe()


def correlation_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every ordered pair as rows ``(a, b, r)``; NULL for a constant column.

    One scan, whatever is missing: each pair uses the rows where both columns have a value, and NaN counts as missing.
    """
    names = list(columns or numeric_columns(df))
    return correlations_of(df.sparkSession, co_moments(df, names), names)


def correlations_of(spark: SparkSession, moments: CoMoments, names: Sequence[str]) -> DataFrame:
    """``correlation_rows`` of co-moments whose first columns are ``names``."""
    matrix = moments.correlation()[: len(names), : len(names)]
    rows = [(a, b, None if r != r else float(r)) for a, line in zip(names, matrix) for b, r in zip(names, line)]
    return small_table(spark, rows, "a string, b string, r double")


def summary_of(spark: SparkSession, moments: CoMoments, names: Sequence[str]) -> DataFrame:
    """``describe_columns`` of co-moments whose first columns are ``names``; NaN counts as missing."""
    rows = [(c, *(None if x != x else x for x in moments.figures(i))) for i, c in enumerate(names)]
    return small_table(spark, rows, "column string, n bigint, mean double, stddev double, min double, max double")


def colour_range(*matrices: DataFrame) -> DataFrame:
    """Smallest and largest correlation over several matrices, for one shared scale."""
    every = matrices[0]
    for m in matrices[1:]:
        every = every.unionByName(m)
    return every.agg(F.min("r").alias("vmin"), F.max("r").alias("vmax"))


def label_correlations(matrix: DataFrame, label: str = LABEL, k: int = 5) -> DataFrame:
    """The k columns most positively and the k most negatively correlated with the label."""
    with_label = matrix.where((F.col("b") == label) & (F.col("a") != label) & F.col("r").isNotNull())
    ends = []
    for side, order in (("positive", F.desc("r")), ("negative", F.asc("r"))):
        place = F.row_number().over(Window.orderBy(order, "a"))
        ends.append(with_label.select(F.lit(side).alias("side"), place.alias("place"), F.col("a").alias("column"), "r"))
    return ends[0].unionByName(ends[1]).where(F.col("place") <= k)


def _with_fences(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Values in long form, each beside its group's quartiles and 1.5 IQR fences."""
    quartiles = exact_quantiles(df, columns, (0.25, 0.5, 0.75), by)
    rows = []
    for (group, column), (q1, median, q3) in quartiles.items():
        reach = WHISKER * (q3 - q1)
        rows.append((group, column, q1, median, q3, q1 - reach, q3 + reach))
    kind = df.schema[by].dataType.simpleString()
    fences = small_table(
        df.sparkSession,
        rows,
        f"g {kind}, c string, q1 double, median double, q3 double, lower double, upper double",
    )
    values = df.select(by, *[col(c).cast("double").alias(c) for c in columns]).unpivot(
        by, [col(c) for c in columns], "column", "value"
    )
    same = F.col(by).eqNullSafe(F.col("g")) & (F.col("column") == F.col("c"))
    return values.where(F.col("value").isNotNull()).join(fences, same).drop("g", "c")


def boxplot_rows(df: DataFrame, columns: Sequence[str], by: str = LABEL) -> DataFrame:
    """Quartiles, whiskers and outlier count of each column in each class."""
    inside = F.when(F.col("value").between(F.col("lower"), F.col("upper")), F.col("value"))
    quartiles = ("q1", "median", "q3")
    return (
        _with_fences(df, columns, by)
        .groupBy(by, "column", *quartiles)
        .agg(
            F.least(F.min(inside), F.col("q1")).alias("whisker_low"),
            F.greatest(F.max(inside), F.col("q3")).alias("whisker_high"),
            F.count("*").alias("n"),
            F.count_if(inside.isNull()).alias("outliers"),
        )
    )


def boxplot_outliers(df: DataFrame, columns: Sequence[str], by: str = LABEL) -> DataFrame:
    """The values beyond the fences, as rows ``(by, column, value)``."""
    fenced = _with_fences(df, columns, by)
    return fenced.where(~F.col("value").between(F.col("lower"), F.col("upper"))).select(by, "column", "value")
