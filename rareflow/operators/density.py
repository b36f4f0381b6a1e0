"""Histograms and kernel densities."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rareflow.functions.columns import col, join_groups
from rareflow.session import small_table, staged

# exp(-z*z/2) is zero in double precision beyond this distance
KERNEL_REACH = 38.7
#: Width of a cell of values, in bandwidths, and how many powers of the distances from its middle are kept.
CELL, ORDER = 0.5, 12


def _finite(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    return df.select(*by, *[F.nanvl(col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins from minimum to maximum: ``([by], column, bin, lo, hi, n, density)``.

    Each (by, column) has its own range; empty bins are kept and the last bin holds the maximum.
    ``density`` makes the area 1. NULL and NaN are left out. Two passes, the second with a map-side
    count into at most bins x columns x groups rows.
    """
    by = list(by)
    values = _finite(df, columns, by)
    stats = [F.struct(F.min(col(c)), F.max(col(c)), F.count(col(c))).alias(c) for c in columns]
    ranges = []
    for row in values.groupBy(*by).agg(*stats).collect():
        for c in columns:
            lo, hi, n = row[c]
            if n == 0:
                continue
            if not (math.isfinite(lo) and math.isfinite(hi)):
                raise ValueError(f"{c}: the range {lo}..{hi} is not finite")
            if lo == hi:
                lo, hi = lo - 0.5, hi + 0.5
            ranges.append((*[row[b] for b in by], c, lo, hi, (hi - lo) / bins, n))
    group_types = [f"`{b}` {df.schema[b].dataType.simpleString()}" for b in by]
    spec = ", ".join([*group_types, "column string, lo double, hi double, width double, total bigint"])
    table = small_table(df.sparkSession, ranges, spec)

    ids = [*by, "column"]
    long = values.unpivot([col(b) for b in by], [col(c) for c in columns], "column", "value").where("value is not null")
    bin_no = F.least(F.floor((F.col("value") - F.col("lo")) / F.col("width")).cast("int"), F.lit(bins - 1))
    counted = (
        join_groups(long, table, ids).groupBy(*ids, bin_no.alias("bin")).agg(F.count("*").alias("n"))
    )
    return _filled(table, counted, ids, bins)


def _filled(table: DataFrame, counted: DataFrame, ids: Sequence[str], bins: int) -> DataFrame:
    """Every bin of the ranges in ``table(*ids, lo, width, total)`` with its number of values."""
    grid = table.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    n = F.coalesce("n", F.lit(0))
    left = F.col("lo") + F.col("bin") * F.col("width")
    return join_groups(grid, counted, [*ids, "bin"], "left").select(
        *ids,
        "bin",
        left.alias("lo"),
        (left + F.col("width")).alias("hi"),
        n.alias("n"),
        (n / (F.col("total") * F.col("width"))).alias("density"),
    )


def _expansion() -> list[list[float]]:
    """``[j][k]``: the factor of t^j in He_k(t) / k!, where exp(-(t - z)^2 / 2) = exp(-t^2 / 2) * sum over k of He_k(t) / k! * z^k."""
    hermite = [[1.0], [0.0, 1.0]]
    for k in range(1, ORDER - 1):
        above = [0.0, *hermite[k]]
        hermite.append([x - k * (hermite[k - 1][j] if j < k else 0.0) for j, x in enumerate(above)])
    return [[h[j] / math.factorial(k) if j < len(h) else 0.0 for k, h in enumerate(hermite[:ORDER])] for j in range(ORDER)]


def kernel_density(df: DataFrame, column: str, points: int = 200, bins: int = 50) -> DataFrame:
    """Gaussian kernel density of a column on an even grid from its minimum to its maximum.

    Bandwidth: sample deviation times n**(-1/5). A fast Gauss transform: the values are put into cells of half a bandwidth, and a
    cell keeps the sums of the powers of its values' distances from its middle, taken map-side; a cell's kernels are then one
    polynomial times one Gaussian at each grid point that any of them reaches. Powers from the 12th on are left out: as |He_k(t)| exp(-t^2/2)
    is at most 1.1 sqrt(k!) and a distance at most 1/4 bandwidth, the error is below 1e-11 of one kernel's peak for each value, and so
    of the highest density that is possible. ``expected`` is the density scaled to a histogram of ``bins`` bins.
    """
    values = _finite(df, [column], []).where(col(column).isNotNull()).select(col(column).alias("v"))
    n, sd, lo, hi = values.agg(F.count("v"), F.stddev_samp("v"), F.min("v"), F.max("v")).first()
    if n < 2 or not sd or not math.isfinite(sd):
        raise ValueError(f"{column}: a density needs two different finite values")
    bandwidth = sd * n**-0.2
    celled = values.select("v", F.floor((F.col("v") - lo) / (CELL * bandwidth)).alias("cell"))
    z = (F.col("v") - F.lit(lo) - (F.col("cell") + 0.5) * (CELL * bandwidth)) / bandwidth
    moments = celled.select("cell", z.alias("z")).groupBy("cell").agg(*_power_sums())
    return _density_rows(moments, n, bandwidth, lo, hi, points, bins)


def _power_sums() -> list[Column]:
    """Sums of the powers of ``z`` below ``ORDER`` as m0, m1, ..."""
    powers = [F.lit(1.0)]
    for _ in range(1, ORDER):
        powers.append(powers[-1] * F.col("z"))
    return [F.sum(power).alias(f"m{k}") for k, power in enumerate(powers)]


def _density_rows(moments: DataFrame, n: int, bandwidth: float, lo: float, hi: float, points: int, bins: int) -> DataFrame:
    """The density at every grid point from the moments of the cells."""
    width = CELL * bandwidth
    step = (hi - lo) / (points - 1)
    reach = KERNEL_REACH * bandwidth + width

    def at(i):
        return F.lit(lo) + F.lit(hi - lo) * i / F.lit(float(points - 1))

    def middle(cell):
        return F.lit(lo) + (cell + 0.5) * width

    combined = [
        sum((F.col(f"m{k}") * factor for k, factor in enumerate(row) if factor), F.lit(0.0)).alias(f"a{j}") for j, row in enumerate(_expansion())
    ]
    c = middle(F.col("cell"))
    first = F.greatest(F.lit(0), F.ceil((c - reach - lo) / step).cast("int"))
    last = F.least(F.lit(points - 1), F.floor((c + reach - lo) / step).cast("int"))
    near = moments.select(c.alias("c"), *combined, first.alias("i0"), last.alias("i1")).where("i0 <= i1")
    met = near.select("c", *[f"a{j}" for j in range(ORDER)], F.explode(F.sequence("i0", "i1")).alias("i"))
    met = met.withColumn("t", (at(F.col("i")) - F.col("c")) / bandwidth)
    polynomial = F.col(f"a{ORDER - 1}")
    for j in reversed(range(ORDER - 1)):
        polynomial = polynomial * F.col("t") + F.col(f"a{j}")
    sums = met.groupBy("i").agg(F.sum(polynomial * F.exp(-0.5 * F.col("t") * F.col("t"))).alias("s"))
    grid = moments.sparkSession.range(points).select(F.col("id").cast("int").alias("i"))
    density = F.greatest(F.coalesce("s", F.lit(0.0)), F.lit(0.0)) / (n * bandwidth * math.sqrt(2 * math.pi))
    return grid.join(F.broadcast(sums), "i", "left").select(
        "i",
        at(F.col("i")).alias("x"),
        density.alias("density"),
        (density * n * ((hi - lo) / bins)).alias("expected"),
    )


def distributions(
    df: DataFrame, figures: Mapping[str, tuple[int, float, float, float]], points: int = 200, bins: int = 50
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The histogram of several columns and the kernel density of each, from one scan.

    ``figures`` has the number of values, the sample deviation, minimum and maximum by column. Values are counted by histogram bin and
    density cell together, map-side, with the powers of their distances from the cell's middle; both results add up those sums, which are stored.
    """
    rows = []
    for c, (n, sd, lo, hi) in figures.items():
        if n < 2 or not sd or not math.isfinite(sd):
            raise ValueError(f"{c}: a density needs two different finite values")
        rows.append((c, lo, hi, (hi - lo) / bins, n, sd * n**-0.2))
    table = small_table(df.sparkSession, rows, "column string, lo double, hi double, width double, total bigint, bandwidth double")
    names = [col(c) for c in figures]
    long = _finite(df, list(figures), []).unpivot([], names, "column", "value").where("value is not null")
    above = F.col("value") - F.col("lo")
    placed = join_groups(long, table, ["column"]).select(
        "column",
        F.least(F.floor(above / F.col("width")).cast("int"), F.lit(bins - 1)).alias("bin"),
        above.alias("above"),
        F.floor(above / (CELL * F.col("bandwidth"))).alias("cell"),
        "bandwidth",
    )
    z = (F.col("above") - (F.col("cell") + 0.5) * (CELL * F.col("bandwidth"))) / F.col("bandwidth")
    sums = placed.select("column", "bin", "cell", z.alias("z")).groupBy("column", "bin", "cell").agg(F.count("*").alias("n"), *_power_sums())
    sums = staged(sums, "cells")
    binned = _filled(table, sums.groupBy("column", "bin").agg(F.sum("n").alias("n")), ["column"], bins)
    densities = {}
    for c, lo, hi, _, n, bandwidth in rows:
        moments = sums.where(F.col("column") == c).groupBy("cell").agg(*[F.sum(f"m{k}").alias(f"m{k}") for k in range(ORDER)])
        densities[c] = _density_rows(moments, n, bandwidth, lo, hi, points, bins)
    return binned, densities
