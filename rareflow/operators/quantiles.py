"""Exact order statistics and quantiles of large columns.

``percentile`` keeps every distinct value of a group in one task. Here values are selected by the digits of an
order-preserving key: one scan counts the values per group, column and leading digit, a second one keeps the
values whose leading digit holds a wanted rank. What is left is narrowed by the digits of its 64-bit keys without the input.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from rareflow.functions.columns import col
from rareflow.session import small_table, staged

ACCURACY = 10_000
#: Leading digits a power of two has; values with one leading digit agree in the key's bits above the lowest ``KEY_BITS``, but for a carry.
DIGITS = 256
KEY_BITS = 44
#: Rows that one task puts in order at most; more are counted by a further digit first.
RANK_TASK_ROWS = 1_000_000
#: Groups times columns whose figures are looked up together; each is a row on the driver.
MOST_CELLS = 100_000


@dataclass(frozen=True)
class OrderStatistic:
    """The value at a rank (from 1), how many values of the group are smaller, and how many there are."""

    value: float
    below: int
    rank: int
    n: int


def leading_digit(value: Column | str) -> Column:
    """A whole number that never falls as the value grows: the binary logarithm in steps of 1/256, with the sign; both zeros are 0."""
    value = F.col(value) if isinstance(value, str) else value
    # logarithms run from -1074 to 1024, and never fall either
    size = F.floor(F.least(F.log2(F.abs(value)), F.lit(1025.0)) * DIGITS) + 1100 * DIGITS
    return F.when(F.isnan(value), F.lit(1 << 40)).when(value == 0, F.lit(0)).otherwise(F.signum(value).cast("long") * size)


def with_key(df: DataFrame) -> DataFrame:
    """``df`` with ``key``, a long that orders the doubles in ``value`` as Spark does: the bits of the number, negated below zero.

    Both zeros are 0, NaN is the largest. Spark has no function for the bits, so they are put together: the exponent is
    estimated by a logarithm and mended by one, and scaling by a power of two is exact. Each step is a column, so none is computed twice.
    """
    size, guess, scaled, value = (F.col(c) for c in ("_size", "_guess", "_scaled", "value"))
    steps = df.select("*", F.abs("value").alias("_size"))
    steps = steps.select("*", F.least(F.greatest(F.floor(F.least(F.log2(size), F.lit(1025.0))), F.lit(-1022)), F.lit(1023)).alias("_guess"))
    steps = steps.select("*", (size / F.pow(F.lit(2.0), guess)).alias("_scaled"))
    lower = (scaled < 1) & (guess > -1022)
    exponent = F.when(scaled >= 2, guess + 1).when(lower, guess - 1).otherwise(guess)
    fraction = F.when(scaled >= 2, scaled / 2).when(lower, scaled * 2).otherwise(scaled)
    # below the smallest normal number the fraction is under 1, and the exponent's bits are borrowed from it
    bits = (exponent + 1022) * F.lit(1 << 52) + (fraction * float(1 << 52)).try_cast("long")
    bits = F.when(size == 0, F.lit(0)).when(size == float("inf"), F.lit(0x7FF << 52)).otherwise(bits)
    steps = steps.select("*", bits.alias("_bits"))
    key = F.when(F.isnan(value), F.lit((0x7FF << 52) + (1 << 51))).when(value < 0, -F.col("_bits")).otherwise(F.col("_bits"))
    return steps.select(*[col(c) for c in df.columns], key.alias("key"))


def digit(key: Column | str, shift: int) -> Column:
    return F.shiftright(key, shift)


def leading_counts(values: DataFrame) -> DataFrame:
    """``(g, position, bucket, n, lo, one)`` of ``values(g, position, value)``, stored: the first of the two scans.

    Buckets are the leading digits, some thousands a group and column; ``one`` says whether a bucket has a single value.
    """
    counted = values.groupBy("g", "position", leading_digit("value").alias("bucket")).agg(*_figures(F.count("*")))
    return staged(counted, "digits")


def _figures(n: Column) -> list[Column]:
    lo, hi = F.min("value"), F.max("value")
    return [n.alias("n"), lo.alias("lo"), lo.eqNullSafe(hi).alias("one")]


def cells_of(counts: DataFrame) -> list[Row]:
    """Group, position and number of values of every column in every group, one row for each; too many groups are an error."""
    cells = counts.groupBy("g", "position").agg(F.sum("n").alias("n")).limit(MOST_CELLS + 1).collect()
    if len(cells) > MOST_CELLS:
        raise ValueError(f"more than {MOST_CELLS} groups and columns: quantiles are for few groups, such as class labels")
    return cells


def owned(df: DataFrame, cells: Sequence[tuple], extra: str = "") -> DataFrame:
    """``df`` with the ``owner`` (the number) of each row's cell; ``cells`` are (group, position) and what ``extra`` names.

    The table of cells has a known size, by which Spark chooses between broadcasting it and a join by shuffle.
    """
    kind = df.schema["g"].dataType.simpleString()
    names = [part.split()[0] for part in extra.split(", ") if part]
    table = small_table(df.sparkSession, [(i, *c) for i, c in enumerate(cells)], ", ".join(x for x in (f"owner int, _g {kind}, _position int", extra) if x))
    same = F.col("g").eqNullSafe(F.col("_g")) & (F.col("position") == F.col("_position"))
    for name in names:
        same = same & (F.col(name[1:]) == F.col(name))
    return df.join(table, same).drop("_g", "_position", *names)


def locate(counted: DataFrame, asked: Sequence[tuple[int, int]]) -> dict[tuple[int, int], Row]:
    """For each (owner, rank) the row of ``counted(owner, bucket, n, lo, one)`` that has the rank, with the number ``below`` it."""
    wanted = small_table(counted.sparkSession, sorted(set(asked)), "owner int, rank bigint")
    upto = Window.partitionBy("owner").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("below", F.sum("n").over(upto) - F.col("n"))
    met = (F.col("below") < F.col("rank")) & (F.col("rank") <= F.col("below") + F.col("n"))
    return {(r["owner"], r["rank"]): r for r in ranked.join(wanted, "owner").where(met).collect()}


def select_inside(
    inside: DataFrame, asked: dict[tuple[int, int], int], rank_task_rows: int = RANK_TASK_ROWS
) -> dict[tuple[int, int], tuple[float, int]]:
    """(value, number below it) for each (owner, rank) among ``inside(owner, key, value, n)``, an owner's values having one leading digit.

    ``asked`` has the number of values of each (owner, rank). A digit has as many bits as a task may rank rows, so a few
    rounds over ever fewer rows end at single keys; owners with few rows end in the first.
    """
    found: dict[tuple[int, int], tuple[float, int]] = {}
    # what was asked for, as it is asked now: (owner, rank) -> owner and rank among the rows left, and how many are below those
    now = {a: (*a, 0) for a in asked}
    shift, most = KEY_BITS, max(asked.values(), default=0)
    while now:
        shift = 0 if most <= rank_task_rows else max(0, shift - max(1, int(math.log2(rank_task_rows))))
        counted = inside.groupBy("owner", digit("key", shift).alias("bucket")).agg(*_figures(F.sum("n")))
        hits = locate(counted, [(owner, rank) for owner, rank, _ in now.values()])
        ahead, targets, most = {}, {}, 0
        for a, (owner, rank, below) in now.items():
            hit = hits[owner, rank]
            if hit["one"] or rank == hit["below"] + 1:
                found[a] = (hit["lo"], below + hit["below"])
                continue
            target = targets.setdefault((owner, hit["bucket"]), len(targets))
            ahead[a] = (target, rank - hit["below"], below + hit["below"])
            most = max(most, hit["n"])
        if ahead:
            rows = [(target, *t) for t, target in targets.items()]
            narrowed = small_table(inside.sparkSession, rows, "target int, _owner int, _bucket bigint")
            same = (F.col("owner") == F.col("_owner")) & (digit("key", shift) == F.col("_bucket"))
            inside = inside.join(narrowed, same).select(F.col("target").alias("owner"), "key", "value", "n")
        now = ahead
    return found


def long_values(df: DataFrame, columns: Sequence[str], by: str | None = None) -> DataFrame:
    """``(g, position, value)``: the columns as doubles in long form, without NULLs."""
    base = df.select(
        (col(by) if by else F.lit(0)).alias("g"), *[col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)]
    )
    values = base.select("g", F.posexplode(F.array(*[f"_{i}" for i in range(len(columns))])).alias("position", "value"))
    return values.where("value is not null")


def order_statistics(
    df: DataFrame,
    columns: Sequence[str],
    ranks: Callable[[int], dict[str, tuple[int, ...]]],
    by: str | None = None,
    rank_task_rows: int = RANK_TASK_ROWS,
) -> dict[tuple, tuple[OrderStatistic, ...]]:
    """``{(group, column, name): statistics}`` for ``ranks(n) -> {name: neighbouring ranks}``.

    Values are taken as doubles, NULLs are left out and NaN counts as the largest. The groups of
    ``by`` must be few, such as class labels: one driver row is kept for each. Two scans of ``df`` at most, at any size.
    """
    values = long_values(df, columns, by)
    counts = leading_counts(values)
    cells = cells_of(counts)
    wanted = {}
    for owner, cell in enumerate(cells):
        for name, some in ranks(cell["n"]).items():
            wanted[owner, name] = tuple(min(max(r, 1), cell["n"]) for r in some)
    if not wanted:
        return {}
    by_digit = owned(counts, [(c["g"], c["position"]) for c in cells])
    hits = locate(by_digit, [(owner, r) for (owner, _), some in wanted.items() for r in some])
    found, targets, ahead = {}, {}, {}
    for (owner, rank), hit in hits.items():
        if hit["one"] or rank == hit["below"] + 1:
            found[owner, rank] = (hit["lo"], hit["below"])
            continue
        target = targets.setdefault((owner, hit["bucket"]), len(targets))
        ahead[target, rank - hit["below"]] = (owner, rank, hit["below"], hit["n"])
    if ahead:
        of_digit = [(cells[owner]["g"], cells[owner]["position"], bucket) for owner, bucket in targets]
        kept = with_key(owned(values.withColumn("bucket", leading_digit("value")), of_digit, "_bucket bigint"))
        inside = staged(kept.groupBy("owner", "key").agg(F.min("value").alias("value"), F.count("*").alias("n")), "inside")
        for a, (value, below) in select_inside(inside, {a: x[3] for a, x in ahead.items()}, rank_task_rows).items():
            owner, rank, before, _ = ahead[a]
            found[owner, rank] = (value, before + below)
    return {
        (cells[owner]["g"], columns[cells[owner]["position"]], name): tuple(
            OrderStatistic(*found[owner, r], r, cells[owner]["n"]) for r in some
        )
        for (owner, name), some in wanted.items()
    }


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: str | None = None,
    interpolate: bool = True,
    rank_task_rows: int = RANK_TASK_ROWS,
) -> dict[tuple, list[float]]:
    """``{(group, column): [quantile, ...]}``: between neighbours when ``interpolate``, else a value of the column."""

    def ranks(n: int) -> dict[str, tuple[int, ...]]:
        if not interpolate:
            return {f"{p}": (math.ceil(p * n),) for p in probabilities}
        places = {p: p * (n - 1) for p in probabilities}
        return {f"{p}": (math.floor(x) + 1, math.ceil(x) + 1) for p, x in places.items()}

    found = order_statistics(df, columns, ranks, by, rank_task_rows)
    result = {}
    for group, column in dict.fromkeys((g, c) for g, c, _ in found):
        row = []
        for p in probabilities:
            first, last = (found[(group, column, f"{p}")][i] for i in (0, -1))
            share = p * (first.n - 1) % 1.0
            equal = first.value == last.value or first.rank == last.rank
            row.append(first.value if equal else first.value + (last.value - first.value) * share)
        result[(group, column)] = row
    return result


def quantile_rows(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: str | None = None,
    interpolate: bool = True,
) -> DataFrame:
    """The exact quantiles as rows ``([by], column, p, value)``."""
    found = exact_quantiles(df, columns, probabilities, by, interpolate)
    rows = [
        (*([group] if by else []), column, float(p), value)
        for (group, column), values in found.items()
        for p, value in zip(probabilities, values)
    ]
    lead = f"`{by}` {df.schema[by].dataType.simpleString()}, " if by else ""
    return small_table(df.sparkSession, rows, f"{lead}column string, p double, value double")


def approximate_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], accuracy: int = ACCURACY
) -> DataFrame:
    """``percentile_approx`` of one column, one row with ``q1, q2, ...``: a single pass, rank error at most n/accuracy."""
    return df.selectExpr(
        *[f"percentile_approx(`{column}`, {p}, {accuracy}) as q{i}" for i, p in enumerate(probabilities, 1)]
    )
