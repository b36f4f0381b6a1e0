"""Running totals over one global order, without sending the whole order to one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import QuantileDiscretizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rareflow.functions.columns import join_groups
from rareflow.session import cut_lineage

ROWS_PER_TASK = 1_000_000


def running_totals(
    rows: DataFrame,
    key: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Adds ``cum_<s>`` (total from the highest key down to this row) and ``all_<s>`` (total of the group).

    ``rows`` must hold one row per (by, key), i.e. be aggregated already. It is written once to the
    shared checkpoint folder, because its size sets the number of ranges and later passes read it again.

    The key is cut into ranges of about ``rows_per_task`` rows at its approximate quantiles, each range gets its own window, and the
    totals of the higher ranges (one row per range and group) are added as offsets. Wherever the cuts
    fall, the result is exact. A NULL in ``by`` is a group of its own.
    """
    rows = cut_lineage(rows)
    n = rows.count()
    if n == 0:  # no quantiles to cut at
        nothing = [F.lit(None).cast("bigint").alias(f"{kind}_{s}") for kind in ("cum", "all") for s in sums]
        return rows.select("*", *nothing)
    return _windows_by_range(rows, key, sums, by, math.ceil(n / rows_per_task) + 1)


def _windows_by_range(rows, key, sums, by, ranges):
    cutter = QuantileDiscretizer(
        inputCol=key,
        outputCol="_range",
        numBuckets=max(2, ranges),
        relativeError=0.25 / ranges,
        handleInvalid="keep",  # NaN gets the highest range, as it sorts above all numbers
    )
    ranged = cutter.fit(rows).transform(rows)
    group = Window.partitionBy(*by)
    higher = group.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*by, "_range").agg(*[F.sum(s).alias(f"_{s}") for s in sums])
    offsets = totals.select(
        *by,
        "_range",
        *[F.coalesce(F.sum(f"_{s}").over(higher), F.lit(0)).alias(f"_above_{s}") for s in sums],
        *[F.sum(f"_{s}").over(group).alias(f"all_{s}") for s in sums],
    )
    inside = Window.partitionBy(*by, "_range").orderBy(F.desc(key))
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return join_groups(ranged, offsets, [*by, "_range"]).select(
        *rows.columns,
        *[(F.col(f"_above_{s}") + F.sum(s).over(inside)).alias(f"cum_{s}") for s in sums],
        *[F.col(f"all_{s}") for s in sums],
    )
