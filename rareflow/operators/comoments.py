"""Counts, means, deviations and co-moments of all pairs of columns, from one scan.

Spark's own two-column aggregates need a buffer and generated code for each pair, hundreds at the width of a card table, and a Gram
matrix needs complete rows and a pass for the means. Here a task folds its batches into one state of a few small matrices; states are
mergeable, so they are merged in two shuffled steps.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareflow.functions.columns import col

#: Tasks that merge the states of all others; one merges theirs.
MERGERS = 16
#: Rows whose moments are taken together.
BLOCK_ROWS = 8_192
#: A deviation below this part of the second moment is rounding: the column is constant there.
ROUNDING = 1e-14


@dataclass
class CoMoments:
    """Of d columns, with NaN taken as missing.

    ``rows`` is the number of rows; ``lowest``, ``highest`` and ``base``, any value, are by column (NaN without a value). The others are
    d x d: at [a, b] they are over the rows where both columns have a value: their number ``n``, the mean of a less its base (``above``, so
    that means that differ little lose no digits), its sum of squared deviations ``m2``, and the sum ``c`` of the products of both
    deviations.
    """

    rows: int
    lowest: np.ndarray
    highest: np.ndarray
    base: np.ndarray
    n: np.ndarray
    above: np.ndarray
    m2: np.ndarray
    c: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return self.base[:, None] + self.above

    @classmethod
    def empty(cls, d: int) -> CoMoments:
        return cls(0, *(np.full(d, np.nan) for _ in range(3)), *(np.zeros((d, d)) for _ in range(4)))

    @classmethod
    def of(cls, x: np.ndarray) -> CoMoments:
        """From a block of rows with at least one; about each column's mean, so that little cancels."""
        there = ~np.isnan(x)
        counts = there.sum(axis=0)
        bare = np.where(there, x, np.inf).min(axis=0), np.where(there, x, -np.inf).max(axis=0)
        lowest, highest = (np.where(counts > 0, b, np.nan) for b in bare)
        # first about a value of the column: a constant one is then exactly zero
        base = np.where(counts > 0, x[np.argmax(there, axis=0), np.arange(x.shape[1])], np.nan)
        y = np.where(there, x - base, 0.0)
        middle = y.sum(axis=0) / np.maximum(counts, 1)
        y = np.where(there, y - middle, 0.0)
        if there.all():
            n = np.full((x.shape[1],) * 2, float(len(x)))
            sums = np.repeat(y.sum(axis=0)[:, None], x.shape[1], axis=1)
            squares = np.repeat((y * y).sum(axis=0)[:, None], x.shape[1], axis=1)
        else:
            p = there.astype(np.float64)
            n, sums, squares = p.T @ p, y.T @ p, (y * y).T @ p
        some = np.maximum(n, 1)
        m2 = squares - sums * sums / some
        m2[m2 <= ROUNDING * squares] = 0.0
        return cls(len(x), lowest, highest, base, n, middle[:, None] + sums / some, m2, y.T @ y - sums * sums.T / some)

    def plus(self, other: CoMoments) -> CoMoments:
        """The state of both sets of rows."""
        n = self.n + other.n
        some = np.maximum(n, 1)
        base = np.where(np.isnan(self.base), other.base, self.base)
        mine, others = (np.where(x.n > 0, (x.base - base)[:, None] + x.above, 0.0) for x in (self, other))
        apart = np.where((self.n > 0) & (other.n > 0), others - mine, 0.0)
        both = self.n * other.n / some
        return CoMoments(
            self.rows + other.rows,
            np.fmin(self.lowest, other.lowest),
            np.fmax(self.highest, other.highest),
            base,
            n,
            np.where(self.n > 0, mine, others) + apart * other.n / some,
            self.m2 + other.m2 + apart * apart * both,
            self.c + other.c + apart * apart.T * both,
        )

    def to_bytes(self) -> bytes:
        parts = [np.array([self.rows], dtype=np.float64), self.lowest, self.highest, self.base, *(m.ravel() for m in (self.n, self.above, self.m2, self.c))]
        return np.concatenate(parts).astype("<f8").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes, d: int) -> CoMoments:
        numbers = np.frombuffer(raw, dtype="<f8")
        return cls(int(numbers[0]), *numbers[1 : 1 + 3 * d].reshape(3, d), *numbers[1 + 3 * d :].reshape(4, d, d))

    def missing(self) -> np.ndarray:
        """How many rows have no value, by column."""
        return self.rows - np.diag(self.n).astype(np.int64)

    def figures(self, i: int) -> tuple[int, float, float, float, float]:
        """Number of values, mean, sample deviation, minimum and maximum of a column; NaN where there are too few values."""
        n = int(self.n[i, i])
        deviation = float(np.sqrt(self.m2[i, i] / (n - 1))) if n > 1 else math.nan
        return n, float(self.mean[i, i]) if n else math.nan, deviation, float(self.lowest[i]), float(self.highest[i])

    def correlation(self) -> np.ndarray:
        """Pearson correlations over the rows where both columns have values; NaN where one of them does not vary."""
        varies = (self.m2 > 0) & (self.lowest != self.highest)[:, None]
        varies &= varies.T
        with np.errstate(invalid="ignore", divide="ignore"):
            r = self.c / (np.sqrt(self.m2) * np.sqrt(self.m2.T))
        return np.where(varies, np.clip(r, -1.0, 1.0), np.nan)


def co_moments(df: DataFrame, columns: Sequence[str]) -> CoMoments:
    """The co-moments of numeric columns of ``df``, read once; one state a task is shuffled, and the last one comes to the driver."""
    d = len(columns)
    numbers = df.select([col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = CoMoments.empty(d)
        with np.errstate(invalid="ignore"):
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK_ROWS):
                    block = batch.slice(at, BLOCK_ROWS)
                    x = np.stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in block.columns], axis=1)
                    state = state.plus(CoMoments.of(x))
        yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "state": [state.to_bytes()]}, STATE)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = CoMoments.empty(d)
        with np.errstate(invalid="ignore"):
            for batch in batches:
                for raw in batch.column("state").to_pylist():
                    state = state.plus(CoMoments.from_bytes(raw, d))
        yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "state": [state.to_bytes()]}, STATE)

    schema = "part int, state binary"
    states = numbers.mapInArrow(fold, schema).repartition(MERGERS, "part").sortWithinPartitions("part").mapInArrow(merge, schema)
    last = states.repartition(1).sortWithinPartitions("part").mapInArrow(merge, schema).agg(F.max("state").alias("state")).first()["state"]
    return CoMoments.empty(d) if last is None else CoMoments.from_bytes(bytes(last), d)


STATE = pa.schema([("part", pa.int32()), ("state", pa.binary())])
