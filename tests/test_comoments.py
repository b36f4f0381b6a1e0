"""The mergeable co-moments against pandas, however the rows are dealt out."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rareflow.operators import comoments, profile
from rareflow.operators.comoments import CoMoments


def frame(seed=3, rows=700):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=rows)
    x = np.stack([a, a * 2 + rng.normal(size=rows), 1e9 + rng.normal(size=rows), rng.integers(0, 2, rows), np.full(rows, 0.1), np.full(rows, np.nan)], axis=1)
    x[rng.random(rows) < 0.2, 1] = np.nan
    x[rng.random(rows) < 0.7, 3] = np.nan
    return x


@pytest.mark.parametrize("cuts", [[], [1], [100, 100, 101, 699], list(range(0, 700, 7))])
def test_states_merge(cuts):
    x = frame()
    state = CoMoments.empty(6)
    for part in np.split(x, cuts):
        if len(part):
            state = state.plus(CoMoments.from_bytes(CoMoments.of(part).to_bytes(), 6))
    state = CoMoments.empty(6).plus(state).plus(CoMoments.empty(6))
    wanted = pd.DataFrame(x - np.array([0, 0, 1e9, 0, 0, 0]))
    assert state.rows == len(x) and state.missing().tolist() == np.isnan(x).sum(axis=0).tolist()
    assert np.array_equal(state.lowest, pd.DataFrame(x).min(), equal_nan=True) and np.array_equal(state.highest, pd.DataFrame(x).max(), equal_nan=True)
    assert np.allclose(state.correlation()[:4, :4], wanted.corr().to_numpy()[:4, :4], atol=1e-9)
    assert np.isnan(state.correlation()[4:]).all() and np.isnan(state.correlation()[:, 4:]).all()
    n = np.diag(state.n)[:4]
    assert np.allclose(np.diag(state.m2)[:4] / (n - 1), wanted.var()[:4]) and np.allclose(np.diag(state.mean)[:4], pd.DataFrame(x).mean()[:4], rtol=1e-14)


def test_one_scan_of_many_partitions(spark):
    x = frame(rows=3_000)
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(v):
        read.add(1)
        return v

    rows = [tuple(None if math.isnan(v) and i == 3 else float(v) for i, v in enumerate(r)) for r in x]
    names = ["a", "b.b", "c", "d", "e", "f"]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names)).repartition(40)
    found = profile.correlation_rows(df.withColumn("a", seen.asNondeterministic()("a"))).collect()
    assert read.value == 3_000 and len(found) == 36
    wanted = pd.DataFrame(x - np.array([0, 0, 1e9, 0, 0, 0]), columns=names).corr()
    for r in found:
        w = wanted.loc[r["a"], r["b"]]
        assert (r["r"] is None) == bool(math.isnan(w) or "e" in (r["a"], r["b"])) and (r["r"] is None or r["r"] == pytest.approx(w, abs=1e-9))


def test_constant_where_the_other_has_values():
    x = np.array([[0.1, 5.0], [0.1, 6.0], [0.1, 8.0], [7.3, np.nan]])
    assert math.isnan(CoMoments.of(x).correlation()[0, 1]) and CoMoments.of(x).correlation()[0, 0] == 1.0


def test_of_nothing(spark):
    nothing = spark.createDataFrame([], "a double, b int")
    assert comoments.co_moments(nothing, ["a", "b"]).rows == 0
    assert [r["r"] for r in profile.correlation_rows(nothing).collect()] == [None] * 4
