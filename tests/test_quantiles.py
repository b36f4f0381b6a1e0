import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rareflow.operators import quantiles
from rareflow.operators.running import running_totals


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.sampled_from([0.0, 1.0, 1.5, -3.0, 1e9]) | st.floats(-1e6, 1e6), min_size=1, max_size=60),
    p=st.sampled_from([0.0, 0.25, 0.5, 0.9, 1.0]),
)
def test_small_columns(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert quantiles.exact_quantiles(df, ["v"], [p])[(0, "v")][0] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-9)
    lower = sorted(values)[max(math.ceil(p * len(values)), 1) - 1]
    assert quantiles.exact_quantiles(df, ["v"], [p], interpolate=False)[(0, "v")] == [lower]


@pytest.fixture(scope="module")
def skewed(spark):
    """30,000 rows, a third of them with one value, in two groups."""
    rng = np.random.default_rng(3)
    v = np.where(rng.random(30_000) < 1 / 3, 7.25, rng.lognormal(2, 2, 30_000))
    return v, spark.createDataFrame([(int(i % 2), float(x), float(-x)) for i, x in enumerate(v)], "g int, v double, w double").repartition(6)


@pytest.mark.parametrize("limit", [1_000_000, 150, 3])
def test_digit_by_digit(skewed, limit):
    v, df = skewed
    found = quantiles.exact_quantiles(df, ["v", "w"], (0.01, 0.25, 0.5, 0.999), by="g", rank_task_rows=limit)
    for g in (0, 1):
        assert found[(g, "v")] == pytest.approx(np.quantile(v[g::2], (0.01, 0.25, 0.5, 0.999)).tolist(), rel=1e-12)
        assert found[(g, "w")] == pytest.approx(np.quantile(-v[g::2], (0.01, 0.25, 0.5, 0.999)).tolist(), rel=1e-12)


def test_two_scans_however_many_digits(spark, skewed, tmp_path):
    """The input is read once per scan; with room for two rows a task, every further digit is taken from the stored rest."""
    v, df = skewed
    path = f"{tmp_path}/skewed"
    df.write.parquet(path)
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(x):
        read.add(1)
        return x

    counted = spark.read.parquet(path).select("g", seen.asNondeterministic()("v").alias("v"))
    found = quantiles.exact_quantiles(counted, ["v"], (0.01, 0.25, 0.5, 0.9, 0.999), by="g", rank_task_rows=2)
    assert found[(0, "v")] == pytest.approx(np.quantile(v[0::2], (0.01, 0.25, 0.5, 0.9, 0.999)).tolist(), rel=1e-12)
    assert read.value == 2 * len(v)
    read.value = 0
    assert quantiles.exact_quantiles(counted.withColumn("v", F.floor("v") % 3 * 1e9), ["v"], (0.5,))
    assert read.value == len(v)  # each leading digit has a single value, so one scan tells all


def test_keys_order_doubles(spark):
    rng = np.random.default_rng(8)
    values = rng.integers(-(2**63), 2**63 - 1, 4_000).view(np.float64)
    edges = [0.0, -0.0, 1.0, 2.0, 0.5, 3.0, 1e308, 1.7976931348623157e308, 2.2250738585072014e-308, 2.225073858507201e-308, 5e-324, 1e-310, math.inf]
    values = np.concatenate([values[~np.isnan(values)], edges, -np.array(edges), np.nextafter(2.0 ** np.arange(-40, 40), 0), 2.0 ** np.arange(-1074, 1024)])
    df = spark.createDataFrame([(float(x),) for x in values] + [(math.nan,)], "value double")
    df = quantiles.with_key(df).select(F.col("value").alias("v"), F.col("key").alias("k"), quantiles.leading_digit("value").alias("digit"))
    found = {r["v"]: r["k"] for r in df.collect()}
    digits = [r["digit"] for r in df.orderBy("k").collect()]
    assert digits == sorted(digits)
    ordered = [found[x] for x in sorted({float(x) for x in values})]
    assert all(a < b for a, b in zip(ordered, ordered[1:])) and max(ordered) < df.where("isnan(v)").first()["k"]
    for x in values:
        bits = int(np.array([abs(x)]).view(np.int64)[0])
        assert found[float(x)] == (-bits if x < 0 else bits)


def test_too_many_groups(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "MOST_CELLS", 50)
    with pytest.raises(ValueError, match="few groups"):
        quantiles.exact_quantiles(spark.range(60).selectExpr("id as g", "double(id) as v"), ["v"], (0.5,), by="g")


def test_order_statistics_count_below(spark):
    df = spark.createDataFrame([(float(x),) for x in (5, 1, 5, 5, 2, 9)], "v double")
    (found,) = quantiles.order_statistics(df, ["v"], lambda n: {"x": (4,)})[(0, "v", "x")]
    assert (found.value, found.below, found.rank, found.n) == (5.0, 2, 4, 6)


def test_missing_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (2.0,)], "v double")
    low, high = quantiles.exact_quantiles(df, ["v"], (0.0, 1.0), interpolate=False)[(0, "v")]
    assert low == 1.0 and math.isnan(high)
    empty = df.where("v is null")
    assert quantiles.exact_quantiles(empty, ["v"], (0.5,)) == {}


def test_quantile_rows_and_approximation(spark, labelled):
    rows = quantiles.quantile_rows(labelled, ["a"], (0.5,), by="Class").collect()
    assert [sorted(r.asDict()) for r in rows] == [["Class", "column", "p", "value"]] * 2
    approximate = quantiles.approximate_quantiles(labelled, "a", (0.25, 0.75)).first()
    exact = quantiles.exact_quantiles(labelled, ["a"], (0.25, 0.75), interpolate=False)[(0, "a")]
    assert list(approximate) == exact


@pytest.mark.parametrize("rows_per_task", [10**6, 70])
def test_running_totals(spark, rows_per_task):
    rng = np.random.default_rng(5)
    keys = np.unique(np.concatenate([rng.normal(size=900), rng.normal(scale=1e-6, size=900)]))
    data = [(m, float(k), int(n)) for m in ("x", "y") for k, n in zip(keys, rng.integers(0, 9, len(keys)))]
    df = spark.createDataFrame(data, "m string, k double, n bigint")
    found = running_totals(df, "k", ["n"], ["m"], rows_per_task).toPandas()
    for m in ("x", "y"):
        mine = found[found.m == m].sort_values("k", ascending=False)
        assert mine.cum_n.tolist() == mine.n.cumsum().tolist()
        assert set(mine.all_n) == {mine.n.sum()} and len(mine) == len(keys)
