"""NULL groups, labels beyond 0 and 1, and plans that do not depend on the size."""

import pytest
from pyspark.sql import functions as F

from rareflow.operators import balance, curves, density, thresholds
from rareflow.plans.prepare import prepare


@pytest.fixture(scope="module")
def two_groups(spark):
    rows = [(m, i / 30, int(i % 3 == 0)) for m in ("x", None) for i in range(30)]
    return spark.createDataFrame(rows, "model string, score double, Class int")


@pytest.mark.parametrize("rows_per_task", [10**6, 5])
def test_curves_keep_a_null_group(two_groups, rows_per_task):
    points = curves.curve_points(two_groups, by=["model"], rows_per_task=rows_per_task)
    counts = {r["model"]: r["count"] for r in points.groupBy("model").count().collect()}
    assert counts == {"x": 30, None: 30}
    found = {r["model"]: r.asDict() for r in curves.compare_scores(two_groups, rows_per_task=rows_per_task).collect()}
    assert {k: v for k, v in found["x"].items() if k != "model"} == {k: v for k, v in found[None].items() if k != "model"}


def test_histogram_and_sweep_keep_a_null_group(two_groups):
    bins = density.histogram(two_groups, ["score"], bins=5, by=["model"])
    assert {r["model"]: r["n"] for r in bins.groupBy("model").agg(F.sum("n").alias("n")).collect()} == {"x": 30, None: 30}
    sweep = thresholds.threshold_sweep(two_groups, by=["model"], thresholds=[0.5]).collect()
    assert len({(r["tp"], r["fp"], r["fn"]) for r in sweep}) == 1
    assert len(sweep) == 2 and sweep[0]["tp"] > 0


def test_a_density_counts_equal_values_once(spark):
    values = [1.0] * 50 + [2.0] * 30 + [4.0]
    one = spark.createDataFrame([(v,) for v in values], "v double")
    found = density.kernel_density(one, "v", points=7).orderBy("i").collect()
    import numpy as np

    bandwidth = np.std(values, ddof=1) * len(values) ** -0.2
    for r in found:
        expected = np.exp(-0.5 * ((r["x"] - np.array(values)) / bandwidth) ** 2).sum() / (len(values) * bandwidth * np.sqrt(2 * np.pi))
        assert abs(r["density"] - expected) < 1e-12


def test_prepare_counts_every_label(spark, tmp_path):
    rows = [(float(i), None if i % 10 == 0 else 2 if i % 10 == 1 else i % 2) for i in range(200)]
    raw = spark.createDataFrame(rows, "V1 double, Class int")
    raw.union(raw.limit(7)).write.parquet(str(tmp_path / "raw"))
    stats = prepare(spark, str(tmp_path / "raw"), str(tmp_path / "out"), source_format="parquet").collect()
    total = {}
    for r in stats:
        total[r["stage"]] = total.get(r["stage"], 0) + r["n"]
    assert total["rows_in"] == 207 and total["rows_dedup"] == 200 and total["train"] + total["test"] == 200
    assert {r["Class"] for r in stats} == {0, 1, 2, None}


def test_other_labels_are_an_error(spark):
    df = spark.createDataFrame([(0,), (1,), (2,)], "Class int")
    for use in (lambda: balance.positive_ratio(df), lambda: balance.with_class_weights(df)):
        with pytest.raises(ValueError, match="no others"):
            use()


def test_a_density_of_skewed_values_is_within_its_bound(spark):
    """Heavy tails and clusters, cells far apart, against the sum over all values."""
    import math

    import numpy as np

    rng = np.random.default_rng(4)
    values = np.concatenate([rng.lognormal(0, 2, 3_000), np.repeat(5.0, 500), rng.normal(400, 0.01, 700), -rng.pareto(1.5, 800)])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (math.nan,)], "v double").repartition(5)
    h = values.std(ddof=1) * len(values) ** -0.2
    peak = 1 / (h * math.sqrt(2 * math.pi))
    for r in density.kernel_density(df, "v", points=90).collect():
        wanted = np.exp(-0.5 * ((r["x"] - values) / h) ** 2).mean() * peak
        assert abs(r["density"] - wanted) < 1e-11 * peak
