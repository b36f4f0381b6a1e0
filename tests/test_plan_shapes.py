"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

from rareflow.functions.hashing import row_hash
from rareflow.operators import balance, curves, density, models, profile, split, thresholds
from rareflow.session import staged

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "SortMergeJoin")


@pytest.fixture(scope="module")
def stored(labelled):
    return staged(labelled.withColumn("score", F.col("b") / 10))


@pytest.fixture
def plan(capsys):
    def text(df):
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    return text


def test_label_aggregates_read_the_label_only(stored, plan):
    assert "ReadSchema: struct<Class:int>" in plan(profile.class_counts(stored))


def test_filters_reach_the_scan(stored, plan):
    shape = plan(balance.undersample(stored, row_hash(["id"])).select("a"))
    assert "ReadSchema: struct<id:bigint,a:double,Class:int>" in shape and "Exchange" not in shape
    assert "EqualTo(Class,1)" in plan(stored.where("Class = 1").select("a", "b"))


def test_row_wise_operators_do_not_shuffle(stored, plan):
    marked = split.mark_stratified_split(stored, row_hash(["id"]), F.col("id"))
    kept, _ = balance.drop_positive_outliers(stored, ["a", "b"])
    weighted, _ = balance.with_class_weights(stored)
    for df in (marked, kept, weighted, thresholds.with_prediction(stored, 0.5), split.sample_hash(stored, 0.1, row_hash(["id"]))):
        shape = plan(df)
        assert "Exchange" not in shape and "Join" not in shape


def test_aggregates_have_a_map_side_step(stored, plan):
    for df in (curves.score_counts(stored), profile.describe_columns(stored), thresholds.prediction_metrics(
        thresholds.with_prediction(stored, 0.5)
    )):
        assert "partial_" in plan(df)


def test_no_cross_joins_and_no_python(stored, plan):
    points = curves.curve_points(stored, rows_per_task=100)
    model = models.make_pipeline(["a", "b"], models.make_estimator("lr", {"maxIter": 3})).fit(stored)
    two = models.score_by_models({"x": model, "y": model}, stored)
    assert plan(two).count("Scan parquet") <= 2  # the tree and its details name the one scan
    for df in (
        density.histogram(stored, ["a", "b"], by=["Class"]),
        density.kernel_density(stored, "a"),
        profile.boxplot_rows(stored, ["a", "b"]),
        profile.boxplot_outliers(stored, ["a"]),
        thresholds.threshold_sweep(stored),
        points,
        curves.curve_areas(points),
        curves.compare_scores(two),
        two,
    ):
        shape = plan(df)
        assert not [word for word in FORBIDDEN if word in shape]
