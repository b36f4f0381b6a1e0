import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rareflow.operators import drawn, models
from rareflow.session import job_stages

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    """30,000 rows of three features of few values, positives in all of their cells."""
    found = spark.range(30_000).selectExpr("double(id % 10) as a", "double(pmod(xxhash64(id), 7)) * 0.1 as b", "double(pmod(xxhash64(id, 3), 25)) as c", "pmod(xxhash64(id, 7), 97) as u")
    return found.select(*FEATURES, F.when(F.col("u") < 5 + 4 * F.col("a") + F.col("c") + 50 * F.col("b"), 1).otherwise(0).alias("Class")).repartition(4).cache()


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(drawn, "LEAST_ROWS", dict.fromkeys(drawn.LEAST_ROWS, 0))


def trees(model):
    """Their shape with rounded numbers."""
    text = model.stages[-1].toDebugString.split("\n", 1)[1]
    return re.sub(r"-?\d+\.\d+(E-?\d+)?", lambda x: f"{float(x.group()):.7g}", text)


@pytest.mark.parametrize(
    "settings",
    [
        {"maxIter": 4, "maxDepth": 5},
        {"maxIter": 3, "maxDepth": 4, "minInstancesPerNode": 400, "minInfoGain": 0.001, "stepSize": 0.3},
        {"maxIter": 2, "maxDepth": 6, "minWeightFractionPerNode": 0.02, "maxBins": 40},
        {"maxIter": 2, "maxDepth": 0},
        {"maxIter": 1, "maxDepth": 1},
    ],
)
def test_trees_of_all_rows_are_those_of_mllib(spark, rows, small, monkeypatch, settings):
    """Where a draw takes every row, nothing is left to chance: the trees, their figures and the model's parameters are MLlib's own."""
    monkeypatch.setattr(drawn, "boosts_drawn_rows", lambda e: True)
    monkeypatch.setattr(models, "rows_by_cell", lambda *_: None)
    monkeypatch.setattr(drawn, "FRESH", 2)
    estimator = models.make_estimator("gbt", settings)
    mine, plain = models.fit_pipeline(rows, FEATURES, estimator), models.make_pipeline(FEATURES, estimator).fit(rows)
    assert trees(mine) == trees(plain)
    one, other = mine.stages[-1], plain.stages[-1]
    assert one.treeWeights == other.treeWeights and one.uid == other.uid and one.numFeatures == 3
    assert {p.name: v for p, v in one.extractParamMap().items()} == {p.name: v for p, v in other.extractParamMap().items()}
    assert one.featureImportances.toArray() == pytest.approx(other.featureImportances.toArray(), abs=1e-9)


def test_every_round_draws_its_share_of_single_rows(spark, rows, small, tmp_path):
    estimator = models.make_estimator("gbt", {"maxIter": 6, "maxDepth": 3, "subsamplingRate": 0.8})
    model = models.fit_pipeline(rows, FEATURES, estimator)
    model.write().overwrite().save(f"{tmp_path}/m")
    roots = {r["treeID"]: r["nodeData"] for r in spark.read.parquet(f"{tmp_path}/m/stages/2_*/data").where("nodeData.id = 0").collect()}
    n = [roots[i]["rawCount"] for i in range(6)]
    assert all(abs(x - 24_000) < 5 * np.sqrt(30_000 * 0.16) for x in n) and len(set(n)) > 1
    again = models.PipelineModel.load(f"{tmp_path}/m")
    assert again.stages[-1].toDebugString == model.stages[-1].toDebugString
    plain = models.make_pipeline(FEATURES, estimator).fit(rows)
    areas = [models.areas_of(m, rows).first()["auprc_spark"] for m in (model, plain)]
    assert areas[0] == pytest.approx(areas[1], abs=0.01)
    assert trees(models.fit_pipeline(rows, FEATURES, estimator)) == trees(model)
    assert trees(models.fit_pipeline(rows, FEATURES, models.make_estimator("gbt", {"maxIter": 6, "maxDepth": 3, "subsamplingRate": 0.8}, seed=7))) != trees(model)


def test_a_cell_gives_a_binomial_number_of_its_rows():
    n = np.repeat([1, 2, 50, 1000], 20_000)
    found = drawn.draw(n, 0.8, np.random.default_rng(1)).reshape(4, -1)
    for k, size in enumerate((1, 2, 50, 1000)):
        assert found[k].max() <= size and found[k].mean() == pytest.approx(0.8 * size, rel=0.01) and found[k].var() == pytest.approx(0.16 * size, rel=0.05)


def test_large_tables_are_not_left_to_mllibs_passes(spark, rows, small, monkeypatch):
    """Candidates that differ in rounds share one boosting here too, and nothing stays in memory."""
    monkeypatch.setattr(models.GBTClassifier, "fit", lambda *_: pytest.fail("a pass over all rows a level"))
    estimator = models.make_estimator("gbt", {"maxDepth": 3, "subsamplingRate": 0.8})
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    with job_stages(spark):
        few, many = models.fit_pipelines(rows, FEATURES, [estimator.copy({estimator.maxIter: k}) for k in (2, 4)], 2)
    assert (few.stages[-1].getNumTrees, many.stages[-1].getNumTrees) == (2, 4)
    assert trees(many).startswith(trees(few)[: trees(few).index("Tree 1")])
    assert few.stages[-1].getMaxIter() == 2
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept


def test_values_cut_at_quantiles_hold_all_rows(spark, small):
    rows = spark.range(40_000).selectExpr("double(pmod(xxhash64(id), 100003)) as a", "double(id % 5) as b", "1.0D as c").withColumn("Class", (F.col("a") + 9_000 * F.col("b") > 70_000).cast("int")).cache()
    estimator = models.make_estimator("gbt", {"maxIter": 8, "maxDepth": 4, "subsamplingRate": 0.8})
    scaled = models.Pipeline(stages=models.scaling_stages(FEATURES)).fit(rows).transform(rows)
    binned = drawn.binned_rows(scaled, 3, [estimator])
    assert [len(t) for t in binned.thresholds] == [31, 4, 0]
    assert sum(int(n.sum()) for _, _, _, n in binned.blocks.collect()) == 40_000
    areas = [models.areas_of(m, rows).first()["auprc_spark"] for m in (models.fit_pipeline(rows, FEATURES, estimator), models.make_pipeline(FEATURES, estimator).fit(rows))]
    assert areas[0] == pytest.approx(areas[1], abs=0.02)


def test_what_is_left_to_mllib(spark, rows, small, monkeypatch):
    scaled = models.Pipeline(stages=models.scaling_stages(FEATURES)).fit(rows).transform(rows)
    mine = models.make_estimator("gbt", {"subsamplingRate": 0.8})
    assert drawn.binned_rows(scaled, 3, [mine]) is not None
    others = [models.make_estimator("gbt"), models.make_estimator("lr"), models.make_estimator("gbt", {"subsamplingRate": 0.8, "featureSubsetStrategy": "sqrt"}),
              models.make_estimator("gbt", {"subsamplingRate": 0.8}, weight="w"), models.make_estimator("gbt", {"subsamplingRate": 0.8, "maxBins": 300})]
    assert all(drawn.binned_rows(scaled, 3, [e]) is None for e in others)
    assert drawn.binned_rows(scaled, 3, [mine, models.make_estimator("gbt", {"subsamplingRate": 0.8, "maxBins": 8})]) is None
    assert drawn.binned_rows(scaled.withColumn("Class", F.lit(2)), 3, [mine]) is None
    assert drawn.binned_rows(scaled.where("false"), 3, [mine]) is None
    monkeypatch.setattr(drawn, "LEAST_ROWS", {models.GBTClassifier: 30_001})
    assert drawn.binned_rows(scaled, 3, [mine]) is None
