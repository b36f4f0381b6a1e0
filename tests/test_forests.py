import numpy as np
import pytest
from pyspark.sql import functions as F

from rareflow.operators import balance, drawn, forests, models
from test_drawn import FEATURES, rows, small, trees  # noqa: F401


@pytest.mark.parametrize(
    "settings, weighted",
    [
        ({"maxDepth": 5}, False),
        ({"maxDepth": 7, "minInstancesPerNode": 60, "minInfoGain": 0.0005}, True),
        ({"maxDepth": 4, "minWeightFractionPerNode": 0.04}, True),
        ({"maxDepth": 0}, True),
    ],
)
def test_a_tree_of_all_rows_is_that_of_mllib(spark, rows, small, monkeypatch, settings, weighted):  # noqa: F811
    """Where the draw takes every row and nodes choose from all features, nothing is left to chance."""
    monkeypatch.setattr(drawn, "forest_of_drawn_rows", lambda e: True)
    monkeypatch.setattr(models, "rows_by_cell", lambda *_: None)
    fitting = balance.with_class_weights(rows)[0] if weighted else rows
    estimator = models.make_estimator("rf", {"numTrees": 1, "bootstrap": False, **settings}, weight="classWeightCol" if weighted else None)
    mine, plain = models.fit_pipeline(fitting, FEATURES, estimator), models.make_pipeline(FEATURES, estimator).fit(fitting)
    assert trees(mine) == trees(plain)
    one, other = mine.stages[-1], plain.stages[-1]
    assert one.uid == other.uid and (one.numFeatures, one.numClasses) == (3, 2)
    assert {p.name: v for p, v in one.extractParamMap().items()} == {p.name: v for p, v in other.extractParamMap().items()}
    assert one.featureImportances.toArray() == pytest.approx(other.featureImportances.toArray(), abs=1e-9)
    scores = [{tuple(r): None for r in models.score_table(m, fitting).select(*FEATURES, F.round("score", 9)).distinct().collect()} for m in (mine, plain)]
    assert scores[0].keys() == scores[1].keys()


def test_candidates_share_one_forest(spark, rows, small, monkeypatch):  # noqa: F811
    """Each candidate's forest is the one that is fitted for it alone, and none is left to MLlib's passes over all rows."""
    monkeypatch.setattr(models.RandomForestClassifier, "fit", lambda *_: pytest.fail("a pass over all rows a level"))
    monkeypatch.setattr(forests, "CELLS_AT_ONCE", 8_000)  # a few trees at a time
    fitting = balance.with_class_weights(rows)[0]
    estimator = models.make_estimator("rf", {"subsamplingRate": 0.8}, weight="classWeightCol")
    candidates = [estimator.copy({estimator.maxDepth: d, estimator.numTrees: n}) for d in (3, 6) for n in (4, 7)]
    kept, grown, grow = spark.sparkContext._jsc.getPersistentRDDs().size(), [], forests._grown
    monkeypatch.setattr(forests, "_grown", lambda binned, numbers, *rest: grown.extend(numbers) or grow(binned, numbers, *rest))
    together = models.fit_pipelines(fitting, FEATURES, candidates)
    assert grown == list(range(7)) and spark.sparkContext._jsc.getPersistentRDDs().size() == kept
    assert [(m.stages[-1].getNumTrees, m.stages[-1].getMaxDepth()) for m in together] == [(4, 3), (7, 3), (4, 6), (7, 6)]
    monkeypatch.setattr(forests, "CELLS_AT_ONCE", 10**9)
    assert [trees(m) for m in together] == [trees(models.fit_pipeline(fitting, FEATURES, c)) for c in candidates]


@pytest.mark.parametrize("settings, mean, spread", [({}, 1.0, 1.0), ({"subsamplingRate": 0.5}, 0.5, 0.5), ({"subsamplingRate": 0.5, "bootstrap": False}, 0.5, 0.25)])
def test_every_tree_draws_by_itself(spark, rows, small, tmp_path, settings, mean, spread):  # noqa: F811
    model = models.fit_pipeline(rows, FEATURES, models.make_estimator("rf", {"numTrees": 8, "maxDepth": 2, **settings}))
    model.write().overwrite().save(f"{tmp_path}/m")
    roots = [r["nodeData"]["rawCount"] for r in spark.read.parquet(f"{tmp_path}/m/stages/2_*/data").where("nodeData.id = 0").collect()]
    assert len(set(roots)) > 4 and all(abs(n - 30_000 * mean) < 5 * np.sqrt(30_000 * spread) for n in roots)
    assert models.PipelineModel.load(f"{tmp_path}/m").stages[-1].toDebugString == model.stages[-1].toDebugString


def test_a_forest_judges_as_well_as_mllibs(rows, small):  # noqa: F811
    fitting = balance.with_class_weights(rows)[0]
    estimator = models.make_estimator("rf", {"numTrees": 30, "maxDepth": 8, "subsamplingRate": 0.8}, weight="classWeightCol")
    mine, plain = models.fit_pipeline(fitting, FEATURES, estimator), models.make_pipeline(FEATURES, estimator).fit(fitting)
    areas = [models.areas_of(m, rows).first() for m in (mine, plain)]
    assert areas[0]["auprc_spark"] == pytest.approx(areas[1]["auprc_spark"], abs=0.01) and areas[0]["auroc"] == pytest.approx(areas[1]["auroc"], abs=0.01)
    used = [m.stages[-1].featureImportances.toArray() for m in (mine, plain)]
    assert used[0] == pytest.approx(used[1], abs=0.1)


def test_a_cell_gives_a_poisson_number_of_its_rows():
    block = (0, 0), np.zeros((1, 60_000), np.uint8), np.zeros(60_000, np.uint8), np.repeat([1, 3, 400], 20_000)
    cells, n, _ = forests._drawn_cells([5], 42, 0.8, True, block)[2][5]
    found = np.zeros(60_000)
    found[cells] = n
    for k, size in enumerate((1, 3, 400)):
        mine = found[20_000 * k : 20_000 * (k + 1)]
        assert mine.mean() == pytest.approx(0.8 * size, rel=0.02) and mine.var() == pytest.approx(0.8 * size, rel=0.05)


def test_features_of_a_node():
    for how, trees_, wanted in (("auto", 1, 30), ("auto", 2, 6), ("all", 2, 30), ("sqrt", 1, 6), ("log2", 2, 5), ("onethird", 2, 10)):
        assert forests.features_of_a_node(models.make_estimator("rf", {"featureSubsetStrategy": how, "numTrees": trees_}), 30) == wanted


def test_weights_that_do_not_follow_from_the_label_are_left_to_mllib(rows, small):  # noqa: F811
    scaled = models.Pipeline(stages=models.scaling_stages(FEATURES)).fit(rows).transform(rows)
    estimator = models.make_estimator("rf", weight="w")
    assert drawn.binned_rows(scaled.withColumn("w", F.col("Class") + 0.5), 3, [estimator]).weights == (0.5, 1.5)
    for w in (F.col("a") + 1, F.when(F.col("a") > 1, F.lit(2.0)), F.lit(0.0)):
        assert drawn.binned_rows(scaled.withColumn("w", w), 3, [estimator]) is None


def test_small_forests_are_left_to_mllib(rows, monkeypatch):  # noqa: F811
    monkeypatch.setattr(drawn, "LEAST_ROWS", {models.RandomForestClassifier: 150_000})
    scaled = models.Pipeline(stages=models.scaling_stages(FEATURES)).fit(rows).transform(rows)
    two, three = (models.make_estimator("rf", {"numTrees": n}) for n in (2, 3))
    assert drawn.binned_rows(scaled, 3, [two]) is None and drawn.binned_rows(scaled, 3, [two, three]) is not None
