import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rareflow.operators import balance, cells, models

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def rows(spark):
    """12,000 rows in 30 cells of two features, positives in all of them."""
    found = spark.range(12_000).selectExpr("double(id % 10) as a", "double(pmod(xxhash64(id), 3)) * 0.1 as b", "pmod(xxhash64(id, 7), 97) as u")
    return found.select(*FEATURES, F.when(F.col("u") < 5 + 4 * F.col("a") + 100 * F.col("b"), 1).otherwise(0).alias("Class")).repartition(4).cache()


def scores(model, rows):
    return sorted((*r[:-1], round(r[-1], 9)) for r in models.score_table(model, rows).select(*FEATURES, "score").distinct().collect())


@pytest.mark.parametrize(
    "kind, settings, weighted",
    [
        ("gbt", {"maxIter": 4, "maxDepth": 3}, False),
        ("gbt", {"maxIter": 2, "maxDepth": 2, "minInstancesPerNode": 900}, False),
        ("rf", {"numTrees": 3, "maxDepth": 4, "bootstrap": False, "minInstancesPerNode": 700}, True),
        ("rf", {"numTrees": 1, "maxDepth": 1, "bootstrap": False, "minInstancesPerNode": 4000}, True),
        ("rf", {"numTrees": 1, "maxDepth": 0, "bootstrap": False, "minInstancesPerNode": 4000}, True),
    ],
)
def test_trees_from_cells_equal_those_from_rows(rows, kind, settings, weighted):
    """Thirty cells, or a leaf's rows of each, give the trees that MLlib grows from all rows."""
    fitting = balance.with_class_weights(rows)[0] if weighted else rows
    estimator = models.make_estimator(kind, settings, weight="classWeightCol" if weighted else None)
    found = cells.rows_by_cell(fitting, FEATURES, [estimator])
    assert found.count() <= 60 and found.agg(F.sum("n")).first()[0] == 12_000
    mine, plain = models.fit_pipeline(fitting, FEATURES, estimator), models.make_pipeline(FEATURES, estimator).fit(fitting)
    assert scores(mine, fitting) == scores(plain, fitting)
    one, other = mine.stages[-1], plain.stages[-1]
    assert [t.numNodes for t in one.trees] == [t.numNodes for t in other.trees]
    assert {p.name: v for p, v in one.extractParamMap().items()} == {p.name: v for p, v in other.extractParamMap().items()}


def test_folds_from_cells_equal_folds_from_rows(rows, monkeypatch):
    weighted = balance.with_class_weights(rows.withColumn("h", F.xxhash64(F.monotonically_increasing_id())))[0].localCheckpoint()
    estimator = models.make_estimator("rf", {"numTrees": 1, "bootstrap": False}, weight="classWeightCol")
    grid = {"maxDepth": [0, 1, 2], "minInstancesPerNode": [1, 1500, 3000]}
    mine = models.tune_by_folds(weighted, FEATURES, estimator, grid, h=F.col("h"))
    monkeypatch.setattr(models, "rows_by_cell", lambda *_, **__: None)
    plain = models.tune_by_folds(weighted, FEATURES, estimator, grid, h=F.col("h"))
    assert [pytest.approx(a, abs=1e-12) for a in plain.foldMetrics] == mine.foldMetrics
    assert scores(mine.bestModel, weighted) == scores(plain.bestModel, weighted)


def test_many_values_are_cut_where_the_cells_meet(spark):
    """A feature of more values than bins: the rows that a tree sends to a leaf are those of the leaf's cells, and all rows count."""
    rows = spark.range(40_000).selectExpr("double(pmod(xxhash64(id), 100003)) as a", "double(id % 5) as b").withColumn("Class", (F.col("a") + 9_000 * F.col("b") > 70_000).cast("int")).cache()
    estimator = models.make_estimator("gbt", {"maxIter": 5, "maxDepth": 4})
    found = cells.rows_by_cell(rows, FEATURES, [estimator])
    assert found.select("a").distinct().count() == 32 and found.agg(F.sum("n")).first()[0] == 40_000
    by_cell = {r["a"]: r["n"] for r in found.groupBy("a").agg(F.sum("n").alias("n")).collect()}
    assert max(by_cell.values()) < 3 * 40_000 / 32
    model, plain = models.fit_pipeline(rows, FEATURES, estimator), models.make_pipeline(FEATURES, estimator).fit(rows)
    near = sorted(by_cell)
    nearest = F.element_at(F.sort_array(F.transform(F.lit(near), lambda x: F.struct(F.abs(x - F.col("a")).alias("d"), x.alias("x")))), 1)["x"]
    both = model.transform(rows).select("a", "b", vector_to_array("rawPrediction")[1].alias("m"))
    snapped = model.transform(rows.withColumn("kept", F.col("a")).withColumn("a", nearest)).select(F.col("kept").alias("a"), "b", vector_to_array("rawPrediction")[1].alias("s"))
    assert both.distinct().join(snapped.distinct(), ["a", "b"]).where("abs(m - s) > 1e-12").count() <= 5
    areas = [models.areas_of(m, rows).first()["auprc_spark"] for m in (model, plain)]
    assert areas[0] == pytest.approx(areas[1], abs=0.02)


def test_rows_stay_where_cells_do_not_help(spark, rows):
    gbt = models.make_estimator("gbt")
    drawn = [models.make_estimator("gbt", {"subsamplingRate": 0.8}), models.make_estimator("rf", {"numTrees": 2}), models.make_estimator("lr")]
    assert all(cells.rows_by_cell(rows, FEATURES, [e]) is None for e in drawn)
    assert cells.rows_by_cell(rows.limit(90), FEATURES, [gbt]) is None  # hardly more rows than cells
    assert cells.rows_by_cell(rows.withColumn("a", F.when(F.col("a") > 0, F.col("a"))), FEATURES, [gbt]) is None
    assert cells.rows_by_cell(rows.withColumn("a", F.when(F.col("a") > 0, F.col("a")).otherwise(float("inf"))), FEATURES, [gbt]) is None
    weighted = rows.withColumn("a", F.rand(1)).withColumn("w", F.lit(2.0))
    assert cells.rows_by_cell(weighted, FEATURES, [models.make_estimator("gbt", weight="w")]) is None
    assert cells.rows_by_cell(weighted, FEATURES, [gbt, models.make_estimator("gbt", {"maxBins": 8})]) is None
