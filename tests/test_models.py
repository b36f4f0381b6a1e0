import json
from pathlib import Path

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rareflow.__main__ import main
from rareflow.functions.hashing import row_hash
from rareflow.operators import balance, models
from rareflow.operators.split import split_stratified
from rareflow.plans.full_run import full_run
from rareflow.plans.prepare import prepare, split_table
from rareflow.plans.study import run_study
from rareflow.sources.models import load_model, save_model

FEATURES = ["a", "b", "c"]
GRIDS = {
    "lr": {"regParam": [0.01], "elasticNetParam": [0.0, 0.5]},
    "rf": {"maxDepth": [3], "numTrees": [5]},
    "gbt": {"maxIter": [3], "maxDepth": [3]},
}


@pytest.fixture(scope="module")
def parts(labelled):
    return split_stratified(labelled, row_hash(["id"]), F.col("id"))


@pytest.fixture(scope="module")
def fitted(parts):
    settings = {"lr": {}, "rf": {"numTrees": 5}, "gbt": {"maxIter": 5}}
    return {k: models.make_pipeline(FEATURES, models.make_estimator(k, s)).fit(parts[0]) for k, s in settings.items()}


def test_scaling_divides_without_centring(labelled):
    rows = labelled.select(*FEATURES)
    scaled = models.Pipeline(stages=models.scaling_stages(FEATURES)).fit(rows).transform(rows)
    sd = rows.agg(F.stddev_samp("a")).first()[0]
    r = scaled.select("a", vector_to_array("features")[0].alias("z")).first()
    assert r["z"] == pytest.approx(r["a"] / sd)


def test_unknown_model_type():
    with pytest.raises(ValueError, match="unknown model type"):
        models.make_estimator("svm")


def test_search_does_not_depend_on_the_partitioning(labelled):
    lr = models.make_estimator("lr")
    found = [models.tune_by_split(rows, FEATURES, lr, GRIDS["lr"]) for rows in (labelled, labelled.repartition(7, "c"))]
    assert found[0].validationMetrics == pytest.approx(found[1].validationMetrics, rel=1e-6)
    best = found[0].validationMetrics.index(max(found[0].validationMetrics))
    chosen = found[0].bestModel.stages[-1]
    assert all(chosen.getOrDefault(p) == v for p, v in found[0].candidates[best].items())


def test_fixed_grids():
    for kind, size in (("lr", 4), ("rf", 4), ("gbt", 4)):
        assert len(models.make_grid(models.make_estimator(kind), models.GRIDS[kind])) == size


def test_trees_beat_the_linear_model(fitted, parts):
    scores = models.score_by_models(fitted, parts[1])
    from rareflow.operators.curves import compare_scores

    comparison = compare_scores(scores, score="margin")
    areas = {r["model"]: r["auprc_spark"] for r in comparison.collect()}
    assert areas["gbt"] > areas["lr"] > 0.2
    assert models.best_model(comparison).first()["model"] == max(areas, key=areas.get)


def test_scores_in_one_scan_equal_single_scores(fitted, parts):
    together = models.score_by_models(fitted, parts[1], ["id", "Class"])
    for kind, model in fitted.items():
        alone = {r["id"]: r["score"] for r in models.score_table(model, parts[1]).collect()}
        assert {r["id"]: r["score"] for r in together.where(F.col("model") == kind).collect()} == alone


def test_binned_areas_equal_the_default_evaluator(spark, fitted, parts):
    for kind, model in fitted.items():
        areas = models.areas_of(model, parts[1]).first()
        predicted = model.transform(parts[1].coalesce(1))
        for name, metric in (("auprc_binned", "areaUnderPR"), ("auroc_binned", "areaUnderROC")):
            assert areas[name] == pytest.approx(models.make_evaluator(metric, bins=1000).evaluate(predicted), rel=1e-9)
    # more scores than bins, ties among them, and groups of unlike size
    scored = spark.range(9_000).selectExpr("double(if(id % 7 < 5, id, id - id % 7)) / 2 - 2000 as margin", "int(id % 11 = 0 or id > 8000) as Class", "if(id < 500, 'few', 'many') as model")
    from rareflow.operators.curves import curve_areas, curve_points

    for bins in (10, 100, 1000):
        found = {r["model"]: r for r in curve_areas(curve_points(scored, score="margin", by=["model"], bins=bins), ["model"]).collect()}
        for name, r in found.items():
            mine = scored.where(F.col("model") == name).coalesce(1)
            for column, metric in (("auprc_spark", "areaUnderPR"), ("auroc", "areaUnderROC")):
                assert r[column] == pytest.approx(models.make_evaluator(metric, raw="margin", bins=bins).evaluate(mine), rel=1e-9)


def test_folds_equal_the_libraries_cross_validation(labelled):
    from pyspark.ml.tuning import CrossValidator

    rows = labelled.withColumn("_fold", F.pmod(row_hash(["id"]), F.lit(3)).cast("int")).withColumn("fold", F.lit(1))
    lr = models.make_estimator("lr")
    grid = models.make_grid(lr, {"regParam": [0.0, 0.3], "elasticNetParam": [0.0, 0.5]})
    theirs = CrossValidator(
        estimator=models.make_pipeline(FEATURES, lr), estimatorParamMaps=grid, evaluator=models.make_evaluator(), numFolds=3, foldCol="_fold"
    ).fit(rows)
    mine = models.tune_by_folds(rows.drop("_fold"), FEATURES, lr, {"regParam": [0.0, 0.3], "elasticNetParam": [0.0, 0.5]}, h=row_hash(["id"]))
    assert mine.avgMetrics == pytest.approx(theirs.avgMetrics, rel=1e-6) and len(mine.foldMetrics) == 3
    a, b = (m.bestModel.stages[-1] for m in (mine, theirs))
    assert a.coefficients.toArray() == pytest.approx(b.coefficients.toArray(), rel=1e-6)


def test_a_search_judges_all_candidates_together(spark, labelled, tmp_path):
    """The judged rows are read once for all candidates, and each candidate's area is that of the evaluator."""
    read = spark.sparkContext.accumulator(0)
    rows = labelled.select(*FEATURES, "Class")
    lr = models.make_estimator("lr", {"maxIter": 3})
    fitted = {str(i): models.make_pipeline(FEATURES, lr).fit(rows, {lr.regParam: r}) for i, r in enumerate((0.0, 0.1, 1.0))}

    @F.udf("double")
    def seen(x):
        read.add(1)
        return x

    counted = rows.withColumn("a", seen.asNondeterministic()("a"))
    areas = models.areas_by_model(models.score_by_models(fitted, counted))
    assert read.value == 2000
    for name, model in fitted.items():
        assert areas[name] == pytest.approx(models.make_evaluator().evaluate(model.transform(rows)), rel=1e-9)


def test_areas_equal_the_exact_evaluator(fitted, parts):
    for model in fitted.values():
        areas = models.areas_of(model, parts[1]).first()
        predicted = model.transform(parts[1])
        assert areas["auprc_spark"] == pytest.approx(models.make_evaluator().evaluate(predicted), rel=1e-9)
        assert areas["auroc"] == pytest.approx(models.make_evaluator("areaUnderROC").evaluate(predicted), rel=1e-9)


def test_saved_model_scores_alike(fitted, parts, tmp_path):
    path = str(tmp_path / "m")
    save_model(fitted["gbt"], path)
    save_model(fitted["gbt"], path)
    keep = models.score_table(fitted["gbt"], parts[1], keep_vectors=True)
    assert set(models.VECTORS) <= set(keep.columns)
    before = {r["id"]: r["score"] for r in keep.collect()}
    assert {r["id"]: r["score"] for r in models.score_table(load_model(path), parts[1]).collect()} == before


def test_missing_feature_is_an_error(fitted, parts):
    broken = parts[1].withColumn("a", F.lit(None).cast("double"))
    with pytest.raises(Exception):
        models.score_table(fitted["lr"], broken).collect()


def test_tuning(labelled):
    weighted, _ = balance.with_class_weights(labelled)
    lr = models.make_estimator("lr", weight="classWeightCol")
    assert len(models.tune_by_split(weighted, FEATURES, lr, GRIDS["lr"]).validationMetrics) == 2
    one = {"regParam": [0.1], "maxIter": [5]}
    folds = [
        models.tune_by_folds(rows, FEATURES, models.make_estimator("lr"), one, folds=2, h=h).avgMetrics
        for rows, h in ((labelled, row_hash(["id"])), (labelled.repartition(2), row_hash(["id"])), (labelled, None))
    ]
    assert folds[0] == pytest.approx(folds[1], rel=1e-6) and len(folds[2]) == 1


@pytest.fixture(scope="module")
def raw_csv(labelled, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "csv")
    rows = labelled.drop("id")
    rows.unionByName(rows.where("c = 2")).write.csv(path, header=True)
    return path


@pytest.mark.parametrize("how", ["stratified", "hash", "random"])
def test_prepare(spark, labelled, raw_csv, tmp_path, how):
    stats = {(r["stage"], r["Class"]): r["n"] for r in prepare(spark, raw_csv, str(tmp_path), split=how).collect()}
    sizes = {stage: stats[(stage, 0)] + stats[(stage, 1)] for stage in ("rows_in", "rows_dedup", "train", "test")}
    assert sizes["rows_in"] == 2000 + labelled.where("c = 2").count() and sizes["rows_dedup"] == 2000
    assert sizes["train"] + sizes["test"] == 2000
    if how == "stratified":
        assert stats[("train", 1)] == int(0.8 * stats[("rows_dedup", 1)])
    train, test = (spark.read.parquet(f"{tmp_path}/{p}") for p in ("train", "test"))
    assert train.unionByName(test).exceptAll(spark.read.parquet(f"{tmp_path}/raw_parquet")).count() == 0
    assert train.columns == ["a", "b", "c", "Class"]


def test_unknown_split(labelled):
    with pytest.raises(ValueError, match="unknown split"):
        split_table(labelled, "sorted", 0.8, 1)


def test_full_run(spark, raw_csv, tmp_path):
    done = full_run(
        spark, raw_csv, f"{tmp_path}/p", f"{tmp_path}/m", grids=GRIDS, settings={"lr": {}, "rf": {}, "gbt": {}}, schema="a double, b double, c double, Class int"
    )
    metrics = {r["model"]: r for r in done["metrics"].collect()}
    assert set(metrics) == {"lr", "rf", "gbt"} and metrics["gbt"]["auprc"] > metrics["lr"]["auprc"]
    assert metrics["lr"]["train_counts"]["0"] > metrics["lr"]["train_counts"]["1"] > 0
    written = json.loads(next(Path(f"{tmp_path}/m/metrics_lr").glob("part-*")).read_text())
    assert {"auprc", "auroc", "train_counts"} <= set(written)
    scores = spark.read.parquet(f"{tmp_path}/p/scores_gbt")
    assert scores.columns == ["a", "b", "c", "Class", "prediction", "score", "prediction_thresh"]
    assert 0 < done["score"].first()["f1"] <= 1


def test_command_line(spark, raw_csv, tmp_path, capsys, monkeypatch):
    monkeypatch.setitem(models.GRIDS, "lr", GRIDS["lr"])
    out = str(tmp_path)
    main(["prepare", "--input", raw_csv, "--output", f"{out}/p", "--train-ratio", "0.7"], spark)
    main(["train", "--train", f"{out}/p/train", "--test", f"{out}/p/test", "--model-dir", f"{out}/lr", "--metrics", f"{out}/m.json"], spark)
    main(["score", "--model-dir", f"{out}/lr", "--input", f"{out}/p/test", "--output", f"{out}/s", "--threshold", "0.4"], spark)
    shown = capsys.readouterr().out
    assert "rows_dedup" in shown and "auprc" in shown and "precision" in shown
    with pytest.raises(SystemExit):
        main(["train", "--model-type", "svm"], spark)


def test_unlabelled_scoring(spark, fitted, parts, tmp_path):
    from rareflow.plans.score import score

    save_model(fitted["lr"], f"{tmp_path}/m")
    parts[1].drop("Class").write.parquet(f"{tmp_path}/in")
    assert score(spark, f"{tmp_path}/m", f"{tmp_path}/in", f"{tmp_path}/out") is None
    assert spark.read.parquet(f"{tmp_path}/out").count() == parts[1].count()


@pytest.mark.parametrize("order", ["split_first", "balance_first"])
def test_study(spark, labelled, tmp_path, order):
    rows = labelled.drop("id")
    found = run_study(
        rows, str(tmp_path), trim=("b",), boxplots=("a", "b"), amounts=("b", "a"), study_order=order,
        settings={"rf": {"numTrees": 3}, "gbt": {"maxIter": 2}}, lr_grid={"regParam": [0.01]},
    )
    assert {r["model"] for r in found.tables["comparison"].collect()} == {"lr", "rf", "gbt"}
    assert load_model(f"{tmp_path}/{found.best}_pipeline").stages
    assert found.tables["confusion"].count() == 12 and found.tables["sweep"].count() == 150
    tested = found.tables["scores"].where("model = 'lr'")
    share = tested.where("Class = 1").count() / tested.count()
    assert share < 0.15 if order == "split_first" else share > 0.3
    for table in found.tables.values():
        assert table.count() > 0
    with pytest.raises(ValueError):
        run_study(rows, str(tmp_path), study_order="never")


def test_candidates_that_differ_in_rounds_share_their_boosting(labelled, monkeypatch):
    """Of two numbers of rounds the larger is fitted; its first rounds are the model that the smaller one gives."""
    estimator = models.make_estimator("gbt", {"subsamplingRate": 0.8})
    candidates = models.make_grid(estimator, {"maxIter": [2, 5], "maxDepth": [2, 3]})
    alone = [models.make_pipeline(FEATURES, estimator).fit(labelled, c) for c in candidates]
    fits, fit = [], models.GBTClassifier.fit
    monkeypatch.setattr(models.GBTClassifier, "fit", lambda self, *args: fits.append(self.getMaxIter()) or fit(self, *args))
    shared = models.fit_pipelines(labelled, FEATURES, [estimator.copy(c) for c in candidates])
    assert fits == [5, 5]
    for one, other in zip(shared, alone):
        a, b = one.stages[-1], other.stages[-1]
        assert a.toDebugString.split("\n", 1)[1] == b.toDebugString.split("\n", 1)[1] and a.treeWeights == b.treeWeights
        assert {p.name: v for p, v in a.extractParamMap().items()} == {p.name: v for p, v in b.extractParamMap().items()}
        scores = [{r["id"]: r["score"] for r in models.score_table(m, labelled).collect()} for m in (one, other)]
        assert scores[0] == scores[1]


def test_fits_at_a_time_share_the_memory(labelled, monkeypatch):
    assert models.at_once(labelled, 2) == 2
    monkeypatch.setattr(models, "ROWS_AT_ONCE", 3999)
    assert models.at_once(labelled, 2) == 1
    monkeypatch.setattr(models, "ROWS_AT_ONCE", 10)
    assert models.at_once(labelled, 2) == 1 and models.at_once(labelled.limit(0), 3) == 3


def test_both_areas_of_the_evaluator_from_one_curve(fitted, parts):
    for model in fitted.values():
        scored = model.transform(parts[1])
        found = models.evaluator_areas(scored)
        assert found == {m: pytest.approx(models.make_evaluator(m).evaluate(scored), abs=1e-12) for m in ("areaUnderPR", "areaUnderROC")}
