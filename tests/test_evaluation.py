import numpy as np
import pytest
from pyspark.sql import functions as F

from rareflow.operators import curves, thresholds
from rareflow.operators.models import make_evaluator


@pytest.fixture(scope="module")
def scored(spark):
    """Rounded scores, so that many rows tie, and one score held by a third of the rows."""
    rng = np.random.default_rng(11)
    y = (rng.random(3000) < 0.07).astype(int)
    s = np.where(rng.random(3000) < 1 / 3, 0.25, np.round(np.clip(rng.normal(0.3 + 0.3 * y, 0.2), 0, 1), 3))
    rows = [(int(a), float(b), "x" if i % 2 else "y") for i, (a, b) in enumerate(zip(y, s))]
    return y, s, spark.createDataFrame(rows, "Class int, score double, model string").repartition(5).cache()


def brute_force(y, s):
    points = []
    for t in sorted(set(s), reverse=True):
        tp, fp = int(((s >= t) & (y == 1)).sum()), int(((s >= t) & (y == 0)).sum())
        points.append((float(t), tp, fp, tp / (tp + fp), tp / y.sum(), fp / (y == 0).sum()))
    return points


@pytest.mark.parametrize("rows_per_task", [10**6, 40])
def test_curve_points(scored, rows_per_task):
    y, s, df = scored
    found = curves.curve_points(df, rows_per_task=rows_per_task).orderBy(F.desc("score")).collect()
    for r, expected in zip(found, brute_force(y, s), strict=True):
        assert (r["score"], r["tp"], r["fp"], r["precision"], r["recall"], r["fpr"]) == pytest.approx(expected)
        assert r["tp"] + r["fn"] == y.sum() and r["fp"] + r["tn"] == (y == 0).sum()


def test_areas(scored):
    y, s, df = scored
    points = brute_force(y, s)
    rec, prec = [0.0] + [p[4] for p in points], [p[3] for p in points]
    fpr = [0.0] + [p[5] for p in points]
    a = curves.curve_areas(curves.curve_points(df)).first()
    assert a["auprc_one"] == pytest.approx(np.trapezoid([1.0, *prec], rec))
    assert a["auprc_spark"] == pytest.approx(np.trapezoid([prec[0], *prec], rec))
    assert a["auroc"] == pytest.approx(np.trapezoid(rec, fpr)) and a["n_thresholds"] == len(points)
    assert make_evaluator(raw="score").evaluate(df) == pytest.approx(a["auprc_spark"], rel=1e-12)
    assert make_evaluator("areaUnderROC", raw="score").evaluate(df) == pytest.approx(a["auroc"], rel=1e-12)
    squeezed = df.withColumn("score", F.exp("score") * 3 - 1)
    assert curves.curve_areas(curves.curve_points(squeezed)).first()["auroc"] == pytest.approx(a["auroc"])


def test_curves_have_their_end_points(scored):
    _, s, df = scored
    points = curves.curve_points(df)
    pr, roc = curves.pr_curve(points), curves.roc_curve(points)
    assert pr.count() == roc.count() == len(set(s)) + 1
    assert tuple(pr.where("threshold is null").first()) == (None, 1.0, 0.0)
    assert tuple(roc.where("threshold is null").first()) == (None, 0.0, 0.0)


def test_tied_scores_give_half(spark):
    df = spark.createDataFrame([(1, 0.3), (0, 0.3)], "Class int, score double")
    assert curves.curve_areas(curves.curve_points(df)).first()["auroc"] == 0.5


def test_best_f1_takes_the_lowest_score_among_equals(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (1, 0.6), (0, 0.2)], "Class int, score double")
    best = curves.best_f1(curves.curve_points(df)).first()
    assert (best["threshold"], best["tp"], best["fp"], best["fn"], best["tn"]) == (0.6, 3, 1, 0, 1)
    tie = spark.createDataFrame([(0, 0.9), (0, 0.8), (1, 0.1)], "Class int, score double")
    assert curves.best_f1(curves.curve_points(tie)).first()["threshold"] == 0.1


@pytest.mark.parametrize("bad", ["cast(null as double)", "double('NaN')"])
def test_bad_scores_are_an_error(spark, bad):
    df = spark.sql(f"select 1 as Class, {bad} as score union all select 0, 0.5D")
    with pytest.raises(Exception, match="curves need"):
        curves.curve_points(df).collect()


@pytest.mark.parametrize("label", [0, 1, 2])
def test_one_class_is_an_error(spark, label):
    df = spark.range(4).select(F.lit(label).alias("Class"), (F.col("id") / 4).alias("score"))
    with pytest.raises(Exception, match="curves need"):
        curves.curve_points(df).collect()


@pytest.mark.parametrize("rows_per_task", [10**6, 40])
def test_compare_scores(scored, rows_per_task):
    y, s, df = scored
    pdf = df.toPandas()
    comparison = curves.compare_scores(df, rows_per_task=rows_per_task)
    cells = {(r["model"], r["Class"], r["pred"]): r["n"] for r in curves.comparison_confusion(comparison).collect()}
    for r in comparison.collect():
        mine = pdf[pdf.model == r["model"]]
        points = brute_force(mine.Class.to_numpy(), mine.score.to_numpy())
        f1 = {p[0]: 2 * p[3] * p[4] / (p[3] + p[4]) if p[1] else 0.0 for p in points}
        assert r["f1"] == pytest.approx(max(f1.values())) and f1[r["threshold"]] == pytest.approx(max(f1.values()))
        says = mine.score >= r["threshold"]
        for actual in (0, 1):
            for pred in (0, 1):
                assert cells[(r["model"], actual, pred)] == int(((mine.Class == actual) & (says == bool(pred))).sum())


def test_sweep_by_brute_force(scored):
    y, s, df = scored
    rows = thresholds.threshold_sweep(df).orderBy("threshold").collect()
    assert [r["threshold"] for r in rows] == np.linspace(0.1, 0.9, 50).tolist()
    for r in rows:
        t = r["threshold"]
        cells = [int(((s >= t) & (y == 1)).sum()), int(((s >= t) & (y == 0)).sum()), int(((s < t) & (y == 1)).sum())]
        assert [r["tp"], r["fp"], r["fn"]] == cells
    recalls = [r["recall"] for r in rows]
    assert recalls == sorted(recalls, reverse=True)
    best = thresholds.best_threshold(thresholds.threshold_sweep(df)).first()
    first = next(r for r in rows if r["f1"] == max(x["f1"] for x in rows))
    assert (best["threshold"], best["f1"]) == (first["threshold"], first["f1"])
    marked = thresholds.with_best_prediction(df, thresholds.threshold_sweep(df))
    assert marked.where("prediction_best_f1 = 1").count() == int((s >= first["threshold"]).sum())


def test_sweep_by_model_and_on_the_cut(scored, spark):
    _, _, df = scored
    both = thresholds.threshold_sweep(df, by=["model"])
    assert both.count() == 100
    alone = thresholds.threshold_sweep(df.where("model = 'x'")).orderBy("i").collect()
    assert [r["tp"] for r in both.where("model = 'x'").orderBy("i").collect()] == [r["tp"] for r in alone]
    edge = spark.createDataFrame([(1, 0.5), (0, 0.2)], "Class int, score double")
    (r,) = thresholds.threshold_sweep(edge, thresholds=[0.5]).collect()
    assert (r["tp"], r["fp"], r["fn"]) == (1, 0, 0)


def test_confusion_keeps_empty_cells(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1)], "Class int, score double")
    cells = thresholds.confusion_rows(thresholds.prediction_metrics(thresholds.with_prediction(df, 0.5)))
    assert sorted(tuple(r) for r in cells.collect()) == [(0, 0, 1), (0, 1, 0), (1, 0, 0), (1, 1, 1)]
