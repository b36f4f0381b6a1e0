"""Exact precision-recall and ROC curves, their areas, and the best F1 over all scores.

Scores are counted per distinct value first (map-side, so one value held by a third of all rows costs
one row), then running totals give every point of both curves at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rareflow.functions.columns import col
from rareflow.operators.running import ROWS_PER_TASK, running_totals
from rareflow.operators.thresholds import confusion_rows
from rareflow.schema import LABEL


def score_counts(scored: DataFrame, label: str = LABEL, score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score; a missing score or a label other than 0 and 1 is an error."""
    s, y = col(score).cast("double"), col(label).cast("int")
    usable = s.isNotNull() & ~F.isnan(s) & y.isNotNull() & y.isin(0, 1)
    checked = F.when(usable, s).otherwise(F.raise_error(F.lit("curves need a score and a 0/1 label in every row")))
    return (
        scored.select(*by, checked.alias("score"), y.alias("y"))
        .groupBy(*by, "score")
        .agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    )


def score_totals(
    scored: DataFrame,
    label: str = LABEL,
    score: str = "score",
    by: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Positives, negatives and distinct scores (``one``) of every score, with their running totals from the highest score down."""
    counts = score_counts(scored, label, score, by).withColumn("one", F.lit(1).cast("bigint"))
    return running_totals(counts, "score", ["pos", "neg", "one"], by, rows_per_task)


def thinned(totals: DataFrame, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """The totals with about ``bins`` scores a group: runs of equally many neighbouring scores are put together.

    As MLlib's evaluator does with the curve of one partition: from the highest score down, floor(scores / bins) scores make one
    with the smallest of them, and curves of fewer than twice as many scores as bins stay whole.
    """
    width = F.greatest(F.floor(F.col("all_one") / F.lit(bins)), F.lit(1))
    run = F.floor((F.col("cum_one") - 1) / width).alias("_run")
    summed = [F.sum(s).alias(s) for s in ("pos", "neg", "one")]
    last = [F.max(f"{kind}_{s}").alias(f"{kind}_{s}") for kind in ("cum", "all") for s in ("pos", "neg", "one")]
    return totals.groupBy(*by, run).agg(F.min("score").alias("score"), *summed, *last).drop("_run")


def curve_points(
    scored: DataFrame,
    label: str = LABEL,
    score: str = "score",
    by: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
    bins: int = 0,
) -> DataFrame:
    """One row per distinct score taken as threshold: tp, fp, fn, tn, precision, recall, fpr and F1.

    ``pos`` and ``neg`` stay: the point before a row is (tp - pos, fp - neg), so areas need no window. With ``bins`` the curve is thinned.
    """
    totals = score_totals(scored, label, score, by, rows_per_task)
    return points_of(thinned(totals, bins, by) if bins else totals, by)


def points_of(totals: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The points of the curves from running totals."""
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    positives = _needed(F.col("all_pos"), "positive")
    negatives = _needed(F.col("all_neg"), "negative")
    precision, recall = tp / (tp + fp), tp / positives
    f1 = F.when(tp > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    return totals.select(
        *by,
        "score",
        "pos",
        "neg",
        tp.alias("tp"),
        fp.alias("fp"),
        (positives - tp).alias("fn"),
        (negatives - fp).alias("tn"),
        precision.alias("precision"),
        recall.alias("recall"),
        (fp / negatives).alias("fpr"),
        f1.alias("f1"),
    )


def _needed(total: Column, kind: str) -> Column:
    return F.when(total > 0, total).otherwise(F.raise_error(F.lit(f"curves need at least one {kind} row")))


def pr_curve(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall per threshold, with the closing point (recall 0, precision 1, no threshold)."""
    curve = points.select(*by, F.col("score").alias("threshold"), "precision", "recall")
    return curve.unionByName(_end_point(points, by, precision=1.0, recall=0.0))


def roc_curve(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """False and true positive rate per threshold, with the opening point (0, 0, no threshold)."""
    curve = points.select(*by, F.col("score").alias("threshold"), "fpr", F.col("recall").alias("tpr"))
    return curve.unionByName(_end_point(points, by, fpr=0.0, tpr=0.0))


def _end_point(points: DataFrame, by: Sequence[str], **values: float) -> DataFrame:
    one_per_group = points.groupBy(*by).agg(F.count("*").alias("n"))
    return one_per_group.select(
        *by, F.lit(None).cast("double").alias("threshold"), *[F.lit(v).alias(k) for k, v in values.items()]
    )


def curve_areas(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``auroc``, ``auprc_spark``, ``auprc_one`` and the number of thresholds.

    The two precision-recall areas differ in where the curve starts: at the first point's own
    precision (as MLlib's evaluator does) or at precision 1.
    """
    return points.groupBy(*by).agg(*_area_columns())


def _area_columns() -> list[Column]:
    tp0, fp0 = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    recall0 = tp0 / (F.col("tp") + F.col("fn"))
    fpr0 = fp0 / (F.col("fp") + F.col("tn"))
    has_before = tp0 + fp0 > 0
    precision0 = F.when(has_before, tp0 / (tp0 + fp0))
    rise, run = F.col("recall") - recall0, F.col("fpr") - fpr0

    def area(start: Column) -> Column:
        return F.sum(rise * (F.col("precision") + F.coalesce(precision0, start)) / 2)

    return [
        F.sum(run * (F.col("recall") + recall0) / 2).alias("auroc"),
        area(F.col("precision")).alias("auprc_spark"),
        area(F.lit(1.0)).alias("auprc_one"),
        F.count("*").alias("n_thresholds"),
    ]


def _best_column() -> Column:
    kept = F.struct(F.col("score").alias("threshold"), "precision", "recall", "f1", "tp", "fp", "fn", "tn")
    return F.max_by(kept, F.struct("f1", -F.col("score"))).alias("best")


def best_f1(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The point with the highest F1, the lowest score among equals."""
    return points.groupBy(*by).agg(_best_column()).select(*by, "best.*")


def compare_scores(
    scored: DataFrame,
    label: str = LABEL,
    score: str = "score",
    model: str = "model",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """One row per model: areas, best F1 with its threshold, and the confusion counts there.

    All models share one shuffle of their score counts; the confusion counts are those of the
    best point, so nothing is scanned again.
    """
    return compare_points(curve_points(scored, label, score, [model], rows_per_task), model)


def compare_points(points: DataFrame, model: str = "model") -> DataFrame:
    """The comparison from points that are there already."""
    return points.groupBy(model).agg(*_area_columns(), _best_column()).select(
        model, "auroc", "auprc_spark", "auprc_one", "n_thresholds", "best.*"
    )


def comparison_confusion(comparison: DataFrame, model: str = "model", label: str = LABEL) -> DataFrame:
    """The 2 x 2 table of each model at its own best threshold."""
    return confusion_rows(comparison, [model], label)
