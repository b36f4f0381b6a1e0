"""The whole study on one table: profile, balance, trim, split, fit three models, compare, export."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareflow.functions.columns import col, feature_columns, free_name, join_groups, log_positive
from rareflow.functions.hashing import row_hash
from rareflow.operators.balance import drop_positive_outliers, undersample
from rareflow.operators.comoments import co_moments
from rareflow.operators.curves import compare_points, comparison_confusion, curve_points, pr_curve, roc_curve
from rareflow.operators.density import distributions, histogram
from rareflow.operators.models import (
    GRIDS,
    STUDY_SETTINGS,
    best_model,
    fit_pipeline,
    make_estimator,
    score_by_models,
    timed,
    tune_by_folds,
)
from rareflow.operators.profile import (
    boxplot_rows,
    class_counts,
    colour_range,
    correlation_rows,
    correlations_of,
    label_correlations,
    numeric_columns,
    summary_of,
)
from rareflow.operators.split import split_stratified
from rareflow.operators.thresholds import best_threshold, confusion_rows, prediction_metrics, threshold_sweep
from rareflow.schema import LABEL
from rareflow.session import job_stages, small_table, staged
from rareflow.sources.models import save_model
from rareflow.sources.tables import scan_parquet, sink_parquet

# fixed values: the columns the study trims, in order, and those it draws as box plots
TRIM = ("V14", "V12", "V10")
BOXPLOTS = ("V10", "V12", "V14", "V17", "V2", "V4", "V11", "V19")


@dataclass
class Study:
    tables: dict[str, DataFrame]
    models: dict[str, PipelineModel]
    best: str


def profile(df: DataFrame, amounts: Sequence[str] = ("Amount", "Time"), label: str = LABEL) -> dict[str, DataFrame]:
    """Class counts, summary, correlations, and histograms and densities of the amounts and of the first one's logarithm.

    Three scans of ``df``: one of the label, one for the co-moments of all numeric columns, from which the summary, the correlations and the
    ranges and bandwidths of the distributions follow, and one of the amounts. NaN counts as missing.
    """
    spark = df.sparkSession
    tables = {"class_counts": staged(class_counts(df, label), "classes")}
    names, log = numeric_columns(df), free_name(df, "log_amount")
    wider = df.withColumn(log, log_positive(col(amounts[0])))
    moments = co_moments(wider, [*names, log])
    tables["summary"], tables["corr_before"] = summary_of(spark, moments, names), correlations_of(spark, moments, names)
    every = [*names, log]
    known = {c: moments.figures(every.index(c)) for c in (*amounts, log)}
    binned, densities = distributions(wider, {c: (n, sd, lo, hi) for c, (n, _, sd, lo, hi) in known.items()})
    tables["histogram"] = binned.where(F.col("column") != log)
    tables["log_histogram"] = binned.where(F.col("column") == log).withColumn("column", F.lit("log_amount"))
    tables |= {f"density_{c}": densities[c] for c in amounts}
    tables["log_density"] = densities[log]
    return tables


def run_study(df: DataFrame, model_dir: str, output: str | None = None, **options) -> Study:
    """The study of ``df``; see ``_study`` for the options.

    With ``output`` every table is written below it, the study returns them as written, and all stages are removed. Without it the
    tables read the stages, which stay.
    """
    if output is None:
        return _study(df, model_dir, **options)
    with job_stages(df.sparkSession):
        found = _study(df, model_dir, **options)
        for name, rows in found.tables.items():
            sink_parquet(rows, f"{output}/{name}")
    return Study({name: scan_parquet(df.sparkSession, f"{output}/{name}") for name in found.tables}, found.models, found.best)


def _study(
    df: DataFrame,
    model_dir: str,
    seed: int = 42,
    trim: Sequence[str] = TRIM,
    boxplots: Sequence[str] = BOXPLOTS,
    amounts: Sequence[str] = ("Amount", "Time"),
    study_order: str = "split_first",
    settings: Mapping[str, Mapping] | None = None,
    lr_grid: Mapping[str, Sequence] | None = None,
    label: str = LABEL,
) -> Study:
    """``study_order="split_first"`` balances and trims the training part only, so the test part keeps the
    table's own class ratio. ``"balance_first"`` balances and trims everything before the split.
    """
    if study_order not in ("split_first", "balance_first"):
        raise ValueError(f"unknown study_order {study_order!r}")
    spark, columns = df.sparkSession, df.columns
    h, tie = row_hash(columns, seed), F.xxhash64(*columns, F.lit(seed))
    # another seed for sampling: the split cuts on h, so sampling by the same hash would not be independent of it
    sampling = row_hash(columns, seed + 1)
    tables = profile(df, amounts, label)

    if study_order == "split_first":
        pool, test = split_stratified(df, h, tie, 0.8, label, stage_keys=True)
    else:
        pool, test = df, None
    # written once: a small part of the rows, which ten of the steps below read
    balanced = staged(undersample(pool, sampling, label), "balanced")
    tables["balanced_counts"] = class_counts(balanced, label)
    tables["corr_after"] = correlation_rows(balanced)
    tables["corr_range"] = colour_range(tables["corr_before"], tables["corr_after"])
    tables["label_correlations"] = label_correlations(tables["corr_after"], label)
    tables["boxplots"] = boxplot_rows(balanced, boxplots, label)
    trimmed, tables["fences"] = drop_positive_outliers(balanced, trim, label)
    tables["boxplots_trimmed"] = boxplot_rows(trimmed, trim, label)

    # written, not cached: three fits and a search read these rows, and they must not change when an executor is lost
    train = trimmed
    if test is None:
        train, test = split_stratified(trimmed, h, tie, 0.8, label, stage_keys=True)
    train, test = staged(train, "train"), staged(test, "test")
    sizes = [("balanced", balanced.count()), ("trimmed", trimmed.count()), ("train", train.count()), ("test", test.count())]
    tables["row_counts"] = small_table(spark, sizes, "stage string, n bigint")

    features = feature_columns(df, [label])
    settings = {**STUDY_SETTINGS, **(settings or {})}

    def fit(kind: str) -> PipelineModel:
        estimator = make_estimator(kind, settings[kind], label, seed=seed)
        if kind != "lr":
            return fit_pipeline(train, features, estimator)
        h = row_hash(columns, seed + 2)
        return tune_by_folds(train, features, estimator, lr_grid or GRIDS["lr"], label, h=h, seed=seed).bestModel

    fitted = {kind: timed(partial(fit, kind)) for kind in ("lr", "rf", "gbt")}
    models = {kind: model for kind, (model, _) in fitted.items()}
    seconds = [(kind, took) for kind, (_, took) in fitted.items()]

    scores = staged(score_by_models(models, test, [label]), "scores")
    tables["scores"] = scores
    tables["fit_seconds"] = small_table(spark, seconds, "model string, fit_seconds double")
    tables["sweep"] = threshold_sweep(scores, label, by=["model"])
    tables["best_threshold"] = best_threshold(tables["sweep"], ["model"])
    points = curve_points(scores, label, by=["model"])
    tables["pr_curve"], tables["roc_curve"] = pr_curve(points, ["model"]), roc_curve(points, ["model"])
    tables["comparison"] = compare_points(points)
    tables["confusion"] = comparison_confusion(tables["comparison"], label=label)
    tables["score_density"] = histogram(scores, ["score"], by=["model", label])
    at_best = col("score") >= col("threshold")
    by_model = join_groups(scores, tables["best_threshold"].select("model", "threshold"), ["model"])
    tables["scores_best_f1"] = with_best = by_model.select(*scores.columns, at_best.cast("double").alias("prediction_best_f1"))
    tables["confusion_best_f1"] = confusion_rows(
        prediction_metrics(with_best, label, "prediction_best_f1", ["model"]), ["model"], label
    )
    best = best_model(tables["comparison"]).first()["model"]
    save_model(models[best], f"{model_dir}/{best}_pipeline")
    return Study(tables, models, best)
