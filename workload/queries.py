"""One named query per operator, each over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareflow.functions.columns import cast_numbers, log_positive, vector_item
from rareflow.operators import balance, curves, density, models, profile, quantiles, split, thresholds
from rareflow.plans.full_run import full_run
from rareflow.plans.prepare import prepare
from rareflow.plans.score import score
from rareflow.plans.study import run_study
from rareflow.plans.train import train
from rareflow.session import scratch_path, small_table, staged
from rareflow.sources import tables as io
from rareflow.sources.models import load_model, save_model
from workload.tables import FEATURES, WIDE, emb, ev, features, stored_txn, table, two_scores, txn

STUMP_FEATURES = ["V1", "V2", "V3"]
STUMPS = {
    "rf": {"numTrees": 1, "maxDepth": 1, "maxBins": 64, "bootstrap": False},
    "gbt": {"maxIter": 1, "maxDepth": 1, "maxBins": 64},
}

def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Doubles rounded, so that both engines print the same values."""
    return df.select(*[
        F.round(c, special.get(c, digits)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes
    ])


# sources, sinks, projections


def class_stats(spark, sf):
    return profile.class_counts(txn(spark, sf))


def row_count(spark, sf):
    return profile.row_count(txn(spark, sf))


def numeric_cast(spark, sf):
    raw = table(spark, sf, "lineitem")
    raw = raw.withColumn("Class", F.when(F.col("l_returnflag") == "R", 1).otherwise(0))
    return cast_numbers(raw.drop("l_shipdate"))


def csv_round_trip(spark, sf):
    path = scratch_path(spark, "csv")
    rows = features(spark, sf)
    io.sink_csv(rows, f"{path}/csv")
    io.sink_parquet(io.scan_csv(spark, f"{path}/csv", rows.schema), f"{path}/parquet", cluster_by="Class")
    return io.scan_parquet(spark, f"{path}/parquet")


def csv_inferred(spark, sf):
    path = scratch_path(spark, "csv")
    io.sink_csv(features(spark, sf), path)
    return cast_numbers(io.scan_csv(spark, path))


def land_once(spark, sf):
    path = scratch_path(spark, "landed")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    io.land_once(orders, path)
    io.land_once(orders.withColumn("o_totalprice", -F.col("o_totalprice")), path)
    return io.scan_parquet(spark, path)


def metrics_sink(spark, sf):
    path = scratch_path(spark, "metrics")
    counts = profile.class_count_map(txn(spark, sf))
    io.sink_metrics(spark.range(1).select(io.label_counts_struct(counts)), path)
    return spark.read.json(path).select("train_counts.*").select(
        F.col("`0`").alias("negatives"), F.col("`1`").alias("positives")
    )


def distinct_rows(spark, sf):
    return profile.distinct_rows(txn(spark, sf).select("V1", "V2", "V3", "Class"))


def log_amount(spark, sf):
    rows = txn(spark, sf).select("txn_id", log_positive(F.col("V2")).alias("log_v2"))
    return rounded(rows.withColumn("non_positive", F.col("log_v2").isNull().cast("int")))


# profiling


def describe_typed(spark, sf):
    return rounded(profile.describe_columns(txn(spark, sf), [*FEATURES, "Class"]), 4)


def quartiles(spark, sf):
    positives = ev(spark, sf).where("Class = 1")
    return rounded(quantiles.quantile_rows(positives, ["Amount", "Time"], (0.25, 0.75), interpolate=False))


def quartiles_by_class(spark, sf):
    rows = stored_txn(spark, sf, "Amount", "V1", "Time", "Class")
    return rounded(quantiles.quantile_rows(rows, ["Amount", "V1", "Time"], (0.25, 0.5, 0.75, 0.99), by="Class"))


def quartiles_approx(spark, sf):
    return rounded(quantiles.approximate_quantiles(ev(spark, sf).where("Class = 1"), "Amount", (0.25, 0.75)))


def corr_matrix(spark, sf):
    columns = [*FEATURES, "Class"]
    return rounded(profile.correlation_rows(stored_txn(spark, sf, *columns), columns), 8)


def corr_wide(spark, sf):
    return rounded(profile.correlation_rows(emb(spark, sf), [*WIDE, "Class"]), 8)


def corr_balanced(spark, sf):
    rows = stored_txn(spark, sf, "h", *FEATURES, "Class")
    matrix = profile.correlation_rows(balance.undersample(rows, F.col("h")), [*FEATURES, "Class"])
    return rounded(matrix, 8)


def corr_range(spark, sf):
    columns = [*FEATURES, "Class"]
    rows = stored_txn(spark, sf, "h", *columns)
    before = profile.correlation_rows(rows, columns)
    after = profile.correlation_rows(balance.undersample(rows, F.col("h")), columns)
    return rounded(profile.colour_range(before, after), 8)


def top_corr(spark, sf):
    matrix = profile.correlation_rows(emb(spark, sf), [*WIDE, "Class"])
    return rounded(profile.label_correlations(matrix), 8)


def histogram(spark, sf):
    return rounded(density.histogram(txn(spark, sf), ["Amount", "Time"]), density=12)


def histogram_log(spark, sf):
    logs = txn(spark, sf).select(log_positive(F.col("Amount")).alias("log_amount"))
    return rounded(density.histogram(logs, ["log_amount"]))


def score_density(spark, sf):
    return rounded(density.histogram(two_scores(spark, sf), ["score"], by=["model", "Class"]))


def kde_amount(spark, sf):
    found = density.kernel_density(txn(spark, sf), "Amount")
    return rounded(found.withColumn("density", F.col("density") * 1e6), x=4, expected=3)


def boxplot_by_class(spark, sf):
    columns = ["Amount", "V1", "Time"]
    return rounded(profile.boxplot_rows(stored_txn(spark, sf, *columns, "Class"), columns))


def boxplot_events(spark, sf):
    return rounded(profile.boxplot_rows(ev(spark, sf), ["Amount"]))


def boxplot_outliers(spark, sf):
    return rounded(profile.boxplot_outliers(ev(spark, sf), ["Amount"]))


# splits, samples, balance


def split_stratified(spark, sf):
    rows = stored_txn(spark, sf, "txn_id", "h", "Class")
    marked = split.mark_stratified_split(rows, F.col("h"), F.col("txn_id"))
    return marked.select("txn_id", "Class", "part")


def split_hash(spark, sf):
    return split.mark_hash_split(txn(spark, sf), 0.8, F.col("h")).select("txn_id", "Class", "part")


def _draw_facts(rows, drawn, share):
    """For each class: the rows and ids drawn from, and what must hold of any draw: each row at most once, and
    a size within five standard deviations of ``share`` (a column of the class) of the rows."""
    of = rows.groupBy("Class", "txn_id").agg(F.count("*").alias("n"))
    taken = drawn.groupBy("Class", "txn_id").agg(F.count("*").alias("k"))
    both = of.join(taken, ["Class", "txn_id"], "full")
    n, k = F.sum("n"), F.coalesce(F.sum("k"), F.lit(0))
    sums = both.groupBy("Class").agg(
        n.alias("n"),
        F.count("n").alias("n_ids"),
        F.bool_and(F.coalesce("k", F.lit(0)) <= F.coalesce("n", F.lit(0))).alias("is_part"),
        k.alias("k"),
    )
    spread = 5 * F.sqrt(F.col("n") * share * (1 - share))
    return sums.select("Class", "n", "n_ids", "is_part", (F.abs(F.col("k") - F.col("n") * share) <= spread + 1e-6).alias("right_size"))


def split_random(spark, sf):
    """Which rows go where depends on the partitioning, but the parts are the input, each row once, in the given ratio."""
    rows = stored_txn(spark, sf, "txn_id", "Class")
    train, test = split.split_random(rows)
    both = balance.union_all(train, test).groupBy("Class")
    whole = both.agg(F.count("*").alias("n_parts"), F.countDistinct("txn_id").alias("ids_parts"))
    return _draw_facts(rows, train, F.lit(0.8)).join(whole, "Class")


def sample_fraction(spark, sf):
    rows = stored_txn(spark, sf, "txn_id", "Class")
    return _draw_facts(rows, split.sample_fraction(rows, 0.1), F.lit(0.1))


def sample_rand(spark, sf):
    rows = stored_txn(spark, sf, "txn_id", "Class")
    return _draw_facts(rows, split.sample_rand(rows, 0.1), F.lit(0.1))


def sample_hash(spark, sf):
    return split.sample_hash(txn(spark, sf), 0.1, F.col("h")).select("txn_id", "Class")


def undersample(spark, sf):
    return balance.undersample(txn(spark, sf), F.col("h")).select("txn_id", "Class")


def undersample_random(spark, sf):
    rows = stored_txn(spark, sf, "txn_id", "Class")
    share = F.when(F.col("Class") == 1, 1.0).otherwise(balance.positive_ratio(rows))
    return _draw_facts(rows, balance.undersample_random(rows), share)


def union_all(spark, sf):
    rows = txn(spark, sf).select("txn_id", "Amount", "Class")
    both = balance.union_all(rows.where("Class = 1"), rows.select("Class", "txn_id", "Amount"))
    return both.groupBy("Class").agg(F.count("*").alias("n"), F.countDistinct("txn_id").alias("n_ids"))


def iqr_outliers(spark, sf):
    kept, _ = balance.drop_positive_outliers(ev(spark, sf), ["Amount", "Time"])
    return rounded(kept.select("event_id", "Amount", "Class"))


def iqr_fences(spark, sf):
    _, fences = balance.drop_positive_outliers(ev(spark, sf), ["Amount", "Time"])
    return rounded(fences)


def class_weights(spark, sf):
    weighted, _ = balance.with_class_weights(txn(spark, sf))
    sums = weighted.groupBy("Class").agg(
        F.count("*").alias("n"), F.min("classWeightCol").alias("weight"), F.sum("classWeightCol").alias("total")
    )
    return rounded(sums, 6)


# features and models


def scale_features(spark, sf):
    rows = stored_txn(spark, sf, "txn_id", *FEATURES)
    scaled = models.Pipeline(stages=models.scaling_stages(FEATURES)).fit(rows).transform(rows)
    return rounded(scaled.select("txn_id", *[vector_item("features", i).alias(f"z{i}") for i in range(len(FEATURES))]))


def _stump_fit(rows, kind, settings, weighted):
    weight = "classWeightCol" if weighted else None
    fitting = balance.with_class_weights(rows)[0] if weighted else rows
    estimator = models.make_estimator(kind, settings, weight=weight)
    return models.fit_pipeline(fitting, STUMP_FEATURES, estimator)


def _stump_rows(spark, sf):
    return stored_txn(spark, sf, *STUMP_FEATURES, "Class")


def _leaf_counts(rows, kind, settings, weighted=False):
    scored = models.score_table(_stump_fit(rows, kind, settings, weighted), rows)
    return scored.groupBy("Class", F.round("score", 6).alias("score")).agg(F.count("*").alias("n"))


def fit_rf_stump(spark, sf):
    return _leaf_counts(_stump_rows(spark, sf), "rf", STUMPS["rf"], weighted=True)


def fit_gbt_stump(spark, sf):
    return _leaf_counts(_stump_rows(spark, sf), "gbt", STUMPS["gbt"])


def _cell():
    """The number of a transaction's cell in a grid of two by two by two."""
    bits = [(F.col("V1") >= 25, 4), (F.col("V2") >= 0.05, 2), (F.col("V3") >= 0.04, 1)]
    return sum(F.when(hit, worth).otherwise(0) for hit, worth in bits)


def _graded(spark, sf):
    """The transactions with positives in every cell of a grid, in shares from 4 to 11 of 16, so that a deep tree has leaves of all kinds."""
    rows = txn(spark, sf)
    return staged(rows.select(*STUMP_FEATURES, F.when(F.col("h") % 16 < _cell() + 4, 1).otherwise(0).alias("Class")))


def fit_rf_tree(spark, sf):
    """One tree of three levels with class weights: every leaf's share."""
    return _leaf_counts(_graded(spark, sf), "rf", {**STUMPS["rf"], "maxDepth": 3}, weighted=True)


def fit_gbt_rounds(spark, sf):
    """Three rounds of boosting with trees of two levels: every sum of leaves."""
    return _leaf_counts(_graded(spark, sf), "gbt", {**STUMPS["gbt"], "maxDepth": 2, "maxIter": 3})


def fit_lr_prior(spark, sf):
    return _leaf_counts(_stump_rows(spark, sf), "lr", {"regParam": 10.0, "elasticNetParam": 1.0})


CELL_FEATURES = [f"cell{i}" for i in range(1, 8)]


def fit_lr_cells(spark, sf):
    """Unregularised, with one indicator for each cell of a grid but the first: a cell's probability is its positive share,
    with class weights its weighted share."""
    rows = txn(spark, sf)
    cell = _cell()
    label = F.when(F.col("h") % 16 < cell + 4, 1).otherwise(0)
    rows = rows.select(cell.alias("cell"), label.alias("Class"))
    marks = [F.when(F.col("cell") == i, 1.0).otherwise(0.0).alias(name) for i, name in enumerate(CELL_FEATURES, 1)]
    rows = staged(rows.select("cell", "Class", *marks))
    found = None
    for name, weight in (("plain", None), ("weighted", "classWeightCol")):
        fitting = balance.with_class_weights(rows)[0] if weight else rows
        estimator = models.make_estimator("lr", {"regParam": 0.0, "maxIter": 200, "tol": 1e-12}, weight=weight)
        scored = models.score_table(models.make_pipeline(CELL_FEATURES, estimator).fit(fitting), fitting)
        cells = scored.groupBy("cell").agg(F.count("*").alias("n"), F.round(F.max("score"), 4).alias("score"))
        cells = cells.select(F.lit(name).alias("model"), "*")
        found = cells if found is None else found.unionByName(cells)
    return found


def _fit(spark, sf, kind):
    """The study's settings and the job's weighting, fitted on the training part and judged on the test part.

    Beside exact counts: that the exact areas are those of MLlib's evaluator, are better than those of chance, and that the fit took time.
    """
    rows = stored_txn(spark, sf, "txn_id", "h", *FEATURES, "Class")
    train, test = (
        staged(part.select(*FEATURES, "Class"), "part") for part in split.split_stratified(rows, F.col("h"), F.col("txn_id"))
    )
    weight = "classWeightCol" if models.JOB_WEIGHTED[kind] else None
    fitting = balance.with_class_weights(train)[0] if weight else train
    estimator = models.make_estimator(kind, models.STUDY_SETTINGS[kind], weight=weight)
    model, seconds = models.timed(lambda: models.fit_pipeline(fitting, FEATURES, estimator))
    areas = models.areas_of(model, test).first()
    theirs = models.evaluator_areas(model.transform(test))
    agree = all(abs(theirs[metric] - areas[name]) < 1e-9 for name, metric in (("auprc_spark", "areaUnderPR"), ("auroc", "areaUnderROC")))
    sizes = rows.groupBy().agg(F.count("*").alias("n"), F.sum("Class").alias("n_positive"))
    judged = test.agg(F.count("*").alias("n_test"), F.sum("Class").alias("n_test_positive"), F.avg("Class").alias("share"))
    better = (F.lit(areas["auprc_spark"]) > F.col("share")) & F.lit(areas["auroc"] > 0.5)
    return sizes.join(F.broadcast(judged)).select(
        F.lit(kind).alias("model"),
        "n",
        "n_positive",
        "n_test",
        "n_test_positive",
        F.lit(agree).alias("areas_agree"),
        better.alias("beats_chance"),
        F.lit(seconds > 0).alias("timed"),
    )


def fit_lr(spark, sf):
    return _fit(spark, sf, "lr")


def fit_rf(spark, sf):
    return _fit(spark, sf, "rf")


def fit_gbt(spark, sf):
    return _fit(spark, sf, "gbt")


def _tuned_rows(spark, tuned, measures):
    """Each candidate, whether its AUPRC is one, and that the best is among them and was fitted again."""
    names = [sorted((p.name, str(v)) for p, v in params.items()) for params in tuned.getEstimatorParamMaps()]
    chosen = tuned.bestModel.stages[-1]
    best = measures.index(max(measures))
    refitted = all(str(chosen.getOrDefault(p)) == v for p, v in names[best])
    rows = [(", ".join(f"{p}={v}" for p, v in c), 0 < m <= 1, refitted) for c, m in zip(names, measures)]
    return small_table(spark, rows, "candidate string, plausible boolean, best_refitted boolean")


def tune_tvs(spark, sf):
    rows = balance.with_class_weights(stored_txn(spark, sf, "h", *FEATURES, "Class"))[0]
    estimator = models.make_estimator("lr", weight="classWeightCol")
    tuned = models.tune_by_split(rows, FEATURES, estimator, models.GRIDS["lr"], h=F.col("h"))
    return _tuned_rows(spark, tuned, tuned.validationMetrics)


def tune_cv(spark, sf):
    rows = staged(balance.undersample(stored_txn(spark, sf, "h", *FEATURES, "Class"), F.col("h")))
    # undersampling keeps the smallest hashes; folds only need them spread modulo 3
    tuned = models.tune_by_folds(rows, FEATURES, models.make_estimator("lr"), models.GRIDS["lr"], h=F.col("h"))
    return _tuned_rows(spark, tuned, list(tuned.avgMetrics))


#: A lone node and a stump, with and without a least number of rows in a leaf.
STUMP_GRID = {"maxDepth": [0, 1], "minInstancesPerNode": [1, 3000]}


def _named(params) -> str:
    return ", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda x: x[0].name))


def tune_stumps(spark, sf):
    """The area of every candidate, which is chosen, and what the refitted one gives the rows."""
    rows = balance.with_class_weights(stored_txn(spark, sf, "h", *STUMP_FEATURES, "Class"))[0]
    estimator = models.make_estimator("rf", STUMPS["rf"], weight="classWeightCol")
    tuned = models.tune_by_split(rows, STUMP_FEATURES, estimator, STUMP_GRID, h=F.col("h"))
    top = tuned.validationMetrics.index(max(tuned.validationMetrics))
    leaves = models.score_table(tuned.bestModel, rows).agg(F.max("score").alias("highest"), F.countDistinct("score").alias("leaves")).first()
    found = [
        (_named(c), area, i == top, *(leaves if i == top else (None, None)))
        for i, (c, area) in enumerate(zip(tuned.candidates, tuned.validationMetrics))
    ]
    return rounded(small_table(spark, found, "candidate string, auprc double, chosen boolean, highest double, leaves bigint"))


def tune_cv_stumps(spark, sf):
    """The area of every candidate in every fold, its mean, and which candidate is chosen."""
    rows = balance.with_class_weights(stored_txn(spark, sf, "h", *STUMP_FEATURES, "Class"))[0]
    estimator = models.make_estimator("rf", STUMPS["rf"], weight="classWeightCol")
    tuned = models.tune_by_folds(rows, STUMP_FEATURES, estimator, STUMP_GRID, h=F.col("h"))
    top = tuned.avgMetrics.index(max(tuned.avgMetrics))
    found = [
        (k, _named(c), area, tuned.avgMetrics[i], i == top)
        for k, areas in enumerate(tuned.foldMetrics)
        for i, (c, area) in enumerate(zip(tuned.candidates, areas))
    ]
    return rounded(small_table(spark, found, "fold int, candidate string, auprc double, mean double, chosen boolean"))


def evaluator_bins(spark, sf):
    """Areas of curves that are thinned to 20 and to 1,000 bins, for scores with few and with many distinct values."""
    found = None
    for bins in (20, 1000):
        points = curves.curve_points(two_scores(spark, sf), by=["model"], bins=bins)
        areas = curves.curve_areas(points, ["model"]).select(F.lit(bins).alias("bins"), "model", "auroc", "auprc_spark", "n_thresholds")
        found = areas if found is None else found.unionByName(areas)
    return rounded(found)


def best_model(spark, sf):
    return rounded(models.best_model(curves.compare_scores(two_scores(spark, sf))))


def save_load_score(spark, sf):
    rows = stored_txn(spark, sf, *STUMP_FEATURES, "Class")
    model = _stump_fit(rows, "rf", STUMPS["rf"], weighted=True)
    path = scratch_path(spark, "scoring")
    save_model(model, f"{path}/model")
    io.sink_parquet(rows, f"{path}/input")
    return rounded(score(spark, f"{path}/model", f"{path}/input", f"{path}/scores", threshold=0.5))


def apply_model(spark, sf):
    rows = stored_txn(spark, sf, "txn_id", *STUMP_FEATURES, "Class")
    model = _stump_fit(rows, "rf", STUMPS["rf"], weighted=True)
    path = scratch_path(spark, "model")
    save_model(model, path)
    scored = models.score_table(load_model(path), rows)
    return rounded(thresholds.with_prediction(scored, 0.5).select("txn_id", "score", "prediction", "prediction_thresh"))


# evaluation


def threshold_predict(spark, sf):
    predicted = thresholds.with_prediction(txn(spark, sf), 0.5)
    return predicted.select("txn_id", "prediction_thresh")


def threshold_metrics(spark, sf):
    return rounded(thresholds.prediction_metrics(thresholds.with_prediction(txn(spark, sf), 0.5)))


def confusion_matrix(spark, sf):
    cells = thresholds.prediction_metrics(thresholds.with_prediction(txn(spark, sf), 0.5))
    return thresholds.confusion_rows(cells)


def threshold_sweep(spark, sf):
    return rounded(thresholds.threshold_sweep(txn(spark, sf)))


def sweep_by_model(spark, sf):
    return rounded(thresholds.threshold_sweep(two_scores(spark, sf), by=["model"]))


def best_threshold(spark, sf):
    return rounded(thresholds.best_threshold(thresholds.threshold_sweep(txn(spark, sf))))


def best_threshold_predict(spark, sf):
    rows = txn(spark, sf)
    return thresholds.with_best_prediction(rows, thresholds.threshold_sweep(rows)).select("txn_id", "prediction_best_f1")


def pr_curve(spark, sf):
    return rounded(curves.pr_curve(curves.curve_points(txn(spark, sf))))


def roc_curve(spark, sf):
    return rounded(curves.roc_curve(curves.curve_points(txn(spark, sf))))


def curve_points_amount(spark, sf):
    """Almost every score is distinct here, so the running totals go through score ranges."""
    points = curves.curve_points(txn(spark, sf), score="Amount")
    return rounded(points.select("score", "tp", "fp", "fn", "tn", "precision", "recall", "fpr", "f1"))


def curve_areas(spark, sf):
    return rounded(curves.curve_areas(curves.curve_points(txn(spark, sf))))


def evaluator_areas(spark, sf):
    rows = txn(spark, sf)
    values = [
        (name, float(models.make_evaluator(metric, raw="score").evaluate(rows)))
        for name, metric in (("auprc_spark", "areaUnderPR"), ("auroc", "areaUnderROC"))
    ]
    return rounded(small_table(spark, values, "metric string, value double"))


def best_f1(spark, sf):
    return rounded(curves.best_f1(curves.curve_points(txn(spark, sf))))


def compare_scores(spark, sf):
    return rounded(curves.compare_scores(two_scores(spark, sf)))


def compare_confusion(spark, sf):
    return curves.comparison_confusion(curves.compare_scores(two_scores(spark, sf)))


# jobs


def _raw_csv(spark, sf, columns):
    path = scratch_path(spark, "raw")
    io.sink_csv(txn(spark, sf).select(*columns, "Class"), path)
    return path


def prepare_job(spark, sf):
    raw = _raw_csv(spark, sf, ["V1", "V2", "V3"])
    return prepare(spark, raw, scratch_path(spark, "prepared"))


def _copied_rows(spark, sf):
    """All columns of the raw table, every fifth hash twice and every fiftieth three times."""
    rows = txn(spark, sf)
    copies = F.lit(1) + F.when(F.col("h") % 5 == 0, 1).otherwise(0) + F.when(F.col("h") % 50 == 0, 1).otherwise(0)
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).select(*FEATURES, "Class")


def prepare_copies(spark, sf):
    """The job over all columns and real duplicates: the counts of every stage and what the parts hold."""
    out, raw = scratch_path(spark, "prepared"), scratch_path(spark, "raw")
    io.sink_csv(_copied_rows(spark, sf), raw)
    stats = prepare(spark, raw, out)
    parts = [io.scan_parquet(spark, f"{out}/{name}") for name in ("train", "test")]
    held = parts[0].unionByName(parts[1]).groupBy("Class").agg(
        F.count("*").alias("n"), *[F.sum(c).alias(f"sum_{c}") for c in FEATURES]
    )
    figures = held.select(F.lit("parts").alias("stage"), "Class", "n", *[F.round(f"sum_{c}", 2).alias(f"sum_{c}") for c in FEATURES])
    return stats.unionByName(figures, allowMissingColumns=True)


def prepare_rows(spark, sf):
    """The train and test tables put together are the distinct input rows, each once."""
    out = scratch_path(spark, "prepared")
    prepare(spark, _raw_csv(spark, sf, ["V1", "V2", "V3"]), out)
    return io.scan_parquet(spark, f"{out}/train").unionByName(io.scan_parquet(spark, f"{out}/test"))


def train_job(spark, sf):
    """The whole job with its own settings and grid; exact counts, and facts of the figures that it wrote."""
    rows = stored_txn(spark, sf, "txn_id", "h", *FEATURES, "Class")
    path = scratch_path(spark, "trained")
    for name, part in zip(("train", "test"), split.split_stratified(rows, F.col("h"), F.col("txn_id"))):
        io.sink_parquet(part.select(*FEATURES, "Class"), f"{path}/{name}")
    metrics = train(spark, f"{path}/train", f"{path}/test", f"{path}/model", f"{path}/metrics", "gbt")
    return _job_facts(metrics)


def train_job_trees(spark, sf):
    """The job with small trees, for which every area that it writes can be told exactly; a lone node is the other candidate."""
    rows = stored_txn(spark, sf, "txn_id", "h", *STUMP_FEATURES, "Class")
    path = scratch_path(spark, "trained")
    for name, part in zip(("train", "test"), split.split_stratified(rows, F.col("h"), F.col("txn_id"))):
        io.sink_parquet(part.select(*STUMP_FEATURES, "Class"), f"{path}/{name}")
    found = None
    for kind in ("rf", "gbt"):
        rounds = {"maxIter": [2]} if kind == "gbt" else {}
        settings = {k: v for k, v in STUMPS[kind].items() if k not in ("maxDepth", "maxIter")}
        metrics = train(
            spark, f"{path}/train", f"{path}/test", f"{path}/{kind}", f"{path}/metrics_{kind}", kind,
            grid={"maxDepth": [0, 2], **rounds}, settings=settings,
        )
        counts = [F.col(f"train_counts.`{c}`").alias(name) for c, name in ((0, "train_negatives"), (1, "train_positives"))]
        metrics = metrics.select("model", "auprc", "auroc", "auprc_one", *counts)
        found = metrics if found is None else found.unionByName(metrics)
    return rounded(found)


def _job_facts(metrics):
    """Class counts of the training part, that the areas are shares and beat chance, and that the fit took time."""
    counts = [F.col(f"train_counts.`{c}`").alias(name) for c, name in ((0, "train_negatives"), (1, "train_positives"))]
    plausible = F.col("auprc").between(0, 1) & F.col("auroc").between(0.5, 1)
    return metrics.select("model", *counts, plausible.alias("plausible"), (F.col("fit_seconds") > 0).alias("timed"))


def full_run_job(spark, sf):
    """All three families with the job's own settings and grids, then the scores' cells at 0.5."""
    path = scratch_path(spark, "run")
    done = full_run(spark, _raw_csv(spark, sf, FEATURES), f"{path}/processed", f"{path}/models")
    cells = done["score"].select(
        F.lit("gbt").alias("model"), (F.col("tp") + F.col("fn")).alias("positives"), (F.col("fp") + F.col("tn")).alias("negatives")
    )
    return _job_facts(done["metrics"]).join(cells, "model", "left")


def study(spark, sf):
    """The study with its own grid: exact sizes of the held-out part, and that the sweep, the curves and the choice agree."""
    found = run_study(
        stored_txn(spark, sf, *FEATURES, "Class"),
        scratch_path(spark, "study-models"),
        trim=("Amount", "V1"),
        boxplots=("V1", "V2", "V3", "Amount"),
    )
    compared = found.tables["comparison"].join(found.tables["fit_seconds"], "model")
    swept = found.tables["best_threshold"].select("model", F.col("f1").alias("swept_f1"))
    return compared.join(swept, "model").select(
        "model",
        (F.col("tp") + F.col("fn")).alias("positives"),
        (F.col("fp") + F.col("tn")).alias("negatives"),
        F.col("auroc").between(0.5, 1).alias("auroc_plausible"),
        (F.col("swept_f1") <= F.col("f1") + 1e-6).alias("f1_is_best"),
        (F.col("fit_seconds") > 0).alias("timed"),
    )
