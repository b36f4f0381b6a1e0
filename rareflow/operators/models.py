"""MLlib pipelines for the three classifiers: build, tune, fit, apply, compare."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rareflow.functions.columns import col, free_name, vector_item
from rareflow.functions.hashing import row_hash
from rareflow.operators.cells import fit_cells, rows_by_cell
from rareflow.operators.curves import curve_areas, curve_points, points_of, score_totals, thinned
from rareflow.operators.drawn import Binned, binned_rows, fit_drawn
from rareflow.operators.forests import fit_forests
from rareflow.operators.split import mark_hash_split, parts
from rareflow.schema import LABEL
from rareflow.session import staged

ESTIMATORS = {"lr": LogisticRegression, "rf": RandomForestClassifier, "gbt": GBTClassifier}

# fixed values: estimator settings of the batch job and of the study, which of them use class weights, and the grids
JOB_SETTINGS = {
    "lr": {},
    "rf": {"numTrees": 200, "maxDepth": 10, "subsamplingRate": 0.8},
    "gbt": {"maxDepth": 5, "maxIter": 50, "subsamplingRate": 0.8},
}
STUDY_SETTINGS = {"lr": {}, "rf": {"numTrees": 20}, "gbt": {"maxIter": 20}}
JOB_WEIGHTED = {"lr": True, "rf": True, "gbt": False}
GRIDS = {
    "lr": {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5]},
    "rf": {"maxDepth": [8, 12], "numTrees": [100, 200]},
    "gbt": {"maxIter": [30, 60], "maxDepth": [4, 6]},
}
DEFAULT_BINS = 1_000
#: Rows that fits running at a time keep in memory together, at 60 to 200 bytes each
ROWS_AT_ONCE = 32_000_000
VECTORS = ("features_raw", "features", "rawPrediction", "probability")


def scaling_stages(features: Sequence[str], on_missing: str = "error") -> list:
    """Assemble the columns, then divide each by its sample deviation (no centring)."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features_raw", handleInvalid=on_missing)
    return [assembler, StandardScaler(inputCol="features_raw", outputCol="features")]


def make_estimator(
    kind: str, settings: Mapping[str, Any] | None = None, label: str = LABEL, weight: str | None = None, seed: int = 42
):
    if kind not in ESTIMATORS:
        raise ValueError(f"unknown model type {kind!r}, expected one of {sorted(ESTIMATORS)}")
    params = {"featuresCol": "features", "labelCol": label, **(settings or {})}
    if kind != "lr":
        params["seed"] = seed
    if weight is not None:
        params["weightCol"] = weight
    return ESTIMATORS[kind](**params)


def make_pipeline(features: Sequence[str], estimator, on_missing: str = "error") -> Pipeline:
    return Pipeline(stages=[*scaling_stages(features, on_missing), estimator])


def fit_pipeline(train: DataFrame, features: Sequence[str], estimator) -> PipelineModel:
    """``make_pipeline(...).fit(train)``; trees that draw no rows grow from cells of equally binned rows where these are far fewer."""
    return fit_pipelines(train, features, [estimator])[0]


def fit_pipelines(train: DataFrame, features: Sequence[str], estimators: Sequence, parallelism: int = 1) -> list[PipelineModel]:
    """A fitted pipeline for each estimator; the deviations, and the cells that trees grow from, are taken once for all."""
    scaling = Pipeline(stages=scaling_stages(features)).fit(train)
    cells = rows_by_cell(train, features, estimators)
    scaled = scaling.transform(train)
    binned = binned_rows(scaled, len(features), estimators) if cells is None else None
    longest = _longest_runs(estimators)
    wanted = sorted(set(longest))

    def fit(estimator):
        if binned is not None:
            return fit_drawn(estimator, binned, train.sparkSession)
        return estimator.fit(scaled) if cells is None else fit_cells(estimator, scaling, cells)

    try:
        if binned is not None and not isinstance(estimators[0], GBTClassifier):
            return [PipelineModel(stages=[*scaling.stages, model]) for model in fit_forests(estimators, binned, train.sparkSession)]
        together = at_once(train if binned is None else binned, parallelism) if min(parallelism, len(wanted)) > 1 else 1
        found = dict(zip(wanted, _fit_each(train.sparkSession, [partial(fit, estimators[i]) for i in wanted], together)))
    finally:
        if binned is not None:
            binned.blocks.unpersist()
    fitted = [found[k] if k == i else first_rounds(found[k], estimators[i].getMaxIter()) for i, k in enumerate(longest)]
    return [PipelineModel(stages=[*scaling.stages, model]) for model in fitted]


def _longest_runs(estimators: Sequence) -> list[int]:
    """For each estimator the number of the one whose fit holds its own: of boostings that differ in their rounds only, the one with most."""

    def rest(e) -> dict | None:
        if not isinstance(e, GBTClassifier) or e.isDefined(e.validationIndicatorCol) and e.getValidationIndicatorCol():
            return None
        return {p.name: v for p, v in e.extractParamMap().items() if p.name != "maxIter"}

    rests, longest = [rest(e) for e in estimators], []
    for i, mine in enumerate(rests):
        alike = [k for k, other in enumerate(rests) if mine is not None and other == mine]
        longest.append(max(alike, key=lambda k: (estimators[k].getMaxIter(), -k), default=i))
    return longest


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model that boosting of so many rounds gives: a round follows from its seed and the rounds before, however many come after."""
    trees, weights = model.trees[:rounds], model.treeWeights[:rounds]
    gateway = SparkContext._active_spark_context._gateway
    ensemble = gateway.jvm.org.apache.spark.ml.classification
    own = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    shares = gateway.new_array(gateway.jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        own[i], shares[i] = tree._java_obj, weight
    short = GBTClassificationModel(ensemble.GBTClassificationModel(model.uid, own, shares, model.numFeatures, model.numClasses))
    return model.copy({model.maxIter: rounds})._copyValues(short)


def make_grid(estimator, values: Mapping[str, Sequence]) -> list:
    builder = ParamGridBuilder()
    for name, choices in values.items():
        builder.addGrid(estimator.getParam(name), list(choices))
    return builder.build()


def make_evaluator(metric: str = "areaUnderPR", label: str = LABEL, raw: str = "rawPrediction", bins: int = 0):
    """MLlib's evaluator; ``bins=0`` keeps every point of the curve, ``bins=1000`` is MLlib's own default."""
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw, metricName=metric, numBins=bins)


def evaluator_areas(scored: DataFrame, label: str = LABEL, raw: str = "rawPrediction", bins: int = 0) -> dict[str, float]:
    """Both areas of MLlib's evaluator, which sorts the scores once for the two."""
    evaluator = make_evaluator(label=label, raw=raw, bins=bins)
    evaluator._transfer_params_to_java()
    metrics = evaluator._java_obj.getMetrics(scored._jdf)
    try:
        return {"areaUnderPR": metrics.areaUnderPR(), "areaUnderROC": metrics.areaUnderROC()}
    finally:
        metrics.unpersist()


@dataclass
class Search:
    """What a search over candidates found, under the names of MLlib's own search models.

    ``foldMetrics`` has the areas of a cross-validation by fold, each in the candidates' order; ``validationMetrics`` are their means.
    """

    bestModel: PipelineModel
    validationMetrics: list[float]
    candidates: list[dict]
    foldMetrics: list[list[float]]

    @property
    def avgMetrics(self) -> list[float]:
        return self.validationMetrics

    def getEstimatorParamMaps(self) -> list[dict]:
        return self.candidates


def _fit_each(spark: SparkSession, works: Sequence[Callable[[], Any]], parallelism: int) -> list:
    """The results of several fits, some of which run at a time."""
    with ThreadPool(max(1, min(parallelism, len(works)))) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda work: work()), works)


def at_once(rows: DataFrame | Binned, parallelism: int) -> int:
    """How many fits run at a time: each keeps the rows in memory, and one alone has work for all cores where these are many."""
    return max(1, min(parallelism, ROWS_AT_ONCE // max(rows.count(), 1)))


def areas_by_model(scored: DataFrame, label: str = LABEL, bins: int = 0) -> dict[str, float]:
    """AUPRC of every model of ``scored(label, model, margin)``: the points of all from one shuffle by model and margin."""
    points = curve_points(scored, label, "margin", ["model"], bins=bins)
    return {r["model"]: r["auprc_spark"] for r in curve_areas(points, ["model"]).collect()}


def tune_by_split(
    train: DataFrame,
    features: Sequence[str],
    estimator,
    grid: Mapping[str, Sequence],
    label: str = LABEL,
    ratio: float = 0.8,
    parallelism: int = 2,
    seed: int = 42,
    bins: int = 0,
    h: Column | None = None,
) -> Search:
    """Every candidate pipeline is fitted on one part and judged by AUPRC on the other; the best is refitted on all.

    A row's part follows from its hash ``h``, by default over all its columns, so the same rows are judged on any
    partitioning. Both parts are written once, as each candidate reads them. The judged part is scored by all candidates in
    one scan, and one shuffle has the curves of all. Among equals the first candidate wins.
    """
    marked = mark_hash_split(train, ratio, row_hash(train.columns, seed) if h is None else h, "_part")
    fitting, judged = (staged(part, "search") for part in parts(marked, "_part"))
    candidates = make_grid(estimator, grid)
    fitted = fit_pipelines(fitting, features, [estimator.copy(c) for c in candidates], parallelism)
    found = areas_by_model(score_by_models({str(i): m for i, m in enumerate(fitted)}, judged, [label]), label, bins)
    areas = [found[str(i)] for i in range(len(candidates))]
    best = candidates[areas.index(max(areas))]
    return Search(fit_pipeline(train, features, estimator.copy(best)), areas, candidates, [areas])


def fold_scales(rows: DataFrame, features: Sequence[str], fold: str, folds: int) -> list[list[float]]:
    """For each fold the factors that divide the features by their sample deviations over all other folds, from one scan.

    Numbers, means and squared deviations are summed up by fold; those of the others are put together for each fold left out.
    """
    figures = [F.struct(F.count(col(c)).alias("n"), F.avg(col(c)).alias("mean"), F.var_pop(col(c)).alias("var")).alias(f"_{i}") for i, c in enumerate(features)]
    by_fold = {r[fold]: r for r in rows.groupBy(fold).agg(*figures).collect()}
    scales = []
    for left_out in range(folds):
        factors = []
        for i in range(len(features)):
            parts_ = [r[f"_{i}"] for k, r in by_fold.items() if k != left_out and r[f"_{i}"]["n"]]
            n = sum(p["n"] for p in parts_)
            mean = sum(p["n"] * p["mean"] for p in parts_) / n if n else 0.0
            squares = sum(p["n"] * (p["var"] + (p["mean"] - mean) ** 2) for p in parts_)
            deviation = math.sqrt(squares / (n - 1)) if n > 1 else 0.0
            factors.append(1 / deviation if deviation else 0.0)
        scales.append(factors)
    return scales


def tune_by_folds(
    train: DataFrame,
    features: Sequence[str],
    estimator,
    grid: Mapping[str, Sequence],
    label: str = LABEL,
    folds: int = 3,
    parallelism: int = 2,
    h: Column | None = None,
    seed: int = 42,
    bins: int = 0,
) -> Search:
    """Cross-validation by AUPRC, with the features scaled as the training folds are; the best candidate is refitted on all.

    A row's fold is its hash ``h``, by default over all its columns, modulo ``folds``, the same on any partitioning. The rows are
    written once, by fold, so a fit reads its folds only; the deviations of all folds come from one scan. Every candidate of every fold
    is judged in one job, over one scan and one shuffle by fold, candidate and margin. Among equals the first candidate wins.
    """
    fold = free_name(train, "fold")
    number = F.pmod(row_hash(train.columns, seed) if h is None else h, F.lit(folds)).cast("int")
    rows = staged(train.withColumn(fold, number), "folds", by=[fold])
    candidates = make_grid(estimator, grid)
    estimators = [estimator.copy(c) for c in candidates]
    assembler, scaler = scaling_stages(features)
    cells = rows_by_cell(rows, features, estimators, by=[fold])

    works = []
    for left_out, factors in enumerate(fold_scales(rows, features, fold, folds)):
        scaled = ElementwiseProduct(scalingVec=Vectors.dense(factors), inputCol=scaler.getInputCol(), outputCol=scaler.getOutputCol())
        scaling = PipelineModel(stages=[assembler, scaled])
        works += [partial(_fit_others, e, scaling, rows if cells is None else cells, col(fold) != left_out, cells is not None) for e in estimators]
    fitted = _fit_each(train.sparkSession, works, at_once(rows if cells is None else cells, parallelism))
    scored = None
    for left_out in range(folds):
        mine = fitted[left_out * len(candidates) : (left_out + 1) * len(candidates)]
        named = {f"{left_out}:{i}": m for i, m in enumerate(mine)}
        scores = score_by_models(named, rows.where(col(fold) == left_out), [label])
        scored = scores if scored is None else scored.unionByName(scores)
    found = areas_by_model(scored, label, bins)
    by_fold = [[found[f"{k}:{i}"] for i in range(len(candidates))] for k in range(folds)]
    areas = [sum(a) / folds for a in zip(*by_fold)]
    best = candidates[areas.index(max(areas))]
    if cells is None:
        return Search(fit_pipeline(train, features, estimator.copy(best)), areas, candidates, by_fold)
    scaling = Pipeline(stages=scaling_stages(features)).fit(train)
    return Search(_fit_others(estimator.copy(best), scaling, cells, F.lit(True), True), areas, candidates, by_fold)


def _fit_others(estimator, scaling: PipelineModel, table: DataFrame, others: Column, by_cell: bool) -> PipelineModel:
    """The pipeline fitted on the rows, or the cells, of the other folds."""
    mine = table.where(others)
    model = fit_cells(estimator, scaling, mine) if by_cell else estimator.fit(scaling.transform(mine))
    return PipelineModel(stages=[*scaling.stages, model])


def add_score(predicted: DataFrame, keep_vectors: bool = False) -> DataFrame:
    """``score`` is the probability of the positive class; the vectors go unless asked for."""
    scored = predicted.withColumn("score", vector_item("probability"))
    return scored if keep_vectors else scored.drop(*VECTORS)


def score_table(model: PipelineModel, df: DataFrame, keep_vectors: bool = False) -> DataFrame:
    return add_score(model.transform(df), keep_vectors)


def score_by_models(models: Mapping[str, PipelineModel], df: DataFrame, carry: Sequence[str] = (LABEL,)) -> DataFrame:
    """Scores of several models over one scan of the table, as rows ``(*carry, model, score, margin)``.

    ``margin`` is the raw prediction, which keeps scores apart that the probability rounds together.
    """
    wide = df
    for i, model in enumerate(models.values()):
        wide = model.transform(wide)
        both = F.struct(vector_item("probability").alias("score"), vector_item("rawPrediction").alias("margin"))
        wide = wide.withColumn(f"_s{i}", both).drop(*VECTORS, "prediction")
    each = [F.struct(F.lit(name).alias("model"), f"_s{i}.score", f"_s{i}.margin") for i, name in enumerate(models)]
    return wide.select(*[col(c) for c in carry], F.inline(F.array(*each)))


def areas_of(model: PipelineModel, df: DataFrame, label: str = LABEL) -> DataFrame:
    """Exact areas of the model's margins, and those at the evaluator's default number of bins, from one pass over the table."""
    margins = model.transform(df).select(label, vector_item("rawPrediction").alias("margin"))
    totals = score_totals(margins, label, "margin")
    binned = curve_areas(points_of(thinned(totals, DEFAULT_BINS))).first()
    extra = {"auprc_binned": F.lit(binned["auprc_spark"]), "auroc_binned": F.lit(binned["auroc"])}
    return curve_areas(points_of(totals)).withColumns(extra)


def timed(work: Callable[[], Any]) -> tuple[Any, float]:
    """The result and the wall seconds; only meaningful around an action."""
    start = time.monotonic()
    return work(), time.monotonic() - start


def best_model(metrics: DataFrame, by: str = "auprc_spark", model: str = "model") -> DataFrame:
    """The model with the highest value, the first name among equals."""
    first = metrics.orderBy(F.desc(by), model).limit(1)
    return first.select(model, by)
