"""Model training, tuning and batch prediction with Spark ML pipelines.

Every model is ``Pipeline([TabularPrep, regressor])``: the preparation is
refitted inside every cross-validation fold, as in the reference, and the
fitted ``PipelineModel`` carries its own preprocessing (no routing by model
kind at prediction time).
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ridgeline.functions.cache import passes_over
from ridgeline.operators.prepare import TabularPrep
from ridgeline.spec import FeatureSpec

SEED = 42
MAX_DEPTH_UNLIMITED = 30  # Spark's largest tree depth stands in for "no limit"

SPLIT = "minRowsToSplit"  # grid dimension of trees, see operators/tree_grid.py

# The hyper-parameter grids, in Spark names (the column share of a
# boosted tree becomes the per-node feature fraction).
DT_GRID = {"maxDepth": [3, 5, 8, 12, 20, MAX_DEPTH_UNLIMITED], "minInstancesPerNode": [1, 2, 5, 10],
           SPLIT: [2, 5, 10, 20]}
RF_GRID = {"numTrees": [100, 200], "maxDepth": [MAX_DEPTH_UNLIMITED, 10, 20],
           SPLIT: [2, 5, 10], "minInstancesPerNode": [1, 2, 5]}
GBT_GRID = {"maxIter": [200, 500], "maxDepth": [3, 5, 8], "stepSize": [0.01, 0.05, 0.1],
            "subsamplingRate": [0.8, 1.0], "featureSubsetStrategy": ["0.8", "all"]}
CV_FOLDS = 5
ROWS_PER_FIT_PARTITION = 25_000
MAX_FIT_PARTITIONS = 20_000

#: Dimensions of a grid that are scored by cutting one fitted model.
CUTS = {"decision_tree": ("maxDepth", SPLIT), "random_forest": ("numTrees", "maxDepth", SPLIT), "xgboost": ("maxIter",)}
TREES = {"random_forest": "numTrees", "xgboost": "maxIter"}

MODEL_KINDS = ["linear_regression", "decision_tree", "random_forest", "xgboost"]
TREE_KINDS = {"decision_tree", "random_forest", "xgboost"}
DRAWS = {"random_forest", "xgboost"}  # learners that draw rows per partition
SCALED_KINDS = {"linear_regression", "spark_linear", "mlp"}


def regressor(kind: str, label: str, **params):
    common = {"featuresCol": "features", "labelCol": label, "predictionCol": "prediction"}
    if kind == "linear_regression":
        # one-pass Gram matrix + minimum-norm solve (see operators/ols.py);
        # Spark's LinearRegression stays available as kind "spark_linear"
        from ridgeline.operators.ols import OLSRegressor
        return OLSRegressor(**common)
    if kind == "spark_linear":
        return LinearRegression(regParam=0.0, elasticNetParam=0.0, solver="auto", **common, **params)
    if kind == "decision_tree":
        # a deep tree is not walked from its root again at every level
        return DecisionTreeRegressor(seed=SEED, maxBins=64, cacheNodeIds=True, **common, **params)
    if kind == "random_forest":
        return RandomForestRegressor(seed=SEED, maxBins=64, featureSubsetStrategy="all",
                                     bootstrap=True, **common, **params)
    if kind == "xgboost":
        return GBTRegressor(seed=SEED, maxBins=64, lossType="squared", **common, **params)
    raise ValueError(f"unknown model kind {kind!r}")


def build_pipeline(spec: FeatureSpec, kind: str, **params) -> Pipeline:
    """M1-M4: preparation (scaled for linear / neural models) + regressor."""
    prep = TabularPrep(numericCols=list(spec.numeric), categoricalCols=list(spec.categorical),
                       scale=kind in SCALED_KINDS)
    return Pipeline(stages=[prep, regressor(kind, spec.target, **params)])


def fit(spec: FeatureSpec, kind: str, train: DataFrame, **params) -> PipelineModel:
    """Fit preparation + regressor; the labelled training rows are built once
    and kept for the fit's passes (preparation statistics, the learner's
    own first passes), then released."""
    rows = fit_rows(spec, train) if kind in DRAWS else labelled_rows(spec, train)
    with passes_over(rows) as rows:
        return build_pipeline(spec, kind, **params).fit(rows)


def fit_early_stopped(spec: FeatureSpec, train: DataFrame, val_col: str, **params) -> PipelineModel:
    """M6 for boosting: trees are grown on the rows where ``val_col`` is false, until
    a round improves the squared error on the others by less than ``validationTol``
    (a share of it); the trees up to the best round are kept."""
    with passes_over(fit_rows(spec, train, [val_col])) as rows:
        prep, boosting = build_pipeline(spec, "xgboost", **params).getStages()
        return Pipeline(stages=[prep, boosting.setValidationIndicatorCol(val_col)]).fit(rows)


def boosting_curve(spec: FeatureSpec, model: PipelineModel, rows: DataFrame) -> list[float]:
    """RMSE on ``rows`` after each round of a boosted model, all rounds in one scan."""
    from ridgeline.operators.explain import ensemble
    from ridgeline.operators.tree_grid import grid_errors

    trees = ensemble(rows.sparkSession, model.stages[-1])
    vectors = model.stages[0].transform(labelled_rows(spec, rows)).select("features", spec.target)
    errors = grid_errors(trees, False, vectors, spec.target, list(range(1, len(trees) + 1)), [MAX_DEPTH_UNLIMITED], [0])
    return [float(e) for e in errors[:, 0, 0]]


def labelled_rows(spec: FeatureSpec, train: DataFrame, keep: list[str] = ()) -> DataFrame:
    return train.filter(F.col(spec.target).isNotNull()).select(*[f"`{c}`" for c in [*spec.features, spec.target, *keep]])


def fit_rows(spec: FeatureSpec, train: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Labelled training rows, dealt and ordered by a hash of their values into
    as many partitions as their number asks for, up to a bound. Learners that draw rows per
    partition (bagging, subsampling) then give the same model whatever the
    input's partitions or the cluster's size."""
    rows = labelled_rows(spec, train, keep)
    parts = min(MAX_FIT_PARTITIONS, max(1, -(-rows.count() // ROWS_PER_FIT_PARTITION)))
    digest = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    return (rows.withColumn("_digest", digest).repartition(parts, "_digest")
            .sortWithinPartitions("_digest").drop("_digest"))


def param_grid(est, grid: dict[str, list]) -> list:
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(est.getParam(name), values)
    return b.build()


@dataclass
class CVResult:
    avgMetrics: list[float]
    foldMetrics: list[list[float]]
    bestIndex: int
    bestModel: PipelineModel


def cross_validate(spec: FeatureSpec, kind: str, train: DataFrame, grid: dict[str, list],
                   fold_col: str = "fold", parallelism: int = 4, folds: int = CV_FOLDS):
    """M8: exhaustive grid x k-fold CV on RMSE; score = mean of the per-fold
    RMSE, first best on ties, best point refit on all training rows.

    The preparation depends only on the fold's training rows, not on the
    grid point, so it is refit once per fold (as the reference's pipeline
    refits it per fold) and the fold's prepared vectors are persisted while
    every grid point is fitted on them, ``parallelism`` fits at a time. The
    result equals refitting the whole pipeline for every (fold, point).
    Folds come from a hash column: the same on every run and executor."""
    pipe = build_pipeline(spec, kind)
    prep, reg = pipe.getStages()
    with passes_over(fit_rows(spec, train, [fold_col])) as labelled:
        if kind in CUTS:
            return _cross_validate_cut(spec, kind, pipe, prep, reg, grid, labelled, fold_col, parallelism, folds)
        maps = param_grid(reg, grid)
        return _cross_validate(spec, pipe, prep, reg, maps, labelled, fold_col, parallelism, folds)


def grid_points(grid: dict[str, list]) -> list[dict]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def _cross_validate_cut(spec, kind, pipe, prep, reg, grid, labelled, fold_col, parallelism, folds):
    """The grid of a tree model: one fit per fold and point of the dimensions that
    change how trees grow; numbers of trees, depths and split minimums (CUTS) are
    scored by cutting the model that was grown at their largest."""
    from ridgeline.operators.explain import ensemble
    from ridgeline.operators.tree_grid import grid_errors

    spark = labelled.sparkSession
    cut = [n for n in CUTS[kind] if n in grid]
    rest = {n: v for n, v in grid.items() if n not in cut}
    counts = grid.get(TREES.get(kind), None) if TREES.get(kind) in cut else None
    depths = grid["maxDepth"] if "maxDepth" in cut else [MAX_DEPTH_UNLIMITED]
    splits = grid.get(SPLIT, [0])
    grown = {n: max(grid[n]) for n in cut if n != SPLIT}
    points, ways = grid_points(grid), grid_points(rest)
    fold_metrics = []
    for f in range(folds):
        tr = labelled.filter(F.col(fold_col) != f)
        prep_model = prep.fit(tr)
        tr_x = prep_model.transform(tr).select("features", spec.target).persist(StorageLevel.MEMORY_AND_DISK)
        va_x = prep_model.transform(labelled.filter(F.col(fold_col) == f)).select("features", spec.target)

        def score(way: dict, tr_x=tr_x, va_x=va_x) -> np.ndarray:
            trees = ensemble(spark, reg.fit(tr_x, {reg.getParam(k): v for k, v in {**grown, **way}.items()}))
            return grid_errors(trees, kind != "xgboost", va_x, spec.target, counts or [len(trees)], depths, splits)

        with ThreadPool(parallelism) as pool:
            by_way = pool.map(inheritable_thread_target(score), ways)
        tr_x.unpersist()

        def at(p: dict) -> float:
            errors = by_way[ways.index({n: p[n] for n in rest})]
            return float(errors[counts.index(p[TREES[kind]]) if counts else 0,
                                depths.index(p["maxDepth"]) if "maxDepth" in cut else 0, splits.index(p[SPLIT]) if SPLIT in p else 0])

        fold_metrics.append([at(p) for p in points])
    avg = [float(np.mean([fm[i] for fm in fold_metrics])) for i in range(len(points))]
    best = min(range(len(points)), key=lambda i: (avg[i], i))
    return CVResult(avg, fold_metrics, best, refit(pipe, reg, labelled, points[best])), points


def refit(pipe: Pipeline, reg, labelled: DataFrame, point: dict) -> PipelineModel:
    """The pipeline fitted at a grid point. Spark's learners have no split minimum,
    so the fitted model's nodes below it are cut."""
    from ridgeline.operators.tree_grid import cut_model

    model = pipe.copy({reg.getParam(k): v for k, v in point.items() if k != SPLIT}).fit(labelled)
    if point.get(SPLIT, 0) <= 2:  # a node of one row is a leaf anyway
        return model
    return PipelineModel(stages=[model.stages[0], cut_model(labelled.sparkSession, model.stages[-1], point[SPLIT])])


def _cross_validate(spec, pipe, prep, reg, maps, labelled, fold_col, parallelism, folds):
    ev = RegressionEvaluator(labelCol=spec.target, metricName="rmse")
    fold_metrics = []
    for f in range(folds):
        tr = labelled.filter(F.col(fold_col) != f)
        va = labelled.filter(F.col(fold_col) == f)
        prep_model = prep.fit(tr)
        tr_x = prep_model.transform(tr).select("features", spec.target).persist(StorageLevel.MEMORY_AND_DISK)
        va_x = prep_model.transform(va).select("features", spec.target).persist(StorageLevel.MEMORY_AND_DISK)

        def score(i: int, tr_x=tr_x, va_x=va_x) -> float:
            return float(ev.evaluate(reg.fit(tr_x, maps[i]).transform(va_x)))

        with ThreadPool(parallelism) as pool:
            fold_metrics.append(pool.map(inheritable_thread_target(score), range(len(maps))))
        tr_x.unpersist()
        va_x.unpersist()
    avg = [float(np.mean([fm[i] for fm in fold_metrics])) for i in range(len(maps))]
    best = min(range(len(maps)), key=lambda i: (avg[i], i))
    best_model = pipe.copy(maps[best]).fit(labelled)
    return CVResult(avg, fold_metrics, best, best_model), maps


def _named(point: dict) -> dict:
    return {getattr(k, "name", k): v for k, v in point.items()}


def cv_table(spark: SparkSession, cvm, maps: list, kind: str) -> DataFrame:
    """M8: one row per grid point: its parameters (as text) and mean CV RMSE."""
    rows = []
    for i, (pm, m) in enumerate(zip(maps, cvm.avgMetrics)):
        params = ", ".join(f"{k}={v}" for k, v in sorted(_named(pm).items()))
        rows.append((kind, i, params, float(m)))
    return spark.createDataFrame(rows, "model string, grid_index int, params string, cv_rmse double")


def best_params_table(spark: SparkSession, cvm, maps: list, kind: str) -> DataFrame:
    """(model, param, value, cv_rmse) of the winning grid point."""
    metrics = list(cvm.avgMetrics)
    best = min(range(len(metrics)), key=lambda i: (metrics[i], i))
    rows = [(kind, k, str(v), float(metrics[best])) for k, v in sorted(_named(maps[best]).items())]
    return spark.createDataFrame(rows, "model string, param string, value string, cv_rmse double")


def predict(model: PipelineModel, df: DataFrame, key: str, label: str | None = None,
            name: str | None = None) -> DataFrame:
    """Batch prediction; with ``label`` and ``name`` the long form
    (model, key, y, p) that the evaluation operators consume."""
    out = model.transform(df)
    cols = [F.col(key)]
    if name is not None:
        cols.insert(0, F.lit(name).alias("model"))
    if label is not None:
        cols.append(F.col(label).cast("double").alias("y"))
        cols.append(F.col("prediction").alias("p"))
    else:
        cols.append(F.col("prediction"))
    return out.select(*cols)


def predict_all(models: dict[str, PipelineModel], df: DataFrame, key: str, label: str) -> DataFrame:
    """M11 for several models in one scan: (model, key, y, p), a row per model and
    row of ``df``. The vectors are prepared once per variant (scaled or not; models
    of a variant share their preparation) and every model adds one column."""
    out, variants, columns = df, {}, []
    for name, model in models.items():
        prep, last = model.stages[0], model.stages[-1]
        variant = str(sorted((p.name, str(v)) for p, v in prep.extractParamMap().items()))
        if variant not in variants:
            variants[variant] = f"_x{len(variants)}"
            out = prep.transform(out).withColumnRenamed(prep.getOrDefault("outputCol"), variants[variant])
        score = last.copy({last.getParam("featuresCol"): variants[variant], last.getParam("predictionCol"): f"_p{len(columns)}"})
        out = score.transform(out)
        columns.append(F.struct(F.lit(name).alias("model"), F.col(f"_p{len(columns)}").alias("p")))
    return (out.select(F.col(key), F.col(label).cast("double").alias("y"), F.explode(F.array(*columns)).alias("m"))
            .select("m.model", key, "y", "m.p"))


def feature_names(model: PipelineModel) -> list[str]:
    return model.stages[0].feature_names()
