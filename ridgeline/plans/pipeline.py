"""The end-to-end job: profile -> split -> prepare -> train / tune ->
evaluate -> explain, writing every result table under one output folder.

    python -m ridgeline.plans.pipeline --table data.parquet --target SCORE \
        --key ID --exclude LEAKY_FLAG --out /shared/run1

Each stage is a DataFrame job or a Spark ML fit; the modelling table is
split by a hash of the key (same rows on every run), written once to the
output folder and re-read, so later stages start from stored data instead
of recomputing the input (and a lost executor never sends a stage back to
the raw scan).
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.operators import curves as C
from ridgeline.operators import evaluate as E
from ridgeline.operators import explain as X
from ridgeline.operators import models as M
from ridgeline.operators import profile as P
from ridgeline.operators import split as S
from ridgeline.operators.mlp import MLPRegressor, history_table
from ridgeline.operators.prepare import TabularPrep
from ridgeline.sources.tables import normalize_missing, read_csv, write_table
from ridgeline.spec import FeatureSpec, detect_roles, role_table

SHAP_SAMPLE = 500


def _write(df: DataFrame, out: str, name: str, fmt: str = "parquet") -> None:
    write_table(df, os.path.join(out, name), fmt)


def run_pipeline(spark: SparkSession, data: DataFrame, target: str, key: str, out: str,
                 id_cols: list[str] = (), exclude_cols: list[str] = (),
                 grids: dict[str, dict] | None = None, fixed: dict[str, dict] | None = None,
                 mlp_epochs: int = 100) -> dict:
    """Run every stage; returns the best model names. ``grids`` maps model
    kind -> grid for cross-validated kinds; ``fixed`` gives parameters for
    kinds trained without a grid."""
    grids = grids if grids is not None else {"decision_tree": M.DT_GRID, "random_forest": M.RF_GRID,
                                             "xgboost": M.GBT_GRID}
    fixed = fixed or {}
    data = normalize_missing(data)
    spec: FeatureSpec = detect_roles(data, target, id_cols=list(id_cols) + [key], exclude_cols=exclude_cols)

    # the input is stored once; everything below reads the stored columns
    data_path = os.path.join(out, "tables/input")
    write_table(data, data_path)
    data = spark.read.parquet(data_path)

    # 1. profile (all rows) -------------------------------------------------
    _write(role_table(spark, data, spec), out, "data_summary/roles")
    _write(P.overview(data, spec), out, "data_summary/dataset_overview", "json")
    _write(P.missing_table(data, P.missing_scope(spec, data, "features_target")), out,
           "data_summary/missing_values", "csv")
    _write(P.describe(data, spec.profile_columns), out, "data_summary/describe", "csv")
    _write(P.category_values(data, list(spec.categorical)), out, "models/categorical_values", "json")
    corr = P.target_correlations(data, list(spec.numeric), target)
    _write(corr, out, "data_summary/target_correlations")
    top20 = P.top_features(data, list(spec.numeric), target, 20)
    _write(P.correlation_matrix(data, top20[:15] + [target]), out, "data_summary/correlation_matrix")
    _write(C.histogram(data, target, 40), out, "plots_data/target_histogram")
    _write(C.kde_curve(data, target), out, "plots_data/target_kde")
    fits = C.ols_fit(data, top20[:4], target)
    _write(C.trend_lines(spark, fits), out, "plots_data/trend_lines")
    _write(C.scatter_series(data, top20[:4], target, key), out, "plots_data/scatter")
    for cat in spec.categorical:
        _write(C.box_stats(data, cat, target), out, f"plots_data/box_{cat}")
        _write(C.violin_density(data, cat, target), out, f"plots_data/violin_{cat}")
    _write(P.kpis(data, spec), out, "data_summary/dashboard", "json")

    # 2. split, stored once -------------------------------------------------
    split = S.exact_split(data, key).withColumn("fold", S.fold_column(key).cast("int")) \
        .withColumn("is_val", S.validation_flag(key))
    split_path = os.path.join(out, "tables/split")
    write_table(split, split_path)
    split = spark.read.parquet(split_path)
    train, test = S.train_test(split)

    # 3. preparation metadata (imputed training rows) ------------------------
    prep = TabularPrep(numericCols=list(spec.numeric), categoricalCols=list(spec.categorical)).fit(train)
    ranges = P.fitted_ranges(spark, prep.stats, list(spec.numeric))
    _write(ranges, out, "data_summary/feature_ranges", "csv")
    _write(P.feature_defaults(ranges), out, "data_summary/feature_defaults", "csv")

    # 4. models ---------------------------------------------------------------
    predictions = None
    fitted = {}
    best_params = []
    for kind in M.MODEL_KINDS:
        if kind in grids:
            cvm, maps = M.cross_validate(spec, kind, train, grids[kind])
            model = cvm.bestModel
            best_params.append(M.best_params_table(spark, cvm, maps, kind))
        else:
            model = M.fit(spec, kind, train, **fixed.get(kind, {}))
        model.write().overwrite().save(os.path.join(out, "models", kind))
        fitted[kind] = model
        p = M.predict(model, test, key, label=target, name=kind)
        predictions = p if predictions is None else predictions.unionByName(p)
    net_prep = TabularPrep(numericCols=list(spec.numeric), categoricalCols=list(spec.categorical),
                           scale=True).fit(train)
    net = MLPRegressor(labelCol=target, keyCol=key, validationCol="is_val",
                       maxEpochs=mlp_epochs).fit(net_prep.transform(train))
    _write(history_table(spark, net.history), out, "metrics/mlp_history", "json")
    from pyspark.ml import PipelineModel
    mlp = PipelineModel(stages=[net_prep, net])
    mlp.write().overwrite().save(os.path.join(out, "models", "mlp"))
    predictions = predictions.unionByName(M.predict(mlp, test, key, label=target, name="mlp"))
    if best_params:
        allp = best_params[0]
        for t in best_params[1:]:
            allp = allp.unionByName(t)
        _write(allp, out, "models/best_params", "csv")

    # 5. evaluation -----------------------------------------------------------
    pred_path = os.path.join(out, "tables/predictions")
    write_table(predictions, pred_path)
    predictions = spark.read.parquet(pred_path)
    metrics = E.regression_metrics(predictions)
    _write(metrics, out, "metrics/model_comparison", "csv")
    _write(metrics, out, "metrics/model_comparison_json", "json")
    _write(E.residuals(predictions, key), out, "plots_data/residuals")
    _write(E.grouped_histogram(E.residuals(predictions, key), "model", "residual", 30), out,
           "plots_data/residual_histograms")
    best = E.best_models(metrics, list(E.MODEL_DISPLAY)).first()
    _write(spark.createDataFrame([tuple(best)], "best_model string, best_tree_model string"), out,
           "models/best_models", "json")

    # 6. explanations of the best tree model ---------------------------------
    tree_model = fitted[best["best_tree_model"]]
    sample = S.hash_sample(test, key, SHAP_SAMPLE)
    shap_long = X.explain_rows(spark, tree_model, sample, key)
    shap_path = os.path.join(out, "shap/values")
    write_table(shap_long, shap_path)
    shap_long = spark.read.parquet(shap_path)
    base = X.base_value(spark, tree_model)
    _write(X.importance_bars(shap_long, 15), out, "shap/top_features", "csv")
    _write(X.beeswarm(shap_long, 20), out, "shap/beeswarm")
    _write(X.waterfall(shap_long, base, 15), out, "shap/waterfall")
    return {"best_model": best["best_model"], "best_tree_model": best["best_tree_model"], "base_value": base}


def main(argv: list[str] | None = None) -> None:
    from ridgeline.session import get_session

    ap = argparse.ArgumentParser(description="profile, train, evaluate and explain a regression table")
    ap.add_argument("--table", required=True, help="Parquet folder/file, or a .csv file")
    ap.add_argument("--target", required=True)
    ap.add_argument("--key", required=True, help="unique row key (splits, folds, samples)")
    ap.add_argument("--id", action="append", default=[])
    ap.add_argument("--exclude", action="append", default=[])
    ap.add_argument("--out", required=True)
    args = ap.parse_args(argv)
    spark = get_session(app="ridgeline-pipeline")
    data = read_csv(spark, args.table) if args.table.endswith(".csv") else spark.read.parquet(args.table)
    print(run_pipeline(spark, data, args.target, args.key, args.out, args.id, args.exclude))


if __name__ == "__main__":
    main()
