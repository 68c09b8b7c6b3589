import os
import uuid

from ridgeline.plans.pipeline import run_pipeline
from ridgeline.session import checkpoint_dir
from ridgeline.sources.fixtures import modelling_table
from tests.conftest import SF001


def test_pipeline_end_to_end(spark):
    out = os.path.join(checkpoint_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    data = modelling_table(spark, SF001).drop("bucket", "fold")
    res = run_pipeline(
        spark, data, "charge", "rk", out,
        grids={"decision_tree": {"maxDepth": [2, 3], "minInstancesPerNode": [5]}},
        fixed={"random_forest": {"numTrees": 5, "maxDepth": 3}, "xgboost": {"maxIter": 5, "maxDepth": 2}},
        mlp_epochs=3)
    assert res["best_tree_model"] in {"decision_tree", "random_forest", "xgboost"}
    metrics = spark.read.option("header", True).csv(os.path.join(out, "metrics/model_comparison"))
    assert {r["model"] for r in metrics.collect()} == {"linear_regression", "decision_tree",
                                                       "random_forest", "xgboost", "mlp"}
    shap = spark.read.parquet(os.path.join(out, "shap/values"))
    assert shap.count() > 0
    overview = spark.read.json(os.path.join(out, "data_summary/dataset_overview")).first()
    assert overview["target_column"] == "charge" and overview["n_features"] == 6


def test_pipeline_without_categories(spark):
    out = os.path.join(checkpoint_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    data = modelling_table(spark, SF001).select("rk", "l_quantity", "l_extendedprice", "charge").limit(400)
    run_pipeline(spark, data, "charge", "rk", out,
                 grids={"decision_tree": {"maxDepth": [2], "minInstancesPerNode": [5], "minRowsToSplit": [2, 10]}},
                 fixed={"random_forest": {"numTrees": 2, "maxDepth": 2}, "xgboost": {"maxIter": 2, "maxDepth": 2}}, mlp_epochs=1)
    assert spark.read.parquet(os.path.join(out, "tables/predictions")).select("model").distinct().count() == 5
    from pyspark.ml import PipelineModel
    assert len(PipelineModel.load(os.path.join(out, "models", "mlp")).stages) == 2
