"""The flagship query: split -> prepare -> train (linear + random forest)
-> held-out metrics on the modelling table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ridgeline.operators import evaluate as E
from ridgeline.plans.q_models import model_predictions


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    preds = model_predictions(spark, sf_dir, kinds=["linear_regression", "random_forest"])
    return E.regression_metrics(preds)
