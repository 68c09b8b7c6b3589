"""Ordinary least squares in one pass (M1).

The reference fits OLS on all one-hot columns plus an intercept; that
design is rank deficient and the reference returns the minimum-norm least
squares solution. Spark's normal-equation solver rejects a singular system
and falls back to iterative L-BFGS (one pass over the data per iteration).

Here the sufficient statistics are gathered in ONE pass: every partition
computes n, sum(x), sum(y), X'X and X'y with NumPy on its Arrow batches and a
``Summarizer`` sum (tree aggregation) adds them up. The centred p x p system
is then solved on the driver with the minimum-norm pseudo-inverse (p = the
number of prepared features, independent of the row count). Prediction is a
built-in expression (``aggregate`` over ``zip_with``), so scoring stays in
the JVM.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class _OLSParams(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "features column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction column", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction")


def gram_statistics(df: DataFrame, features: str, label: str) -> tuple[int, np.ndarray, float, np.ndarray, np.ndarray, float]:
    """(n, sum x, sum y, X'X, X'y, y'y) over all rows with a label, one pass."""
    data = df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y")) \
        .filter(F.col("y").isNotNull())

    def partial(batches):
        acc = None
        for pdf in batches:
            if pdf.empty:
                continue
            X = np.stack(pdf["x"].to_numpy())
            y = pdf["y"].to_numpy()
            part = np.concatenate([[len(y)], X.sum(0), [y.sum()], (X.T @ X).ravel(), X.T @ y, [y @ y]])
            acc = part if acc is None else acc + part
        if acc is not None:
            yield pd.DataFrame({"s": [acc]})

    vec = data.mapInPandas(partial, "s array<double>").select(array_to_vector("s").alias("s")) \
        .agg(Summarizer.sum(F.col("s")).alias("s")).first()["s"]
    if vec is None:
        raise ValueError("no labelled rows to fit")
    s = np.asarray(vec.toArray())
    p = int(round((-2 + np.sqrt(4 + 4 * (len(s) - 3))) / 2))  # len = 1 + p + 1 + p*p + p + 1
    n = s[0]
    sx = s[1:1 + p]
    sy = s[1 + p]
    xtx = s[2 + p:2 + p + p * p].reshape(p, p)
    xty = s[2 + p + p * p:2 + 2 * p + p * p]
    yty = s[-1]
    return int(n), sx, float(sy), xtx, xty, float(yty)


def solve_min_norm(n: int, sx, sy, xtx, xty) -> tuple[np.ndarray, float]:
    """Centred normal equations solved with the pseudo-inverse: the
    minimum-norm least-squares coefficients, then the intercept."""
    mx = sx / n
    my = sy / n
    cxx = xtx - n * np.outer(mx, mx)
    cxy = xty - n * mx * my
    coef = np.linalg.pinv(cxx, rcond=1e-10, hermitian=True) @ cxy
    return coef, float(my - mx @ coef)


class OLSRegressor(Estimator, _OLSParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "OLSModel":
        g = self.getOrDefault
        n, sx, sy, xtx, xty, _ = gram_statistics(dataset, g(self.featuresCol), g(self.labelCol))
        coef, intercept = solve_min_norm(n, sx, sy, xtx, xty)
        return OLSModel(featuresCol=g(self.featuresCol), predictionCol=g(self.predictionCol),
                        coefficients=json.dumps({"coef": coef.tolist(), "intercept": intercept}))


class OLSModel(Model, _OLSParams, DefaultParamsReadable, DefaultParamsWritable):
    coefficients = Param(Params._dummy(), "coefficients", "fitted coefficients (JSON)",
                         TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction",
                 coefficients="{}"):
        super().__init__()
        self._setDefault(coefficients="{}")
        self._set(**self._input_kwargs)

    @property
    def coef(self) -> list[float]:
        return json.loads(self.getOrDefault(self.coefficients))["coef"]

    @property
    def intercept(self) -> float:
        return json.loads(self.getOrDefault(self.coefficients))["intercept"]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array(self.getOrDefault(self.featuresCol))
        w = F.array(*[F.lit(float(c)) for c in self.coef])
        dot = F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
        return dataset.withColumn(self.getOrDefault(self.predictionCol), dot + F.lit(self.intercept))
