"""Feature preparation fitted on training rows and applied to any table.

``TabularPrep`` is a Spark ML Estimator, so it can sit inside a ``Pipeline``
and ``CrossValidator`` refits it on every training fold (no leakage from
the held-out fold). Its fit is two aggregations (one wide aggregate for the
numeric statistics, one grouped count for the categories); its transform
is a single projection of built-in expressions (impute, scale, one-hot)
packed into a vector with ``array_to_vector``, so it stays in whole-stage
codegen and never leaves the JVM.

Semantics (fixed to match the reference's column transformer):
* numeric: exact median imputation (average of the two middle values), then
  optionally (x - mean) / population std of the imputed column; a zero std
  scales by 1.
* categorical: most frequent value imputation (ties -> smallest), then one
  0/1 column per sorted category; unseen values give all zeros.
* output order: numeric columns, then ``{column}_{value}`` per category.
"""

from __future__ import annotations

import json
import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions.cache import passes_over
from ridgeline.operators.quantiles import exact_quantiles

EPS = 2.220446049250313e-16


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


class _PrepParams(Params):
    numericCols = Param(Params._dummy(), "numericCols", "numeric input columns",
                        TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "categorical input columns",
                            TypeConverters.toListString)
    scale = Param(Params._dummy(), "scale", "standardise numeric columns",
                  TypeConverters.toBoolean)
    outputCol = Param(Params._dummy(), "outputCol", "output vector column",
                      TypeConverters.toString)
    approxQuantiles = Param(Params._dummy(), "approxQuantiles",
                            "use percentile_approx for medians (very large tables)",
                            TypeConverters.toBoolean)

    def __init__(self):
        super().__init__()
        self._setDefault(numericCols=[], categoricalCols=[], scale=False,
                         outputCol="features", approxQuantiles=False)


def fit_statistics(df: DataFrame, numeric: list[str], categorical: list[str],
                   approx: bool = False) -> dict:
    """Median, imputed mean and imputed population std per numeric column
    (one pass), mode and sorted categories per categorical column (one
    grouped pass). The result is bounded by the number of columns and the
    category cardinality."""
    with passes_over(df, list(numeric) + list(categorical)) as part:
        return _fit_statistics(part, numeric, categorical, approx)


def _fit_statistics(df, numeric, categorical, approx):
    stats: dict = {"numeric": {}, "categorical": {}}
    if numeric:
        aggs = [F.count(F.lit(1)).alias("n")]
        for i, x in enumerate(numeric):
            v = _c(x).cast("double")
            v = F.when(~F.isnan(v), v)  # NaN is missing
            aggs += [F.count(v).alias(f"c{i}"), F.avg(v).alias(f"m{i}"), F.var_pop(v).alias(f"v{i}"),
                     F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
            if approx:
                aggs.append(F.percentile_approx(v, 0.5, 100000).alias(f"q{i}"))
        row = df.agg(*aggs).first()
        n = row["n"]
        if approx:
            medians = {x: row[f"q{i}"] for i, x in enumerate(numeric)}
        else:
            qs = exact_quantiles(df, list(numeric), [0.5], stats={
                x: (row[f"c{i}"], row[f"lo{i}"], row[f"hi{i}"]) for i, x in enumerate(numeric)})
            medians = {x: qs[x][0] for x in numeric}
        for i, x in enumerate(numeric):
            n1, m1, v1, med = row[f"c{i}"], row[f"m{i}"], row[f"v{i}"], medians[x]
            if not n1:
                med, mean, std, m2 = 0.0, 0.0, 0.0, 0.0
            else:
                # imputed column = n1 observed values + (n - n1) copies of the median;
                # combine the two groups' moments (parallel variance formula)
                k = n - n1
                delta = med - m1
                mean = m1 + delta * k / n
                m2 = v1 * n1 + delta * delta * n1 * k / n
                std = math.sqrt(max(m2 / n, 0.0))
            stats["numeric"][x] = {
                "median": med, "mean": mean, "scale": std if std >= 10 * EPS else 1.0,
                # of the imputed column: its median, least and greatest value are those observed
                "min": row[f"lo{i}"] if n1 else 0.0, "max": row[f"hi{i}"] if n1 else 0.0,
                "std": math.sqrt(max(m2, 0.0) / (n - 1)) if n > 1 else None}
    if categorical:
        long = df.select(F.inline(F.array(*[
            F.struct(F.lit(x).alias("column"), _c(x).cast("string").alias("value"))
            for x in categorical]))).filter(F.col("value").isNotNull())
        counts = long.groupBy("column", "value").count().collect()
        for x in categorical:
            vals = sorted((r["value"], r["count"]) for r in counts if r["column"] == x)
            mode = min(vals, key=lambda t: (-t[1], t[0]))[0] if vals else None
            stats["categorical"][x] = {"mode": mode, "categories": [v for v, _ in vals]}
    return stats


class TabularPrep(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, scale=False,
                 outputCol="features", approxQuantiles=False):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "TabularPrepModel":
        num = self.getOrDefault(self.numericCols)
        cat = self.getOrDefault(self.categoricalCols)
        stats = fit_statistics(dataset, num, cat, self.getOrDefault(self.approxQuantiles))
        return TabularPrepModel(
            numericCols=num, categoricalCols=cat, scale=self.getOrDefault(self.scale),
            outputCol=self.getOrDefault(self.outputCol), statistics=json.dumps(stats))


class TabularPrepModel(Model, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    statistics = Param(Params._dummy(), "statistics", "fitted statistics (JSON)",
                       TypeConverters.toString)

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, scale=False,
                 outputCol="features", statistics="{}", approxQuantiles=False):
        super().__init__()
        self._setDefault(statistics="{}")
        self._set(**self._input_kwargs)

    @property
    def stats(self) -> dict:
        return json.loads(self.getOrDefault(self.statistics))

    def feature_names(self) -> list[str]:
        """F8: numeric names, then ``{column}_{value}`` per category."""
        st = self.stats
        names = list(self.getOrDefault(self.numericCols))
        for x in self.getOrDefault(self.categoricalCols):
            names += [f"{x}_{v}" for v in st["categorical"][x]["categories"]]
        return names

    def feature_exprs(self) -> list[Column]:
        st = self.stats
        scale = self.getOrDefault(self.scale)
        out = []
        for x in self.getOrDefault(self.numericCols):
            s = st["numeric"][x]
            e = F.coalesce(_c(x).cast("double"), F.lit(float(s["median"])))
            if scale:
                e = (e - F.lit(float(s["mean"]))) / F.lit(float(s["scale"]))
            out.append(e)
        for x in self.getOrDefault(self.categoricalCols):
            s = st["categorical"][x]
            v = _c(x).cast("string")
            if s["mode"] is not None:
                v = F.coalesce(v, F.lit(s["mode"]))
            for cat in s["categories"]:
                out.append(F.when(v == F.lit(cat), F.lit(1.0)).otherwise(F.lit(0.0)))
        return out

    def expand(self, dataset: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """The prepared features as named columns (F5 without the vector)."""
        keep = keep or []
        return dataset.select(*[_c(k) for k in keep], *[
            e.alias(n) for e, n in zip(self.feature_exprs(), self.feature_names())])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOrDefault(self.outputCol),
                                  array_to_vector(F.array(*self.feature_exprs())))


def impute_numeric(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    """F1 applied: NULL -> fitted median, other columns untouched."""
    return df.select(*[
        F.coalesce(_c(x).cast("double"), F.lit(float(medians[x]))).alias(x) if x in medians else _c(x)
        for x in df.columns])
