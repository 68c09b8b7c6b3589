"""The numbers behind the reference's plots: histograms, Gaussian KDE
curves, OLS trend lines, box and violin statistics, scatter series.

Scale notes
-----------
* Histogram and KDE need min / max / std first; these are scalar subqueries
  (one small aggregate each, executed once), not joins.
* The KDE sums the kernel over cells no wider than an eighth of the
  bandwidth, whatever the row count. A cell keeps the power sums of its
  values' offsets t from its centre (a grouped aggregate), and the kernel is
  expanded in them: exp(-(z - t)^2 / 2) = exp(-z^2 / 2) sum He_j(z) t^j / j!.
  With |t| <= 1/16 eight terms give about ten digits. Work on the data is O(n).
* Per-category parameters are a table beside the rows: broadcast if its measured
  size allows, else joined (``operators.grouped``). Categories may be many.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions.cache import passes_over
from ridgeline.operators.grouped import grouped_quantiles, with_parameters, written
from ridgeline.operators.quantiles import exact_quantiles

SQRT_2PI = math.sqrt(2 * math.pi)


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _stats(df: DataFrame, v: Column) -> Column:
    return df.agg(F.struct(
        F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"),
        F.stddev_samp(v).alias("sd"))).scalar()


def histogram(df: DataFrame, col: str, bins: int = 40) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed; empty
    bins are kept with count 0."""
    v = _c(col).cast("double")
    st = _stats(df, v)
    lo, hi = st.getField("lo"), st.getField("hi")
    w = (hi - lo) / bins
    b = F.when(hi > lo, F.least(F.floor((v - lo) / w), F.lit(bins - 1))).otherwise(0).cast("int")
    counts = (df.filter(v.isNotNull()).select(b.alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    # counts has at most `bins` rows: a proven bound, safe to broadcast
    return grid.join(F.broadcast(counts), "bin", "left").select(
        "bin", (lo + F.col("bin") * w).alias("bin_lo"), (lo + (F.col("bin") + 1) * w).alias("bin_hi"),
        F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))


CELLS_PER_BANDWIDTH = 8
TERMS = 9
REACH = 38.0  # bandwidths beyond which a double's kernel value is zero


# row j: coefficients of the j-th Hermite polynomial (probabilists') over j!
HERMITE = [np.polynomial.hermite_e.herme2poly([0] * j + [1]) / math.factorial(j) for j in range(TERMS)]


def _cells(d: DataFrame) -> DataFrame:
    """d (g, y, lo, h, start, step) -> a row per cell of width h / 8: the same, its
    centre, and a0..a8, the polynomial in z whose product with exp(-z^2 / 2) is the sum
    of the kernel over the cell's values, from their power sums."""
    cell = F.floor((F.col("y") - F.col("lo")) / (F.col("h") / CELLS_PER_BANDWIDTH)).cast("long")
    t = (F.col("y") - F.col("lo")) / F.col("h") - (F.col("cell") + 0.5) / CELLS_PER_BANDWIDTH
    sums, power = [F.count(F.lit(1)).cast("double").alias("m0")], F.lit(1.0)
    for j in range(1, TERMS):
        power = power * F.col("t")
        sums.append(F.sum(power).alias(f"m{j}"))
    params = ["g", "lo", "h", "start", "step"]
    cells = d.withColumn("cell", cell).withColumn("t", t).groupBy(*params, "cell").agg(*sums)
    terms = []
    for i in range(TERMS):
        a = F.lit(0.0)
        for j in range(i, TERMS):
            if HERMITE[j][i]:
                a = a + F.lit(float(HERMITE[j][i])) * F.col(f"m{j}")
        terms.append(a.alias(f"a{i}"))
    centre = F.col("lo") + (F.col("cell") + 0.5) * (F.col("h") / CELLS_PER_BANDWIDTH)
    return cells.select(*params, centre.alias("centre"), *terms)


def _densities(d: DataFrame, params: DataFrame, grid: int, cut: float) -> DataFrame:
    """d (g, y) -> (g, k, x, density): Gaussian KDE of every group on ``grid``
    points of [lo - cut * h, hi + cut * h]. ``params``: g, n, lo, hi, h; NULL density
    where the bandwidth h is zero or undefined."""
    h, k = F.coalesce(F.col("h"), F.lit(0.0)), F.col("k")
    start = F.col("lo") - h * cut
    params = written(params.withColumns({"start": start, "step": (F.col("hi") - F.col("lo") + h * (2 * cut)) / (grid - 1)}),
                     "densities")
    cells = _cells(with_parameters(d, params.where("h is not null"), "g"))
    edge = [(F.col("centre") + side * F.col("h") * REACH - F.col("start")) / F.col("step") for side in (-1, 1)]
    first = F.greatest(F.lit(0), F.ceil(edge[0])).cast("long")
    last = F.least(F.lit(grid - 1), F.floor(edge[1])).cast("long")
    pts = (cells.filter(first <= last).withColumn("k", F.explode(F.sequence(first, last)))
           .withColumn("z", (F.col("start") + k * F.col("step") - F.col("centre")) / F.col("h")))
    z, total = F.col("z"), F.col(f"a{TERMS - 1}")
    for i in reversed(range(TERMS - 1)):
        total = total * z + F.col(f"a{i}")
    sums = pts.groupBy("g", "k").agg(F.sum(F.exp(-0.5 * z * z) * total).alias("s"))
    axis = params.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(grid - 1).cast("long"))))
    return axis.join(sums, ["g", "k"], "left").select(
        "g", "k", (F.col("start") + k * F.col("step")).alias("x"),
        F.when(F.col("h").isNotNull(), F.coalesce("s", F.lit(0.0)) / (F.col("n") * F.col("h") * SQRT_2PI)).alias("density"))


def _bandwidths(d: DataFrame) -> DataFrame:
    """(g, n, lo, hi, h) of d (g, y), h by Scott's rule."""
    n, sd = F.count("y"), F.stddev_samp("y")
    return d.groupBy("g").agg(n.alias("n"), F.min("y").alias("lo"), F.max("y").alias("hi"),
                              F.when(sd > 0, sd * F.pow(n.cast("double"), F.lit(-0.2))).alias("h"))


def kde_curve(df: DataFrame, col: str, grid: int = 200, cut: float = 0.0, count_bins: int = 40) -> DataFrame:
    """Gaussian KDE with Scott's bandwidth (n^-1/5 * sample std) on a
    ``grid``-point support [min - cut*h, max + cut*h]; ``count_curve`` is
    the density scaled to a ``count_bins``-bin histogram (n * bin width)."""
    d = df.select(F.lit("").alias("g"), _c(col).cast("double").alias("y")).filter(F.col("y").isNotNull())
    params = written(_bandwidths(d), "bandwidths")
    one = params.first()
    width = one["n"] * (one["hi"] - one["lo"]) / count_bins if one else 0.0
    return _densities(d, params, grid, cut).select("k", "x", "density", (F.col("density") * width).alias("count_curve"))


def ols_fit(df: DataFrame, features: list[str], y: str) -> list[dict]:
    """Simple OLS of y on each feature, feature NULLs filled with the
    feature's median. Two aggregate passes; returns bounded fit parameters."""
    with passes_over(df, list(features) + [y]) as part:
        return _ols_fit(part, features, y)


def _ols_fit(df, features, y):
    yv = _c(y).cast("double")
    aggs = []
    for i, f in enumerate(features):
        x = _c(f).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    first = df.agg(*aggs).first().asDict()
    qs = exact_quantiles(df, list(features), [0.5], stats={
        f: (first[f"n{i}"], first[f"lo{i}"], first[f"hi{i}"]) for i, f in enumerate(features)})
    for i, f in enumerate(features):
        first[f"m{i}"] = qs[f][0]
    aggs = []
    for i, f in enumerate(features):
        xf = F.coalesce(_c(f).cast("double"), F.lit(first[f"m{i}"]))
        aggs += [F.regr_slope(yv, xf).alias(f"s{i}"), F.regr_intercept(yv, xf).alias(f"b{i}")]
    second = df.agg(*aggs).first()
    return [{"feature": f, "median": first[f"m{i}"], "lo": first[f"lo{i}"], "hi": first[f"hi{i}"],
             "slope": second[f"s{i}"], "intercept": second[f"b{i}"]} for i, f in enumerate(features)]


def ols_table(spark, fits: list[dict]) -> DataFrame:
    return spark.createDataFrame(
        [(d["feature"], d["median"], d["slope"], d["intercept"]) for d in fits],
        "feature string, median double, slope double, intercept double")


def trend_lines(spark, fits: list[dict], points: int = 100) -> DataFrame:
    """Each fitted line evaluated on ``points`` even steps over the
    feature's [min, max]."""
    rows = F.array(*[F.struct(
        F.lit(d["feature"]).alias("feature"), F.lit(d["lo"]).cast("double").alias("lo"),
        F.lit(d["hi"]).cast("double").alias("hi"), F.lit(d["slope"]).cast("double").alias("slope"),
        F.lit(d["intercept"]).cast("double").alias("intercept")) for d in fits])
    g = spark.range(points).select(F.col("id").alias("k"), F.inline(rows))
    x = F.col("lo") + F.col("k") * (F.col("hi") - F.col("lo")) / (points - 1)
    return g.select("feature", "k", x.alias("x"), (F.col("slope") * x + F.col("intercept")).alias("y_hat"))


def _by_category(df: DataFrame, cat: str, y: str) -> DataFrame:
    return (df.select(_c(cat).cast("string").alias("category"), _c(y).cast("double").alias("y"))
            .filter(F.col("category").isNotNull() & F.col("y").isNotNull()))


def _boxes(d: DataFrame, whis: float) -> DataFrame:
    """(category, n, q1, median, q3, fence_lo, fence_hi) of d (category, y)."""
    v = F.when(~F.isnan("y"), F.col("y"))
    q = grouped_quantiles(d.select(F.col("category").alias("g"), v.alias("v")).filter("v is not null"), [0.25, 0.5, 0.75])
    iqr = F.col("q3") - F.col("q1")
    q = q.select(F.col("g").alias("category"), "n", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    return written(q.withColumns({"fence_lo": F.col("q1") - whis * iqr, "fence_hi": F.col("q3") + whis * iqr}), "boxes")


def box_stats(df: DataFrame, cat: str, y: str, whis: float = 1.5) -> DataFrame:
    """Per category n, quartiles (linear interpolation), whiskers at the
    furthest data point within whis * IQR of the box (at the box itself where
    that point lies inside it), and outlier count."""
    d = _by_category(df, cat, y)
    boxes = _boxes(d, whis)
    v, lo, hi = F.col("y"), F.col("fence_lo"), F.col("fence_hi")
    w = with_parameters(d, boxes.select("category", "fence_lo", "fence_hi"), "category").groupBy("category").agg(
        F.min(F.when(v >= lo, v)).alias("lo"), F.max(F.when(v <= hi, v)).alias("hi"),
        F.count(F.when((v < lo) | (v > hi), 1)).alias("n_outliers"))
    return boxes.join(w, "category").select(  # one row per category on both sides
        "category", "n", "q1", "median", "q3", F.least("q1", "lo").alias("whisker_lo"),
        F.greatest("q3", "hi").alias("whisker_hi"), "n_outliers")


def box_outliers(df: DataFrame, cat: str, y: str, key: str, whis: float = 1.5) -> DataFrame:
    """The rows outside the whisker fences."""
    d = df.select(_c(key).alias("row_id"), _c(cat).cast("string").alias("category"),
                  _c(y).cast("double").alias("y")).filter(
        F.col("category").isNotNull() & F.col("y").isNotNull())
    d = with_parameters(d, _boxes(d.drop("row_id"), whis).select("category", "fence_lo", "fence_hi"), "category")
    return d.filter((F.col("y") < F.col("fence_lo")) | (F.col("y") > F.col("fence_hi"))).select("row_id", "category", "y")


def violin_density(df: DataFrame, cat: str, y: str, grid: int = 100, cut: float = 2.0) -> DataFrame:
    """Per-category Gaussian KDE (Scott bandwidth), support extended by
    ``cut`` bandwidths on both sides, ``grid`` points."""
    d = _by_category(df, cat, y).withColumnRenamed("category", "g")
    return _densities(d, _bandwidths(d), grid, cut).withColumnRenamed("g", "category")


def scatter_series(df: DataFrame, features: list[str], y: str, key: str) -> DataFrame:
    """(feature, row_id, x, y) for each chosen feature, every row."""
    return df.select(_c(key).alias("row_id"), _c(y).cast("double").alias("y"), F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), _c(f).cast("double").alias("x")) for f in features])))
