"""Registered plot-data queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgeline.operators import curves as C
from ridgeline.operators import profile as P
from ridgeline.plans import oracle_fixtures as O
from ridgeline.plans.q_profile import W, sql_corr_long
from ridgeline.plans.registry import query
from ridgeline.sources.fixtures import customer_wide, cw_spec, modelling_table

TOP4 = ",".join([
    "r AS (" + sql_corr_long("cw", O.CW_NUMERIC, "SCORE") + ")",
    "top4 AS (SELECT feature FROM r WHERE r IS NOT NULL ORDER BY abs(r) DESC, ordinal LIMIT 4)",
    "lng AS (" + "\nUNION ALL ".join(
        f"SELECT c_custkey, '{x}' AS feature, CAST({x} AS DOUBLE) AS x, SCORE AS y FROM cw"
        for x in O.CW_NUMERIC) + ")",
    "sel AS (SELECT l.* FROM lng l JOIN top4 t ON l.feature = t.feature)",
    "md AS (SELECT feature, median(x) AS med, min(x) AS lo, max(x) AS hi FROM sel GROUP BY feature)",
    "fit AS (SELECT s.feature, regr_slope(y, coalesce(x, med)) AS slope, "
    "regr_intercept(y, coalesce(x, med)) AS intercept FROM sel s JOIN md ON s.feature = md.feature "
    "GROUP BY s.feature)",
])


def _cw_top4(spark, sf_dir):
    cw = customer_wide(spark, sf_dir)
    spec = cw_spec(cw)
    return cw, spec, P.top_features(cw, list(spec.numeric), spec.target, 4)


@query("a12_target_histogram", sql=W(O.MT, """
st AS (SELECT min(charge) AS lo, max(charge) AS hi FROM mt)""", """
cnt AS (SELECT CAST(CASE WHEN hi > lo THEN least(floor((charge - lo) / ((hi - lo) / 40)), 39) ELSE 0 END AS INTEGER) AS bin,
               count(*) AS count FROM mt, st WHERE charge IS NOT NULL GROUP BY 1)""") + """
SELECT CAST(g.k AS INTEGER) AS bin, lo + g.k * ((hi - lo) / 40) AS bin_lo, lo + (g.k + 1) * ((hi - lo) / 40) AS bin_hi,
       coalesce(count, 0) AS count
FROM range(40) g(k) CROSS JOIN st LEFT JOIN cnt ON cnt.bin = g.k""", round_cols=["bin_lo", "bin_hi"])
def a12_target_histogram(spark, sf_dir):
    return C.histogram(modelling_table(spark, sf_dir), "charge", 40)


KDE_SQL = W(O.MT, """
st AS (SELECT count(charge) AS n, min(charge) AS lo, max(charge) AS hi,
              stddev_samp(charge) * pow(CAST(count(charge) AS DOUBLE), -0.2) AS h FROM mt)""", """
axis AS (SELECT g.k, lo + g.k * ((hi - lo) / 199) AS x FROM st CROSS JOIN range(200) g(k))""", """
sums AS (SELECT k, x, sum(exp(-0.5 * pow((x - charge) / h, 2))) AS s
         FROM axis CROSS JOIN st CROSS JOIN mt WHERE charge IS NOT NULL GROUP BY k, x)""") + """
SELECT k, x, s / (n * h * sqrt(2 * pi())) AS density,
       s / (n * h * sqrt(2 * pi())) * n * (hi - lo) / 40 AS count_curve FROM sums CROSS JOIN st"""


@query("a13_target_kde", sql=KDE_SQL, round_cols=["x", "density", "count_curve"], digits=8)
def a13_target_kde(spark, sf_dir):
    return C.kde_curve(modelling_table(spark, sf_dir), "charge", grid=200, cut=0.0)


@query("a14_trend_fit", sql=W(O.CW, TOP4) + """
SELECT fit.feature, med AS median, slope, intercept FROM fit JOIN md ON fit.feature = md.feature""",
       round_cols=["median", "slope", "intercept"])
def a14_trend_fit(spark, sf_dir):
    cw, spec, top = _cw_top4(spark, sf_dir)
    return C.ols_table(spark, C.ols_fit(cw, top, spec.target))


@query("a15_trend_line", sql=W(O.CW, TOP4) + """
SELECT f.feature, g.k, lo + g.k * (hi - lo) / 99 AS x, slope * (lo + g.k * (hi - lo) / 99) + intercept AS y_hat
FROM fit f JOIN md ON f.feature = md.feature CROSS JOIN range(100) g(k)""", round_cols=["x", "y_hat"])
def a15_trend_line(spark, sf_dir):
    cw, spec, top = _cw_top4(spark, sf_dir)
    return C.trend_lines(spark, C.ols_fit(cw, top, spec.target), 100)


BOX = W(O.MT, """
d AS (SELECT rk, l_returnflag AS category, charge AS y FROM mt WHERE l_returnflag IS NOT NULL AND charge IS NOT NULL)""", """
q AS (SELECT category, count(*) AS n, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.5) AS median,
             quantile_cont(y, 0.75) AS q3 FROM d GROUP BY category)""", """
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q)""")


@query("a16_box_stats", sql=BOX + """
SELECT f.category, n, q1, median, q3, least(q1, min(CASE WHEN y >= lo_f THEN y END)) AS whisker_lo,
       greatest(q3, max(CASE WHEN y <= hi_f THEN y END)) AS whisker_hi, count(CASE WHEN y < lo_f OR y > hi_f THEN 1 END) AS n_outliers
FROM d JOIN f ON d.category = f.category GROUP BY f.category, n, q1, median, q3""",
       round_cols=["q1", "median", "q3", "whisker_lo", "whisker_hi"])
def a16_box_stats(spark, sf_dir):
    return C.box_stats(modelling_table(spark, sf_dir), "l_returnflag", "charge")


@query("a16_box_outliers", sql=BOX + """
SELECT rk AS row_id, d.category, y FROM d JOIN f ON d.category = f.category WHERE y < lo_f OR y > hi_f""",
       round_cols=["y"])
def a16_box_outliers(spark, sf_dir):
    return C.box_outliers(modelling_table(spark, sf_dir), "l_returnflag", "charge", "rk")


SKEWED = W(O.MT, """
d AS (SELECT rk, l_returnflag AS category, charge * charge * charge * charge AS y FROM mt WHERE l_returnflag IS NOT NULL AND charge IS NOT NULL)""", """
q AS (SELECT category, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.75) AS q3 FROM d GROUP BY category)""")


@query("a16_box_outliers_skewed", sql=SKEWED + """
SELECT rk AS row_id, d.category, y FROM d JOIN q ON d.category = q.category
WHERE y < q1 - 1.5 * (q3 - q1) OR y > q3 + 1.5 * (q3 - q1)""", round_cols=["y"])
def a16_box_outliers_skewed(spark, sf_dir):
    """A16 on a skewed value, where rows do lie outside the fences."""
    y = F.col("charge")
    mt = modelling_table(spark, sf_dir).withColumn("skewed", y * y * y * y)
    return C.box_outliers(mt, "l_returnflag", "skewed", "rk")


@query("a17_violin_density", sql=W(O.MT, """
d AS (SELECT l_returnflag AS category, charge AS y FROM mt WHERE l_returnflag IS NOT NULL AND charge IS NOT NULL)""", """
st AS (SELECT category, count(*) AS n, min(y) AS lo, max(y) AS hi,
              stddev_samp(y) * pow(CAST(count(*) AS DOUBLE), -0.2) AS h FROM d GROUP BY category)""", """
axis AS (SELECT category, g.k, (lo - h * 2.0) + g.k * ((hi + h * 2.0) - (lo - h * 2.0)) / 99 AS x, n, h
        FROM st CROSS JOIN range(100) g(k))""") + """
SELECT a.category, a.k, a.x, sum(exp(-0.5 * pow((a.x - d.y) / a.h, 2))) / (a.n * a.h * sqrt(2 * pi())) AS density
FROM axis a JOIN d ON d.category = a.category GROUP BY a.category, a.k, a.x, a.n, a.h""",
       round_cols=["x", "density"], digits=8)
def a17_violin_density(spark, sf_dir):
    return C.violin_density(modelling_table(spark, sf_dir), "l_returnflag", "charge")


@query("a18_scatter_top4", sql=W(O.CW, TOP4) + "SELECT feature, c_custkey AS row_id, x, y FROM sel",
       round_cols=["x", "y"])
def a18_scatter_top4(spark, sf_dir):
    cw, spec, top = _cw_top4(spark, sf_dir)
    return C.scatter_series(cw, top, spec.target, "c_custkey")
