"""Registered evaluation queries over the closed-form prediction table PT."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgeline.operators import evaluate as E
from ridgeline.plans import oracle_fixtures as O
from ridgeline.plans.q_profile import W
from ridgeline.plans.registry import query
from ridgeline.sources.fixtures import prediction_table

PT_ORDER = ["const", "price", "exact"]
PT_TREE = ["const", "price"]  # the subset used to exercise the tree-only argmin
MCOLS = ["rmse", "mae", "r2", "explained_variance", "mape"]


def _metrics_sql(by: str) -> str:
    return f"""
SELECT {by}, model AS display_name, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae,
       CASE WHEN var_pop(y) = 0 THEN NULL ELSE 1 - sum((y - p) * (y - p)) / (count(y) * var_pop(y)) END AS r2,
       CASE WHEN var_pop(y) = 0 THEN NULL ELSE 1 - var_pop(y - p) / var_pop(y) END AS explained_variance,
       CASE WHEN min(abs(y)) > 0 THEN 100 * avg(abs(y - p) / abs(y)) END AS mape
FROM pt WHERE y IS NOT NULL AND p IS NOT NULL GROUP BY {by}"""


METRICS_CTE = "m AS (" + _metrics_sql("model") + ")"


@query("e6_model_metrics", sql=W(O.PT) + _metrics_sql("model"), round_cols=MCOLS)
def e6_model_metrics(spark, sf_dir):
    """RMSE, MAE, R2, explained variance, MAPE per model."""
    return E.regression_metrics(prediction_table(spark, sf_dir))


# the prediction table under keys that have a label and one that has none
KEYS = {"const": "linear_regression", "price": "xgboost", "exact": "own_model"}
DISPLAY = {"display_name": "Model", "rmse": "RMSE", "mae": "MAE", "r2": "R2", "explained_variance": "Explained variance", "mape": "MAPE (%)"}


@query("p7_p8_display_metrics", sql=W(O.PT, METRICS_CTE) + """
SELECT CASE model WHEN 'const' THEN 'Linear Regression' WHEN 'price' THEN 'XGBoost' ELSE 'own_model' END AS "Model",
       rmse AS "RMSE", mae AS "MAE", r2 AS "R2", explained_variance AS "Explained variance", mape AS "MAPE (%)"
FROM m""", round_cols=[f'"{label}"' for label in list(DISPLAY.values())[1:]])
def p7_p8_display_metrics(spark, sf_dir):
    """The metric table with labels for keys, columns renamed and in display order."""
    renamed = prediction_table(spark, sf_dir).replace(KEYS, subset=["model"])
    return E.display_table(E.regression_metrics(renamed), DISPLAY)


@query("e6_metrics_by_segment", sql=W(O.PT) + _metrics_sql("model, l_returnflag"), round_cols=MCOLS)
def e6_metrics_by_segment(spark, sf_dir):
    return E.regression_metrics(prediction_table(spark, sf_dir), by=["model", "l_returnflag"])


@query("e7_identity_limits", sql=W(O.PT) + """
SELECT model, least(min(y), min(p)) AS lim_lo, greatest(max(y), max(p)) AS lim_hi FROM pt GROUP BY model""",
       round_cols=["lim_lo", "lim_hi"])
def e7_identity_limits(spark, sf_dir):
    return E.identity_limits(prediction_table(spark, sf_dir))


@query("e8_residuals", sql=W(O.PT) + "SELECT model, rk, p, y - p AS residual FROM pt",
       round_cols=["p", "residual"])
def e8_residuals(spark, sf_dir):
    return E.residuals(prediction_table(spark, sf_dir), "rk")


@query("e9_residual_histogram", sql=W(O.PT, """
d AS (SELECT model, y - p AS v FROM pt WHERE y - p IS NOT NULL)""", """
st AS (SELECT model, min(v) AS lo, max(v) AS hi FROM d GROUP BY model)""", """
c AS (SELECT d.model, CAST(CASE WHEN hi > lo THEN least(floor((v - lo) / ((hi - lo) / 30)), 29) ELSE 0 END AS INTEGER) AS bin,
             count(*) AS n FROM d JOIN st ON d.model = st.model GROUP BY 1, 2)""") + """
SELECT st.model, CAST(g.k AS INTEGER) AS bin, lo + g.k * ((hi - lo) / 30) AS bin_lo,
       lo + (g.k + 1) * ((hi - lo) / 30) AS bin_hi, coalesce(n, 0) AS count
FROM st CROSS JOIN range(30) g(k) LEFT JOIN c ON c.model = st.model AND c.bin = g.k""",
       round_cols=["bin_lo", "bin_hi"])
def e9_residual_histogram(spark, sf_dir):
    r = E.residuals(prediction_table(spark, sf_dir), "rk")
    return E.grouped_histogram(r, "model", "residual", 30)


@query("e10_best_models", sql=W(O.PT, METRICS_CTE, """
o AS (SELECT * FROM (VALUES ('const', 0), ('price', 1), ('exact', 2)) AS t(model, ord))""") + """
SELECT first(m.model ORDER BY rmse, ord) AS best_model,
       coalesce(first(CASE WHEN m.model IN ('const', 'price') THEN m.model END
                      ORDER BY CASE WHEN m.model IN ('const', 'price') THEN 0 ELSE 1 END, rmse, ord),
                (SELECT first(model ORDER BY rmse) FROM m)) AS best_tree_model
FROM m JOIN o ON m.model = o.model""")
def e10_best_models(spark, sf_dir):
    """Best model and best model within a subset."""
    m = E.regression_metrics(prediction_table(spark, sf_dir))
    return E.best_models(m, PT_ORDER, PT_TREE)


@query("p6_subset_rows", sql=W(O.PT, METRICS_CTE) + """
SELECT model, rmse FROM m WHERE model IN ('const', 'price')""", round_cols=["rmse"])
def p6_subset_rows(spark, sf_dir):
    """Membership filter on the metric table."""
    m = E.regression_metrics(prediction_table(spark, sf_dir))
    return m.filter(F.col("model").isin(PT_TREE)).select("model", "rmse")


@query("k4_rmse_bars", sql=W(O.PT, METRICS_CTE) + """
SELECT model, display_name, rmse AS value, rmse = min(rmse) OVER () AS is_best FROM m""", round_cols=["value"])
def k4_rmse_bars(spark, sf_dir):
    return E.metric_bars(E.regression_metrics(prediction_table(spark, sf_dir)), "rmse", ascending=True)


@query("k4_r2_bars", sql=W(O.PT, METRICS_CTE) + """
SELECT model, display_name, r2 AS value, r2 = max(r2) OVER () AS is_best FROM m""", round_cols=["value"])
def k4_r2_bars(spark, sf_dir):
    return E.metric_bars(E.regression_metrics(prediction_table(spark, sf_dir)), "r2", ascending=False)


@query("k8_metric_highlight", sql=W(O.PT, METRICS_CTE, "lng AS (" + " UNION ALL ".join(
    f"SELECT model, '{x}' AS metric, CAST({x} AS DOUBLE) AS value FROM m" for x in MCOLS) + ")") + """
SELECT model, metric, value,
       value = CASE WHEN metric IN ('rmse', 'mae', 'mape') THEN min(value) OVER (PARTITION BY metric)
                    ELSE max(value) OVER (PARTITION BY metric) END AS is_best
FROM lng""", round_cols=["value"])
def k8_metric_highlight(spark, sf_dir):
    return E.metric_highlight(E.regression_metrics(prediction_table(spark, sf_dir)))


@query("s6_json_roundtrip", sql=W(O.PT) + _metrics_sql("model"), round_cols=MCOLS)
def s6_json_roundtrip(spark, sf_dir):
    """S6 / S7 + S5: the metric table written as JSON records under the
    shared checkpoint folder, then read back with its schema."""
    import uuid

    from ridgeline.session import scratch_path
    from ridgeline.sources.tables import read_json, write_table
    m = E.regression_metrics(prediction_table(spark, sf_dir))
    path = scratch_path(spark, f"sinks/metrics-{uuid.uuid4().hex}")
    write_table(m, path, "json")
    return read_json(spark, path, multi_line=False, schema=m.schema)
