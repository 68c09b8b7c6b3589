"""Registered scoring queries (R1-R11, K9) over the applicant table ST, with
defaults and ranges fitted on the training rows of CW."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgeline.operators import profile as P
from ridgeline.operators import score as R
from ridgeline.operators.prepare import TabularPrep
from ridgeline.plans import oracle_fixtures as O
from ridgeline.plans.q_profile import W
from ridgeline.plans.registry import query
from ridgeline.sources.fixtures import customer_wide, cw_spec, explanation_table, scoring_table

NUM = O.CW_NUMERIC


def _fit(spark, sf_dir):
    """Defaults, categories and ranges of CW's training rows, all from one
    preparation fit."""
    cw = customer_wide(spark, sf_dir)
    spec = cw_spec(cw)
    train = cw.filter(F.col("bucket") >= 2000)
    model = TabularPrep(numericCols=list(spec.numeric), categoricalCols=list(spec.categorical)).fit(train)
    st = model.stats
    medians = {x: s["median"] for x, s in st["numeric"].items()}
    cats = {x: s["categories"] for x, s in st["categorical"].items()}
    ranges = P.fitted_ranges(spark, st, list(spec.numeric))
    return cw, spec, train, medians, cats, ranges


def _features_df(spark, spec):
    return spark.createDataFrame(
        [(f, "numeric") for f in spec.numeric] + [(f, "categorical") for f in spec.categorical],
        "feature string, kind string")


TRAIN_STATS = ",".join([
    "tr AS (SELECT * FROM cw WHERE bucket >= 2000)",
    "defaults AS (" + " UNION ALL ".join(
        f"SELECT '{x}' AS feature, {i} AS ordinal, median({x}) AS \"default\" FROM tr"
        for i, x in enumerate(NUM)) + ")",
    "ranges AS (" + " UNION ALL ".join(
        f"SELECT '{x}' AS feature, {i} AS ordinal, min(v) AS min, max(v) AS max, median(v) AS median, "
        f"avg(v) AS mean, stddev_samp(v) AS std FROM (SELECT CAST(coalesce({x}, "
        f"(SELECT median({x}) FROM tr)) AS DOUBLE) AS v FROM tr)"
        for i, x in enumerate(NUM)) + ")",
])


def _sql_long_inputs() -> str:
    parts = [f"SELECT c_custkey AS row_id, '{x}' AS feature, CAST({x} AS DOUBLE) AS num_value, "
             f"CAST(NULL AS VARCHAR) AS str_value FROM st WHERE {x} IS NOT NULL" for x in NUM]
    parts.append("SELECT c_custkey, 'CAT_SEGMENT', CAST(NULL AS DOUBLE), CAT_SEGMENT FROM st "
                 "WHERE CAT_SEGMENT IS NOT NULL")
    return "lng AS (" + " UNION ALL ".join(parts) + ")"


FLAGS = ("flags AS (SELECT row_id, l.feature, num_value, str_value, d.\"default\", "
         "CASE WHEN str_value IS NOT NULL THEN TRUE "
         "ELSE coalesce(abs(num_value - d.\"default\") > 1e-6, FALSE) END AS changed "
         "FROM lng l LEFT JOIN defaults d ON l.feature = d.feature)")


@query("r1_complete_inputs", sql=W(O.CW, O.ST, TRAIN_STATS) + "SELECT c_custkey, " + ", ".join(
    ["coalesce(CAT_SEGMENT, (SELECT min(CAT_SEGMENT) FROM tr)) AS CAT_SEGMENT"]
    + [f"CAST(coalesce({x}, (SELECT \"default\" FROM defaults WHERE feature = '{x}')) AS DOUBLE) AS {x}"
       for x in NUM]) + " FROM st", round_cols=NUM)
def r1_complete_inputs(spark, sf_dir):
    cw, spec, train, medians, cats, ranges = _fit(spark, sf_dir)
    st = scoring_table(spark, sf_dir)
    return R.complete_inputs(st, list(spec.features), medians, cats, keep=["c_custkey"])


@query("r2_r5_score_card", sql=W(O.CW, O.ST, """
s AS (SELECT c_custkey, CAST(round_even(greatest(300.0, least(800.0, raw_score)), 0) AS INTEGER) AS score FROM st)""", """
d AS (SELECT c_custkey, score, score - CAST(round_even((SELECT avg(SCORE) FROM cw), 0) AS INTEGER) AS delta FROM s)""") + """
SELECT c_custkey, score, greatest(0.0, least(1.0, (score - 300) / 500.0)) AS position, delta,
       CASE WHEN delta >= 0 THEN '+' || CAST(delta AS VARCHAR) ELSE CAST(delta AS VARCHAR) END AS delta_label,
       CASE WHEN delta >= 0 THEN 'above' ELSE 'below' END AS direction,
       CASE WHEN score >= 740 THEN 'Excellent' WHEN score >= 670 THEN 'Good' WHEN score >= 580 THEN 'Fair'
            ELSE 'Poor' END AS tier
FROM d""", round_cols=["position"])
def r2_r5_score_card(spark, sf_dir):
    """Clip + half-even round, position, difference to the mean, tier."""
    cw = customer_wide(spark, sf_dir)
    mean = cw.agg(F.avg("SCORE")).scalar()
    return R.score_card(scoring_table(spark, sf_dir), "raw_score", mean, keep=["c_custkey"])


@query("r6_change_flags", sql=W(O.CW, O.ST, TRAIN_STATS, _sql_long_inputs(), FLAGS) + "SELECT * FROM flags",
       round_cols=["num_value", '"default"'])
def r6_change_flags(spark, sf_dir):
    cw, spec, train, medians, cats, ranges = _fit(spark, sf_dir)
    defaults = spark.createDataFrame(list(medians.items()), "feature string, default double")
    return R.change_flags(scoring_table(spark, sf_dir), "c_custkey", list(spec.numeric),
                          list(spec.categorical), defaults)


@query("r7_change_counts", sql=W(O.CW, O.ST, TRAIN_STATS, _sql_long_inputs(), FLAGS) + f"""
SELECT row_id, count(CASE WHEN changed THEN 1 END) AS n_changed, count(*) AS n_shown,
       {len(NUM) + 1} - count(*) AS n_auto_filled FROM flags GROUP BY row_id""")
def r7_change_counts(spark, sf_dir):
    cw, spec, train, medians, cats, ranges = _fit(spark, sf_dir)
    defaults = spark.createDataFrame(list(medians.items()), "feature string, default double")
    flags = R.change_flags(scoring_table(spark, sf_dir), "c_custkey", list(spec.numeric),
                           list(spec.categorical), defaults)
    return R.change_counts(flags, len(spec.features))


def _sql_group(x: str) -> str:
    core = ", ".join(f"'{c}'" for c in R.CORE_FINANCIALS)
    return (f"CASE WHEN {x} IN ({core}) THEN 'Core Financials' "
            f"WHEN starts_with({x}, 'T_') AND ends_with({x}, '_12') THEN 'Annual Spend ($)' "
            f"WHEN starts_with({x}, 'T_') AND ends_with({x}, '_6') THEN 'Semi-Annual Spend ($)' "
            f"WHEN ends_with({x}, '_INCOME') THEN 'Ratio to Income' "
            f"WHEN ends_with({x}, '_DEBT') THEN 'Ratio to Debt' "
            f"WHEN ends_with({x}, '_SAVINGS') THEN 'Ratio to Savings' "
            f"WHEN starts_with({x}, 'CAT_') THEN 'Binary Flags' ELSE 'Other Ratios' END")


@query("r8_group_rollup", sql=W(O.CW, TRAIN_STATS) + f"""
SELECT {_sql_group('feature')} AS feature_group, count(*) AS n_features, min(min) AS min_of_min,
       max(max) AS max_of_max, avg(std) AS avg_std FROM ranges GROUP BY 1""",
       round_cols=["min_of_min", "max_of_max", "avg_std"])
def r8_group_rollup(spark, sf_dir):
    """Feature groups by name rule, training ranges rolled up per group."""
    cw, spec, train, medians, cats, ranges = _fit(spark, sf_dir)
    return R.group_rollup(ranges)


IMPORTANCE = ",".join([
    "imp AS (SELECT feature, avg(abs(shap)) AS m FROM xt GROUP BY feature)",
    "top15 AS (SELECT feature, row_number() OVER (ORDER BY m DESC, feature) AS rank FROM imp "
    "ORDER BY m DESC, feature LIMIT 15)",
    "keyf AS (SELECT feature, rank, 'numeric' AS kind FROM top15 WHERE rank <= 12 "
    "UNION ALL SELECT 'CAT_SEGMENT', CAST(NULL AS BIGINT), 'categorical')",
])


def _key_features(spark, sf_dir):
    cw = customer_wide(spark, sf_dir)
    spec = cw_spec(cw)
    imp = P.ranked_top(P.mean_abs_by(explanation_table(spark, sf_dir)), "mean_abs_shap", 15, "feature")
    feats = _features_df(spark, spec)
    return R.key_features(imp, feats, 12), feats


@query("r9_key_features", sql=W(O.CW, O.XT, IMPORTANCE) + "SELECT * FROM keyf")
def r9_key_features(spark, sf_dir):
    """Top importance features that exist, first 12, plus categoricals."""
    return _key_features(spark, sf_dir)[0]


@query("r9_key_features_fallback", sql=W(O.CW, TRAIN_STATS) + """
SELECT feature, row_number() OVER (ORDER BY std DESC, ordinal) AS rank, 'numeric' AS kind
FROM (SELECT * FROM ranges ORDER BY std DESC, ordinal LIMIT 12)
UNION ALL SELECT 'CAT_SEGMENT', CAST(NULL AS BIGINT), 'categorical'""")
def r9_key_features_fallback(spark, sf_dir):
    """R9 + K9: without importances the features with the largest spread."""
    cw, spec, train, medians, cats, ranges = _fit(spark, sf_dir)
    fallback = P.ranked_top(ranges.select("feature", "ordinal", "std"), "std", 12, "ordinal").select("feature", "rank")
    none = P.ranked_top(P.mean_abs_by(explanation_table(spark, sf_dir).filter("false")), "mean_abs_shap", 15, "feature")
    return R.key_features(none, _features_df(spark, spec), 12, fallback)


@query("r10_remaining_features", sql=W(O.CW, O.XT, IMPORTANCE) + " UNION ALL ".join(
    f"SELECT '{x}' AS feature" for x in NUM) + " EXCEPT SELECT feature FROM keyf")
def r10_remaining_features(spark, sf_dir):
    key, feats = _key_features(spark, sf_dir)
    return R.remaining_features(feats, key.select("feature"))


@query("r11_domain_check", sql=W(O.CW, O.ST, TRAIN_STATS, _sql_long_inputs()) + """
SELECT row_id, l.feature, num_value AS value, min, max, num_value BETWEEN min AND max AS in_range,
       greatest(min, least(max, median)) AS default_clipped, abs(max - min) < 1e-9 AS is_constant
FROM lng l JOIN ranges r ON l.feature = r.feature WHERE num_value IS NOT NULL""",
       round_cols=["value", "min", "max", "default_clipped"])
def r11_domain_check(spark, sf_dir):
    cw, spec, train, medians, cats, ranges = _fit(spark, sf_dir)
    return R.domain_check(scoring_table(spark, sf_dir), "c_custkey", list(spec.numeric),
                          ranges)


@query("k9_top_std_features", sql=W(O.CW, TRAIN_STATS) + """
SELECT feature, ordinal, std FROM ranges ORDER BY std DESC, ordinal LIMIT 12""", round_cols=["std"])
def k9_top_std_features(spark, sf_dir):
    """K9: fallback key features, top 12 by training std."""
    cw, spec, train, medians, cats, ranges = _fit(spark, sf_dir)
    r = ranges
    return r.orderBy(F.col("std").desc(), "ordinal").limit(12).select("feature", "ordinal", "std")


@query("a20_k7_importance", sql=W(O.CW, O.XT) + """
SELECT feature, m AS mean_abs_shap, rank FROM (
  SELECT feature, avg(abs(shap)) AS m, row_number() OVER (ORDER BY avg(abs(shap)) DESC, feature) AS rank
  FROM xt GROUP BY feature) WHERE rank <= 15""", round_cols=["mean_abs_shap"])
def a20_k7_importance(spark, sf_dir):
    """A20 + K7 (X3 on stored explanations): mean |shap| per feature, top 15
    with rank."""
    imp = P.ranked_top(P.mean_abs_by(explanation_table(spark, sf_dir)), "mean_abs_shap", 15, "feature")
    return imp.withColumn("rank", F.col("rank").cast("long"))
