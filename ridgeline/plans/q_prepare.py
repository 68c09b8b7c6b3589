"""Registered split and feature-preparation queries (T, F, A8, A9)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ridgeline.functions.exprs import hash32
from ridgeline.operators import profile as P
from ridgeline.operators import split as S
from ridgeline.operators.dictionary import DictionaryPrep
from ridgeline.operators.prepare import TabularPrep, impute_numeric
from ridgeline.plans import oracle_fixtures as O
from ridgeline.plans.registry import query
from ridgeline.sources.fixtures import modelling_table, mt_spec
from ridgeline.sources.tables import read_table

NUM, CAT = O.MT_NUMERIC, O.MT_CATEGORICAL


def W(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _mt_train_test(spark, sf_dir):
    mt = modelling_table(spark, sf_dir)
    return mt, mt_spec(mt), mt.filter(F.col("bucket") >= 2000), mt.filter(F.col("bucket") < 2000)


def _prep(spark, sf_dir, scale: bool, numeric=True, categorical=True):
    mt, spec, train, test = _mt_train_test(spark, sf_dir)
    model = TabularPrep(numericCols=list(spec.numeric) if numeric else [],
                        categoricalCols=list(spec.categorical) if categorical else [],
                        scale=scale).fit(train)
    return model, train, test


STATS = ",".join([
    "tr AS (SELECT * FROM mt WHERE bucket >= 2000)",
    "te AS (SELECT * FROM mt WHERE bucket < 2000)",
    "med AS (SELECT " + ", ".join(f"median({x}) AS q_{x}" for x in NUM) + " FROM tr)",
    "imp_tr AS (SELECT " + ", ".join(f"coalesce({x}, (SELECT q_{x} FROM med)) AS {x}" for x in NUM)
    + " FROM tr)",
    "sc AS (SELECT " + ", ".join(
        f"avg({x}) AS mu_{x}, CASE WHEN stddev_pop({x}) < 2.220446049250313e-15 THEN 1.0 "
        f"ELSE stddev_pop({x}) END AS sd_{x}" for x in NUM) + " FROM imp_tr)",
    "cnt AS (" + " UNION ALL ".join(
        f"SELECT '{x}' AS col, CAST({x} AS VARCHAR) AS value, count(*) AS n FROM tr "
        f"WHERE {x} IS NOT NULL GROUP BY 2" for x in CAT) + ")",
    "mode AS (SELECT col, value FROM (SELECT col, value, row_number() OVER "
    "(PARTITION BY col ORDER BY n DESC, value) AS rn FROM cnt) WHERE rn = 1)",
])


def _imp(x):
    return f"coalesce({x}, (SELECT q_{x} FROM med))"


def _scaled(x):
    return f"({_imp(x)} - (SELECT mu_{x} FROM sc)) / (SELECT sd_{x} FROM sc)"


def _cat_imp(x):
    return f"coalesce({x}, (SELECT value FROM mode WHERE col = '{x}'))"


def _onehot_cols(x):
    # fixed values: the sorted categories of the driver data (checked against
    # the fitted model by the f8_feature_names query)
    vals = {"l_returnflag": ["A", "N", "R"], "l_linestatus": ["F", "O"]}[x]
    return [f"CASE WHEN {_cat_imp(x)} = '{v}' THEN 1.0 ELSE 0.0 END AS {x}_{v}" for v in vals]


ONEHOT_NAMES = [f"{x}_{v}" for x, vs in (("l_returnflag", "ANR"), ("l_linestatus", "FO")) for v in vs]


# ------------------------------------------------------------------- T

@query("t1_hash_split", sql=W(O.MT) + "SELECT rk, bucket < 2000 AS is_test FROM mt")
def t1_hash_split(spark, sf_dir):
    return S.hash_split(modelling_table(spark, sf_dir), "rk").select("rk", "is_test")


@query("t1b_exact_split", sql=W(O.MT) + """
SELECT rk, row_number() OVER (ORDER BY h, rk) <= (SELECT ceil(0.2 * count(*)) FROM mt) AS is_test
FROM (SELECT rk, ('0x' || substr(md5('42:' || rk), 1, 8))::BIGINT AS h FROM mt)""")
def t1b_exact_split(spark, sf_dir):
    return S.exact_split(modelling_table(spark, sf_dir), "rk").select("rk", "is_test")


@query("t2_folds", sql=W(O.MT) + "SELECT rk, fold FROM mt WHERE bucket >= 2000")
def t2_folds(spark, sf_dir):
    mt = modelling_table(spark, sf_dir)
    return mt.filter(F.col("bucket") >= 2000).select("rk", S.fold_column("rk").alias("fold"))


@query("t3_sample", sql=W(O.MT) + """
SELECT rk, charge FROM mt WHERE bucket < 2000
ORDER BY ('0x' || substr(md5('sample:' || rk), 1, 8))::BIGINT, rk LIMIT 500""", round_cols=["charge"])
def t3_sample(spark, sf_dir):
    """The SHAP sample, n = min(500, N) test rows (a sampling operator)."""
    mt = modelling_table(spark, sf_dir)
    return S.hash_sample(mt.filter(F.col("bucket") < 2000), "rk", 500).select("rk", "charge")


@query("t4_validation_split", sql=W(O.MT) + """
SELECT rk, ('0x' || substr(md5('val:' || rk), 1, 8))::BIGINT % 10000 >= 8000 AS is_val
FROM mt WHERE bucket >= 2000""")
def t4_validation_split(spark, sf_dir):
    mt = modelling_table(spark, sf_dir)
    return mt.filter(F.col("bucket") >= 2000).select("rk", S.validation_flag("rk").alias("is_val"))


# ------------------------------------------------------------------- F

@query("f1_median_impute", sql=W(O.MT, STATS) + "SELECT rk, " + ", ".join(
    f"{_imp(x)} AS {x}" for x in NUM) + " FROM te", round_cols=NUM)
def f1_median_impute(spark, sf_dir):
    model, train, test = _prep(spark, sf_dir, scale=False, categorical=False)
    return model.expand(test, keep=["rk"])


@query("f2_mode_impute", sql=W(O.MT, STATS) + "SELECT rk, " + ", ".join(
    f"{_cat_imp(x)} AS {x}" for x in CAT) + " FROM te")
def f2_mode_impute(spark, sf_dir):
    model, train, test = _prep(spark, sf_dir, scale=False, numeric=False)
    modes = {x: s["mode"] for x, s in model.stats["categorical"].items()}
    return test.select("rk", *[F.coalesce(F.col(x), F.lit(modes[x])).alias(x) for x in CAT])


@query("f3_standardise", sql=W(O.MT, STATS) + "SELECT rk, " + ", ".join(
    f"{_scaled(x)} AS {x}" for x in NUM) + " FROM te", round_cols=NUM)
def f3_standardise(spark, sf_dir):
    model, train, test = _prep(spark, sf_dir, scale=True, categorical=False)
    return model.expand(test, keep=["rk"])


@query("f4_one_hot", sql=W(O.MT, STATS) + "SELECT rk, " + ", ".join(
    c for x in CAT for c in _onehot_cols(x)) + " FROM te", round_cols=ONEHOT_NAMES)
def f4_one_hot(spark, sf_dir):
    model, train, test = _prep(spark, sf_dir, scale=False, numeric=False)
    return model.expand(test, keep=["rk"])


def _vector_query(spark, sf_dir, scale):
    model, train, test = _prep(spark, sf_dir, scale=scale)
    out = model.transform(test).select("rk", vector_to_array("features").alias("_v"))
    return out.select("rk", *[F.col("_v")[i].alias(n) for i, n in enumerate(model.feature_names())])


@query("f6_prepared_tree", sql=W(O.MT, STATS) + "SELECT rk, " + ", ".join(
    [f"{_imp(x)} AS {x}" for x in NUM] + [c for x in CAT for c in _onehot_cols(x)]) + " FROM te",
    round_cols=NUM + ONEHOT_NAMES)
def f6_prepared_tree(spark, sf_dir):
    """F5-F7 (tree variant): fit on train, transform test, vector unpacked."""
    return _vector_query(spark, sf_dir, scale=False)


@query("f6_prepared_scaled", sql=W(O.MT, STATS) + "SELECT rk, " + ", ".join(
    [f"{_scaled(x)} AS {x}" for x in NUM] + [c for x in CAT for c in _onehot_cols(x)]) + " FROM te",
    round_cols=NUM + ONEHOT_NAMES)
def f6_prepared_scaled(spark, sf_dir):
    """F5-F7 (scaled variant for linear / neural models)."""
    return _vector_query(spark, sf_dir, scale=True)


@query("f7_prepared_rows", sql=W(O.MT, STATS) + "SELECT rk, bucket >= 2000 AS is_train, " + ", ".join(
    [f"{_scaled(x)} AS {x}" for x in NUM] + [c for x in CAT for c in _onehot_cols(x)]) + " FROM mt",
    round_cols=NUM + ONEHOT_NAMES)
def f7_prepared_rows(spark, sf_dir):
    """fitted on the training rows, training and test rows transformed in one scan."""
    mt, spec, train, test = _mt_train_test(spark, sf_dir)
    model = TabularPrep(numericCols=list(spec.numeric), categoricalCols=list(spec.categorical), scale=True).fit(train)
    return model.expand(mt.withColumn("is_train", F.col("bucket") >= 2000), ["rk", "is_train"])


@query("f8_feature_names", sql=W(O.MT, STATS) + """
SELECT * FROM (VALUES (0, 'l_quantity'), (1, 'l_extendedprice'), (2, 'l_discount'), (3, 'l_tax')) AS t(position, name)
UNION ALL
SELECT CAST(3 + row_number() OVER (ORDER BY co, value) AS INTEGER) AS position, col || '_' || value AS name
FROM (SELECT CASE col WHEN 'l_returnflag' THEN 0 ELSE 1 END AS co, col, value FROM cnt)""")
def f8_feature_names(spark, sf_dir):
    model, train, test = _prep(spark, sf_dir, scale=False)
    return spark.createDataFrame(list(enumerate(model.feature_names())), "position int, name string")


# ------------------------------------------------------------------- A8 / A9

@query("a8_feature_ranges", sql=W(O.MT, STATS) + " UNION ALL ".join(
    f"SELECT '{x}' AS feature, {i} AS ordinal, min({x}) AS min, max({x}) AS max, "
    f"median({x}) AS median, avg({x}) AS mean, stddev_samp({x}) AS std FROM imp_tr"
    for i, x in enumerate(NUM)), round_cols=["min", "max", "median", "mean", "std"])
def a8_feature_ranges(spark, sf_dir):
    model, train, test = _prep(spark, sf_dir, scale=False, categorical=False)
    return P.fitted_ranges(spark, model.stats, NUM)


@query("a9_feature_defaults", sql=W(O.MT, STATS) + " UNION ALL ".join(
    f"SELECT '{x}' AS feature, {i} AS ordinal, median({x}) AS \"default\" FROM imp_tr"
    for i, x in enumerate(NUM)), round_cols=['"default"'])
def a9_feature_defaults(spark, sf_dir):
    model, train, test = _prep(spark, sf_dir, scale=False, categorical=False)
    return P.feature_defaults(P.fitted_ranges(spark, model.stats, NUM))


# ------------------------------------------------------------------- categories as a table

@query("f4_dictionary_one_hot", sql=f"""
WITH o AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cust, o_orderpriority AS prio,
                  {O.h32('42', 'CAST(o_orderkey AS VARCHAR)')} % 10000 >= 2000 AS is_train FROM orders),
c AS (SELECT cust, row_number() OVER (ORDER BY cust) AS at, n, row_number() OVER (ORDER BY n DESC, cust) AS best
      FROM (SELECT cust, count(*) AS n FROM o WHERE is_train AND cust IS NOT NULL GROUP BY cust)),
p AS (SELECT prio, row_number() OVER (ORDER BY prio) + (SELECT count(*) FROM c) AS at, row_number() OVER (ORDER BY n DESC, prio) AS best
      FROM (SELECT prio, count(*) AS n FROM o WHERE is_train AND prio IS NOT NULL GROUP BY prio))
SELECT o_orderkey, is_train, CAST(1 + (SELECT count(*) FROM c) + (SELECT count(*) FROM p) AS INTEGER) AS size,
       concat_ws(',', '0', c.at, p.at) AS positions
FROM o LEFT JOIN c ON coalesce(o.cust, (SELECT cust FROM c WHERE best = 1)) = c.cust
       LEFT JOIN p ON coalesce(o.prio, (SELECT prio FROM p WHERE best = 1)) = p.prio""")
def f4_dictionary_one_hot(spark, sf_dir):
    """F2 / F4 / F7 with a category per customer: width and set positions of the
    sparse vector of every order, training and test rows, fitted on the former."""
    orders = read_table(spark, sf_dir, "orders", balance=True)
    rows = orders.select("o_orderkey", "o_totalprice", "o_custkey", "o_orderpriority",
                         (hash32("42", "o_orderkey") % 10000 >= 2000).alias("is_train"))
    model = DictionaryPrep(numericCols=["o_totalprice"], categoricalCols=["o_custkey", "o_orderpriority"]).fit(rows.where("is_train"))
    out = model.transform(rows).withColumn("v", F.unwrap_udt("features"))
    return out.select("o_orderkey", "is_train", F.col("v.size").alias("size"),
                      F.array_join(F.col("v.indices").cast("array<string>"), ",").alias("positions"))
