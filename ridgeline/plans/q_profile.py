"""Registered profile queries (sources, projections, aggregations, top-k)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgeline.operators import profile as P
from ridgeline.plans import oracle_fixtures as O
from ridgeline.plans.registry import query
from ridgeline.sources.fixtures import customer_wide, cw_spec, modelling_table, mt_spec
from ridgeline.sources.tables import normalize_missing, read_table

MT_FEATURES = O.MT_NUMERIC + O.MT_CATEGORICAL
MT_COLS = ["rk", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
           "l_linestatus", "charge", "bucket", "fold"]
CW_ALL = (["c_custkey", "c_acctbal", "CAT_SEGMENT"] + O.CW_NUMERIC + ["SCORE", "bucket"])


def W(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def sql_null_counts(table: str, cols: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{x}' AS \"column\", {i} AS ordinal, count(*) - count({x}) AS missing_count FROM {table}"
        for i, x in enumerate(cols))


def sql_corr_long(table: str, cols: list[str], target: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{x}' AS feature, {i} AS ordinal, "
        f"CASE WHEN isnan(corr({x}, {target})) THEN NULL ELSE corr({x}, {target}) END AS r FROM {table}"
        for i, x in enumerate(cols))


def sql_describe(table: str, cols: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{x}' AS feature, {i} AS ordinal, count({x}) AS count, avg({x}) AS mean, "
        f"stddev_samp({x}) AS std, CAST(min({x}) AS DOUBLE) AS min, "
        f"quantile_cont({x}, 0.25) AS p25, quantile_cont({x}, 0.5) AS p50, "
        f"quantile_cont({x}, 0.75) AS p75, CAST(max({x}) AS DOUBLE) AS max FROM {table}"
        for i, x in enumerate(cols))


DESCRIBE_COLS = ["mean", "std", "min", "p25", "p50", "p75", "max"]
TARGET_COLS = ["target_mean", "target_median", "target_std", "target_min", "target_max"]


# ------------------------------------------------------------------- S / P

@query("s1_parquet_scan", sql="""
SELECT count(*) AS n_rows, avg(l_quantity) AS avg_quantity, avg(l_extendedprice) AS avg_price,
       avg(l_discount) AS avg_discount, avg(l_tax) AS avg_tax,
       CAST(min(l_shipdate) AS VARCHAR) AS min_shipdate, CAST(max(l_shipdate) AS VARCHAR) AS max_shipdate
FROM lineitem""", round_cols=["avg_quantity", "avg_price", "avg_discount", "avg_tax"])
def s1_parquet_scan(spark, sf_dir):
    """Columnar scan; only the six referenced columns are read."""
    li = normalize_missing(read_table(spark, sf_dir, "lineitem"))
    return li.agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg("l_quantity").alias("avg_quantity"),
        F.avg("l_extendedprice").alias("avg_price"), F.avg("l_discount").alias("avg_discount"),
        F.avg("l_tax").alias("avg_tax"),
        F.min("l_shipdate").cast("string").alias("min_shipdate"),
        F.max("l_shipdate").cast("string").alias("max_shipdate"))


@query("s2_missing_normalised", sql=W(O.MT) + sql_null_counts("mt", MT_COLS))
def s2_missing_normalised(spark, sf_dir):
    """NaN and NA tokens -> NULL, then null counts of every column."""
    return P.null_counts(normalize_missing(modelling_table(spark, sf_dir)))


@query("s1_csv_scan", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_discount END AS l_discount,
       CASE WHEN l_linenumber % 4 = 1 THEN NULL ELSE l_returnflag END AS l_returnflag FROM lineitem""",
       round_cols=["l_quantity", "l_discount"])
def s1_csv_scan(spark, sf_dir):
    """Lineitem written as CSV with NA tokens in place of values, read
    back with inferred types (quantities are written as ``17.0``)."""
    import uuid

    from ridgeline.session import scratch_path
    from ridgeline.sources.tables import read_csv, write_table
    li = read_table(spark, sf_dir, "lineitem")
    no = F.col("l_linenumber")
    text = li.select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("l_quantity"),
        F.when(no % 3 == 0, F.when(no % 2 == 0, "NA").otherwise("null")).otherwise(
            F.col("l_discount").cast("double").cast("string")).alias("l_discount"),
        F.when(no % 4 == 1, "N/A").otherwise(F.col("l_returnflag")).alias("l_returnflag"))
    path = scratch_path(spark, f"sinks/lineitem-csv-{uuid.uuid4().hex}")
    write_table(text, path, "csv")
    out = read_csv(spark, path)
    assert dict(out.dtypes)["l_quantity"] == "double" and dict(out.dtypes)["l_orderkey"] == "bigint"
    return out


@query("s2_nan_and_tokens", sql="""
SELECT 'l_quantity' AS "column", 0 AS ordinal, count(CASE WHEN l_linenumber % 5 = 0 THEN 1 END) AS missing_count FROM lineitem
UNION ALL SELECT 'l_returnflag', 1, count(CASE WHEN l_linenumber % 4 = 1 THEN 1 END) FROM lineitem
UNION ALL SELECT 'l_orderkey', 2, 0 FROM lineitem""".replace(" 0 FROM lineitem", " count(*) - count(l_orderkey) FROM lineitem"))
def s2_nan_and_tokens(spark, sf_dir):
    """S2 with NaN and NA tokens present: both count as missing."""
    no = F.col("l_linenumber")
    li = read_table(spark, sf_dir, "lineitem").select(
        F.when(no % 5 == 0, F.lit(float("nan"))).otherwise(F.col("l_quantity").cast("double")).alias("l_quantity"),
        F.when(no % 4 == 1, F.when(no % 8 == 1, "#N/A").otherwise("None")).otherwise(F.col("l_returnflag"))
        .alias("l_returnflag"), "l_orderkey")
    return P.null_counts(normalize_missing(li))


@query("p3_xy_projection",
       sql=W(O.MT) + "SELECT rk, " + ", ".join(MT_FEATURES) + ", charge FROM mt",
       round_cols=["l_quantity", "l_extendedprice", "l_discount", "l_tax", "charge"])
def p3_xy_projection(spark, sf_dir):
    """Drop id / excluded / target columns that exist, keep X and y."""
    mt = modelling_table(spark, sf_dir)
    spec = mt_spec(mt)
    return mt.select("rk", *spec.features, spec.target)


# ------------------------------------------------------------------- A

@query("a1_overview", sql=W(O.MT) + """
SELECT count(*) AS total_rows, CAST(10 AS BIGINT) AS total_columns, CAST(6 AS BIGINT) AS n_features,
  CAST(4 AS BIGINT) AS n_numeric_features, CAST(2 AS BIGINT) AS n_categorical_features,
  'l_quantity,l_extendedprice,l_discount,l_tax' AS numeric_features,
  'l_returnflag,l_linestatus' AS categorical_features, 'charge' AS target_column,
  CAST(6 * count(*) - count(l_quantity) - count(l_extendedprice) - count(l_discount)
       - count(l_tax) - count(l_returnflag) - count(l_linestatus) AS BIGINT) AS n_missing_total,
  (SELECT count(*) FROM mt) - (SELECT count(*) FROM (SELECT DISTINCT * FROM mt)) AS n_duplicates,
  avg(charge) AS target_mean, median(charge) AS target_median, stddev_samp(charge) AS target_std,
  min(charge) AS target_min, max(charge) AS target_max
FROM mt""", round_cols=TARGET_COLS)
def a1_overview(spark, sf_dir):
    mt = modelling_table(spark, sf_dir)
    o = P.overview(mt, mt_spec(mt))
    return o.withColumn("numeric_features", F.array_join("numeric_features", ",")) \
            .withColumn("categorical_features", F.array_join("categorical_features", ","))


@query("a2_null_counts", sql=W(O.MT) + sql_null_counts("mt", MT_FEATURES + ["charge"]))
def a2_null_counts(spark, sf_dir):
    mt = modelling_table(spark, sf_dir)
    spec = mt_spec(mt)
    return P.null_counts(mt, P.missing_scope(spec, mt, "features_target"))


@query("a3_missing_table", sql=W(O.MT, "nc AS (" + sql_null_counts("mt", MT_FEATURES + ["charge"]) + ")") + """
SELECT "column", ordinal, missing_count,
       round_even(missing_count * 100.0 / (SELECT count(*) FROM mt), 4) AS missing_pct
FROM nc WHERE missing_count > 0""", round_cols=["missing_pct"])
def a3_missing_table(spark, sf_dir):
    mt = modelling_table(spark, sf_dir)
    spec = mt_spec(mt)
    return P.missing_table(mt, P.missing_scope(spec, mt, "features_target"))


DUP_COLS = ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query("a4_duplicates", sql=W(O.MT) + f"""
SELECT (SELECT count(*) FROM mt) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(DUP_COLS)} FROM mt))
       AS n_duplicates""")
def a4_duplicates(spark, sf_dir):
    mt = modelling_table(spark, sf_dir)
    return P.duplicate_count(mt.select(*DUP_COLS))


@query("a4_duplicates_all_columns", sql=W(O.MT) + """
SELECT (SELECT count(*) FROM mt) - (SELECT count(*) FROM (SELECT DISTINCT * FROM mt)) AS n_duplicates""")
def a4_duplicates_all_columns(spark, sf_dir):
    """A4 as the profile of a table asks for it: rows that repeat in every column."""
    return P.duplicate_count(modelling_table(spark, sf_dir))


@query("a5_target_stats", sql=W(O.MT) + """
SELECT avg(charge) AS target_mean, median(charge) AS target_median, stddev_samp(charge) AS target_std,
       min(charge) AS target_min, max(charge) AS target_max FROM mt""", round_cols=TARGET_COLS)
def a5_target_stats(spark, sf_dir):
    return P.target_stats(modelling_table(spark, sf_dir), "charge")


@query("a6_describe_mt", sql=W(O.MT) + sql_describe("mt", O.MT_NUMERIC + ["charge"]),
       round_cols=DESCRIBE_COLS)
def a6_describe_mt(spark, sf_dir):
    mt = modelling_table(spark, sf_dir)
    return P.describe(mt, mt_spec(mt).profile_columns)


@query("a6_describe_cw", sql=W(O.CW) + sql_describe("cw", O.CW_NUMERIC + ["SCORE"]),
       round_cols=DESCRIBE_COLS)
def a6_describe_cw(spark, sf_dir):
    cw = customer_wide(spark, sf_dir)
    return P.describe(cw, cw_spec(cw).profile_columns)


def sql_long_values(table: str, cols: list[str], where: str = "TRUE") -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{x}' AS \"column\", CAST({x} AS VARCHAR) AS value FROM {table} "
        f"WHERE {where} AND {x} IS NOT NULL"
        for x in cols)


@query("a7_category_values", sql=W(O.MT, "lv AS (" + sql_long_values("mt", O.MT_CATEGORICAL) + ")") + """
SELECT "column", value, row_number() OVER (PARTITION BY "column" ORDER BY value) AS value_rank
FROM (SELECT DISTINCT "column", value FROM lv)""")
def a7_category_values(spark, sf_dir):
    mt = modelling_table(spark, sf_dir)
    return P.category_values(mt, list(mt_spec(mt).categorical))


@query("a10_target_corr", sql=W(O.CW) + sql_corr_long("cw", O.CW_NUMERIC, "SCORE"), round_cols=["r"])
def a10_target_corr(spark, sf_dir):
    cw = customer_wide(spark, sf_dir)
    spec = cw_spec(cw)
    return P.target_correlations(cw, list(spec.numeric), spec.target)


def _sql_cw_long(cols: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT c_custkey, '{x}' AS feature, CAST({x} AS DOUBLE) AS v FROM cw" for x in cols)


@query("a11_corr_matrix", sql=W(
    O.CW, "r AS (" + sql_corr_long("cw", O.CW_NUMERIC, "SCORE") + ")",
    """top AS (SELECT feature, CAST(row_number() OVER (ORDER BY abs(r) DESC, ordinal) - 1 AS INTEGER) AS pos
              FROM r WHERE r IS NOT NULL ORDER BY abs(r) DESC, ordinal LIMIT 15)""",
    "cols AS (SELECT feature, pos FROM top UNION ALL SELECT 'SCORE', 15)",
    "lng AS (" + _sql_cw_long(O.CW_NUMERIC + ["SCORE"]) + ")",
    "sel AS (SELECT l.c_custkey, l.feature, l.v, c.pos FROM lng l JOIN cols c ON l.feature = c.feature)") + """
SELECT a.feature AS row_feature, a.pos AS row_ordinal, b.feature AS col_feature, b.pos AS col_ordinal,
       CASE WHEN isnan(corr(a.v, b.v)) THEN NULL ELSE corr(a.v, b.v) END AS r
FROM sel a JOIN sel b ON a.c_custkey = b.c_custkey
GROUP BY a.feature, a.pos, b.feature, b.pos""", round_cols=["r"])
def a11_corr_matrix(spark, sf_dir):
    cw = customer_wide(spark, sf_dir)
    spec = cw_spec(cw)
    top = P.top_features(cw, list(spec.numeric), spec.target, 15)
    return P.correlation_matrix(cw, top + [spec.target])


def _sql_kpis() -> str:
    miss = " + ".join(f"(count(*) - count({x}))" for x in CW_ALL)
    return W(O.CW) + f"""
SELECT 'Rows' AS kpi, 0 AS ordinal, format('{{:,}}', count(*)) AS value FROM cw
UNION ALL SELECT 'Features', 1, '{1 + len(O.CW_NUMERIC)}'
UNION ALL SELECT 'Numeric Features', 2, '{len(O.CW_NUMERIC)}'
UNION ALL SELECT 'Categorical Features', 3, '1'
UNION ALL SELECT 'Missing Values', 4, format('{{:,}}', {miss}) FROM cw
UNION ALL SELECT 'Target Mean ± Std', 5, printf('%.0f ± %.0f', avg(SCORE), stddev_samp(SCORE)) FROM cw"""


@query("a19_kpis", sql=_sql_kpis())
def a19_kpis(spark, sf_dir):
    cw = customer_wide(spark, sf_dir)
    return P.kpis(cw, cw_spec(cw))


@query("a21_modes", sql=W(O.MT, "lv AS (" + sql_long_values("mt", O.MT_CATEGORICAL, "bucket >= 2000") + ")") + """
SELECT "column", value AS mode, cnt AS count FROM (
  SELECT "column", value, count(*) AS cnt,
         row_number() OVER (PARTITION BY "column" ORDER BY count(*) DESC, value) AS rn
  FROM lv GROUP BY "column", value) WHERE rn = 1""")
def a21_modes(spark, sf_dir):
    """Most frequent category on the training rows (ties -> smallest)."""
    mt = modelling_table(spark, sf_dir)
    train = mt.filter(F.col("bucket") >= 2000)
    return P.modes(train, list(mt_spec(mt).categorical))


# ------------------------------------------------------------------- K

@query("k1_top4_abs_corr", sql=W(O.CW, "r AS (" + sql_corr_long("cw", O.CW_NUMERIC, "SCORE") + ")") + """
SELECT * FROM r WHERE r IS NOT NULL ORDER BY abs(r) DESC, ordinal LIMIT 4""", round_cols=["r"])
def k1_top4_abs_corr(spark, sf_dir):
    cw = customer_wide(spark, sf_dir)
    spec = cw_spec(cw)
    return P.top_abs(P.target_correlations(cw, list(spec.numeric), spec.target), 4)


@query("k2_top20_signed", sql=W(O.CW, "r AS (" + sql_corr_long("cw", O.CW_NUMERIC, "SCORE") + ")") + """
SELECT *, CASE WHEN r < 0 THEN 'negative' ELSE 'positive' END AS sign
FROM (SELECT * FROM r WHERE r IS NOT NULL ORDER BY abs(r) DESC, ordinal LIMIT 20)""", round_cols=["r"])
def k2_top20_signed(spark, sf_dir):
    cw = customer_wide(spark, sf_dir)
    spec = cw_spec(cw)
    return P.signed_order(P.top_abs(P.target_correlations(cw, list(spec.numeric), spec.target), 20))


@query("k3_top_missing", sql=W(O.MT, "nc AS (" + sql_null_counts("mt", MT_COLS) + ")") + """
SELECT * FROM (SELECT * FROM nc ORDER BY missing_count DESC, ordinal LIMIT 20) WHERE missing_count > 0""")
def k3_top_missing(spark, sf_dir):
    return P.top_missing(modelling_table(spark, sf_dir), 20)


@query("s8_csv_roundtrip", sql=W(O.CW) + sql_describe("cw", O.CW_NUMERIC + ["SCORE"]),
       round_cols=DESCRIBE_COLS)
def s8_csv_roundtrip(spark, sf_dir):
    """S8 + S4: the describe table written as CSV with a header under the
    shared checkpoint folder, then read back as a keyed table."""
    import uuid

    from ridgeline.session import scratch_path
    from ridgeline.sources.tables import read_csv, write_table
    cw = customer_wide(spark, sf_dir)
    path = scratch_path(spark, f"sinks/describe-{uuid.uuid4().hex}")
    write_table(P.describe(cw, cw_spec(cw).profile_columns), path, "csv")
    return read_csv(spark, path, schema=P.DESCRIBE_SCHEMA)
