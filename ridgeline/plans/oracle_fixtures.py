"""The same fixture tables written as SQL common table expressions, for the
independent DuckDB oracle. Each constant is a comma-separated list of CTEs
to be placed after ``WITH``."""

from __future__ import annotations

from ridgeline.sources.fixtures import PART_TYPES


def h32(seed: str, key: str) -> str:
    return f"('0x' || substr(md5('{seed}:' || {key}), 1, 8))::BIGINT"


MT = f"""
mt_base AS (
  SELECT concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR),
                   CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                   CAST(l_shipdate AS VARCHAR)) AS rk,
         l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus
  FROM lineitem),
mt AS (
  SELECT rk, l_quantity,
         CASE WHEN {h32('n1', 'rk')} % 10 = 0 THEN NULL ELSE l_extendedprice END AS l_extendedprice,
         l_discount, l_tax,
         CASE WHEN {h32('n2', 'rk')} % 10 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag,
         l_linestatus,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge,
         {h32('42', 'rk')} % 10000 AS bucket,
         {h32('fold', 'rk')} % 5 AS fold
  FROM mt_base)
"""

MT_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
MT_CATEGORICAL = ["l_returnflag", "l_linestatus"]


def _cw() -> str:
    sums = []
    for t in PART_TYPES:
        for months, suffix in ((36, "12"), (18, "6")):
            sums.append(
                f"sum(CASE WHEN p_type = '{t}' THEN CASE WHEN l_shipdate > mx - INTERVAL {months} MONTH "
                f"THEN l_extendedprice ELSE 0.0 END END) AS T_{t}_{suffix}")
    cols = ["c_custkey", "c_acctbal", "c_mktsegment AS CAT_SEGMENT"]
    for t in PART_TYPES:
        cols += [
            f"T_{t}_12", f"T_{t}_6",
            f"CASE WHEN T_{t}_12 = 0 THEN NULL ELSE T_{t}_6 / T_{t}_12 END AS R_{t}",
            f"CASE WHEN c_acctbal = 0 THEN NULL ELSE T_{t}_12 / c_acctbal END AS R_{t}_ACCTBAL",
            f"CASE WHEN T_{t}_12 > 0 THEN 1 ELSE 0 END AS CAT_{t}",
        ]
    cols += ["300.0 + c_acctbal / 20 AS SCORE",
             f"{h32('42', 'CAST(c_custkey AS VARCHAR)')} % 10000 AS bucket"]
    return f"""
cw_mx AS (SELECT max(l_shipdate) AS mx FROM lineitem),
cw_spend AS (
  SELECT o_custkey, {', '.join(sums)}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN part ON l_partkey = p_partkey CROSS JOIN cw_mx
  GROUP BY o_custkey),
cw AS (
  SELECT {', '.join(cols)}
  FROM customer LEFT JOIN cw_spend ON c_custkey = o_custkey)
"""


CW = _cw()
CW_NUMERIC = [c for t in PART_TYPES
              for c in (f"T_{t}_12", f"T_{t}_6", f"R_{t}", f"R_{t}_ACCTBAL", f"CAT_{t}")]
CW_CATEGORICAL = ["CAT_SEGMENT"]
CW_FEATURES = ["CAT_SEGMENT"] + CW_NUMERIC

PT = f"""
pt_base AS (
  SELECT rk, l_returnflag, l_extendedprice,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) AS y,
         {h32('42', 'rk')} % 10000 AS bucket
  FROM (SELECT concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR),
                   CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                   CAST(l_shipdate AS VARCHAR)) AS rk, * FROM lineitem)),
pt_test AS (SELECT * FROM pt_base WHERE bucket < 2000),
pt AS (
  SELECT 'const' AS model, rk, l_returnflag, y,
         (SELECT avg(y) FROM pt_base WHERE bucket >= 2000) AS p FROM pt_test
  UNION ALL SELECT 'price', rk, l_returnflag, y, l_extendedprice * 0.9 FROM pt_test
  UNION ALL SELECT 'exact', rk, l_returnflag, y, y FROM pt_test)
"""


def _st() -> str:
    cols = ["c_custkey"]
    for i, f in enumerate(CW_FEATURES):
        cols.append(
            f"CASE WHEN ('0x' || substr(dg, {i + 1}, 1))::BIGINT % 4 = 0 THEN NULL ELSE {f} END AS {f}")
    cols.append("300.0 + c_acctbal / 20 AS raw_score")
    return f"""
st AS (
  SELECT {', '.join(cols)}
  FROM (SELECT *, md5('st:' || CAST(c_custkey AS VARCHAR)) AS dg FROM cw))
"""


ST = _st()


def _xt() -> str:
    parts = [
        f"SELECT c_custkey AS row_id, '{f}' AS feature, {i} AS pos, CAST({f} AS DOUBLE) AS feature_value "
        f"FROM cw WHERE bucket < 2000"
        for i, f in enumerate(CW_NUMERIC)
    ]
    return f"""
xt_long AS ({' UNION ALL '.join(parts)}),
xt_stats AS (SELECT feature, avg(feature_value) AS mu, stddev_pop(feature_value) AS sd
             FROM xt_long GROUP BY feature),
xt AS (
  SELECT row_id, l.feature, pos, feature_value,
         coalesce(CASE WHEN sd = 0 OR sd IS NULL THEN NULL
                  ELSE (coalesce(feature_value, mu) - mu) / sd * 10.0 / (pos + 1) END, 0.0) AS shap
  FROM xt_long l JOIN xt_stats s ON l.feature = s.feature)
"""


XT = _xt()
