"""Registry of named queries (Spark callables) and their SQL oracles.

Each query takes (spark, sf_dir) and returns a DataFrame over the whole
driver tables. Floating outputs are rounded at the very end (never inside
a computation) so that results are hash-comparable across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def sig_round(col, digits: int):
    """Round to ``digits`` significant digits with the same IEEE steps the SQL
    side uses (power of ten, multiply, round to integer, divide), so values
    that differ only by summation order map to the same double."""
    k = F.lit(digits - 1) - F.floor(F.log10(F.abs(col)))
    scale = F.pow(F.lit(10.0), k)
    # |x| < 5e-13 is cancellation noise around zero (e.g. 1 - x/x): 0
    return F.when(F.abs(col) < ZERO_NOISE, F.lit(0.0)).otherwise(F.round(col * scale, 0) / scale)


ZERO_NOISE = 5e-13


def rounded(df: DataFrame, digits: int = 10) -> DataFrame:
    """Round every double column (at the output only)."""
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            col = sig_round(col.cast("double"), digits)
        out.append(col.alias(f.name))
    return df.select(*out)


def sql_sig_round(x: str, digits: int) -> str:
    k = f"({digits - 1} - floor(log10(abs({x}))))"
    return (f"CASE WHEN abs({x}) < {ZERO_NOISE} THEN 0.0 "
            f"ELSE round({x} * pow(10.0, {k})) / pow(10.0, {k}) END")


def sql_rounded(sql: str, cols: list[str], digits: int = 10) -> str:
    if not cols:
        return sql
    rep = ", ".join(f"{sql_sig_round(x, digits)} AS {x}" for x in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS q"


def query(name: str, sql: str | None = None, round_cols: list[str] | None = None,
          digits: int = 10):
    """Register a query; ``sql`` is its DuckDB oracle, ``round_cols`` the
    double columns the oracle rounds the same way as the Spark side."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(spark, sf_dir), digits)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql_rounded(sql, round_cols or [], digits)
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from ridgeline.plans import (  # noqa: F401
        q_profile, q_curves, q_prepare, q_evaluate, q_score, q_explain, q_models, q_identities,
    )
