"""Column-expression helpers. All of them are built-in Spark expressions, so
they stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash32(seed: str, key: Column | str) -> Column:
    """First 8 hex digits of md5(seed ':' key) as a bigint in [0, 2^32).

    Deterministic, independent of partitioning and row order, and
    reproducible in any SQL engine with md5 (the oracle uses the same rule).
    """
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def row_key(*cols: str) -> Column:
    """A string key made of several columns, each cast to string."""
    return F.concat_ws("|", *[F.col(c).cast("string") for c in cols])


def clip(c: Column, lo: float | Column, hi: float | Column) -> Column:
    lo = lo if isinstance(lo, Column) else F.lit(lo)
    hi = hi if isinstance(hi, Column) else F.lit(hi)
    return F.greatest(lo, F.least(hi, c))


def round_half_even(c: Column, digits: int = 0) -> Column:
    """Python/pandas/NumPy round half to even (Spark ``round`` is half-up)."""
    return F.bround(c, digits)


def nan_to_null(c: Column) -> Column:
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def pair_masked(x: Column, y: Column) -> tuple[Column, Column]:
    """Keep x and y only where both are non-null (pairwise deletion)."""
    both = x.isNotNull() & y.isNotNull()
    return F.when(both, x), F.when(both, y)


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson r with pairwise null deletion; NULL (not an error) when either
    side is constant or fewer than two pairs exist.

    Bare ``corr`` raises DIVIDE_BY_ZERO under ANSI mode on a constant column,
    and a CASE guard around it does not help because the aggregate is
    evaluated anyway. The covariance / (std * std) form with ``try_divide``
    is exact to ~1e-15 and never raises.
    """
    xm, ym = pair_masked(x, y)
    r = F.try_divide(F.covar_pop(xm, ym), F.stddev_pop(xm) * F.stddev_pop(ym))
    return F.when(F.count(xm) > 1, r)


def null_count(c: Column) -> Column:
    return F.sum(c.isNull().cast("long"))


def literal_map(key: Column, values: dict) -> Column:
    """``values[key]`` as an expression (double); NULL for other keys. For a few
    entries, such as one per category."""
    if not values:
        return F.lit(None).cast("double")
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(v).cast("double"))])[key]
