"""Table profiling: overview, missing values, duplicates, descriptive
statistics, categories, correlations, modes and top-k rankings.

Scale notes
-----------
* Per-column statistics are computed as ONE wide aggregate over the table
  (partial aggregation on every task, one small final merge) and the single
  result row is unpivoted with ``inline``; the data itself is never
  unpivoted, so the row count is not multiplied by the column count.
* Exact quantiles come from shrinking rank brackets (``operators.quantiles``);
  ``approx=True`` takes them from ``percentile_approx`` in the same aggregate.
* Groupings by value (duplicates, modes, categories) use hash aggregation
  with map-side partial aggregation, so a value that holds a third of all
  rows is combined on each task before the shuffle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ridgeline.functions.cache import passes_over
from ridgeline.functions.exprs import null_count, safe_corr
from ridgeline.operators.quantiles import exact_quantiles
from ridgeline.session import scratch_path
from ridgeline.spec import FeatureSpec


def c(name: str) -> Column:
    return F.col(f"`{name}`")


def _unpivot_row(wide: DataFrame, fields: list[tuple[str, dict[str, str]]],
                 key: str = "column") -> DataFrame:
    """Turn a one-row wide aggregate into one row per entry.

    ``fields`` = [(label, {out_col: wide_col, ...}), ...]."""
    if not fields:
        raise ValueError("no columns to unpivot")
    structs = []
    for i, (label, cols) in enumerate(fields):
        parts = [F.lit(label).alias(key), F.lit(i).alias("ordinal")]
        parts += [F.col(src).alias(dst) for dst, src in cols.items()]
        structs.append(F.struct(*parts))
    return wide.select(F.inline(F.array(*structs)))


# ---------------------------------------------------------------- A2 / A3 / K3

def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A2: (column, ordinal, missing_count) for the given columns, one pass."""
    cols = list(df.columns if columns is None else columns)
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, ordinal int, missing_count bigint")
    wide = df.agg(*[null_count(c(x)).alias(f"n{i}") for i, x in enumerate(cols)])
    return _unpivot_row(wide, [(x, {"missing_count": f"n{i}"}) for i, x in enumerate(cols)])


def missing_scope(spec: FeatureSpec, df: DataFrame, scope: str) -> list[str]:
    """The reference counts nulls over three different column sets."""
    if scope == "features":
        return list(spec.features)
    if scope == "features_target":
        return list(spec.features) + [spec.target]
    if scope == "all":
        return list(df.columns)
    raise ValueError(f"unknown scope {scope!r}")


def missing_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """A3: columns with missing values, count and percent (4 dp, half-even),
    sorted by count descending."""
    n = df.agg(F.count(F.lit(1))).scalar()
    nc = null_counts(df, columns)
    return (nc.filter(F.col("missing_count") > 0)
            .select("column", "ordinal", "missing_count",
                    F.bround(F.col("missing_count") * 100.0 / n, 4).alias("missing_pct"))
            .orderBy(F.col("missing_count").desc(), "ordinal"))


def top_missing(df: DataFrame, k: int = 20) -> DataFrame:
    """K3: top-k columns (all columns) by missing count, then only those > 0."""
    return (null_counts(df).orderBy(F.col("missing_count").desc(), "ordinal")
            .limit(k).filter(F.col("missing_count") > 0))


# ---------------------------------------------------------------- A4 / A5 / A1

def duplicate_count(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A4: rows that repeat an earlier row (all columns; NULL equals NULL).

    Rows are grouped by a 128-bit digest of their values and of which of them
    are NULL, so the shuffle carries 16 bytes a row, not the row."""
    cols = [c(x) for x in (df.columns if columns is None else columns)]
    nulls = F.concat(F.lit(""), *[F.when(x.isNull(), "1").otherwise("0") for x in cols])
    digest = [F.xxhash64(nulls, *cols).alias("_a"), F.xxhash64(F.lit(7), *reversed(cols), nulls).alias("_b")]
    groups = df.select(*digest).groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_k"))
    return groups.agg(F.coalesce(F.sum(F.col("_k") - 1), F.lit(0)).cast("long").alias("n_duplicates"))


def target_stats(df: DataFrame, target: str, approx: bool = False) -> DataFrame:
    """A5: mean, median, sample std, min, max of the target (one pass)."""
    y = c(target).cast("double")
    if approx:
        med = F.percentile_approx(y, 0.5, 100000)
    else:
        med = F.lit(exact_quantiles(df, [target], [0.5])[target][0]).cast("double")
    return df.agg(
        F.avg(y).alias("target_mean"), med.alias("target_median"),
        F.stddev_samp(y).alias("target_std"), F.min(y).alias("target_min"),
        F.max(y).alias("target_max"))


def overview(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """A1: one row describing the table. Its four passes (moments, median
    refinement, duplicate grouping) run over one persisted copy; the result
    is a single row."""
    with passes_over(df) as part:
        y = c(spec.target).cast("double")
        n_missing = F.lit(0).cast("long")
        for f in spec.features:
            n_missing = n_missing + null_count(c(f))
        med = exact_quantiles(part, [spec.target], [0.5])[spec.target][0]
        row = part.agg(
            F.count(F.lit(1)).alias("total_rows"), n_missing.alias("n_missing_total"),
            F.avg(y).alias("target_mean"), F.stddev_samp(y).alias("target_std"),
            F.min(y).alias("target_min"), F.max(y).alias("target_max")).first()
        dups = duplicate_count(part).first()[0]
    out = [(row["total_rows"], len(df.columns), len(spec.features), len(spec.numeric),
            len(spec.categorical), list(spec.numeric), list(spec.categorical), spec.target,
            row["n_missing_total"], dups, row["target_mean"], med, row["target_std"],
            row["target_min"], row["target_max"])]
    return df.sparkSession.createDataFrame(out, OVERVIEW_SCHEMA)


OVERVIEW_SCHEMA = (
    "total_rows bigint, total_columns bigint, n_features bigint, n_numeric_features bigint, "
    "n_categorical_features bigint, numeric_features array<string>, categorical_features array<string>, "
    "target_column string, n_missing_total bigint, n_duplicates bigint, target_mean double, "
    "target_median double, target_std double, target_min double, target_max double")


# ---------------------------------------------------------------- A6 / A8 / A9

def describe(df: DataFrame, columns: list[str], approx: bool = False,
             accuracy: int = 100000) -> DataFrame:
    """Count, mean, std (ddof=1), min, p25, p50, p75, max per column,
    transposed to one row per column (a bounded, column-sized result).

    One wide aggregate gives the moments; the quartiles are exact order
    statistics from rank brackets (``operators.quantiles``) or, with
    ``approx``, ``percentile_approx`` sketches in the same aggregate."""
    with passes_over(df, list(columns)) as part:
        return _describe(part, columns, approx, accuracy)


def _describe(df, columns, approx, accuracy):
    aggs = []
    for i, x in enumerate(columns):
        v = c(x).cast("double")
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"m{i}"),
                 F.stddev_samp(v).alias(f"s{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
        if approx:
            aggs.append(F.percentile_approx(v, [0.25, 0.5, 0.75], accuracy).alias(f"q{i}"))
    row = df.agg(*aggs).first()
    if approx:
        qs = {x: list(row[f"q{i}"]) if row[f"q{i}"] is not None else [None] * 3
              for i, x in enumerate(columns)}
    else:
        qs = exact_quantiles(df, list(columns), [0.25, 0.5, 0.75], stats={
            x: (row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"]) for i, x in enumerate(columns)})
    rows = [(x, i, row[f"n{i}"], row[f"m{i}"], row[f"s{i}"], row[f"lo{i}"],
             qs[x][0], qs[x][1], qs[x][2], row[f"hi{i}"]) for i, x in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, DESCRIBE_SCHEMA)


DESCRIBE_SCHEMA = ("feature string, ordinal int, count bigint, mean double, std double, min double, "
                   "p25 double, p50 double, p75 double, max double")


def feature_ranges(imputed_train: DataFrame, numeric: list[str], approx: bool = False) -> DataFrame:
    """Min, max, median, mean, std (ddof=1) per numeric feature of the
    imputed training rows."""
    d = describe(imputed_train, numeric, approx=approx)
    return d.select("feature", "ordinal", "min", "max", F.col("p50").alias("median"), "mean", "std")


def fitted_ranges(spark, stats: dict, numeric: list[str]) -> DataFrame:
    """A8 from a preparation fit: imputing the median leaves the median and the
    extremes as they are, and the fit has the imputed moments, so the rows are
    not read again."""
    rows = [(x, i, *(stats["numeric"][x][k] for k in ("min", "max", "median", "mean", "std")))
            for i, x in enumerate(numeric)]
    return spark.createDataFrame(
        rows, "feature string, ordinal int, min double, max double, median double, mean double, std double")


def feature_defaults(ranges: DataFrame) -> DataFrame:
    """Default input value per feature = training median."""
    return ranges.select("feature", "ordinal", F.col("median").alias("default"))


# ---------------------------------------------------------------- A7 / A21

def _long_values(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(x).alias("column"), c(x).cast("string").alias("value"))
        for x in columns]))).filter(F.col("value").isNotNull())


def category_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Sorted distinct non-null values per categorical column, as a long
    table (column, value, value_rank). Distinct is a grouped aggregation, so
    no single task ever collects a whole column."""
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, value string, value_rank bigint")
    counts = _long_values(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return ranked_values(counts).select("column", "value", "value_rank")


def ranked_values(counts: DataFrame) -> DataFrame:
    """``counts`` (column, value, ...; a row per distinct value) with ``value_rank``,
    the place (from 1) of a value among its column's, in sorted order.

    Values are sorted by range partitions, so a column with many values is spread
    over many tasks, and a row's place in its partition is added to the number of
    rows of its column in the partitions before. These numbers are one small row
    per column and partition. Range bounds are sampled, and another run may sample
    others: the sorted rows are written to the shared folder and read back."""
    spark = counts.sparkSession
    path = scratch_path(spark, f"ranks/{uuid.uuid4().hex}")
    (counts.repartitionByRange("column", "value").sortWithinPartitions("column", "value")
     .withColumn("_at", F.monotonically_increasing_id()).write.parquet(path))
    # the id holds the partition above 33 bits and the place in it below
    placed = (spark.read.parquet(path).withColumn("_part", F.shiftright("_at", 33))
              .withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))))
    parts = (placed.groupBy("column", "_part").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("first"))
             .orderBy("column", "_part").collect())
    rows, before, last = [], 0, None
    for r in parts:
        before = 0 if r["column"] != last else before
        rows.append((r["column"], r["_part"], before - r["first"] + 1))
        before, last = before + r["n"], r["column"]
    shift = spark.createDataFrame(rows, "column string, _part long, _shift long")
    return (placed.join(F.broadcast(shift), ["column", "_part"])
            .withColumn("value_rank", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift"))


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Most frequent non-null value per column, ties -> smallest value.

    Counts per (column, value) and then the best of each column are grouped
    aggregations with map-side combine: a task sends one row per column."""
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, mode string, count bigint")
    counts = _long_values(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return best_values(counts)


def best_values(counts: DataFrame) -> DataFrame:
    """(column, mode, count) of ``counts`` (column, value, n)."""
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("value")))
    return (counts.groupBy("column").agg(best.alias("best"))
            .select("column", F.col("best.value").alias("mode"), (-F.col("best.less")).alias("count")))


# ---------------------------------------------------------------- A10 / A11 / K1 / K2

def target_correlations(df: DataFrame, numeric: list[str], target: str) -> DataFrame:
    """A10: Pearson r of each numeric feature with the target, pairwise null
    deletion, NULL for constant columns. One wide aggregate."""
    if not numeric:
        return df.sparkSession.createDataFrame([], "feature string, ordinal int, r double")
    y = c(target).cast("double")
    wide = df.agg(*[safe_corr(c(x).cast("double"), y).alias(f"r{i}") for i, x in enumerate(numeric)])
    return _unpivot_row(wide, [(x, {"r": f"r{i}"}) for i, x in enumerate(numeric)], key="feature")


def top_abs(corr: DataFrame, k: int, value: str = "r") -> DataFrame:
    """K1: top-k by absolute value, NULL dropped, ties in column order."""
    return (corr.filter(F.col(value).isNotNull())
            .orderBy(F.abs(F.col(value)).desc(), "ordinal").limit(k))


def signed_order(top: DataFrame, value: str = "r") -> DataFrame:
    """K2: re-sort the top-k by signed value and classify the sign."""
    return (top.select("*", F.when(F.col(value) < 0, "negative").otherwise("positive").alias("sign"))
            .orderBy(F.col(value), "ordinal"))


def top_features(df: DataFrame, numeric: list[str], target: str, k: int) -> list[str]:
    """Names of the top-k features by |r| (a bounded list of k names)."""
    rows = top_abs(target_correlations(df, numeric, target), k).select("feature").collect()
    return [r.feature for r in rows]


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pairwise Pearson matrix in long form (row_feature, row_ordinal,
    col_feature, col_ordinal, r) with pairwise null deletion; NULL for
    constant pairs and for fewer than two complete pairs.

    Two passes: column means (one wide aggregate) to centre the data, then
    pairwise-complete sufficient statistics from four matrix products per
    Arrow batch (M'M, X'M, (X*X)'M and X'X with M the non-null mask), added
    up by a tree aggregation. The state is p x p, whatever the row count."""
    import numpy as np
    import pandas as pd
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    p = len(columns)
    with passes_over(df, list(columns)) as part:
        means = part.agg(*[F.avg(c(x).cast("double")).alias(f"m{i}") for i, x in enumerate(columns)]).first()
        shift = np.array([means[f"m{i}"] if means[f"m{i}"] is not None else 0.0 for i in range(p)])
        arr = part.select(F.array(*[c(x).cast("double") for x in columns]).alias("x"))

        def partial(batches):
            acc = None
            for pdf in batches:
                if pdf.empty:
                    continue
                X = np.stack(pdf["x"].to_numpy()).astype(float)  # Arrow nulls arrive as NaN
                M = (~np.isnan(X)).astype(float)
                X0 = np.where(M > 0, X - shift, 0.0)
                stats = np.concatenate([(M.T @ M).ravel(), (X0.T @ M).ravel(),
                                        ((X0 * X0).T @ M).ravel(), (X0.T @ X0).ravel()])
                acc = stats if acc is None else acc + stats
            if acc is not None:
                yield pd.DataFrame({"s": [acc]})

        vec = arr.mapInPandas(partial, "s array<double>").select(array_to_vector("s").alias("s")) \
            .agg(Summarizer.sum(F.col("s")).alias("s")).first()["s"]
    s = np.asarray(vec.toArray()) if vec is not None else np.zeros(4 * p * p)
    nn, sx, sxx, sxy = (s[k * p * p:(k + 1) * p * p].reshape(p, p) for k in range(4))
    rows = []
    for i in range(p):
        for j in range(p):
            n = nn[i, j]
            r = None
            if n > 1:
                # column i restricted to rows where j is present: sx[i, j], sxx[i, j]
                mx, my = sx[i, j] / n, sx[j, i] / n
                cov = sxy[i, j] / n - mx * my
                vx = sxx[i, j] / n - mx * mx
                vy = sxx[j, i] / n - my * my
                if vx > 0 and vy > 0:
                    r = float(cov / np.sqrt(vx * vy))
                    if vx <= 1e-12 * max(sxx[i, j] / n, 1e-300) or vy <= 1e-12 * max(sxx[j, i] / n, 1e-300):
                        r = None  # constant up to rounding
            rows.append((columns[i], i, columns[j], j, r))
    return df.sparkSession.createDataFrame(
        rows, "row_feature string, row_ordinal int, col_feature string, col_ordinal int, r double")


# ---------------------------------------------------------------- A19 / A20 / K7

def kpis(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Dashboard figures as display strings (missing over all columns)."""
    y = c(spec.target).cast("double")
    n_missing = F.lit(0).cast("long")
    for x in df.columns:
        n_missing = n_missing + null_count(c(x))
    one = df.agg(F.count(F.lit(1)).alias("n"), n_missing.alias("miss"),
                 F.avg(y).alias("mu"), F.stddev_samp(y).alias("sd"))
    items = [
        ("Rows", F.format_number(F.col("n"), 0)),
        ("Features", F.lit(str(len(spec.numeric) + len(spec.categorical)))),
        ("Numeric Features", F.lit(str(len(spec.numeric)))),
        ("Categorical Features", F.lit(str(len(spec.categorical)))),
        ("Missing Values", F.format_number(F.col("miss"), 0)),
        ("Target Mean ± Std", F.format_string("%.0f ± %.0f", F.col("mu"), F.col("sd"))),
    ]
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("kpi"), F.lit(i).alias("ordinal"), v.alias("value"))
        for i, (k, v) in enumerate(items)])))


def mean_abs_by(long: DataFrame, key: str = "feature", value: str = "shap") -> DataFrame:
    """Mean of absolute values per key (grouped, partial aggregation)."""
    return long.groupBy(key).agg(F.avg(F.abs(F.col(value))).alias(f"mean_abs_{value}"))


def ranked_top(df: DataFrame, value: str, k: int, tie: str) -> DataFrame:
    """K7: top-k by value descending with rank 1..k (a top-k limit; the rank
    window then runs over k rows only)."""
    top = df.orderBy(F.col(value).desc(), F.col(tie)).limit(k)
    return top.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col(value).desc(), F.col(tie))))
