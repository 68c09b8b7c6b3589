"""Scans and sinks: Parquet / CSV / JSON readers with missing-value
normalisation, writers, and reads that fall back to a default when absent."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The tokens pandas.read_csv treats as missing by default
# (pandas documentation, ``na_values``), matched exactly after no trimming.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]


def read_table(spark: SparkSession, sf_dir: str, name: str, balance: bool = False) -> DataFrame:
    """Parquet scan of one driver table; ``balance`` spreads an
    under-partitioned fact-table scan (see ``balanced``)."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return balanced(df) if balance else df


def balanced(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread an under-partitioned scan over the cluster.

    A scan has one task per file split; a file with a single large row group
    (or an unsplittable compressed CSV) gives one task for all the per-row
    work that follows (hashing, projections, model training). When the scan
    has fewer splits than half the default parallelism, the rows are
    repartitioned (round-robin, made deterministic by Spark's local sort
    before repartitioning). Large inputs already have many splits and pass
    through unchanged. Projections and filters still reach the scan:
    Catalyst pushes them below the repartition.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() * 2 <= target:
        return df.repartition(target)
    return df


def normalize_missing(df: DataFrame, na_tokens: list[str] | None = None) -> DataFrame:
    """NaN -> NULL in float columns, NA tokens -> NULL in string columns.

    Spark treats NaN as a value (``avg`` becomes NaN, ``count`` counts it,
    percentiles sort it highest); the profile operators expect SQL NULL.
    """
    tokens = NA_TOKENS if na_tokens is None else na_tokens
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.isnan(c), F.lit(None).cast(f.dataType)).otherwise(c)
        elif isinstance(f.dataType, T.StringType) and tokens:
            c = F.when(c.isin(tokens), F.lit(None).cast("string")).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def infer_csv_types(df: DataFrame) -> DataFrame:
    """Type string columns the way a CSV reader with an NA-token set would:
    a column whose every non-missing value is written as a whole number that
    fits becomes bigint, one whose every value parses as a number (``1.0``,
    ``1e3``) double; everything else stays string.

    One aggregate pass over the data decides all columns at once.
    """
    str_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not str_cols:
        return df
    aggs = []
    for c in str_cols:
        col = F.col(f"`{c}`")
        whole = F.when(col.rlike(r"^\s*[+-]?[0-9]+\s*$"), col.try_cast("bigint"))
        aggs += [
            F.count(col).alias(f"n_{len(aggs)}"),
            F.count(col.try_cast("double")).alias(f"d_{len(aggs)}"),
            F.count(whole).alias(f"i_{len(aggs)}"),
        ]
    stats = df.agg(*aggs).first()
    casts = {}
    for i, c in enumerate(str_cols):
        n, d, integral = stats[3 * i], stats[3 * i + 1], stats[3 * i + 2]
        if n > 0 and d == n:
            casts[c] = "bigint" if integral == n else "double"
    return df.select(*[
        F.col(f"`{c}`").cast(casts[c]).alias(c) if c in casts else F.col(f"`{c}`")
        for c in df.columns
    ])


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    na_tokens: list[str] | None = None,
) -> DataFrame:
    """CSV scan with a header. With a schema the types are taken as given;
    without one, all columns are read as strings, NA tokens become NULL and
    types are inferred from the remaining values."""
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    if schema is not None:
        df = reader.schema(schema).csv(path)
        return normalize_missing(df, na_tokens=[] if na_tokens is None else na_tokens)
    raw = reader.option("inferSchema", False).csv(path)
    return infer_csv_types(normalize_missing(raw, na_tokens))


def read_json(spark: SparkSession, path: str, multi_line: bool = True,
              schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_or_default(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    default_rows: list[tuple] | None = None,
) -> DataFrame:
    """Read a stored table; when the path does not exist return the default
    rows (empty by default) with the same schema."""
    try:
        reader = spark.read.schema(schema)
        if fmt == "csv":
            reader = reader.option("header", True)
        elif fmt == "json":
            reader = reader.option("multiLine", True)
        df = reader.format(fmt).load(path)
        df.schema  # resolve now so a missing path raises here
        return df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
            raise
        return spark.createDataFrame(default_rows or [], schema)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a table. CSV gets a header; JSON is one record per line."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def to_json_records(df: DataFrame) -> DataFrame:
    """Each row as one JSON document string (records orientation)."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("json"))
