"""Exact quantiles of any number of groups, and parameters of groups beside rows."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.session import scratch_path

BROADCAST_BYTES = 16 << 20  # of a table of parameters that is sent to all tasks


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = scratch_path(df.sparkSession, f"{name}/{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_parameters(rows: DataFrame, params: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of ``params`` (written; a row per value of ``key``).
    The parameters are broadcast if their measured size allows, so that rows stay
    where they lie; else both are shuffled, and Spark splits partitions that one
    large group has made uneven."""
    n, text = params.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.col(key).cast("string")))).first()
    small = n * 16 * (len(params.columns) + 2) + (text or 0) <= BROADCAST_BYTES
    return rows.join(F.broadcast(params) if small else params, key)


def grouped_quantiles(d: DataFrame, probs: list[float]) -> DataFrame:
    """(g, n, q0, q1, ...): rows and linearly interpolated quantiles of ``v`` per
    group of ``d`` (g, v), which holds no NULLs. Equal values are counted first, so
    that a value or group with a third of all rows is small; then one range sort by
    (g, v) and running numbers of rows give every value its ranks. A partition's
    start is the number of rows in those before it: one number per partition."""
    spark = d.sparkSession
    counts = d.groupBy("g", "v").agg(F.count(F.lit(1)).alias("k"))
    ordered = (counts.repartitionByRange("g", "v").sortWithinPartitions("g", "v")
               .select("g", "v", "k", F.spark_partition_id().alias("part")))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            k = batch.column("k").to_numpy()
            through = before + np.cumsum(k)
            before = int(through[-1]) if len(k) else before
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(through, pa.int64())], names=[*batch.schema.names, "upto"])

    # range bounds are sampled, and another run may sample others: written once
    group_type = d.schema["g"].dataType.simpleString()
    placed = written(ordered.mapInArrow(add_up, f"g {group_type}, v double, k long, part int, upto long"), "grouped-values")
    sizes = placed.groupBy("part").agg(F.sum("k").alias("k")).orderBy("part").collect()
    starts = np.concatenate([[0], np.cumsum([r["k"] for r in sizes])]).astype(int)
    shift = spark.createDataFrame([(r["part"], int(s)) for r, s in zip(sizes, starts)], "part int, shift long")
    placed = (placed.join(F.broadcast(shift), "part")
              .select("g", "v", "k", (F.col("upto") + F.col("shift")).alias("upto")))
    groups = written(placed.groupBy("g").agg(F.min(F.col("upto") - F.col("k")).alias("start"), F.sum("k").alias("n")), "grouped-sizes")
    upto = F.col("upto") - F.col("start")
    rank = [(F.col("n") - 1) * F.lit(float(q)) for q in probs]

    def at(r):
        return F.max(F.when((upto > r) & (upto - F.col("k") <= r), F.col("v")))

    found = (with_parameters(placed, groups, "g").groupBy("g", "n")
             .agg(*[at(F.floor(r)).alias(f"lo{i}") for i, r in enumerate(rank)],
                  *[at(F.ceil(r)).alias(f"hi{i}") for i, r in enumerate(rank)]))
    return found.select("g", "n", *[
        F.when((F.col(f"lo{i}") == F.col(f"hi{i}")) | (r == F.floor(r)), F.col(f"lo{i}"))
        .otherwise(F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * (r - F.floor(r))).alias(f"q{i}")
        for i, r in enumerate(rank)])
