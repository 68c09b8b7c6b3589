"""Connected components of an edge table (large-star / small-star).

Kiveris et al., "Connected Components in MapReduce and Beyond", 2014: each step
hangs every neighbour of a node on the smallest node it sees. The steps are
partial aggregates and equi-joins, so a hub's edges are pre-aggregated and a
hot join key can be split; a step's edges are checkpointed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.session import checkpoint_dir


def _smallest(arcs: DataFrame) -> DataFrame:
    """arcs (u, v) -> (u, v, m): m the smallest of u and its neighbours."""
    low = arcs.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
    return arcs.join(low, "u")


def _state(edges: DataFrame) -> tuple[int, int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                    F.coalesce(F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31))), F.lit(0)).alias("s")).first()
    return row["n"], row["x"] or 0, row["s"]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node with an
    edge. Loops, repeated and reversed edges are allowed; null ends are not edges."""
    checkpoint_dir(edges.sparkSession)  # names the folder that checkpoint() writes to
    now = (edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
           .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct().checkpoint())
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_smallest(both).where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        hung = _smallest(large)  # here every v is below its u
        now = (hung.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                             F.struct("u", F.col("m").alias("v")))).alias("e"))
               .select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct().checkpoint())
        new = _state(now)
        if new == state:
            break
        state = new
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
