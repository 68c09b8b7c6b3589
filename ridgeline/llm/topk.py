"""Exact top-k search by exhaustive term-at-a-time accumulation.

Every vector is a sparse row of integer weights ``floor(scale * x)``; its
dimensions are the terms. Candidates are dealt to blocks by a hash. A task
holds the postings (dimension -> vector numbers, weights) of its block, then
streams over all queries: each query row scatters ``weight * posting`` into a
dense array of scores, partition selection keeps the block's best k, and the
blocks' lists are merged per query.

Queries are replicated once per candidate block (the smaller side of the
block product); nothing is broadcast, and no task holds more than one block
and one batch of queries.

Defined results: rows whose id or vector is null, or whose vector holds a null
or non-finite component, take no part. Exact repeats of (id, vector) count
once. A candidate with the query's own id is not its neighbour; rows that share
an id but not the vector are separate candidates, and the query's rank list
then is that of its best row per (candidate, score). Shorter vectors count as
padded with zeros. Empty vectors score 0. Sums outside 64 bits are exact inside
and clamped to the 64-bit range.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.llm.common import lean

BLOCK_ROWS = 16_384
QUERY_ROWS = 256
LIMIT = (1 << 63) - 1


class Postings:
    """Term -> (rows, weights) of one block of candidates."""

    def __init__(self, ids: np.ndarray, rows: list[np.ndarray]):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.terms: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        width = max((len(r) for r in rows), default=0)
        dense = np.zeros((len(rows), width), dtype=np.float64)
        for i, j in enumerate(order):
            dense[i, :len(rows[j])] = rows[j]
        self.peak = float(np.abs(dense).max(initial=0.0))
        for t in range(width):
            at = np.flatnonzero(dense[:, t])
            if len(at):
                self.terms[t] = (at, dense[at, t])

    def scores(self, queries: list[np.ndarray]) -> np.ndarray:
        """Dense scores [queries, candidates] of one batch."""
        n = len(self.ids)
        bound = max((float(np.abs(q).sum()) for q in queries), default=0.0) * self.peak
        if bound < 2.0 ** 53:  # every partial sum is an integer that a double holds exactly
            acc = np.zeros((len(queries), n))
            width = max((len(q) for q in queries), default=0)
            for t in range(width):
                if t not in self.terms:
                    continue
                at, w = self.terms[t]
                qw = np.array([q[t] if t < len(q) else 0.0 for q in queries])
                use = np.flatnonzero(qw)
                if len(at) == n and len(use) == len(qw):
                    acc += qw[:, None] * w[None, :]
                elif len(at) == n:
                    acc[use] += qw[use, None] * w[None, :]
                else:
                    acc[np.ix_(use, at)] += qw[use, None] * w[None, :]
            return acc.astype(np.int64)
        acc = np.zeros((len(queries), n), dtype=object)
        for i, q in enumerate(queries):
            for t in np.flatnonzero(q):
                if int(t) in self.terms:
                    at, w = self.terms[int(t)]
                    acc[i, at] += np.array([int(x) for x in w], dtype=object) * int(q[t])
        return np.clip(acc, -LIMIT - 1, LIMIT).astype(np.int64)


def select(ids: np.ndarray, row: np.ndarray, own: int, k: int) -> np.ndarray:
    """Positions of the k best of one score row: score down, then id up.
    ``ids`` ascend, so a stable sort by score settles ties."""
    allowed = ids != own
    if allowed.all():
        at, s = None, row
    else:
        at = np.flatnonzero(allowed)
        s = row[at]
    if len(s) > k:
        cut = np.partition(s, len(s) - k)[len(s) - k]
        over = np.flatnonzero(s > cut)
        keep = np.concatenate([over, np.flatnonzero(s == cut)[:k - len(over)]])
    else:
        keep = np.arange(len(s))
    keep = np.sort(keep)
    keep = keep[np.argsort(-s[keep], kind="stable")]
    return keep if at is None else at[keep]


def weights(df: DataFrame, scale: int, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, w): one row per distinct usable vector, w = floor(scale * x)."""
    def weight(c):
        big = F.abs(c * F.lit(float(scale))) >= F.lit(2.0 ** 52)  # already whole numbers
        return F.when(big, c * F.lit(float(scale))).otherwise(F.floor(c * F.lit(float(scale))).cast("double"))

    x = F.transform(F.col(f"`{embedding}`"), lambda c: c.cast("double"))
    usable = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    return (df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), x.alias("x"))
            .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & usable)
            .select("vec_id", F.transform("x", weight).alias("w"))
            .groupBy("vec_id", "w").agg(F.count(F.lit(1)).alias("copies"))
            .select("vec_id", "w"))


def top_k(df: DataFrame, is_query, k: int = 10, scale: int = 1024, vec_id: str = "vec_id",
          embedding: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k best.

    ``is_query`` is a predicate Column over ``vec_id``."""
    vectors = weights(df, scale, vec_id, embedding)
    rows = df.count()  # from Parquet footers: fixes the number of blocks only
    blocks = max(1, math.ceil(rows / block_rows))
    cand = vectors.select(F.pmod(F.xxhash64("vec_id", "w"), F.lit(blocks)).cast("int").alias("block"),
                          F.lit(0).alias("side"), "vec_id", "w")
    queries = (vectors.where(is_query)
               .select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                       F.lit(1).alias("side"), "vec_id", "w"))
    both = (cand.unionByName(queries).repartition(blocks, "block")
            .sortWithinPartitions("block", "side", "vec_id"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, index, ids, held, asks = None, None, [], [], []

        def flush():
            nonlocal asks
            if not asks or not held:
                asks = []
                return None
            q, r, c, s = [], [], [], []
            scores = index.scores([w for _, w in asks])
            for (own, _), row in zip(asks, scores):
                at = select(index.ids, row, own, k)
                q.append(np.full(len(at), own, np.int64))
                c.append(index.ids[at])
                s.append(row[at])
            asks = []
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).astype(np.int64)) for x in (q, c, s)],
                names=["query_id", "vec_id", "score"])

        for batch in batches:
            col = {n: batch.column(n) for n in batch.schema.names}
            bl, sd, vi = (col[n].to_numpy(zero_copy_only=False) for n in ("block", "side", "vec_id"))
            lists = col["w"]
            flat = lists.values.to_numpy(zero_copy_only=False)
            off = lists.offsets.to_numpy()
            for i in range(batch.num_rows):
                if bl[i] != block:
                    if (out := flush()) is not None:
                        yield out
                    block, index, ids, held = bl[i], None, [], []
                w = np.array(flat[off[i]:off[i + 1]], dtype=np.float64)
                if sd[i] == 0:
                    ids.append(vi[i])
                    held.append(w)
                    continue
                if index is None and held:
                    index = Postings(np.array(ids, np.int64), held)
                asks.append((int(vi[i]), w))
                if len(asks) >= QUERY_ROWS and (out := flush()) is not None:
                    yield out
        if (out := flush()) is not None:
            yield out

    found = both.mapInArrow(lean(search), "query_id long, vec_id long, score long").distinct()
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
