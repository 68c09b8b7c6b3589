"""Benchmark decontamination by spaced seeds.

A spaced seed is a fixed mask over consecutive words; the words under its 1s are
hashed, those under its 0s are ignored, so a substitution at an ignored place
does not break the hit (PatternHunter, Ma et al. 2002, on words). All test items
and all training documents are hashed at every position under every mask, and
the two tables are joined on the hash. Each hit names a document, an item and a
diagonal; the overlap is then verified word by word along the diagonal, mismatches
allowed: the segment with the most equal words among those of which a share of
``identity`` or more agrees must hold ``least`` equal words or, in a shorter item,
``identity`` of the item's words.

The masks lose none of these: every placing of the mismatches that a segment may
have leaves a hit under one of them (tested for segments of up to 24 words).
Items shorter than ``SPAN`` words have masks for their own length.

Before the join, positions that hit no item hash are dropped by a bitmap of the
item hashes (one bit per hash modulo its size). The bitmap is built by a Spark
aggregation and its size is bounded (``common.MAX_BITS``); a fuller bitmap lets more
positions through to the join, never fewer. Documents send their hits in
clusters that carry the surrounding words, so texts are not read again.

Defined results: null and empty texts, on either side, overlap with nothing.
Items of up to three words need all of theirs. Repeated items each report;
repeated document rows report once. Null ids do not take part. Extra columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import (U64, as_i64, bitmap_has, bitmap_of, doc_slices, lean, splitmix, stored,
                                  text_buffers, word_hashes)

LEAST, IDENTITY = 12, 0.75
SPAN, WEIGHT = 16, 6  # words: of a segment with LEAST equal words, and under a mask's 1s
#: ``lossless_masks(16, 4, 6)``: of 16 words, 4 may differ at any place. The last
#: one adds the few placings of 5 in 20 and 6 in 24 that these miss.
MASKS = ("11010111", "11100010011", "110010001011", "1101001011", "11010000000111", "111100011",
         "1110111")


def needed(n: int, least: int, identity: float) -> int:
    """Equal words that an overlap with an item of ``n`` words must hold."""
    return min(least, math.ceil(identity * n - 1e-9))


@lru_cache(maxsize=None)
def lossless_masks(n: int, k: int, weight: int) -> tuple[str, ...]:
    """Masks such that, wherever ``k`` of ``n`` words differ, one of them lies at
    some place on equal words only. Greedy: the mask that serves most of the
    placings left comes next."""
    weight = min(weight, n - k)
    placings = np.array([sum(1 << p for p in c) for c in combinations(range(n), k)], np.int64)
    masks = [1 | (1 << span - 1) | sum(1 << p for p in inner)
             for span in range(weight, n + 1) for inner in combinations(range(1, span - 1), max(weight - 2, 0))
             if weight > 1 or span == 1]
    serves = np.zeros((len(masks), len(placings)), bool)
    for i, m in enumerate(masks):
        for shift in range(n - m.bit_length() + 1):
            serves[i] |= placings & (m << shift) == 0
    out, left = [], np.ones(len(placings), bool)
    while left.any():
        best = int(np.argmax(serves[:, left].sum(axis=1)))
        out.append(f"{masks[best]:b}")
        left &= ~serves[best]
    return tuple(out)


def masks_of(n: int, masks: tuple[str, ...], least: int, identity: float) -> tuple[str, ...]:
    """The masks of an item of ``n`` words. The fewer words, the fewer under a
    mask, but one less than the equal words needed at least."""
    if n >= SPAN:
        return masks
    m = needed(n, least, identity)
    return lossless_masks(n, n - m, m if n - m == 0 or m <= 3 else min(WEIGHT, m - 1))


def seed_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the words under the mask's 1s at every position."""
    m = len(words) - len(mask) + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(m, U64(int(mask, 2)))
    for i, bit in enumerate(mask):
        if bit == "1":
            out = (out ^ words[i:i + m]) * U64(0x9FB21C651E98DF25)
            out ^= out >> U64(29)
    return splitmix(out)


def _documents(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    data, offs = text_buffers(batch.column("text"))
    for lo, hi in doc_slices(offs):
        words, _, _, per_doc = word_hashes(data, offs[lo:hi + 1])
        ends = np.cumsum(per_doc)
        for i in range(hi - lo):
            yield lo + i, words[ends[i] - per_doc[i]:ends[i]]


def item_seeds(items: DataFrame, masks: tuple[str, ...], least: int, identity: float) -> DataFrame:
    """(item_id, n, words, seeds): word hashes and (hash, position) of each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item_id").to_pylist()
            out = []
            for i, w in _documents(batch):
                if not len(w):
                    continue
                seeds = [(int(h), p) for m in masks_of(len(w), masks, least, identity)
                         for p, h in enumerate(as_i64(seed_hashes(w, m)))]
                out.append({"item_id": ids[i], "n": len(w), "words": as_i64(w).tolist(),
                            "seeds": [{"h": h, "p": p} for h, p in seeds]})
            kind = pa.schema([("item_id", pa.int64()), ("n", pa.int64()), ("words", pa.list_(pa.int64())),
                              ("seeds", pa.list_(pa.struct([("h", pa.int64()), ("p", pa.int64())])))])
            yield pa.RecordBatch.from_pylist(out, schema=kind)

    return items.mapInArrow(lean(run), "item_id long, n long, words array<bigint>, seeds array<struct<h:bigint,p:bigint>>")


CLUSTER = "doc_id long, start long, words array<bigint>, hits array<struct<h:bigint,p:bigint>>"


def hit_clusters(docs: DataFrame, bitmap, shapes: list[str], reach: int) -> DataFrame:
    """Runs of nearby seed hits of each document, with ``reach`` words on both sides."""
    kind = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("words", pa.list_(pa.int64())),
                      ("hits", pa.list_(pa.struct([("h", pa.int64()), ("p", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for batch in batches:
            data, offs = text_buffers(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            for lo, hi in doc_slices(offs):
                words, _, _, per_doc = word_hashes(data, offs[lo:hi + 1])
                ends = np.cumsum(per_doc)
                owner = np.repeat(np.arange(hi - lo), per_doc)
                found_h, found_p = [], []
                for m in shapes:
                    h = seed_hashes(words, m)
                    if not len(h):
                        continue
                    at = np.flatnonzero(bitmap_has(bits, h))
                    at = at[owner[at] == owner[at + len(m) - 1]]  # inside one document
                    found_h.append(h[at])
                    found_p.append(at)
                if not found_p:
                    continue
                p, h = np.concatenate(found_p), as_i64(np.concatenate(found_h))
                order = np.argsort(p, kind="stable")
                p, h = p[order], h[order]
                cut = np.flatnonzero((np.diff(p) > reach) | (np.diff(owner[p]) != 0)) + 1
                out = []
                for g in np.split(np.arange(len(p)), cut):
                    if not len(g):
                        continue
                    d = owner[p[g[0]]]
                    begin = ends[d] - per_doc[d]
                    a, b = max(begin, p[g[0]] - reach), min(ends[d], p[g[-1]] + reach)
                    out.append({"doc_id": ids[lo + d], "start": int(a - begin), "words": as_i64(words[a:b]),
                                "hits": [{"h": int(x), "p": int(y - a)} for x, y in zip(h[g], p[g])]})
                yield pa.RecordBatch.from_pylist(out, schema=kind)

    return docs.mapInArrow(lean(run), CLUSTER)


def best_segment(equal: np.ndarray, identity: float = IDENTITY) -> tuple[int, int, int]:
    """Start, end and number of equal words of the run that holds the most equal
    words among those of which a share of ``identity`` or more is equal."""
    share = round(identity * 1000)
    score = np.concatenate([[0], np.cumsum(np.where(equal, 1000 - share, -share))])
    held = np.concatenate([[0], np.cumsum(equal)])
    low = np.minimum.accumulate(score)
    first = np.searchsorted(-low, -score)  # the earliest start of a run that ends here
    e = int(np.argmax(held - held[first]))
    s = int(first[e])
    while s < e and not equal[s]:
        s += 1
    return s, e, int(held[e] - held[s])


def overlaps(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
             item_id: str = "item_id", item_text: str = "text", masks: tuple[str, ...] = MASKS,
             least: int = LEAST, identity: float = IDENTITY) -> DataFrame:
    """doc_id, item_id, start_word, end_word, item_start, n_equal, item_words:
    the best verified overlap of each (document, item) pair."""
    spark = documents.sparkSession
    docs = documents.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                            F.col(f"`{text}`").cast("string").alias("text")).where("doc_id is not null and text is not null")
    items = benchmark.select(F.col(f"`{item_id}`").cast("long").alias("item_id"),
                             F.col(f"`{item_text}`").cast("string").alias("text")).where("item_id is not null and text is not null")
    table = stored(item_seeds(items, masks, least, identity), "seed-items")
    facts = table.agg(F.max("n").alias("reach"), F.collect_set(F.least("n", F.lit(SPAN))).alias("sizes")).first()
    schema = "doc_id long, item_id long, start_word long, end_word long, item_start long, n_equal long, item_words long"
    if facts["reach"] is None:
        return spark.createDataFrame([], schema)
    seeds = table.select("item_id", F.explode("seeds").alias("s")).select("item_id", "s.h", F.col("s.p").alias("q"))
    seeds = stored(seeds.distinct(), "seeds")
    bitmap = spark.sparkContext.broadcast(bitmap_of(seeds.select("h").distinct(), "h"))
    shapes = sorted({m for n in facts["sizes"] for m in masks_of(n, masks, least, identity)})
    clusters = stored(hit_clusters(docs, bitmap, shapes, int(facts["reach"])).distinct(), "seed-clusters")
    hits = clusters.select("doc_id", "start", F.explode("hits").alias("s")).select("doc_id", "start", "s.h", "s.p")
    lines = (hits.join(seeds, "h").select("doc_id", "start", "item_id", (F.col("p") - F.col("q")).alias("shift"))
             .distinct())
    pairs = (lines.join(clusters.select("doc_id", "start", "words"), ["doc_id", "start"])
             .join(table.select("item_id", F.col("words").alias("item")), "item_id"))
    names = [f.split()[0] for f in schema.split(", ")]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            cols = [batch.column(c).to_pylist() for c in ("doc_id", "start", "item_id", "shift")]
            for d, start, item, shift, w, t in zip(*cols, batch.column("words"), batch.column("item")):
                w, t = w.values.to_numpy(), t.values.to_numpy()
                a, b = max(0, shift), min(len(w), shift + len(t))
                if a >= b:
                    continue
                s, e, same = best_segment(w[a:b] == t[a - shift:b - shift], identity)
                if same >= max(1, needed(len(t), least, identity)):
                    out.append((d, item, start + a + s, start + a + e, a - shift + s, same, len(t)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(7)], names=names)

    found = pairs.select("doc_id", "start", "item_id", "shift", "words", "item").mapInArrow(lean(check), schema)
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct(
        "n_equal", (-F.col("start_word")).alias("a"), "end_word", "item_start", "item_words")).alias("b"))
    return best.select("doc_id", "item_id", (-F.col("b.a")).alias("start_word"), "b.end_word", "b.item_start",
                       "b.n_equal", "b.item_words")


def decontaminate(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **kw) -> DataFrame:
    """Documents without a verified overlap; rows without an id or text stay."""
    bad = overlaps(documents, benchmark, doc_id=doc_id, **kw).select(F.col("doc_id").alias(doc_id)).distinct()
    return documents.join(bad, doc_id, "left_anti").select(documents.columns)
