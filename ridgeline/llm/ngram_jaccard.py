"""N-gram Jaccard join by parity sketches, and its near-duplicate classes.

A document is the set of its distinct k-word shingles (64-bit hashes). Two
documents link when ``den * |A n B| >= num * |A u B|``, which is the same as
``|A ^ B| <= (den - num) / (den + num) * (|A| + |B|)``.

1. *Parity sketch.* Each shingle toggles (XOR) one bit of a sketch, so the sketch
   of A ^ B is the XOR of the two sketches and their Hamming distance is a lower
   bound of |A ^ B|.
2. *Size bands.* Sizes are cut into geometric bands; linked sizes differ by one
   band at most. A document enters its own band's join, and the next one's if it
   can have a partner there.
3. *Pigeonhole join.* In a band where at most K shingles may differ, the hash
   space is split into P = 1.25 K + 2 parts. At least P - K parts of two linked
   documents hold the same shingles, hence the same parity bits. A part's bits
   are folded to a 64-bit XOR digest: the join key. A document may skip its
   lightest parts (by number of shingles, which equal parts share) as long as it
   skips fewer than P minus its own bound: the keys left are selective and no
   linked pair is lost.
4. *Blocks.* Documents that meet under a key are compared sketch against sketch
   (one matrix product per block; hot keys are split into blocks and every pair
   of blocks is one group). Pairs whose Hamming distance exceeds their bound
   cannot link. From each block leaves a spanning forest of the rest, not all
   pairs.
5. *Verify.* The pairs are checked on the shingle sets. A second round over keys
   that still hold several components checks every pair the forest left out, so
   the classes are exact.

Documents with equal sets are joined first by a 128-bit digest of the set, and
one row stands for them in all later steps.

Defined results: no words (null, empty, white space): n_shingles 0, linked with
nothing, component_id its own id. Fewer than k words: one shingle of all of them.
Rows without an id take the class of equal texts that have one, else a null
component. Rows that repeat a (id, text) give one result row each; rows that
share an id but not the text are classed by their own text. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.llm.common import (U64, Scratch, as_i64, bitmap_has, bitmap_of, doc_slices, lean, shingles,
                                  splitmix, stored, text_buffers, word_hashes)
from ridgeline.llm.components import components

BLOCK_ROWS = 512
FEW = 6  # groups up to this size compare pair by pair
BLOCK_BYTES = 4 << 20
BROADCAST_IDS = 500_000  # more ids are joined by a shuffle
SIGNATURE = ("doc_id long, n long, hi long, lo long, keys array<bigint>, sketch binary")


class Bands:
    """Size bands and the difference bounds of a threshold num / den."""

    def __init__(self, num: int, den: int, ratio: float = 1.4, slack: float = 0.25):
        self.num, self.den = num, den
        self.slack = slack
        self.ratio = max(ratio, den / num)
        self.tops = [0]

    def partner(self, n: int) -> int:
        """Largest size that a set of n can link to."""
        return n * self.den // self.num

    def bound(self, both: int) -> int:
        """Largest symmetric difference of two linked sets of this total size."""
        return (self.den - self.num) * both // (self.den + self.num)

    def band(self, n: int) -> int:
        while self.tops[-1] < n:
            self.tops.append(max(self.tops[-1] + 1, int(self.tops[-1] * self.ratio)))
        return int(np.searchsorted(self.tops, n))

    def plans(self, n: int) -> list[tuple[int, int, int]]:
        """(band, parts, own bound) of each join that a set of n enters."""
        most = self.partner(n)
        if self.bound(n + most) == 0:
            return []  # links to equal sets only
        b = self.band(n)
        self.band(self.partner(self.tops[b]) + 1)
        out = []
        for t in (b, b + 1):
            top = self.tops[t]
            if t > b and most <= self.tops[b]:
                break
            limit = self.bound(2 * top)
            parts = int(limit * (1 + self.slack)) + 2
            out.append((t, parts, self.bound(n + min(most, top))))
        return out


def part_keys(hashes: np.ndarray, band: int, parts: int, bound: int) -> np.ndarray:
    """Join keys of one sorted set in one band."""
    part = ((hashes >> U64(32)) * U64(parts)) >> U64(32)
    count = np.bincount(part.astype(np.int64), minlength=parts)
    light = np.cumsum(np.bincount(np.minimum(count, 15), minlength=16))
    fits = np.flatnonzero(light <= parts - bound - 1)
    skip = int(fits[-1]) if len(fits) else -1  # parts of at most so many shingles are left out
    digest = np.zeros(parts, np.uint64)
    first = np.flatnonzero(np.diff(part, prepend=U64(1 << 63)))
    digest[part[first].astype(np.int64)] = np.bitwise_xor.reduceat(splitmix(hashes), first)
    use = np.flatnonzero(count > skip)
    return splitmix(digest[use] ^ splitmix(use.astype(U64) + U64(band << 40)))


def parity_sketch(hashes: np.ndarray) -> bytes:
    """Parity bits at ``hash mod 2**b``, b so that a bit has half a shingle or less.
    Sketches of two lengths compare after folding the longer by XOR."""
    bits = 1 << max(8, (2 * len(hashes) - 1).bit_length())
    at = (hashes & U64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    data, offs = text_buffers(batch.column("text"))
    for lo, hi in doc_slices(offs):
        words, _, _, per_doc = word_hashes(data, offs[lo:hi + 1])
        ends = np.cumsum(per_doc)
        for i in range(hi - lo):
            yield lo + i, np.unique(shingles(words[ends[i] - per_doc[i]:ends[i]], k))


def signatures(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(num, den)
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            ids = batch.column("doc_id").to_pylist()
            size = 0
            for i, s in _sets(batch, k):
                n = len(s)
                plans = bands.plans(n) if n else []
                keys = np.concatenate([part_keys(s, *p) for p in plans]) if plans else np.zeros(0, np.uint64)
                digest = as_i64(np.array([splitmix(s).sum(), splitmix(s ^ U64(0xA0761D6478BD642F)).sum()], np.uint64))
                row = (ids[i], n, int(digest[0]), int(digest[1]), as_i64(keys), parity_sketch(s) if plans else b"")
                for c, v in zip(out, row):
                    c.append(v)
                size += len(row[5]) + 8 * len(keys)
                if size > 8 << 20:
                    yield _signature_batch(out)
                    out, size = [[], [], [], [], [], []], 0
            yield _signature_batch(out)

    return docs.mapInArrow(lean(run), SIGNATURE)


def _signature_batch(out: list[list]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)],
                                      names=["doc_id", "n", "hi", "lo", "keys", "sketch"])


# ------------------------------------------------------------------ blocks

def _fold(sketch: np.ndarray, size: int) -> np.ndarray:
    while len(sketch) > size:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


def close_pairs(n: np.ndarray, comp: np.ndarray, sketches: list[bytes], num: int, den: int) -> np.ndarray:
    """bool[m, m]: pairs of different components whose bound the Hamming
    distance of their sketches does not exceed."""
    raw = [np.frombuffer(s, np.uint8) for s in sketches]
    size = min(map(len, raw))
    packed = np.stack([_fold(s, size) for s in raw])
    m = len(raw)
    if m <= FEW:
        near = np.zeros((m, m), bool)
        value = [int.from_bytes(p.tobytes()) for p in packed]
        for i in range(m):
            for j in range(i):
                allowed = (den - num) * int(n[i] + n[j]) // (den + num)
                near[i, j] = near[j, i] = (comp[i] != comp[j] and abs(int(n[i] - n[j])) <= allowed
                                           and (value[i] ^ value[j]).bit_count() <= allowed)
        return near
    common = np.zeros((m, m), np.float32)
    ones = np.zeros(m, np.float32)
    for lo in range(0, size, 512):
        bits = np.unpackbits(packed[:, lo:lo + 512], axis=1).astype(np.float32)
        common += bits @ bits.T
        ones += bits.sum(axis=1)
    allowed = (den - num) * (n[:, None] + n[None, :]) // (den + num)
    far = ones[:, None] + ones[None, :] - 2 * common
    return ((far <= allowed) & (np.abs(n[:, None] - n[None, :]) <= allowed)
            & (comp[:, None] != comp[None, :]))


def forest(near: np.ndarray, comp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a breadth-first forest over the pairs; rows of one component
    count as joined already."""
    left = np.ones(len(comp), bool)
    a, b = [], []
    for root in range(len(comp)):
        if not left[root]:
            continue
        queue = [root]
        left[root] = False
        while queue:
            u = queue.pop()
            same = np.flatnonzero(left & (comp == comp[u]))
            left[same] = False
            new = np.flatnonzero(near[u] & left)
            left[new] = False
            a.append(np.full(len(new), u))
            b.append(new)
            queue += [*same, *new]
    return np.concatenate(a), np.concatenate(b)


def block_pairs(rows: DataFrame, num: int, den: int, every: bool) -> DataFrame:
    """rows (key, i, j, rep, n, comp, sketch) -> candidate pairs (a, b)."""
    def emit(group: dict[str, list]) -> pa.RecordBatch | None:
        rep, n, comp = (np.array(group[c], np.int64) for c in ("rep", "n", "comp"))
        if len(rep) < 2:
            return None
        near = close_pairs(n, comp, group["sketch"], num, den)
        a, b = np.nonzero(np.triu(near)) if every else forest(near, comp)
        if not len(a):
            return None
        x, y = rep[a], rep[b]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, group = None, {}
        for batch in batches:
            cols = batch.to_pydict()
            for r in zip(*(cols[c] for c in ("key", "i", "j", "rep", "n", "comp", "sketch"))):
                if r[:3] != at:
                    if group and (out := emit(group)) is not None:
                        yield out
                    at, group = r[:3], {"rep": [], "n": [], "comp": [], "sketch": []}
                for c, v in zip(group, r[3:]):
                    group[c].append(v)
        if group and (out := emit(group)) is not None:
            yield out

    dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(lean(run), "a long, b long").distinct()


def candidates(shared: DataFrame, sketches: DataFrame, comps: DataFrame | None,
               num: int, den: int, every: bool) -> DataFrame:
    """Candidate pairs of the keys that hold more than one component."""
    if comps is None:
        rows = shared.withColumn("comp", F.col("rep"))
    else:
        rows = (shared.join(comps, shared["rep"] == comps["node"], "left")
                .select("key", "rep", "n", F.coalesce("component", "rep").alias("comp")))
    load = F.sum(F.greatest(F.col("n"), F.lit(64)) / 4)
    keys = (rows.groupBy("key")
            .agg(F.min("comp").alias("low"), F.max("comp").alias("high"),
                 F.greatest(F.ceil(load / BLOCK_BYTES), F.ceil(F.count(F.lit(1)) / BLOCK_ROWS)).alias("blocks"))
            .where(F.col("low") != F.col("high")).select("key", "blocks"))
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    pair = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
                       lambda j: F.struct(F.least(mine, j).alias("i"), F.greatest(mine, j).alias("j")))
    rows = (rows.join(keys, "key").select("key", "rep", "n", "comp", F.explode(pair).alias("p"))
            .join(sketches, ["rep", "n"]).select("key", "p.i", "p.j", "rep", "n", "comp", "sketch"))
    return block_pairs(rows, num, den, every)


def verify(pairs: DataFrame, docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs whose shingle sets link. A bitmap of the pairs' ids picks the
    documents to shingle again, so texts are read where they lie and only sets
    are shuffled; the joins drop what the bitmap let through."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap_of(ends, "doc_id"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(bitmap_has(wanted.value, batch.column("doc_id").to_numpy())))
            ids = batch.column("doc_id").to_pylist()
            at, held, size = [], [], 0
            seen = set()
            for i, s in _sets(batch, k):
                if (mark := (ids[i], len(s), int(s.sum()))) in seen:  # a repeated row
                    continue
                seen.add(mark)
                at.append(ids[i])
                held.append(s.tobytes())
                size += len(held[-1])
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(held, pa.binary())], names=["id", "s"])
                    at, held, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(held, pa.binary())], names=["id", "s"])

    table = stored(docs.where("doc_id is not null").mapInArrow(lean(sets), "id long, s binary"), "jaccard-sets")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                p = np.frombuffer(x.as_buffer(), np.uint64)
                q = np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(den * both >= num * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return (pairs.join(table.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
            .join(table.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
            .select("a", "b", "sa", "sb").mapInArrow(lean(check), "a long, b long").distinct())


# ------------------------------------------------------------------ operator

def named_texts(df: DataFrame, doc_id: str, text: str, name: str) -> tuple[DataFrame, bool]:
    """``df`` with a column ``name`` that names a text: the id itself, but for ids
    that stand at several texts, where only the text of least hash keeps it and the
    others get a number of their own. And whether there are such ids."""
    ident, h = F.col(f"`{doc_id}`").cast("long"), F.xxhash64(F.col(f"`{text}`").cast("string"))
    mixed = (df.where(ident.isNotNull()).select(ident.alias("of"), h.alias("h")).groupBy("of")
             .agg(F.min("h").alias("low"), F.max("h").alias("high")).where("low <> high"))
    low, of = (_free(df, n) for n in ("_low", "_of"))
    mixed = stored(mixed.select(F.col("of").alias(of), F.col("low").alias(low)), "jaccard-mixed")
    if mixed.isEmpty():
        return df.withColumn(name, ident), False
    own = F.when(F.col(low).isNull() | (h == F.col(low)), ident).otherwise(F.xxhash64(ident, F.col(f"`{text}`").cast("string"), F.lit("")))
    return df.join(mixed, ident == F.col(of), "left").withColumn(name, own).drop(low, of), True


def _free(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    held = {c.lower() for c in df.columns}
    return next(x for x in (f"{name}{'_' * k}" for k in range(99)) if x not in held)


def text_classes(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(doc_id, n, component): every row of a table (doc_id, text), whose ids name
    texts, with the size of its shingle set and the least id it reaches."""
    with Scratch() as scratch:
        sig = scratch.keep(stored(signatures(docs, k, num, den), "jaccard-signatures"))
        classes = (sig.where("n > 0").groupBy("n", "hi", "lo").agg(F.min("doc_id").alias("rep")))
        classes = scratch.keep(stored(classes, "jaccard-classes"))
        # rows that are not their class's own are few as a rule: a join that leaves them out
        # need not shuffle the key arrays
        copies = stored(sig.where("doc_id is not null").select("doc_id", "n", "hi", "lo").join(classes, ["n", "hi", "lo"])
                        .where("doc_id <> rep").select("doc_id").distinct(), "jaccard-copies")
        if copies.count() <= BROADCAST_IDS:
            copies = F.broadcast(copies)
        lead = (sig.where((F.size("keys") > 0) & F.col("doc_id").isNotNull()).select("doc_id", "n", "keys")
                .join(copies, "doc_id", "left_anti"))
        keys = lead.select(F.col("doc_id").alias("rep"), "n", F.explode("keys").alias("key"))
        # a table of its own, so that its shuffle is gone before the keys are shuffled again
        met = stored(keys.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
                     .where("low <> high").select("key"), "jaccard-met")
        shared = stored(keys.join(met, "key", "left_semi").select("key", "rep", "n"), "jaccard-shared")
        sketches = (sig.where(F.size("keys") > 0).select(F.col("doc_id").alias("rep"), "n", "sketch")
                    .join(shared.select("rep", "n").distinct(), ["rep", "n"], "left_semi"))
        sketches = stored(sketches.distinct(), "jaccard-sketches")
        edges, comps = None, None
        for every in (False, True):
            pairs = stored(candidates(shared, sketches, comps, num, den, every), "jaccard-pairs")
            if pairs.isEmpty():
                break
            links = verify(pairs, docs, k, num, den)
            edges = stored(links if edges is None else edges.unionByName(links), "jaccard-links")
            comps = scratch.keep(stored(components(edges), "jaccard-components"))
    if comps is None:
        named = classes.withColumn("component", F.col("rep"))
    else:
        named = (classes.join(comps, classes["rep"] == comps["node"], "left")
                 .select("n", "hi", "lo", F.coalesce("component", "rep").alias("component")))
    return (sig.select("doc_id", "n", "hi", "lo").join(named.select("n", "hi", "lo", "component"), ["n", "hi", "lo"], "left")
            .select("doc_id", "n", F.coalesce("component", "doc_id").alias("component")))


def near_duplicates(df: DataFrame, k: int = 5, num: int = 80, den: int = 100,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    named, mixed = named_texts(df.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text")),
                               "id", "text", "doc_id")
    found = text_classes(named.select("doc_id", "text"), k, num, den)
    if not mixed:
        return found.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
    ids = named.where("id is not null").select("doc_id", "id").distinct()
    low = found.join(ids, "doc_id").groupBy("component").agg(F.min("id").alias("component_id"))
    return (found.join(ids, "doc_id", "left").join(low, "component", "left")
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id"))


def drop_near_duplicates(df: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of each class stays: the one whose text names the class, that is the
    text of the smallest id. An id that stands at several texts is several documents,
    each in the class of its own text. Of rows that repeat id and text one stays (the
    least by a hash of all columns). Documents without words are classes of their
    own; rows without an id stay."""
    name, rank = _free(df, "_name"), _free(df, "_rank")
    named, mixed = named_texts(df, "doc_id", "text", name)
    found = text_classes(named.select(F.col(name).alias("doc_id"), F.col("text").cast("string").alias("text")), k, num, den)
    if mixed:  # a number of its own may be smaller than the smallest id
        ids = named.where("doc_id is not null").select(F.col(name).alias("text"), F.col("doc_id").alias("id")).distinct()
        least = found.join(ids, F.col("doc_id") == F.col("text")).groupBy("component").agg(F.min(F.struct("id", "text")).alias("m"))
        stay = least.select(F.col("m.text").alias(name))
    else:
        stay = found.where("doc_id = component").select(F.col("doc_id").alias(name)).distinct()
    first = Window.partitionBy(name).orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    kept = named.join(stay, name, "left_semi").withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1)
    return kept.select(df.columns).unionByName(df.where("doc_id is null"))
