"""Language-model scores: a hashed maximum-entropy model with class-factored softmax.

Vocabulary. Every distinct training token is counted over all training
documents. A task packs consecutive documents into a chunk (bounded text) with a
dictionary of its distinct tokens; the dictionaries' entries, not the tokens, are
shuffled by token, summed, and sent back to their chunk. A frequent token has one
entry per chunk, so no key is hotter than the number of chunks. Tokens are
identified by a 64-bit hash.

Outcomes. Every training token has its own probability. The ``TOP`` most frequent
ones have a "slot" each; all others are grouped in tail slots by the hash of their last
two bytes. Slots form ``CLASSES`` classes of ``PER_CLASS``, and all tokens of a tail slot
form nested classes: a tree of two branches a node, by the bits of their hashes, with at
least as many leaves as the slot has tokens seen more than ``ROUNDS`` times, so the model
grows with the vocabulary. Tokens that meet in a leaf (mostly rarer ones) have their
add-0.5 share of it, which no context changes. An unseen token has the share 0.5 of its slot.
``P(token | h) = P(class | h) P(slot | class, h) P(branches | slot, h) P(token | leaf)``.

Model. All softmaxes are log-linear in the active features of the context, plus the
unigram log odds as a fixed offset. Classes and slots see the slot before (bigram), the
two before (hashed n-gram), the one two and the one three places back (skips); branches
see the token before, the two before and the one two places back, each hashed with the
node into a table with ``WEIGHTS_PER_LEAF`` weights a leaf or more.
Training is one pass over all training documents in ``ROUNDS`` disjoint batches (by a hash
of the id): every task adds up the gradient of its documents under the
broadcast weights, Spark sums the gradients by block of weights, and the driver
takes one step, scaled per weight by the curvature. The result does not
depend on how the rows are partitioned, beyond rounding. What is broadcast is the model:
``FEATURES`` x 272 floats for classes and slots, and for the branches a few floats a leaf.

Defined results: null and empty texts are the end token alone. Rows map one to
one; null ids train (their fold is 0). Without training rows every base score
is 0 and the model is uniform over slots. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.llm.common import U64, as_i64, doc_slices, drop_scratch, lean, splitmix, stored, text_buffers, tidy, word_hashes

CLASSES, PER_CLASS = 16, 16
SLOTS = CLASSES * PER_CLASS
SUFFIXES = 64                 # tail slots, the last four classes
TOP = SLOTS - SUFFIXES
PAIR_ROWS = 3328              # hashed rows of the two-word context
FEATURES = 3 * 256 + PAIR_ROWS
KINDS = ((0, 256), (256, 256), (512, 256), (768, PAIR_ROWS))  # first row and rows of each kind of feature
ACTIVE = len(KINDS)           # features of one context
WIDTH = CLASSES + SLOTS       # outputs per feature
ROUNDS = 4
BLOCK = 64                    # features per gradient block
WEIGHTS_PER_LEAF = 1          # hashed weights of the branches, rounded up to a power of two
WORD_BLOCK = 1 << 16          # of them per gradient block
WORD_ACTIVE = 3               # features of a branch
CHUNK_BYTES = 8 << 20
TOKENS = 1 << 16              # tokens per numpy batch
WORD_TOKENS = 1 << 13         # of the branches, some ten a token: arrays that stay in a core's cache
DAMP, STEP_LIMIT = 4.0, 1.5
START = 255                   # slot that stands before a text
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
END_HASH = int(as_i64(splitmix(np.array([0x5DEECE66D], np.uint64)))[0])


# ------------------------------------------------------------------ chunks

CHUNK = ("chunk bigint, ids array<bigint>, held array<boolean>, sizes array<bigint>, tokens binary, "
         "h array<bigint>, suffix binary, train array<bigint>")


def _planes(x: np.ndarray) -> bytes:
    """Byte planes of 32-bit numbers: small numbers leave planes of zeros."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplanes(b: bytes) -> np.ndarray:
    return np.frombuffer(b, np.uint8).reshape(4, -1).T.copy().view("<u4").reshape(-1).astype(np.int64)


def chunk_table(docs: DataFrame) -> DataFrame:
    """docs (doc_id, held, text) -> one row per chunk of documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            data, offs = text_buffers(batch.column("text"))
            ids = batch.column("doc_id")
            held = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
            for lo, hi in doc_slices(offs, CHUNK_BYTES):
                words, s, e, per_doc = word_hashes(data, offs[lo:hi + 1], limit=1 << 20)
                n = per_doc + 1
                at_end = np.cumsum(n) - 1
                h = np.empty(len(words) + len(n), np.int64)
                word_at = np.ones(len(h), bool)
                word_at[at_end] = False
                h[at_end] = END_HASH
                h[word_at] = as_i64(words)
                tail = np.zeros(len(h), np.uint64)
                last = LOWER[data[e - 1]].astype(U64)  # folded: one slot for all spellings of a token
                before = np.where(e - s > 1, LOWER[data[np.maximum(e - 2, 0)]], 0).astype(U64)
                tail[word_at] = splitmix(last * U64(256) + (before | U64(32))) % U64(SUFFIXES)
                kinds, first, index, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
                order = np.argsort(-count, kind="stable")
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                index = rank[index]
                learns = np.repeat(~held[lo:hi], n)
                train = np.bincount(index[learns], minlength=len(kinds))
                one = lambda v, t: pa.array([v], t)
                yield pa.RecordBatch.from_arrays([
                    one(part << 32 | seq, pa.int64()), one(ids.slice(lo, hi - lo).to_pylist(), pa.list_(pa.int64())),
                    one(held[lo:hi], pa.list_(pa.bool_())), one(n, pa.list_(pa.int64())), one(_planes(index), pa.binary()),
                    one(kinds[order], pa.list_(pa.int64())), one(tail[first][order].astype(np.uint8).tobytes(), pa.binary()),
                    one(train, pa.list_(pa.int64()))],
                    names=["chunk", "ids", "held", "sizes", "tokens", "h", "suffix", "train"])
                seq += 1

    return docs.mapInArrow(lean(run), CHUNK)


def entry_counts(chunks: DataFrame) -> DataFrame:
    """(chunk, at, c, suffix, h): global training count of each dictionary
    entry; h is null on all but one entry of a token."""
    entries = chunks.select("chunk", F.posexplode("h").alias("at", "h"), F.col("train"), F.col("suffix")).select(
        "chunk", "at", "h", F.element_at("train", F.col("at") + 1).alias("n"),
        F.conv(F.hex(F.substring("suffix", F.col("at") + 1, F.lit(1))), 16, 10).cast("int").alias("suffix"))
    same = Window.partitionBy("h")
    return (entries.withColumn("c", F.sum("n").over(same))
            .withColumn("k", F.row_number().over(same.orderBy("chunk", "at")))
            .select("chunk", "at", "c", "suffix", F.when(F.col("k") == 1, F.col("h")).alias("h")))


@dataclass(frozen=True)
class Vocabulary:
    """Totals, the frequent tokens, the slots' mass and the trees of the tail slots."""

    total: int                # N
    kinds: int                # V
    top: np.ndarray           # hashes, sorted
    top_slot: np.ndarray
    mass: np.ndarray          # per slot: training mass the slot's outcome stands for
    trees: Trees

    def slots(self, h: np.ndarray, suffix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot of every dictionary entry and whether it is a shared one."""
        if not len(self.top):
            return TOP + suffix.astype(np.int64), np.ones(len(h), bool)
        at = np.minimum(np.searchsorted(self.top, h), len(self.top) - 1)
        own = self.top[at] == h
        return np.where(own, self.top_slot[at], TOP + suffix.astype(np.int64)), ~own


@dataclass(frozen=True)
class Trees:
    """The nested classes of each tail slot. A token's code is the upper half of its hash;
    the first ``depth`` bits of it lead to its leaf. Nodes of a slot are numbered from
    ``first`` like a heap, leaves from ``first`` in order."""

    depth: np.ndarray         # per tail slot
    first: np.ndarray
    leaf: np.ndarray          # training mass (add 0.5 per token) of each leaf
    odds: np.ndarray          # per node: log of the right branch's mass over the left's; nan unless both have some

    @staticmethod
    def of(depth: np.ndarray, leaf: np.ndarray) -> Trees:
        sizes = 1 << depth
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        odds = np.full(len(leaf), np.nan, np.float32)
        for d, at in zip(depth.tolist(), first.tolist()):
            level = leaf[at:at + (1 << d)]
            for k in range(d - 1, -1, -1):
                left, right = level[0::2], level[1::2]
                both = (left > 0) & (right > 0)
                odds[at + (1 << k):at + (2 << k)][both] = np.log(right[both] / left[both])
                level = left + right
        return Trees(depth, first, leaf, odds)

    def leaves(self, tail: np.ndarray, code: np.ndarray) -> np.ndarray:
        return self.first[tail] + (code.astype(U64) >> (32 - self.depth[tail]).astype(U64)).astype(np.int64)

    def branches(self, tail: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which token, node, branch taken) of every choice on the way to the tokens' leaves."""
        who, nodes, bits = [], [], []
        order = np.argsort(-self.depth[tail].astype(np.int8), kind="stable")
        depth, first, code = self.depth[tail][order], self.first[tail][order], code[order].astype(np.int64)
        ends = np.searchsorted(-depth, -np.arange(int(depth.max(initial=0))))  # how many are deeper
        for k, n in enumerate(ends.tolist()):
            node = first[:n] + (1 << k) + (code[:n] >> (32 - k))
            open_ = np.flatnonzero(~np.isnan(self.odds[node]))
            who.append(order[open_])
            nodes.append(node[open_])
            bits.append((code[open_] >> (31 - k)) & 1)
        if not who:
            z = np.zeros(0, np.int64)
            return z, z, z
        return np.concatenate(who), np.concatenate(nodes), np.concatenate(bits)


def trees(known: DataFrame, n: np.ndarray, top: list[int]) -> Trees:
    """The trees of the tail slots, of ``n`` leaves each or more, over all tokens but ``top``."""
    depth = np.array([max(0, int(x) - 1).bit_length() for x in n], np.int64)
    bits = F.element_at(F.array(*[F.lit(int(d)) for d in depth]), F.col("suffix") + 1)
    path = F.when(bits == 0, F.lit(0)).otherwise(F.call_function("shiftrightunsigned", F.col("h"), F.lit(64) - bits))
    rows = (known.where(~F.col("h").isin(top)).select("suffix", path.alias("leaf"), (F.col("c") + 0.5).alias("m"))
            .groupBy("suffix", "leaf").agg(F.sum("m").alias("m")))
    with tidy(known.sparkSession):
        found = rows.toArrow()  # a row a leaf at most
    sizes = 1 << depth
    leaf = np.zeros(int(sizes.sum()))
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    suffix, at, m = (found.column(c).to_numpy() for c in ("suffix", "leaf", "m"))
    leaf[first[suffix] + at] = m
    return Trees.of(depth, leaf)


def vocabulary(counts: DataFrame) -> Vocabulary:
    known = counts.where("h is not null and c > 0")
    best = known.orderBy(F.desc("c"), "h").select("h", "c", "suffix").limit(TOP).collect()
    often = F.count_if(F.col("c") > ROUNDS).alias("often")
    tails = known.groupBy("suffix").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n"), often).collect()
    mass = np.zeros(SLOTS)
    n, leaves = np.zeros(SUFFIXES), np.zeros(SUFFIXES, np.int64)
    total = kinds = 0
    for r in tails:
        mass[TOP + r["suffix"]] += r["c"]
        n[r["suffix"]] += r["n"]
        leaves[r["suffix"]] += r["often"]
        total += r["c"]
        kinds += r["n"]
    for i, r in enumerate(best):
        mass[i] = r["c"]
        mass[TOP + r["suffix"]] -= r["c"]
        n[r["suffix"]] -= 1
        leaves[r["suffix"]] -= r["c"] > ROUNDS
    mass[TOP:] += 0.5 * n + 0.5  # add 0.5 per token, and once for unseen ones
    h = np.array([r["h"] for r in best], np.int64)
    order = np.argsort(h)
    return Vocabulary(total, kinds, h[order], order, mass, trees(known, leaves, h.tolist()))


ENCODED = ("doc_id long, held boolean, n_tokens long, n_known long, base double, inner double, slots binary, "
           "codes binary, part int")


def encode(chunks: DataFrame, counts: DataFrame, vocab: Vocabulary) -> DataFrame:
    """One row per document: its slots and codes (the lowest bit says that the token is
    known), base score and the shares inside slots and leaves that need no context."""
    down = math.log10(vocab.total + 0.5 * (vocab.kinds + 1))
    inner_mass = np.log10(np.maximum(vocab.mass, 0.5))
    known_share = np.log10(np.maximum(vocab.mass - 0.5, 0.5)) - inner_mass
    shared_vocab = chunks.sparkSession.sparkContext.broadcast(vocab)

    def run(entries: pa.Table, chunk: pa.Table) -> pa.Table:
        vocab = shared_vocab.value
        out: list[list] = [[] for _ in range(9)]
        for r in range(chunk.num_rows):
            row = {c: chunk.column(c)[r] for c in ("ids", "held", "sizes", "tokens", "h", "suffix")}
            h = row["h"].values.to_numpy()
            c = np.zeros(len(h))
            c[entries.column("at").to_numpy()] = entries.column("c").to_numpy()
            slot, shared = vocab.slots(h, np.frombuffer(row["suffix"].as_buffer(), np.uint8))
            log_c = np.log10(c + 0.5)
            inner = np.where(shared, log_c - inner_mass[slot], 0.0)
            code = (h.view(np.uint64) >> U64(32)) & U64(2**32 - 2) | (c > 0).astype(U64)
            own = np.flatnonzero(shared & (c > 0))
            inner[own] = log_c[own] + known_share[slot[own]] - np.log10(vocab.trees.leaf[vocab.trees.leaves(slot[own] - TOP, code[own])])
            tokens = _unplanes(row["tokens"].as_buffer())
            sizes = row["sizes"].values.to_numpy()
            starts = np.concatenate([[0], np.cumsum(sizes)])
            per = [np.add.reduceat(v[tokens], starts[:-1]) for v in (log_c, inner, (c > 0).astype(np.int64))]
            all_slots, all_codes = slot[tokens].astype(np.uint8), code[tokens].astype("<u4")
            ids, held = row["ids"].as_py(), row["held"].as_py()
            for i in range(len(ids)):
                out[0].append(ids[i])
                out[1].append(held[i])
                out[2].append(int(sizes[i]))
                out[3].append(int(per[2][i]))
                out[4].append(float(per[0][i] - sizes[i] * down))
                out[5].append(float(per[1][i]))
                out[6].append(all_slots[starts[i]:starts[i + 1]].tobytes())
                out[7].append(all_codes[starts[i]:starts[i + 1]].tobytes())
                key = -1 if ids[i] is None else ids[i]
                out[8].append(ROUNDS if held[i] else int(splitmix(np.array([key & (2**64 - 1)], np.uint64))[0] % U64(ROUNDS)))
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.int32())
        return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(out, kinds)],
                                    names=[f.split()[0] for f in ENCODED.split(", ")])

    left = counts.select("chunk", F.col("at").cast("int").alias("at"), "c")
    return left.groupBy("chunk").cogroup(chunks.drop("train").groupBy("chunk")).applyInArrow(run, ENCODED)


# ------------------------------------------------------------------ model

class Model:
    """Weights [FEATURES, WIDTH]: class outputs, then the slots of each class.

    The unigram offsets are added to the rows of the first feature, of which
    every context has exactly one. Logits stay far inside the range of a 32-bit
    exponential: each of the ROUNDS steps moves a weight by STEP_LIMIT at most."""

    def __init__(self, mass: np.ndarray, weights: np.ndarray | None = None):
        p = (mass + 0.5).reshape(CLASSES, PER_CLASS)
        self.class_share = (p.sum(axis=1) / p.sum()).astype(np.float32)
        self.slot_share = (p / p.sum(axis=1, keepdims=True)).astype(np.float32)
        self.weights = np.zeros((FEATURES, WIDTH), np.float32) if weights is None else weights
        self.of_class = self.weights[:, :CLASSES].copy()
        self.of_class[:256] += np.log(self.class_share)
        slots = self.weights[:, CLASSES:].reshape(FEATURES, CLASSES, PER_CLASS).copy()
        slots[:256] += np.log(self.slot_share)
        self.of_slot = slots.reshape(FEATURES * CLASSES, PER_CLASS)

    def forward(self, feats: np.ndarray, slot: np.ndarray):
        """Unnormalised class and slot likelihoods of a batch, their sums, and
        natural log P(slot)."""
        c, j = slot // PER_CLASS, slot % PER_CLASS
        a = self.of_class[feats[0]]
        b = self.of_slot[feats[0] * CLASSES + c]
        for f in feats[1:]:
            a += self.of_class[f]
            b += self.of_slot[f * CLASSES + c]
        rows = np.arange(len(slot))
        log_p = a[rows, c] + b[rows, j]
        np.exp(a, out=a)
        np.exp(b, out=b)
        sa, sb = a.sum(axis=1), b.sum(axis=1)
        log_p -= np.log(sa) + np.log(sb)
        return a, b, sa, sb, log_p


def _back(x: np.ndarray, starts: np.ndarray, k: int, start: int) -> np.ndarray:
    """What stands ``k`` places before; ``start`` in front of a document."""
    out = np.full(len(x), start, np.int64)
    out[k:] = x[:-k] if k <= len(x) else out[k:]
    for d in range(k):
        at = starts[:-1] + d
        out[at[at < starts[1:]]] = start
    return out


def contexts(slots: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Active features [ACTIVE, tokens] of documents laid one after the other."""
    back = [_back(slots, starts, k, START) for k in (1, 2, 3)]
    pair = splitmix((back[0] * 256 + back[1]).astype(np.uint64)) % U64(PAIR_ROWS)
    return np.stack([back[0], 256 + back[1], 512 + back[2], 768 + pair.astype(np.int64)])


def _batches(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Document range, slots and starts of numpy batches of about TOKENS tokens."""
    data, offs = text_buffers(batch.column("slots"))
    for lo, hi in doc_slices(offs, TOKENS):
        yield lo, hi, data[offs[lo]:offs[hi]].astype(np.int64), offs[lo:hi + 1] - offs[lo]


def _pieces(feats: np.ndarray, slots: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for lo in range(0, len(slots), TOKENS):  # a long document goes in pieces
        yield feats[:, lo:lo + TOKENS], slots[lo:lo + TOKENS]


def gradient(rows: DataFrame, shared) -> np.ndarray:
    """[FEATURES, WIDTH + 1 + CLASSES]: summed gradient, then how often each
    feature was active, and in which class."""
    spark = rows.sparkSession
    weights = spark.sparkContext.broadcast(shared)
    wide = WIDTH + 1 + CLASSES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*weights.value)
        total = np.zeros((FEATURES, wide))
        expected = np.zeros((FEATURES * CLASSES, PER_CLASS))
        observed = np.zeros((FEATURES, SLOTS), np.int64)
        seen = False
        for batch in batches:
            for _, _, slots, starts in _batches(batch):
                feats = contexts(slots, starts)
                for f, s in _pieces(feats, slots):
                    seen = True
                    a, b, sa, sb, _ = model.forward(f, s)
                    a /= sa[:, None]
                    b /= sb[:, None]
                    c = s // PER_CLASS
                    for (lo, rows_), k in zip(KINDS, f):
                        # expected: probabilities summed over the rows of a (feature, class);
                        # 16-bit keys are sorted by radix
                        kc = (k * CLASSES + c).astype(np.uint16)
                        order = np.argsort(kc, kind="stable")
                        kc = kc[order].astype(np.int64)
                        heads = np.flatnonzero(np.diff(kc, prepend=-1))
                        at = kc[heads]
                        expected[at] += np.add.reduceat(b[order], heads, axis=0)
                        by_pair = np.add.reduceat(a[order], heads, axis=0)
                        first = np.flatnonzero(np.diff(at // CLASSES, prepend=-1))
                        total[at[first] // CLASSES, :CLASSES] -= np.add.reduceat(by_pair, first, axis=0)
                        # observed
                        observed[lo:lo + rows_] += np.bincount((k - lo) * SLOTS + s, minlength=rows_ * SLOTS).reshape(rows_, SLOTS)
        if seen:
            by_class = observed.reshape(FEATURES, CLASSES, PER_CLASS).sum(axis=2)
            total[:, :CLASSES] += by_class
            total[:, CLASSES:WIDTH] = observed - expected.reshape(FEATURES, SLOTS)
            total[:, WIDTH] = by_class.sum(axis=1)
            total[:, WIDTH + 1:] = by_class
            blocks = range(0, FEATURES, BLOCK)
            yield pa.RecordBatch.from_arrays(
                [pa.array([b // BLOCK for b in blocks], pa.int64()),
                 pa.array([total[b:b + BLOCK].astype(np.float32).tobytes() for b in blocks], pa.binary())], names=["block", "g"])

    parts = rows.select("slots").mapInArrow(lean(run), "block long, g binary")
    out = np.zeros((FEATURES, wide))
    for block, g in _summed(parts, BLOCK * wide):  # FEATURES / BLOCK rows
        out[block * BLOCK:(block + 1) * BLOCK] = g.reshape(BLOCK, wide)
    weights.destroy()
    return out


def _summed(parts: DataFrame, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """The sum of the tasks' arrays (``g``, 32-bit floats) by block."""
    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.float64)
        for batch in batches:
            for g in batch.column("g"):
                total += np.frombuffer(g.as_buffer(), np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([total.tobytes()], pa.binary())],
                                         names=["block", "g"])

    add.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch],
                           "return": Iterator[pa.RecordBatch]}
    with tidy(parts.sparkSession):
        found = parts.groupBy("block").applyInArrow(add, "block long, g binary").toArrow()
    for block, g in zip(found.column("block"), found.column("g")):
        yield block.as_py(), np.frombuffer(g.as_buffer())


def step(model: Model, g: np.ndarray) -> np.ndarray:
    """Weights after one step along the gradient, scaled per weight by the
    curvature that the unigram shares give it."""
    curve = np.empty((FEATURES, WIDTH))
    p, q = model.class_share.astype(float), model.slot_share.astype(float)
    curve[:, :CLASSES] = g[:, WIDTH:WIDTH + 1] * (p * (1 - p))
    curve[:, CLASSES:] = (g[:, WIDTH + 1:, None] * (q * (1 - q))).reshape(FEATURES, SLOTS)
    move = np.clip(g[:, :WIDTH] / (ACTIVE * (curve + DAMP)), -STEP_LIMIT, STEP_LIMIT)
    return (model.weights + move).astype(np.float32)


# ------------------------------------------------------------------ branches

def word_contexts(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashed contexts [WORD_ACTIVE, tokens] of the branches: the token before, the two
    before, the one two places back."""
    one, two = (_back(codes >> 1, starts, k, -1).astype(np.uint64) for k in (1, 2))
    return np.stack([splitmix(one), splitmix(one * U64(0x9FB21C651E98DF25) + two + U64(1)), splitmix(two ^ U64(1 << 40))])


class Branches:
    """The log-linear model of the choices inside tail slots over a table of hashed weights."""

    def __init__(self, trees: Trees, weights: np.ndarray):
        self.trees, self.weights = trees, weights
        self.shift = U64(64 - (len(weights).bit_length() - 1))

    def forward(self, contexts: np.ndarray, slots: np.ndarray, codes: np.ndarray):
        """Per choice of the batch's known tail tokens: (which token, branch taken, log
        odds of the right branch, weights [WORD_ACTIVE] that are active)."""
        tail = np.flatnonzero((slots >= TOP) & (codes & 1 > 0))
        who, node, bit = self.trees.branches(slots[tail] - TOP, codes[tail])
        who = tail[who]
        z = self.trees.odds[node]
        node = node.astype(np.uint64) * U64(0xD1342543DE82EF95)
        active = []
        for c in contexts:
            at = (((c[who] ^ node) * U64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)
            z += self.weights[at]
            active.append(at)
        return who, bit, z, active

    def log_p(self, contexts: np.ndarray, slots: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Natural log probability of each token's leaf within its slot."""
        who, bit, z, _ = self.forward(contexts, slots, codes)
        return -np.bincount(who, np.log1p(np.exp(np.where(bit, -z, z))), len(slots))


def empty_weights(leaves: int) -> np.ndarray:
    return np.zeros(1 << max(10, (WEIGHTS_PER_LEAF * leaves - 1).bit_length()), np.float32)


def _coded(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Document range, slots, codes and starts of numpy batches."""
    data, offs = text_buffers(batch.column("codes"))
    codes = np.frombuffer(data.tobytes(), "<u4")
    for lo, hi, slots, starts in _batches(batch):
        yield lo, hi, slots, codes[offs[lo] // 4:offs[hi] // 4].astype(np.int64), starts


def word_gradient(rows: DataFrame, trees, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Summed gradient and curvature of every hashed weight; ``trees`` is a broadcast."""
    spark = rows.sparkSession
    model = spark.sparkContext.broadcast(weights)
    size = len(weights)
    block = min(WORD_BLOCK, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        branches = Branches(trees.value, model.value)
        total = np.zeros((2, size))
        seen = False
        for batch in batches:
            part = np.zeros((2, size), np.float32)
            for _, _, slots, codes, starts in _coded(batch):
                contexts = word_contexts(codes, starts)
                for lo in range(0, len(slots), WORD_TOKENS):
                    piece = slice(lo, lo + WORD_TOKENS)
                    _, bit, z, active = branches.forward(contexts[:, piece], slots[piece], codes[piece])
                    seen = seen or len(z) > 0
                    p = 1 / (1 + np.exp(-z))
                    g, curve = bit.astype(np.float32) - p, p * (1 - p)
                    for at in active:
                        np.add.at(part[0], at, g)
                        np.add.at(part[1], at, curve)
            total += part
        if seen:
            for b in range(0, size, block):
                yield pa.RecordBatch.from_arrays([pa.array([b // block], pa.int64()), pa.array([total[:, b:b + block].astype(np.float32).tobytes()], pa.binary())],
                                                 names=["block", "g"])

    tasks = 2 * spark.sparkContext.defaultParallelism  # each emits an array of the table's size
    parts = rows.select("slots", "codes").coalesce(tasks).mapInArrow(lean(run), "block long, g binary")
    out = np.zeros((2, size), np.float32)
    for b, g in _summed(parts, 2 * block):
        out[:, b * block:(b + 1) * block] = g.reshape(2, block)
    model.destroy()
    return out[0], out[1]


def word_step(weights: np.ndarray, gradient: np.ndarray, curve: np.ndarray) -> np.ndarray:
    return (weights + np.clip(gradient / (WORD_ACTIVE * (curve + DAMP)), -STEP_LIMIT, STEP_LIMIT)).astype(np.float32)


def language_scores(documents: DataFrame, held, doc_id: str = "doc_id", text: str = "text",
                    rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    ``held`` is a predicate Column over doc_id: rows that do not train."""
    docs = (documents.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                             F.col(f"`{text}`").cast("string").alias("text"))
            .select("doc_id", held.alias("held"), "text"))
    chunks = stored(chunk_table(docs), "lm-chunks", codec="zstd")
    counts = stored(entry_counts(chunks), "lm-counts", codec="zstd")
    vocab = vocabulary(counts)
    texts = stored(encode(chunks, counts, vocab), "lm-texts", partition_by=["part"], codec="zstd")
    drop_scratch(chunks, counts)
    trees = documents.sparkSession.sparkContext.broadcast(replace(vocab.trees, leaf=None))
    model, words = Model(vocab.mass), empty_weights(len(vocab.trees.odds))
    for r in range(rounds):
        batch = texts.where(F.col("part") == r)
        model = Model(vocab.mass, step(model, gradient(batch, (vocab.mass, model.weights))))
        words = word_step(words, *word_gradient(batch, trees, words))
    weights = documents.sparkSession.sparkContext.broadcast((vocab.mass, model.weights, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, branches = Model(*weights.value[:2]), Branches(trees.value, weights.value[2])
        for batch in batches:
            logs = np.zeros(batch.num_rows)
            for lo, hi, slots, codes, starts in _coded(batch):
                feats, before = contexts(slots, starts), word_contexts(codes, starts)
                log_p = np.concatenate([model.forward(f, s)[4] for f, s in _pieces(feats, slots)]).astype(np.float64)
                for at in range(0, len(slots), WORD_TOKENS):
                    piece = slice(at, at + WORD_TOKENS)
                    log_p[piece] += branches.log_p(before[:, piece], slots[piece], codes[piece])
                logs[lo:hi] = np.add.reduceat(log_p, starts[:-1])  # every text has its end token
            score = logs / math.log(10) + batch.column("inner").to_numpy()
            keep = [batch.column(c) for c in ("doc_id", "held", "n_tokens", "n_known", "base")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(score)],
                                             names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    out = texts.mapInArrow(lean(run), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(vocab.total).cast("long").alias("train_tokens"),
                      "base_score", "score")
