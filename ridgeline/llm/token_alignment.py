"""Cross-tokenizer alignment by whitespace-token anchors.

A text is tokenised as a whole by two tokenizers, A (byte-level BPE, over a space
and the text) and B (sentencepiece, which adds that space itself). Where both
token sequences spell the same bytes, byte offsets at which a token of A and a
token of B end together cut them into groups, and every token of A in a group is
linked with every token of B in it.

Shared ends in front of tokens that begin with a space in both sequences are
anchors. They cut a document into windows, mostly single words, and a window's
groups follow from its two tuples of ids alone. So alignments are memoised by
these tuples: each worker aligns a window once and strings documents together
from memoised groups and links. The memo is bounded and starts anew when full.

Corpus counts (in how many documents a pair of ids is linked) are added up by
Spark from the distinct pairs of each document. To look a document's pairs up,
the ``HOT`` most frequent pairs at most travel to the tasks as sorted arrays; all
other pairs of a document are joined with the table of counts, so no vocabulary is
too large and no frequent pair becomes a hot join key.

Tokenizer A is read from its JSON file: the vocabulary's ranks drive tiktoken's
merge loop, which gives the same ids as the file's own merge list because that
list is in id order and every entry's parts are what lower ranks leave of it
(checked in the tests, as is the split pattern over all of Unicode).

Defined results: null and empty texts, and texts whose tokens do not spell the
space and the text (U+2581 in a text, which B reads as a space), have no tokens:
zeros and the empty string. Special-token strings inside texts are plain text.
Repeated rows are documents of their own. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import Scratch, doc_slices, lean, stored, text_buffers

MEMO = 1 << 18        # windows that a worker remembers
MEMO_IDS = 1 << 21    # ids of these windows
FEW = 64              # links of a group up to which they are written out
HOT = 1 << 20         # pairs whose counts travel to the tasks
ID_BITS = 20          # a token id is smaller than 2 ** 20
ONE = 1 << 2 * ID_BITS  # one link; the bits below hold the pair
LEVELS = 8            # levels of pair counts per power of two
#: Fixed value: the split pattern of the byte-level BPE vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def json_ranks(path: str) -> dict[bytes, int]:
    """Bytes -> id of a byte-level BPE file, without its special tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["id"] for t in spec.get("added_tokens", [])}
    alphabet = byte_alphabet()
    return {bytes(alphabet[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if i not in special}


class Tokens:
    """Bytes, byte length and leading space of every id."""

    def __init__(self, spelled: dict[int, bytes]):
        n = max(spelled) + 1
        self.bytes = [spelled.get(i, b"") for i in range(n)]
        self.size = np.array([len(b) for b in self.bytes], np.int64)
        self.space = np.array([b[:1] == b" " for b in self.bytes])

    def spell(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


class Aligner:
    def __init__(self, bpe: str, pieces: str):
        import sentencepiece
        import tiktoken

        ranks = json_ranks(bpe)
        self.encode_a = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.sp = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.a = Tokens({i: b for b, i in ranks.items()})
        self.b = Tokens({i: bytes([int(self.sp.id_to_piece(i)[3:5], 16)]) if self.sp.is_byte(i)
                         else self.sp.id_to_piece(i).replace("▁", " ").encode() for i in range(self.sp.get_piece_size())})
        self.name = pa.array([str(i) for i in range(max(len(self.a.bytes), len(self.b.bytes)))])
        self.forget()

    def forget(self) -> None:
        self.memo: dict[bytes, int] = {}
        self.ids = 0
        self.groups: list[str] = []    # of each window: its groups in text form
        self.links: list[bytes] = []   # its links as packed words
        self.many: list[int] = []      # and their number

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of A and B; none where the tokens do not spell the text. A's always
        do: its pattern leaves out no character and merges keep bytes."""
        return [(self.encode_a(" " + t), b) if t and self.b.spell(b) == b" " + t.encode() else ([], [])
                for t, b in zip(texts, self.sp.encode(texts, num_threads=1))]

    def remember(self, keys: list[bytes], names: list[str], links: list[bytes]) -> None:
        for key, name, link in zip(keys, names, links):
            self.memo[key] = len(self.many)
            self.groups.append(name)
            self.links.append(link)
            self.many.append(len(link) // 8)
            self.ids += len(key) // 4

    def align_windows(self, a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        """Groups in text form and packed links of windows, each the groups ``lo``
        to ``hi``; ``ga`` and ``gb`` are the first tokens of the groups."""
        g = spread(lo, hi - lo)
        na, nb = ga[g + 1] - ga[g], gb[g + 1] - gb[g]
        ta, tb = a[spread(ga[g], na)], b[spread(gb[g], nb)]
        oa, ob = offsets(na), offsets(nb)
        sides = [pc.binary_join(pa.ListArray.from_arrays(pa.array(o, pa.int32()), self.name.take(pa.array(t))), ",")
                 for o, t in ((oa, ta), (ob, tb))]
        per = offsets(hi - lo)
        names = pc.binary_join(pa.ListArray.from_arrays(pa.array(per, pa.int32()), pc.binary_join_element_wise(*sides, "|")), ";")
        small = na * nb <= FEW
        n = np.where(small, na * nb, 0)
        of = np.repeat(np.arange(len(g)), n)
        at = np.arange(len(of)) - np.repeat(offsets(n)[:-1], n)
        words = ONE | ta[oa[of] + at // nb[of]] << ID_BITS | tb[ob[of] + at % nb[of]]
        raw, cut = words.tobytes(), (8 * offsets(n)[per]).tolist()
        links = [raw[i:j] for i, j in zip(cut, cut[1:])]
        for k in np.flatnonzero(~small).tolist():  # groups of many links: once per pair
            x, y = (Counter(t[o[k]:o[k + 1]].tolist()) for t, o in ((ta, oa), (tb, ob)))
            more = [w for (p, n), (q, m) in product(x.items(), y.items()) for w in packed(p << ID_BITS | q, n * m)]
            links[int(np.searchsorted(per, k, side="right")) - 1] += array("q", more).tobytes()
        return names.to_pylist(), links

    def align(self, docs: list[tuple[list[int], list[int]]]):
        """Per document: number of groups, digest of the groups; and of all
        documents together: document, pair and links of each distinct pair."""
        if len(self.memo) > MEMO or self.ids > MEMO_IDS:
            self.forget()
        a, b = (list(chain.from_iterable(d[k] for d in docs)) for k in (0, 1))
        xa, xb = np.array(a, np.int64), np.array(b, np.int64)
        end_a, end_b = np.cumsum(self.a.size[xa]), np.cumsum(self.b.size[xb])
        begin_a, begin_b = end_a - self.a.size[xa], end_b - self.b.size[xb]
        total = int(end_a[-1]) if len(a) else 0
        cuts = []
        for begin, space in ((begin_a, self.a.space[xa]), (begin_b, self.b.space[xb])):
            starts, words = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
            starts[begin] = True
            words[begin[space]] = True
            cuts.append((starts, words))
        (starts_a, words_a), (starts_b, words_b) = cuts
        shared, anchor = starts_a & starts_b, words_a & words_b
        many = np.array([len(d[0]) for d in docs], np.int64)
        first = offsets(many)  # tokens of A before each document
        anchor[begin_a[first[:-1][many > 0]]] = True
        group_a, group_b = np.flatnonzero(shared[begin_a]), np.flatnonzero(shared[begin_b])
        window_a, window_b = np.flatnonzero(anchor[begin_a]), np.flatnonzero(anchor[begin_b])
        raw_a, raw_b = xa.astype("<u4").tobytes(), (xb | 1 << 31).astype("<u4").tobytes()
        wa, wb = (4 * window_a).tolist() + [4 * len(a)], (4 * window_b).tolist() + [4 * len(b)]
        keys = [raw_a[i:j] + raw_b[k:m] for i, j, k, m in zip(wa, wa[1:], wb, wb[1:])]
        known = list(map(self.memo.get, keys))
        fresh = {k: p for p, (k, n) in enumerate(zip(keys, known)) if n is None}
        if fresh:
            at = np.fromiter(fresh.values(), np.int64)
            wg = np.append(np.searchsorted(group_a, window_a), len(group_a))
            self.remember(list(fresh), *self.align_windows(xa, xb, np.append(group_a, len(a)), np.append(group_b, len(b)),
                                                           wg[at], wg[at + 1]))
            known = list(map(self.memo.get, keys))
        of_doc = np.searchsorted(window_a, first)
        cut = of_doc.tolist()
        digests = [hashlib.sha256(";".join(map(self.groups.__getitem__, known[i:j])).encode()).hexdigest() if j > i else ""
                   for i, j in zip(cut, cut[1:])]
        raw = np.frombuffer(b"".join(map(self.links.__getitem__, known)), np.int64)
        each = np.array(self.many, np.int64)[known] if known else np.zeros(0, np.int64)
        doc = np.repeat(np.arange(len(docs)), np.diff(offsets(each)[of_doc]))
        mixed = doc << 2 * ID_BITS | raw & ONE - 1
        order = np.argsort(mixed)
        mixed = mixed[order]
        new = np.ones(len(mixed), bool)
        new[1:] = mixed[1:] != mixed[:-1]
        at = np.flatnonzero(new)
        links = np.add.reduceat(raw[order] >> 2 * ID_BITS, at) if len(at) else at
        mixed = mixed[at]
        return np.diff(np.searchsorted(group_a, first)), digests, mixed >> 2 * ID_BITS, mixed & ONE - 1, links


def offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges (start, size), one after the other."""
    return np.arange(sizes.sum()) + np.repeat(starts - offsets(sizes)[:-1], sizes)


def packed(code: int, links: int) -> Iterator[int]:
    """A pair and its number of links, as much of it as fits, in one word each."""
    most = (1 << 62 - 2 * ID_BITS) - 1
    while links:
        n = min(links, most)
        yield n << 2 * ID_BITS | code
        links -= n


@lru_cache(maxsize=2)
def aligner(bpe: str, pieces: str) -> Aligner:
    return Aligner(bpe, pieces)


DIGEST = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
LOW = (1 << ID_BITS) - 1


def alignments(df: DataFrame, bpe: str, pieces: str, keep: list[str], text: str = "text") -> DataFrame:
    """One row per row of ``df``: ``row`` (a number of its own), ``keep``, the
    digest columns, and its distinct linked pairs ``a``, ``b`` with their links ``m``."""
    src = df.select(F.col(f"`{text}`").cast("string").alias("text"), F.monotonically_increasing_id().alias("row"),
                    F.struct(*[F.col(f"`{c}`") for c in keep]).alias("keep"))
    schema = f"row long, keep {src.schema['keep'].dataType.simpleString()}, {DIGEST}, a array<int>, b array<int>, m array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(bpe, pieces)
        for batch in batches:
            column = batch.column("text").fill_null("")
            _, offs = text_buffers(column)
            for lo, hi in doc_slices(offs):
                docs = tool.encode(column.slice(lo, hi - lo).to_pylist())
                n_groups, digests, doc, code, links = tool.align(docs)
                n_links = np.zeros(hi - lo, np.int64)
                np.add.at(n_links, doc, links)
                off = pa.array(np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(off, pa.array(x.astype(np.int32)))
                         for x in (code >> ID_BITS, code & LOW, links)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(lo, hi - lo), batch.column("keep").slice(lo, hi - lo),
                     *[pa.array([len(d[k]) for d in docs], pa.int64()) for k in (0, 1)],
                     pa.array(n_groups, pa.int64()), pa.array(n_links), pa.array(digests, pa.string()), *lists],
                    names=["row", "keep", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "m"])

    return src.mapInArrow(lean(run), schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, n, best): in how many rows a pair is linked, and whether that is the
    highest count of its ``a``. Batches are added up before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = _codes(batch, "a", "b")
            code, n = np.unique(code, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array((code >> ID_BITS).astype(np.int32)), pa.array((code & LOW).astype(np.int32)),
                                              pa.array(n.astype(np.int64))], names=["a", "b", "n"])

    counts = (aligned.select("a", "b").mapInArrow(lean(run), "a int, b int, n long")
              .groupBy("a", "b").agg(F.sum("n").alias("n")))
    counts = stored(counts, "pair-counts")
    top = counts.groupBy("a").agg(F.max("n").alias("top"))
    return counts.join(top, "a").select("a", "b", "n", (F.col("n") == F.col("top")).alias("best"))


def _codes(batch: pa.RecordBatch, a: str, b: str) -> np.ndarray:
    x, y = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in (a, b))
    return x << ID_BITS | y


def with_counts(aligned: DataFrame, counts: DataFrame, hot: int = HOT) -> DataFrame:
    """``aligned`` without its pairs, plus ``n_best`` and ``count_sum``."""
    counts = counts.withColumn("level", F.floor(LEVELS * F.log2("n")).cast("int"))
    least, room = 1 << 30, hot
    for level, n in sorted(counts.groupBy("level").count().collect(), reverse=True):  # 64 * LEVELS rows at most
        if n > room:
            break
        least, room = level, room - n
    table = counts.where(F.col("level") >= least).select("a", "b", "n", "best").toArrow()
    code = (table.column("a").to_numpy().astype(np.int64) << ID_BITS) | table.column("b").to_numpy()
    order = np.argsort(code)
    known = aligned.sparkSession.sparkContext.broadcast(
        (code[order], table.column("n").to_numpy()[order], table.column("best").to_numpy()[order].astype(np.int64)))
    rest = [f for f in aligned.schema if f.name not in ("a", "b", "m")]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in rest]
                       + ["n_best long", "count_sum long", "a array<int>", "b array<int>", "m array<int>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, best = known.value
        for batch in batches:
            mine, times = _codes(batch, "a", "b"), batch.column("m").flatten().to_numpy().astype(np.int64)
            of = batch.column("a").value_parent_indices().to_numpy()
            at = np.minimum(np.searchsorted(codes, mine), max(0, len(codes) - 1))
            hit = codes[at] == mine if len(codes) else np.zeros(len(mine), bool)
            sums = []
            for value in (best, counts):
                out = np.zeros(len(batch), np.int64)
                np.add.at(out, of[hit], times[hit] * value[at[hit]])
                sums.append(pa.array(out))
            left = ~hit
            off = pa.array(np.searchsorted(of[left], np.arange(len(batch) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(off, pa.array(x[left].astype(np.int32)))
                     for x in (mine >> ID_BITS, mine & LOW, times)]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in rest], *sums, *lists],
                                             names=[f.name for f in rest] + ["n_best", "count_sum", "a", "b", "m"])

    some = stored(aligned.mapInArrow(lean(run), schema), "pair-sums")
    pairs = some.select("row", F.explode(F.arrays_zip("a", "b", "m")).alias("p")).select("row", "p.a", "p.b", "p.m")
    others = (pairs.join(counts.where(F.col("level") < least), ["a", "b"]).groupBy("row")
              .agg(F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("more_best"),
                   F.sum(F.col("m") * F.col("n")).alias("more_sum")))
    return (some.join(others, "row", "left")
            .select(*[f.name for f in rest], (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
                    (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum")))


def align_tokenizers(df: DataFrame, bpe: str, pieces: str, keep: list[str], text: str = "text", hot: int = HOT) -> DataFrame:
    """``keep`` columns and n_a, n_b, n_groups, n_links, groups_sha256, n_best,
    count_sum of every row."""
    with Scratch() as scratch:
        aligned = stored(alignments(df, bpe, pieces, keep, text), "alignments")
        counts = stored(pair_counts(aligned), "pair-table")
        out = stored(with_counts(aligned, counts, hot), "alignment-digests")
        scratch.keep(out)
    digest = [f.split()[0] for f in DIGEST.split(", ")]
    return out.select(*[F.col(f"keep.`{c}`").alias(c) for c in keep], *digest, "n_best", "count_sum")
