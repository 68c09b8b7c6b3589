"""Line dedup by content-defined line chunks.

A text is read as lines; a line is cut further after sentence ends (``.``, ``!``
or ``?`` before a space), and what is still longer than ``LONG_LINE`` words after
words whose hash is a multiple of ``CUT_EVERY``, so that a long paragraph has
inner lines too. Each line has a 64-bit hash of its bytes without surrounding
white space. A rolling hash over each line and the one before it is computed,
and a chunk ends where that value is a local minimum among its neighbours: the
choice depends on a few adjacent lines only, so boundaries move with inserted
text and no two of them are adjacent (a chunk has two lines or more). The end of
a text line that holds two or more lines of its own is a boundary as well.

A chunk at the end of a passage inside a line takes in its surroundings, and a
short passage may hold no full chunk. So windows of ``ANCHOR`` words are taken as
well, by winnowing (Schleimer et al. 2003): the one with the least hash of every
``WINDOW`` in a row. Any ``ANCHOR + WINDOW - 1`` = 49 equal words hold an anchor.

Chunks of two or more lines and anchors that occur more than once in all documents
are fetched and grouped by their bytes; every occurrence but the first (smallest
document id, then position) is a repeat. Each repeat is extended in both
directions by whole words as far as its document and the first occurrence's agree.
Extended repeats and runs of adjacent chunks that hold ``MIN_WORDS`` or more words
are removed; shorter ones are chance.

With ``copy_share`` a document of whose words at least that share would go to one
and the same other document keeps these words if it is a near copy of it: their
k-word shingle sets, taken as this stage leaves both texts, have a Jaccard
coefficient of ``copy_test`` or more. Whole copies are the business of a
near-duplicate stage with that test, which needs their text. Documents that share
less (excerpts, short documents around a passage, copies with a long tail) are
cut like all others, and so are rows without an id, which that stage keeps.

Defined results: null text stays null, empty text empty. A document without a
repeated passage keeps its bytes as they are; others lose exactly the bytes of
the removed chunks and the white space behind them, and of the words by which a
repeat was extended, without the white space outside. Rows that repeat a
(id, text) share one fate: each is the first occurrence if one is. Null ids sort
first. Extra columns pass through; helper names are chosen so as not to clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.llm.common import (_SPACE, U64, Scratch, _powers, as_i64, bitmap_has, bitmap_of, doc_slices, lean, shingles,
                                  splitmix, stored, text_buffers, word_hashes)

NO_ID = -(1 << 63)
WHITE = b" \t\n\v\f\r"
LONG_LINE, CUT_EVERY = 12, 6   # words
MIN_WORDS = 8                  # of a run of adjacent chunks that may be removed
ANCHOR, WINDOW = 12, 38        # words of an anchor; anchors of which the least is taken
REACH = (512, None)            # bytes compared on both sides of a repeat, in turn; None: whole texts
COPY_TEST = (5, 80, 100)       # shingle words and least Jaccard (num, den) of a copy
CUT_BYTES = 1 << 18            # of a slice of documents whose arrays are worked on at once
_RAW = splitmix(np.arange(1, 257, dtype=np.uint64) * U64(0x8CB92BA72F3D8DD7))
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?"]] = True


def cut_lines(data: np.ndarray, offs: np.ndarray):
    """Lines of the documents of one slice: hash, start, end (without white
    space), document, number of words, and whether a newline follows."""
    return cut_words(data, offs)[:6]


def cut_words(data: np.ndarray, offs: np.ndarray):
    """``cut_lines`` and the anchors: hash, start, end, document."""
    n = len(data)
    word = ~_SPACE[data]
    if not word.any():
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, z, z, np.zeros(0, bool), (np.zeros(0, np.uint64), z, z, z)
    begins = np.zeros(n + 1, bool)
    begins[offs[:-1]] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | begins[1:n]
    last = word.copy()
    last[:-1] &= ~word[1:] | begins[1:n]
    ws, we = np.flatnonzero(first), np.flatnonzero(last) + 1  # words
    doc = np.searchsorted(offs, ws, side="right") - 1
    newlines = np.concatenate([[0], np.cumsum(data == 10)])
    broken = newlines[ws[1:]] > newlines[we[:-1]]  # a newline between word i and i + 1
    stop = np.ones(len(ws), bool)  # word i ends a line
    stop[:-1] = broken | _END[data[we[:-1] - 1]] | (doc[1:] != doc[:-1])
    up, down = _powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_RAW[data] * up, out=total[1:], dtype=np.uint64)

    def span_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return splitmix((total[b] - total[a]) * down[a] + (b - a).astype(U64) * U64(0x2545F4914F6CDD1D))

    ends = np.flatnonzero(stop)
    size = np.diff(ends, prepend=-1)
    stop |= (np.repeat(size, size) > LONG_LINE) & (span_hash(ws, we) % U64(CUT_EVERY) == 0)
    ends = np.flatnonzero(stop)
    heads = np.concatenate([[0], ends[:-1] + 1])
    s, e = ws[heads], we[ends]
    h = span_hash(s, e)
    hard = np.ones(len(ends), bool)
    hard[:-1] = broken[ends[:-1]]
    at = np.arange(max(0, len(ws) - ANCHOR + 1))
    g = span_hash(ws[at], we[at + ANCHOR - 1]) ^ U64(0xD6E8FEB86659FD93)  # no chunk's hash
    pick = winnow(g, doc)
    return (h, s, e, doc[heads], ends - heads + 1, hard,
            (g[pick], ws[pick], we[pick + ANCHOR - 1], doc[pick]))


def winnow(g: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Places of the least hash of every ``WINDOW`` in a row inside one document;
    of equal hashes that follow each other, as in periodic text, every WINDOW-th."""
    n = len(g) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    low, size = np.arange(len(g)), 1

    def least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(g[a] <= g[b], a, b)

    while 2 * size <= WINDOW:
        low = least(low[:-size], low[size:])
        size *= 2
    low = least(low[:n], low[WINDOW - size:WINDOW - size + n])
    whole = doc[:n] == doc[WINDOW + ANCHOR - 2:WINDOW + ANCHOR - 2 + n]
    pick = low[whole]  # never falls
    pick = pick[np.diff(pick, prepend=-1) > 0]
    new = np.ones(len(pick), bool)
    new[1:] = (g[pick[1:]] != g[pick[:-1]]) | (doc[pick[1:]] != doc[pick[:-1]])
    heads = np.flatnonzero(new)
    rank = np.arange(len(pick)) - np.repeat(heads, np.diff(heads, append=len(pick)))
    return pick[rank % WINDOW == 0]


def cut_chunks(h: np.ndarray, doc: np.ndarray, hard: np.ndarray) -> np.ndarray:
    """Index of the last line of every chunk."""
    n = len(h)
    if not n:
        return np.zeros(0, np.int64)
    new = np.ones(n, bool)  # first line of a document
    new[1:] = doc[1:] != doc[:-1]
    final = np.ones(n, bool)
    final[:-1] = new[1:]
    before = np.where(new, U64(0), np.concatenate([h[:1], h[:-1]]))
    r = splitmix(h + before * U64(0x9FB21C651E98DF25))  # rolls over two lines
    top = np.iinfo(np.uint64).max
    left = np.where(new, U64(top), np.concatenate([r[:1], r[:-1]]))
    right = np.where(final, U64(top), np.concatenate([r[1:], r[-1:]]))
    low = (r < left) & (r < right) & ~new
    # a text line of two or more lines is closed on both sides
    ends = np.flatnonzero(hard | final)
    size = np.diff(ends, prepend=-1)
    closed = np.zeros(n, bool)
    closed[ends[size >= 2]] = True
    open_before = ends[size >= 2] - size[size >= 2]
    closed[open_before[open_before >= 0]] = True
    closed |= final
    low[1:] &= ~closed[:-1]   # no chunk of one line beside a closed end
    low[:-1] &= ~closed[1:]
    return np.flatnonzero(low | closed)


SCHEMA = "id long, row long, words long, h array<bigint>, s array<bigint>, e array<bigint>, w array<bigint>"


def chunk_table(docs: DataFrame) -> DataFrame:
    """One row per document with the hash, byte span and words of its chunks
    of two or more lines, and of its anchors (as 0 words). A chunk's span ends
    where the next line begins."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = text_buffers(batch.column("text"))
            ids, rows = batch.column("id"), batch.column("row")
            for lo, hi in doc_slices(offs, CUT_BYTES):
                piece, o = data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
                h, s, _, doc, nw, hard, (ah, as_, ae, adoc) = cut_words(piece, o)
                last = cut_chunks(h, doc, hard)
                first = np.concatenate([[0], last[:-1] + 1])[:len(last)]
                cdoc = doc[last]
                stop = np.where(np.isin(last, len(h) - 1), o[-1], 0)
                inner = last < len(h) - 1
                stop[inner] = s[np.minimum(last[inner] + 1, len(h) - 1)]
                stop = np.minimum(stop, o[cdoc + 1]) if len(last) else stop
                # order-sensitive combination of a chunk's line hashes
                pos = np.arange(len(h)) - np.repeat(first, last - first + 1)
                mixed = splitmix(h + splitmix(pos.astype(U64) + U64(77)))
                sums = np.concatenate([[U64(0)], np.cumsum(mixed, dtype=np.uint64)])
                ch = splitmix(sums[last + 1] - sums[first] + (last - first).astype(U64))
                words = np.concatenate([[0], np.cumsum(nw)])
                cw = words[last + 1] - words[first]
                begin = s[first] if len(first) else first
                use = last > first
                every = np.concatenate([cdoc[use], adoc])
                order = np.argsort(every, kind="stable")
                bounds = np.searchsorted(every[order], np.arange(hi - lo + 1))
                total = np.bincount(doc, weights=nw, minlength=hi - lo).astype(np.int64)
                base = o[every]
                cols = (as_i64(np.concatenate([ch[use], ah])), np.concatenate([begin[use], as_]) - base,
                        np.concatenate([stop[use], ae]) - base, np.concatenate([cw[use], np.zeros(len(ah), np.int64)]))
                off = pa.array(bounds.astype(np.int32), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), rows.slice(lo, hi - lo), pa.array(total, pa.int64()),
                     *[pa.ListArray.from_arrays(off, pa.array(c[order].astype(np.int64))) for c in cols]],
                    names=["id", "row", "words", "h", "s", "e", "w"])

    return docs.mapInArrow(lean(run), SCHEMA)


def removals(docs: DataFrame, copy_share: float | None, copy_test: tuple[int, int, int] = COPY_TEST) -> DataFrame:
    """(id, row, cut): sorted byte spans that go, one row per changed document."""
    table = stored(chunk_table(docs), "line-chunks")
    common = stored(table.select(F.explode("h").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
                    .where("n > 1").select("h"), "line-again")
    chunks = repeated(table, docs.sparkSession.sparkContext.broadcast(bitmap_of(common, "h")))
    first = (chunks.groupBy("h").agg(F.min(F.struct("id", "row", "s")).alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("h", "first"))
    met = (chunks.join(first, "h").where(F.struct("id", "row", "s") != F.col("first"))
           .select("id", "row", F.col("first.id").alias("owner"), F.col("first.row").alias("owner_row"),
                   (F.col("s") - F.col("first.s")).alias("shift"), F.struct("s", "e", "w").alias("mark"))
           .groupBy(*SAME).agg(F.collect_set("mark").alias("marks")))
    again = not table.groupBy("id", "row").count().where("count > 1").isEmpty()
    later = stored(compared(docs, stored(met, "line-pairs"), again), "line-repeats")
    out = cut_spans(later)
    if copy_share is None:
        return out
    out = stored(out, "line-cuts")
    other = (F.col("owner") != F.col("id")) | (F.col("owner_row") != F.col("row"))
    near = (later.where(other & ~F.col("whole") & (F.col("id") != NO_ID) & (F.col("owner") != NO_ID))
            .groupBy("id", "row", "owner", "owner_row").agg(F.sum("w").alias("w"))
            .groupBy("id", "row").agg(F.max(F.struct("w", "owner", "owner_row")).alias("most"))
            .join(table.select("id", "row", "words").distinct(), ["id", "row"])
            .where(F.col("most.w") >= F.lit(copy_share) * F.col("words"))
            .select("id", "row", "most.owner", "most.owner_row"))
    near = stored(near, "line-near")
    foreign = (later.join(near.select("id", "row"), ["id", "row"], "left_semi")
               .join(near, ["id", "row", "owner", "owner_row"], "left_anti"))
    rest = stored(cut_spans(foreign), "line-foreign")
    exempt = stored(copies(docs, near, out, rest, *copy_test), "line-copies")
    return (out.join(exempt, ["id", "row"], "left_anti")
            .unionByName(rest.join(exempt, ["id", "row"], "left_semi")))


def repeated(table: DataFrame, bitmap) -> DataFrame:
    """The chunks and anchors whose hash may be in the bitmap, one row each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(c) for c in ("h", "s", "e", "w")]
            h = lists[0].flatten()
            at = pa.array(np.flatnonzero(bitmap_has(bitmap.value, h.to_numpy())))
            parent = lists[0].value_parent_indices()
            cols = [batch.column(c).take(parent.take(at)) for c in ("id", "row")] + [x.flatten().take(at) for x in lists]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "row", "h", "s", "e", "w"])

    return table.mapInArrow(lean(run), "id long, row long, h long, s long, e long, w long")


def picked(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The documents whose ``row`` may be among ``rows``, taken where the texts
    lie, so that only they are shuffled; a join drops what the bitmap let through."""
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap_of(rows, "row"))

    @F.arrow_udf("boolean")
    def may_be(row: pa.Array) -> pa.Array:  # the texts stay in the JVM
        return pa.array(bitmap_has(wanted.value, row.to_numpy()))

    return docs.where(may_be("row"))


def agree(a: bytes, b: bytes, a_open: bool, b_open: bool) -> tuple[int, bool]:
    """Bytes of the whole words in front that ``a`` and ``b`` share, and whether
    they are known: an open end may be inside a word that goes on."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        p = n
    elif n <= 512:  # quicker than an array for few bytes
        differ = int.from_bytes(a[:n], "little") ^ int.from_bytes(b[:n], "little")
        p = ((differ & -differ).bit_length() - 1) // 8
    else:
        p = int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)))
    if p == n and ((p == len(a) and a_open) or (p == len(b) and b_open)):
        return 0, False
    ends = [p == len(x) or x[p] in WHITE for x in (a, b)]
    if not all(ends):  # back to the end of the last whole word
        while p and a[p - 1] not in WHITE:
            p -= 1
    while p and a[p - 1] in WHITE:
        p -= 1
    return p, True


SAME = ["id", "row", "owner", "owner_row", "shift"]
PAIR = "id long, row long, owner long, owner_row long, shift long"
REPEAT = "id long, row long, owner long, owner_row long, s long, e long, w long, whole boolean"
MARKS = "array<struct<s:bigint,e:bigint,w:bigint>>"


def repeats(marks: list[tuple[int, int, int]], mine: bytes, lo: int, size: int, own: bytes, own_lo: int, own_size: int,
            shift: int) -> tuple[list[tuple], list[tuple]]:
    """Marks (s, e, w) of a document against its owner, given a part of each text
    that begins at ``lo`` and ``own_lo``. Returns the repeats (s, e, w, whole): the
    chunks whose bytes agree, adjacent ones as one, and their runs, grown by whole words
    as far as both texts agree; and the runs that agree up to the end of a part, as marks."""
    found, runs, open_ = [], [], []
    for s, e, w in sorted(marks):
        body = mine[s - lo:e - lo].rstrip(WHITE)
        at = s - shift - own_lo
        if not body or not own.startswith(body, at):
            continue  # equal hashes of other bytes
        if w and found and found[-1][1] == s:
            found[-1] = (found[-1][0], e, found[-1][2] + w, False)
        elif w:
            found.append((s, e, w, False))
        if runs and s <= runs[-1][1]:
            runs[-1][1:] = max(runs[-1][1], e), max(runs[-1][2], s + len(body))
        else:
            runs.append([s, e, s + len(body)])
    for s, e, stop in runs:
        known = sure = False
        for most in (256, len(mine) + len(own)):  # seldom more than a few words
            if not known:
                i, j = s - lo, s - shift - own_lo
                a, b = mine[max(0, i - most):i], own[max(0, j - most):j]
                left, known = agree(a[::-1], b[::-1], len(a) < s, len(b) < s - shift)
            if not sure:
                i, j = stop - lo, stop - shift - own_lo
                a, b = mine[i:i + most], own[j:j + most]
                right, sure = agree(a, b, stop + len(a) < size, stop - shift + len(b) < own_size)
            if known and sure:
                a, b = s - left, max(e, stop + right)
                found.append((a, b, len(mine[a - lo:b - lo].split()), True))
                break
        else:
            open_.append((s, e, 1))  # whose chunks are counted already
    return found, open_


def compared(docs: DataFrame, pairs: DataFrame, again: bool) -> DataFrame:
    """REPEAT rows of (SAME, marks). A part of the document around its marks is taken
    once per pair and brought to the owner's text, where the same part is cut out, so
    that neither text is copied. Runs that agree over all of one ``REACH`` around
    them are compared again over the next. ``again``: whether rows repeat an (id, text)."""
    body, size = F.col("text").cast("binary"), F.octet_length(F.col("text").cast("binary"))

    def once(ids: DataFrame) -> DataFrame:
        mine = picked(docs, ids.distinct())
        return mine.dropDuplicates(["id", "row"]) if again else mine  # rows that repeat are rare, sorting texts is not free

    def sides(pairs: DataFrame, reach: int | None) -> DataFrame:
        low, high = F.array_min(F.transform("marks", lambda m: m.s)), F.array_max(F.transform("marks", lambda m: m.e))
        if reach is not None:
            low, high = low - reach, high + reach
        else:
            low, high = F.lit(0).cast("long"), F.lit(1 << 40)
        mine = once(pairs.select("row"))
        one = (pairs.withColumns({"lo": F.greatest(low, F.lit(0)), "hi": high}).join(mine, ["id", "row"])
               .select(*SAME, "marks", "lo", F.least("hi", size).alias("hi"), size.alias("size"),
                       F.substring(body, F.col("lo").cast("int") + 1, (F.least("hi", size) - F.col("lo")).cast("int")).alias("mine")))
        owner = (once(pairs.select(F.col("owner_row").alias("row")))
                 .select(F.col("id").alias("owner"), F.col("row").alias("owner_row"), "text"))
        at = F.greatest(F.col("lo") - F.col("shift") - 1, F.lit(0))  # and the byte beyond, if the document ends there
        until = F.least(F.col("hi") - F.col("shift") + 1, size)
        return (one.join(owner, ["owner", "owner_row"])
                .select(*SAME, "marks", "lo", "size", "mine", at.alias("own_lo"), size.alias("own_size"),
                        F.substring(body, at.cast("int") + 1, F.greatest(until - at, F.lit(0)).cast("int")).alias("own")))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64()), ("w", pa.int64())]))
        kinds = dict(zip(("s", "e", "w", "whole", "marks"), [pa.int64()] * 3 + [pa.bool_(), mark]))

        def told(batch: pa.RecordBatch, at: list[int], known: dict[str, list]) -> pa.RecordBatch:
            keys = [batch.column(c).take(pa.array(at, pa.int64())) for c in SAME]
            rest = [pa.array(known[c], k) if c in known else pa.nulls(len(at), k) for c, k in kinds.items()]
            return pa.RecordBatch.from_arrays([*keys, *rest], names=[*SAME, *kinds])

        for batch in batches:
            every, begin = batch.column("marks").flatten(), [0, *batch.column("marks").value_lengths().to_numpy().cumsum().tolist()]
            every = list(zip(*(every.field(c).to_numpy().tolist() for c in ("s", "e", "w"))))
            parts = [batch.column(c).to_numpy().tolist() for c in ("lo", "size", "own_lo", "own_size", "shift")]
            (mine, m), (own, o) = ((memoryview(d), x.tolist()) for d, x in (text_buffers(batch.column(c)) for c in ("mine", "own")))
            out, at, more, more_at = [], [], [], []
            for i, (lo, size_, own_lo, own_size, shift) in enumerate(zip(*parts)):
                found, left = repeats(every[begin[i]:begin[i + 1]], bytes(mine[m[i]:m[i + 1]]), lo, size_,
                                      bytes(own[o[i]:o[i + 1]]), own_lo, own_size, shift)
                out += found
                at += [i] * len(found)
                if left:
                    more.append([{"s": s, "e": e, "w": w} for s, e, w in left])
                    more_at.append(i)
            yield told(batch, at, dict(zip(("s", "e", "w", "whole"), list(zip(*out)) or [[]] * 4)))
            if more:
                yield told(batch, more_at, {"marks": more})

    done = None
    for reach in REACH:
        told = stored(sides(pairs, reach).mapInArrow(lean(check), f"{PAIR}, s long, e long, w long, whole boolean, marks {MARKS}"), "line-told")
        # the chunks of a run are reported once, in the first comparison
        sure = told.where("marks is null" if done is None else "marks is null and whole").drop("marks", "shift")
        done = sure if done is None else done.unionByName(sure)
        pairs = told.where("marks is not null").select(*SAME, "marks")
        if pairs.isEmpty():
            break
    return done


def cut_spans(later: DataFrame) -> DataFrame:
    """(id, row, cut): the extended repeats and the runs of adjacent chunks of
    ``MIN_WORDS`` words or more, as far as they meet in one span."""
    along = Window.partitionBy("id", "row").orderBy("s")
    apart = F.when(F.lag("e").over(along) == F.col("s"), 0).otherwise(1)
    runs = (later.where("not whole").withColumn("apart", apart).withColumn("run", F.sum("apart").over(along))
            .groupBy("id", "row", "run").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.sum("w").alias("w"))
            .drop("run").unionByName(later.where("whole").select("id", "row", "s", "e", "w"))
            .where(F.col("w") >= MIN_WORDS))
    before = F.max("e").over(along.rowsBetween(Window.unboundedPreceding, -1))
    spans = (runs.withColumn("apart", F.when(before >= F.col("s"), 0).otherwise(1))
             .withColumn("run", F.sum("apart").over(along.rowsBetween(Window.unboundedPreceding, 0)))
             .groupBy("id", "row", "run").agg(F.min("s").alias("s"), F.max("e").alias("e")))
    return spans.groupBy("id", "row").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("cut"))


def cut_text(text: Column, cut: Column) -> Column:
    """``text`` without the byte spans ``cut``."""
    raw = text.cast("binary")
    spans = F.arrays_zip(F.concat(F.array(F.lit(0).cast("long")), cut["e"]).alias("a"),
                         F.concat(cut["s"], F.array(F.octet_length(raw).cast("long"))).alias("b"))
    return F.array_join(F.transform(spans, lambda x: F.substring(
        raw, x.a.cast("int") + 1, (x.b - x.a).cast("int")).cast("string")), "")


def copies(docs: DataFrame, near: DataFrame, out: DataFrame, rest: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(id, row) of ``near`` whose text without the spans ``rest`` and whose
    owner's without the spans ``out`` have k-word shingle sets of Jaccard
    num / den or more. An owner that may be a copy itself vouches for nobody."""
    pairs = near.join(near.select(F.col("id").alias("owner"), F.col("row").alias("owner_row")),
                      ["owner", "owner_row"], "left_anti")

    def texts(ids: DataFrame, cuts: DataFrame) -> DataFrame:
        mine = (picked(docs, ids.select("row").distinct()).join(ids.distinct(), ["id", "row"], "left_semi")
                .dropDuplicates(["id", "row"]))
        left = F.when(F.col("cut").isNull(), F.col("text")).otherwise(cut_text(F.col("text"), F.col("cut")))
        return mine.join(cuts, ["id", "row"], "left").select("id", "row", left.alias("text"))

    owners = texts(pairs.select(F.col("owner").alias("id"), F.col("owner_row").alias("row")), out)
    owners = owners.select(F.col("id").alias("owner"), F.col("row").alias("owner_row"), F.col("text").alias("owner_text"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, np.zeros(0, np.uint64)  # an owner's copies often follow each other
        for batch in batches:
            ok = []
            for i in range(len(batch)):
                key = (batch.column("owner")[i].as_py(), batch.column("owner_row")[i].as_py())
                if key != at:
                    at, own = key, shingle_set(batch.column("owner_text").slice(i, 1), k)
                mine = shingle_set(batch.column("text").slice(i, 1), k)
                both = len(np.intersect1d(mine, own, assume_unique=True))
                ok.append(both > 0 and den * both >= num * (len(mine) + len(own) - both))
            yield batch.select(["id", "row"]).filter(pa.array(ok, pa.bool_()))

    mine = texts(pairs.select("id", "row"), rest).join(pairs, ["id", "row"])
    both = mine.join(owners, ["owner", "owner_row"]).select("id", "row", "owner", "owner_row", "text", "owner_text")
    return both.mapInArrow(lean(check), "id long, row long")


def shingle_set(text: pa.Array, k: int) -> np.ndarray:
    """The distinct k-word shingles of one text, as the near-duplicate join takes them."""
    words, _, _, _ = word_hashes(*text_buffers(text))
    return np.unique(shingles(words, k))


def dedup_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", copy_share: float | None = None,
                report: str | None = None, copy_test: tuple[int, int, int] = COPY_TEST) -> DataFrame:
    """``df`` with repeated chunks cut out of ``text``. ``report`` names a column
    to add: the byte spans that were removed (an empty array where none)."""
    columns = df.columns
    names = {c.lower() for c in columns}
    id_, row_, cut_ = (next(x for x in (f"_{n}{'_' * k}" for k in range(99)) if x not in names)
                       for n in ("id", "row", "cut"))
    t = F.col(f"`{text}`").cast("string")
    ident = F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(NO_ID))
    row = F.xxhash64(ident, t)
    docs = df.select(ident.alias("id"), row.alias("row"), t.alias("text")).where("text is not null")
    with Scratch() as scratch:
        gone = scratch.keep(stored(removals(docs, copy_share, copy_test), "line-removals"))
    gone = gone.select(F.col("id").alias(id_), F.col("row").alias(row_), F.col("cut").alias(cut_))
    left = cut_text(t, F.col(cut_))
    joined = df.withColumns({id_: ident, row_: row}).join(gone, [id_, row_], "left")
    out = [F.when(F.col(cut_).isNull(), F.col(f"`{c}`")).otherwise(left).alias(c) if c == text else F.col(f"`{c}`")
           for c in columns]
    if report:
        out.append(F.coalesce(F.col(cut_), F.array().cast("array<struct<s:bigint,e:bigint>>")).alias(report))
    return joined.select(*out)
