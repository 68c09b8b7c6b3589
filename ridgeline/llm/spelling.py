"""Spelling variant grouping by permuterm rotations.

Words are taken from whole texts with their corpus counts. A word ``w`` of L
code points is marked with a terminator, and all L + 1 rotations of ``w$`` are
sorted. A rotation ends in one character of the word (or in the terminator), so
all words that differ from ``w`` in that character alone share the rotation's
prefix without it, and the word that lacks the character is that prefix itself,
as a rotation of its own. Every rotation is therefore sorted under two keys: as a
whole (no character skipped) and without its last character. Under one key stand
at most one word that lacks the character and one word per letter, so a group is
bounded by the alphabet, whatever the corpus.

The sorted table is scanned group by group. Words under a key with a skipped
character are replacements of each other; they and the word without it are
insertions. Where a letter repeats, as in ``aab``, leaving out either copy gives
the same word; only the first of a run of equal letters stands for the insertion,
so each near pair is met exactly once. The scan emits, for each member, the number
of its near words in the group and the best of them, never the pairs.

A word's form is its near word of largest count (ties: smallest in code-point
order) if that count is ``factor`` times the word's or more. Counts grow by that
factor along a chain of forms, so a chain is at most log_factor(largest count)
long, and pointer doubling finds all roots in a few joins.

Defined results: null and empty texts hold no words; a null id is the empty string
in the slip rule; repeated rows count again; an empty table gives no rows. Extra
columns are ignored. A word without near words has ``n_near`` 0, a null form and
itself as root.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import Scratch, drop_scratch, lean, stored

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MARK = "$"  # the terminator; no letter


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 6,
                least_n: int = 5, slip_every: int | None = None) -> DataFrame:
    """(word, n): words of ``least_length`` code points or more that occur
    ``least_n`` times or more. With ``slip_every`` a run loses one code point where
    that number divides the crc32 of ``<id>:<run>``, at place crc32 mod length."""
    runs = docs.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.translate(F.col(f"`{text}`").cast("string"), UPPER, LOWER),
                                       F.lit(RUN), F.lit(0))).alias("run"))
    if slip_every is None:
        words = runs.select(F.col("run").alias("word"))
    else:
        runs = (runs.where(F.char_length("run") >= least_length)  # a slip only shortens
                .withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary"))))
        at = F.pmod(F.col("h"), F.char_length("run")).cast("int")
        cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
        words = runs.select(F.when(F.pmod("h", F.lit(slip_every)) == 0, cut).otherwise(F.col("run")).alias("word"))
    return (words.where(F.char_length("word") >= least_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_n))


def rotations(words: DataFrame) -> DataFrame:
    """(key, last, first, n): every rotation of every marked word, as a whole with
    an empty ``last``, and without its last character where that is a letter.
    ``first``: the letter begins a run of equal letters (or nothing is skipped)."""
    size = F.char_length("word")
    twice = F.concat("word", F.lit(MARK), "word")
    before = F.substring(F.col("word"), F.col("at") - 1, F.lit(1))
    here = F.substring(F.col("word"), F.col("at"), F.lit(1))
    turned = words.select("word", "n", size.alias("size"), twice.alias("twice"), F.explode(F.sequence(F.lit(0), size)).alias("at"))
    whole = F.struct(F.substring(F.col("twice"), F.col("at") + 1, F.col("size") + 1).alias("key"), F.lit("").alias("last"),
                     F.lit(True).alias("first"))
    skip = F.struct(F.substring(F.col("twice"), F.col("at") + 1, F.col("size")).alias("key"), here.alias("last"),
                    ((F.col("at") == 1) | (before != here)).alias("first"))
    return (turned.select("n", F.explode(F.when(F.col("at") == 0, F.array(whole)).otherwise(F.array(whole, skip))).alias("r"))
            .select("r.key", "r.last", "r.first", "n"))


def scan_group(rows: list[tuple[str, bool, int, str]]) -> list[tuple[str, int, int, str]]:
    """(last, first, n, word) of one key -> (word, near words, best's n, best) of
    the members that have near words here."""
    letters = sorted(((-n, w, first) for last, first, n, w in rows if last))
    bare = next(((-n, w) for last, _, n, w in rows if not last), None)
    inserted = [x for x in letters if x[2]]
    out = []
    for x in letters:
        near = len(letters) - 1
        best = letters[x is letters[0]][:2] if near else None
        if bare and x[2]:
            near += 1
            best = min(best, bare) if best else bare
        if near:
            out.append((x[1], near, -best[0], best[1]))
    if bare and inserted:
        out.append((bare[1], len(inserted), -inserted[0][0], inserted[0][1]))
    return out


FOUND = "word string, n_near long, best_n long, best string"


def scan_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of a partition sorted by key; the last group of a batch waits for
    the next batch, which may go on with it."""
    def groups(t: pa.Table) -> pa.RecordBatch:
        key = t.column("key").combine_chunks()
        new = np.ones(len(t), bool)
        new[1:] = pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
        heads = np.flatnonzero(new)
        size = np.diff(heads, append=len(t))
        few = t.take(pa.array(np.flatnonzero(np.repeat(size > 1, size))))
        cols = [few.column(c).to_pylist() for c in ("key", "last", "first", "n")]
        out, lo = [], 0
        for n in size[size > 1].tolist():
            mark = cols[0][lo].index(MARK)
            rows = [(last, first, count, key[mark + 1:] + last + key[:mark])
                    for key, last, first, count in zip(*(c[lo:lo + n] for c in cols))]
            out += scan_group(rows)
            lo += n
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))],
            names=["word", "n_near", "best_n", "best"])

    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        if not len(t):
            continue
        same = pc.equal(t.column("key"), t.column("key")[-1]).to_numpy()
        head = len(t) - int(np.argmin(same[::-1])) if not same.all() else 0
        if head:
            yield groups(t.slice(0, head))
        held = t.slice(head)
    if held is not None and len(held):
        yield groups(held)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, n_near, best_n, best) for a table of distinct (word, n)."""
    ranged = rotations(words).repartitionByRange("key").sortWithinPartitions("key", "last")
    found = ranged.mapInArrow(lean(scan_sorted), FOUND)
    every = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast(
        "struct<m:bigint,best:string>").alias("best"))
    return (every.unionByName(found.select("word", F.lit(None).cast("long").alias("n"), "n_near",
                                           F.struct((-F.col("best_n")).alias("m"), "best").alias("best")))
            .groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("b"))
            .select("word", "n", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best")))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of a table (word, form): the last word that following forms
    reaches. Each round doubles the steps, so chains of n links take log2(n)."""
    at = stored(links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-chain")
    while not at.where("moved").isEmpty():
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(at.drop("moved").join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-chain")
        drop_scratch(at)
        at = step
    return at


def spelling_forms(words: DataFrame, factor: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for a table of distinct (word, n)."""
    with Scratch() as scratch:
        words = stored(words, "spelling-words")
        good = F.col("best_n") >= factor * F.col("n")
        forms = stored(near_words(words).select(
            "word", F.when(good, F.col("best")).alias("form"), "n", "n_near",
            F.when(good, F.col("best_n")).alias("form_n")), "spelling-forms")
        end = roots(forms.where("form is not null").select("word", "form"))
        scratch.keep(forms)
        scratch.keep(end)
    return (forms.join(end.drop("moved"), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
