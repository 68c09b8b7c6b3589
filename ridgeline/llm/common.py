"""Helpers that several operators of this folder share.

Tables between jobs are written as Parquet under the folder that the cluster
names in ``spark.checkpoint.dir``: a lost executor costs a re-read, never a
recomputation of the whole lineage, and all executors see the files.

Words are maximal runs of bytes outside ``20 09-0D`` (hex) with A-Z folded to
a-z. Because every other byte stays as it is, splitting the UTF-8 bytes and
splitting the code points give the same words.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.session import scratch_path

SLICE_BYTES = 1 << 19
U64 = np.uint64


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Else shuffle files stay until the driver collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Arrow batches are bounded by rows only, nearly so: a batch of long texts is held by
#: the JVM beside its heap and by each Python worker beside what is made of it.
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


@contextmanager
def tidy(spark: SparkSession):
    """Jobs run in the block leave no shuffle files, and their Arrow batches are bounded."""
    held = {SHUFFLE_CLEANUP: "true", ARROW_BYTES: str(BATCH_BYTES)}
    before = {k: spark.conf.get(k, None) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back. Inside a ``Scratch``
    block the table is deleted at the block's end unless it is kept. The shuffle
    files of the write go when it ends, and its Arrow batches hold ``BATCH_BYTES`` or
    a row more at most."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with tidy(spark):
        writer.parquet(path, compression=codec)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    scope = _SCOPE.get()
    if scope is not None:
        scope.paths.append((spark, path))
    return out


class Scratch:
    """A ``with`` block that owns the tables ``stored`` writes in it. At its end
    they are deleted from the shared folder, but for those passed to ``keep``: a
    lazy result still reads them, so they go to the enclosing block, if any."""

    def __enter__(self) -> Scratch:
        self.paths: list[tuple[SparkSession, str]] = []
        self.kept: set[str] = set()
        self.outer = _SCOPE.set(self)
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        self.kept.add(df._scratch)
        return df

    def __exit__(self, *error) -> None:
        _SCOPE.reset(self.outer)
        outer = _SCOPE.get()
        for spark, path in self.paths:
            if path not in self.kept:
                delete(spark, path)
            elif outer is not None:
                outer.paths.append((spark, path))


_SCOPE: ContextVar[Scratch | None] = ContextVar("scratch", default=None)


def drop_scratch(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` wrote and nothing reads any more."""
    for df in tables:
        delete(df.sparkSession, df._scratch)


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def crc_mod(col, m: int):
    """``crc32(id as text) mod m``: the fold of a row; null ids fall in fold 0."""
    return F.coalesce(F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(m)), F.lit(0))


# ---------------------------------------------------------------- Arrow text

def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (int64) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    o = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)
    o = o[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[o[0]:o[-1]], o - o[0]


def doc_slices(offs: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive document ranges of at most ``limit`` bytes (one longer
    document stands alone), so the working arrays stay small."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def lean(run):
    """``run`` for mapInArrow, giving memory back to the system after every input
    batch: Python workers outlive their tasks, and what allocators keep adds to
    the executor beside the JVM's heap."""
    def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def feed():
            for batch in batches:
                yield batch
                del batch
                _trim()

        yield from run(feed())
        _trim()

    return trimmed


def _trim() -> None:
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only


# ---------------------------------------------------------------- word hashes

def splitmix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (Steele et al., SplitMix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_CODE = splitmix(np.arange(1, 257, dtype=np.uint64) * U64(0xD1342543DE82EF95))
_CODE[65:91] = _CODE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse mod 2**64, at least n of each."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for key, b in (("up", _BASE), ("down", _INV)):
            steps = np.full(size, U64(b))
            steps[0] = 1
            _POWERS[key] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _hash_piece(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of the words of one piece; ``breaks`` are offsets
    where a document begins (a word never spans one)."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z
    word = ~_SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[breaks[(breaks >= 0) & (breaks <= n)]] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | cut[1:n]
    last = word.copy()
    last[:-1] &= ~word[1:] | cut[1:n]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODE[data] * up, out=total[1:], dtype=np.uint64)
    h = (total[e] - total[s]) * down[s] + (e - s).astype(U64) * U64(0x2545F4914F6CDD1D)
    return splitmix(h), s, e


def word_hashes(data: np.ndarray, offs: np.ndarray, limit: int = 2 * SLICE_BYTES):
    """64-bit hash, start, end (offsets in ``data``) of every word, and the
    number of words per document. The hash is a polynomial over random byte
    codes, taken from prefix sums, so no Python runs per word. Longer inputs
    go in pieces that are cut between words."""
    data = data[offs[0]:offs[-1]]
    starts = offs - offs[0]
    hs, ss, es = [], [], []
    lo, n = 0, len(data)
    while lo < n:
        hi = min(n, lo + limit)
        if hi < n:
            gap = np.flatnonzero(_SPACE[data[lo:hi]])
            while not len(gap) and hi < n:  # one word longer than a piece
                hi = min(n, hi + limit)
                gap = np.flatnonzero(_SPACE[data[lo:hi]])
            if hi < n:
                hi = lo + int(gap[-1]) + 1
        h, s, e = _hash_piece(data[lo:hi], starts - lo)
        hs.append(h)
        ss.append(s + lo)
        es.append(e + lo)
        lo = hi
    if not hs:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, np.zeros(len(offs) - 1, np.int64)
    h, s, e = (np.concatenate(x) for x in (hs, ss, es))
    per_doc = np.diff(np.searchsorted(s, starts))
    return h, s + offs[0], e + offs[0], per_doc


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-word windows; a shorter sequence counts as one."""
    n = len(words)
    if n == 0:
        return words
    k = min(k, n)
    out = np.full(n - k + 1, U64(k))
    for i in range(k):
        out = splitmix(out * U64(0x9FB21C651E98DF25) + words[i:n - k + 1 + i])
    return out


def as_i64(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


# ---------------------------------------------------------------- bounded filters

MAX_BITS = 1 << 27  # 16 MB
SHIFTS = (0, 16, 32)


def bitmap_of(df: DataFrame, column: str) -> np.ndarray:
    """Bloom filter of a long column: three bits per value, taken from the value
    and its right shifts modulo the size. The size is 128 bits per value up to
    MAX_BITS; a fuller bitmap lets more foreign values through, never fewer own
    ones, so it may only stand before an exact join. At most MAX_BITS / 64 words
    reach the driver."""
    bits = min(MAX_BITS, 1 << max(16, (128 * df.count()).bit_length()))
    slots = F.array(*[F.pmod(F.shiftrightunsigned(column, k), F.lit(bits)) for k in SHIFTS])
    words = (df.select(F.explode(slots).alias("slot"))
             .select(F.shiftright("slot", 6).alias("at"), F.pmod(F.col("slot"), F.lit(64)).cast("int").alias("bit"))
             .groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("w")).toArrow())
    out = np.zeros(bits // 64, np.uint64)
    out[words.column("at").to_numpy()] = words.column("w").to_numpy().view(np.uint64)
    return out


def bitmap_has(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values (64-bit) may be in the bitmap."""
    low = U64(len(bits) * 64 - 1)

    def test(v: np.ndarray, k: int) -> np.ndarray:
        slot = (v >> U64(k)) & low
        return (bits[(slot >> U64(6)).astype(np.int64)] >> (slot & U64(63)) & U64(1)).astype(bool)

    v = values.view(np.uint64)
    ok = test(v, SHIFTS[0])
    at = np.flatnonzero(ok)
    for k in SHIFTS[1:]:
        at = at[test(v[at], k)]
    ok[:] = False
    ok[at] = True
    return ok
