"""SentencePiece encoding and decoding with byte offsets into the original.

Normalisation is done here: the model's compiled character map (a double-array
trie over UTF-8 bytes plus a table of replacement strings) is matched
longest-prefix-first, and every byte of the normalised text records the source
byte it came from. The sentencepiece library segments the text; because the
concatenated pieces are the normalised text, their lengths project each piece
to a span of original bytes. Decoding uses the library's ``decode(ids)``.

With an empty character map (identity) the same alignment is computed for the
whole text at once in NumPy.

Defined results: null text is empty; an empty text has no ids and decodes to
the empty text. Rows map one to one. A piece made of the added leading space
only has an empty span at the start; spans tile the text, so the end of one
piece is the start of the next.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import doc_slices, lean, text_buffers

SPACE = "▁".encode()  # U+2581 stands for a space in pieces


def proto_fields(buf: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the top-level fields of a protocol-buffer message."""
    i = 0

    def varint() -> int:
        nonlocal i
        out = shift = 0
        while True:
            b = buf[i]
            i += 1
            out |= (b & 127) << shift
            if b < 128:
                return out
            shift += 7

    while i < len(buf):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, buf[i:i + size]
        i += size


class CharMap:
    """The compiled character map: little-endian trie size, trie, strings."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if size else ()
        self.strings = blob[4 + size:]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest mapped prefix at ``at``."""
        units, found = self.units, None
        if not units:
            return None
        node = _child(units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            unit = units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= _child(unit)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        start = found[1]
        return found[0], self.strings[start:self.strings.index(b"\0", start)]


def _child(unit: int) -> int:
    return unit >> 10 << ((unit & 512) >> 6)


def _char_len(lead: int) -> int:
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


class Codec:
    """One loaded model; built once per Python worker."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            model = f.read()
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        spec = next((v for n, v in proto_fields(model) if n == 3), b"")
        fields = dict(proto_fields(spec))
        self.chars = CharMap(fields.get(2, b""))
        self.prefix = bool(fields.get(3, 1))
        self.squeeze = bool(fields.get(4, 1))
        self.escape = bool(fields.get(5, 1))
        trainer = dict(proto_fields(next((v for n, v in proto_fields(model) if n == 2), b"")))
        self.suffix = bool(trainer.get(24, 0))  # white space goes to the end of words
        n = self.sp.get_piece_size()
        pieces = [self.sp.id_to_piece(i) for i in range(n)]
        self.size = np.array([1 if self.sp.is_byte(i) else len(p.encode()) for i, p in enumerate(pieces)], np.int64)
        self.unknown = self.sp.unk_id()
        self.text_of = [str(i) for i in range(n)]

    # -- normalisation with alignment

    def normalize(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes and, per byte and at the end, the source offset."""
        if not text:
            return b"", np.zeros(1, np.int64)
        if not self.chars.units and not self.squeeze:
            return self._identity(text)
        return self._mapped(text)

    def _identity(self, text: bytes) -> tuple[bytes, np.ndarray]:
        src = np.frombuffer(text, np.uint8)
        gap = SPACE if self.escape else b" "
        width = np.where(src == 32, len(gap), 1)
        align = np.repeat(np.arange(len(src)), width)
        out = text.replace(b" ", gap)
        if self.prefix and self.suffix:
            out += gap
            align = np.concatenate([align, np.full(len(gap), len(src))])
        elif self.prefix:
            out = gap + out
            align = np.concatenate([np.zeros(len(gap), np.int64), align])
        return out, np.concatenate([align, [len(src)]])

    def _mapped(self, text: bytes) -> tuple[bytes, np.ndarray]:
        gap = SPACE if self.escape else b" "
        parts: list[tuple[bytes, int, int]] = []  # replacement, source start, source end
        i = 0
        while i < len(text):
            hit = self.chars.longest(text, i)
            n, new = hit if hit else (_char_len(text[i]), text[i:i + _char_len(text[i])])
            parts.append((new, i, i + n))
            i += n
        if self.squeeze:
            while parts and parts[0][0].strip(b" ") == b"" and parts[0][0]:
                parts.pop(0)
        if not any(p for p, _, _ in parts):
            return b"", np.zeros(1, np.int64)
        out, align = bytearray(), []
        if self.prefix and not self.suffix:
            out += gap
            align += [parts[0][1]] * len(gap)
        after_space = self.squeeze
        for new, a, _ in parts:
            if after_space:
                new = new.lstrip(b" ")
            if not new:
                continue
            for b in new:
                put = gap if b == 32 else bytes([b])
                out += put
                align += [a] * len(put)
            after_space = self.squeeze and new.endswith(b" ")
        end = len(text)
        if self.squeeze:
            while out.endswith(gap):
                end = align[-len(gap)]
                del out[-len(gap):], align[-len(gap):]
        if self.prefix and self.suffix:
            out += gap
            align += [end] * len(gap)
        return bytes(out), np.array([*align, end], np.int64)

    # -- encoding

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], np.ndarray]]:
        """Ids of each text and the byte spans' bounds: piece i covers
        ``bounds[i]`` to ``bounds[i + 1]`` of the original UTF-8 bytes."""
        for text, ids in zip(texts, self.sp.encode(texts, num_threads=1)):
            normal, align = self.normalize(text.encode())
            size = self.size[ids] if ids else np.zeros(0, np.int64)
            if self.unknown in ids and not self.sp.is_byte(self.unknown):
                for i, piece in enumerate(self.sp.encode(text, out_type=str)):
                    if ids[i] == self.unknown:
                        size[i] = len(piece.encode())
            at = np.concatenate([[0], np.cumsum(size)])
            if at[-1] != len(normal):
                raise ValueError("pieces do not tile the normalised text: unsupported normaliser setting")
            yield ids, align[at]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.sp.decode(ids)


_LOADED: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _LOADED:
        _LOADED[path] = Codec(path)
    return _LOADED[path]


def encode_map(df: DataFrame, model: str, finish: Callable, fields: str, text: str = "text",
               keep: list[str] | None = None) -> DataFrame:
    """Encode every text and hand ``(codec, texts, ids, bounds)`` of a slice of
    rows to ``finish``, which returns the columns ``fields`` names."""
    src = df.select(*[F.col(f"`{c}`") for c in keep or []], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    kept = [f for f in src.schema if f.name != "_text"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [fields])
    names = [f.name for f in kept] + [x.split()[0] for x in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in batches:
            at = batch.schema.get_field_index("_text")
            rest = [x for i, x in enumerate(batch.columns) if i != at]
            for lo, hi in doc_slices(text_buffers(batch.column(at))[1]):
                texts = batch.column(at).slice(lo, hi - lo).to_pylist()
                ids, bounds = [], []
                for x, b in c.encode(texts):
                    ids.append(x)
                    bounds.append(b)
                cols = finish(c, texts, ids, bounds)
                yield pa.RecordBatch.from_arrays([*[x.slice(lo, hi - lo) for x in rest], *cols], names=names)

    return src.mapInArrow(lean(run), schema)


def encode(df: DataFrame, model: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, ids, and starts / ends (byte offsets) of every piece."""
    def finish(c, texts, ids, bounds):
        return [pa.array(ids, pa.list_(pa.int32())),
                pa.array([b[:-1] for b in bounds], pa.list_(pa.int64())),
                pa.array([b[1:] for b in bounds], pa.list_(pa.int64()))]

    return encode_map(df, model, finish, "ids array<int>, starts array<bigint>, ends array<bigint>", text, keep)


def decode(df: DataFrame, model: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns and ``decoded``; null ids decode to the empty text."""
    src = df.select(*[F.col(f"`{c}`") for c in keep or []],
                    F.coalesce(F.col(f"`{ids}`").cast("array<int>"), F.array().cast("array<int>")).alias("_ids"))
    kept = [f for f in src.schema if f.name != "_ids"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["decoded string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in batches:
            at = batch.schema.get_field_index("_ids")
            rest = [x for i, x in enumerate(batch.columns) if i != at]
            out = c.decode(batch.column(at).to_pylist()) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*rest, pa.array(out, pa.string())],
                                             names=[f.name for f in kept] + ["decoded"])

    return src.mapInArrow(lean(run), schema)
