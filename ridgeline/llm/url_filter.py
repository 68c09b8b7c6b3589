"""URL filters: bit-parallel wildcard automaton over canonical URLs.

Rules are globs over (host, path): ``*`` any run, ``?`` one symbol. All of
them are packed into one multiword Shift-And mask (Baeza-Yates & Gonnet;
``*`` as a self-loop), and the automaton advances one symbol at a time for
all URLs of a batch at once (one NumPy row of words per URL).

The canonical form of a URL is ``. host END_OF_HOST path END_OF_URL``; the two
END symbols lie outside the byte alphabet, so no byte of a URL can imitate
them. A rule ``h/p`` becomes the glob ``*.h END_OF_HOST /p* END_OF_URL``: it
fits the host h and its subdomains, and paths that start with ``/p``.

Defined results: null url, or no ``://``: host and path are empty, no rule,
the default verdict. Host: after the first ``://`` up to ``/``, ``?``, ``#`` or
the end, A-Z lower-cased (port and user info stay). Path: from there up to
``?``, ``#`` or the end. Of several matching rules the longest wins; of equally
long ones the first given. Rows, repeated ones too, map one to one; extra
columns are left alone unless ``keep`` names them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import lean, text_buffers

END_OF_HOST, END_OF_URL, SYMBOLS = 256, 257, 258
BATCH = 4096


@dataclass(frozen=True)
class Rule:
    """``pattern`` is ``host/path``, both may hold ``*`` and ``?``."""

    verdict: str
    pattern: str

    def tokens(self) -> list[int | str]:
        host, _, path = self.pattern.partition("/")

        def part(s: str) -> list[int | str]:
            return [c if c in ("*", "?") else b for c in s for b in (c.encode() if c not in "*?" else c)]

        return ["*", ord("."), *part(host.lower()), END_OF_HOST, ord("/"), *part(path), "*", END_OF_URL]


class Automaton:
    """Shift-And masks of all rules, each rule after the other in one bit string."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        loops, finals, starts, rows = [], [], [], []
        bit = 0
        for r in rules:
            starts.append(bit)
            loop_next = False
            # bit i is set when the first i symbols of the rule have been read
            loops_r: list[int] = []
            syms: list[int | str] = []
            for t in r.tokens():
                if t == "*":
                    loop_next = True
                    continue
                if loop_next:
                    loops_r.append(bit + len(syms))
                    loop_next = False
                syms.append(t)
            if loop_next:
                loops_r.append(bit + len(syms))
            loops += loops_r
            rows += [(bit + i + 1, s) for i, s in enumerate(syms)]
            bit += len(syms) + 1
            finals.append(bit - 1)
        self.words = max(1, (bit + 63) // 64)
        self.initial = self._mask(starts)
        self.loop = self._mask(loops)
        self.start = self._mask(starts)
        self.finals = finals
        self.table = np.zeros((SYMBOLS, self.words), np.uint64)
        for i, s in rows:
            for c in (range(256) if s == "?" else (s,)):
                self.table[c, i // 64] |= np.uint64(1 << (i % 64))

    def _mask(self, bits: list[int]) -> np.ndarray:
        out = np.zeros(self.words, np.uint64)
        for b in bits:
            out[b // 64] |= np.uint64(1 << (b % 64))
        return out

    def run(self, symbols: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """symbols of all URLs one after the other -> bool[urls, rules]."""
        n = len(offs) - 1
        size = np.diff(offs)
        order = np.argsort(-size, kind="stable")
        begin, size = offs[:-1][order], size[order]
        state = np.repeat(self.initial[None, :], n, axis=0)
        final = np.zeros((n, self.words), np.uint64)
        for step in range(int(size[0]) if n else 0):
            live = int(np.searchsorted(-size, -step, side="left"))  # rows longer than step
            d = state[:live]
            moved = d << np.uint64(1)
            if self.words > 1:
                moved[:, 1:] |= d[:, :-1] >> np.uint64(63)
            moved &= ~self.start
            state[:live] = (moved & self.table[symbols[begin[:live] + step]]) | (d & self.loop)
        final[order] = state
        hit = np.zeros((n, len(self.rules)), bool)
        for k, b in enumerate(self.finals):
            hit[:, k] = (final[:, b // 64] >> np.uint64(b % 64)) & np.uint64(1) != 0
        return hit


def host_path(url):
    """SQL expressions for host and path; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    up, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, up, low), path


def _symbols(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    hd, ho = text_buffers(batch.column("host"))
    pd_, po = text_buffers(batch.column("path"))
    hl, pl = np.diff(ho), np.diff(po)
    offs = np.concatenate([[0], np.cumsum(hl + pl + 3)])
    out = np.empty(offs[-1], np.int32)
    out[offs[:-1]] = ord(".")
    n = len(hl)
    row = np.repeat(np.arange(n), hl)
    out[offs[row] + 1 + np.arange(len(hd)) - ho[row]] = hd
    out[offs[:-1] + 1 + hl] = END_OF_HOST
    row = np.repeat(np.arange(n), pl)
    out[offs[row] + 2 + hl[row] + np.arange(len(pd_)) - po[row]] = pd_
    out[offs[1:] - 1] = END_OF_URL
    return out, offs


def filter_urls(df: DataFrame, rules: list[Rule], url: str = "url", keep: list[str] | None = None,
                default: str = "allow") -> DataFrame:
    """``keep`` columns plus host, path, rule (null when none fits) and verdict."""
    keep = keep or []
    host, path = host_path(F.col(f"`{url}`"))
    src = df.select(*[F.col(f"`{c}`") for c in keep], host.alias("host"), path.alias("path"))
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in src.schema)}, rule string, verdict string"
    size = [len(r.pattern) for r in rules]
    order = sorted(range(len(rules)), key=lambda i: (-size[i], i))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Automaton(rules)
        names = np.array([r.pattern for r in rules] + [None], dtype=object)
        verdicts = np.array([r.verdict for r in rules] + [default], dtype=object)
        for whole in batches:
            for lo in range(0, whole.num_rows, BATCH):
                batch = whole.slice(lo, BATCH)
                hit = machine.run(*_symbols(batch))
                best = np.full(batch.num_rows, len(rules))
                for k in reversed(order):
                    best[hit[:, k]] = k
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(names[best], pa.string()), pa.array(verdicts[best], pa.string())],
                    names=[*batch.schema.names, "rule", "verdict"])

    return src.mapInArrow(lean(judge), schema)
