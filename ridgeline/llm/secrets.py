"""Secret scans: fixed patterns plus sliding-window Shannon entropy.

Base kinds (leftmost, non-overlapping, per kind; a match that fails its length
is dropped after it has been consumed): ``assign`` (a credential name, a
separator and a value of 12+ characters), ``access`` (access key ids of 18+
characters), ``hex`` (runs of 16+ lower-case hex digits).

The entropy method adds spans of kind ``entropy``. Candidate strings are runs
of ``MIN_RUN`` or more key characters. Each is scored by its narrowest
character class (digits, lower hex, letters and digits, base64 alphabet): the
Shannon entropy of every window of ``WINDOW`` characters, updated from one
window to the next by the counts of the one character that leaves and the one
that enters. A candidate is reported when its best window reaches the class's
threshold, unless the allow list suppresses it (dates and numbers, UUIDs,
runs with a repeated short unit, plain words joined by separators,
documentation examples). Base spans are never suppressed.

Spans are code-point offsets, end exclusive, over whole texts. Null text is
empty: no spans. Every row maps to one row; extra columns are left alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import lean

# The base patterns, case folded by hand because the regex flag
# would also fold letters outside ASCII.
_NAMES = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
                  for w in ("password", "passwd", "secret", "token"))
ASSIGN = re.compile(rf"(?:{_NAMES}|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the same spans as all maximal runs of 16 or more
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "entropy")

MIN_RUN, WINDOW = 20, 20
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
CLASSES = (
    # name, whole-run pattern, bits per character that the best window must reach
    ("digits", re.compile(r"[0-9]+"), math.inf),
    ("hex", re.compile(r"[0-9a-f]+|[0-9A-F]+"), 3.0),
    ("alnum", re.compile(r"[A-Za-z0-9]+"), 3.7),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]+"), 3.9),
)
ALLOW = (
    re.compile(r"[0-9_./=+-]+"),                                        # numbers, dates, rules
    re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),  # UUID
    re.compile(r"(.{1,6}?)\1{2,}.{0,5}"),                               # a short unit repeated
    # plain words; possessive, because runs of separators can be cut in many ways
    re.compile(r"[A-Z]?[a-z]*+(?:[_/+=-]++[A-Z]?[a-z]*+)*+|[A-Z]++(?:[_/+=-]++[A-Z]*+)*+"),
    re.compile(r".*(?:EXAMPLE|example|placeholder|changeme|xxxxxx|XXXXXX).*"),
)
_PLOGP = [0.0] + [c / WINDOW * math.log2(c / WINDOW) for c in range(1, WINDOW + 1)]


def peak_entropy(s: str, window: int = WINDOW) -> float:
    """Highest Shannon entropy (bits per character) of any window of ``s``.
    The sum of p*log2(p) moves by the terms of the two counts that change."""
    if len(s) < window:
        return 0.0
    table = _PLOGP if window == WINDOW else \
        [0.0] + [c / window * math.log2(c / window) for c in range(1, window + 1)]
    count: dict[str, int] = {}
    for c in s[:window]:
        count[c] = count.get(c, 0) + 1
    total = sum(table[n] for n in count.values())
    best = total
    for out, new in zip(s, s[window:]):
        if out != new:
            a, b = count[out], count.get(new, 0)
            total += table[a - 1] - table[a] + table[b + 1] - table[b]
            count[out], count[new] = a - 1, b + 1
            if total < best:
                best = total
    return -best


def entropy_hit(run: str) -> bool:
    for _, pattern, least in CLASSES:
        if pattern.fullmatch(run):
            return least < math.inf and not any(a.fullmatch(run) for a in ALLOW) \
                and peak_entropy(run) >= least - 1e-9
    return False


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all spans, in report order."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    out += [(m.start(), 3, m.end()) for m in RUN.finditer(text) if entropy_hit(m.group())]
    out.sort()
    return out


SPANS = "array<struct<kind:string,start:int,end:int>>"


def find_secrets(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns plus ``found``: all spans by start, then by kind as listed."""
    held = {c.lower() for c in keep or []}
    body = next(n for n in (f"_text{'_' * k}" for k in range(99)) if n not in held)
    src = df.select(*[F.col(f"`{c}`") for c in keep or []], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(body))
    fields = [f for f in src.schema if f.name != body]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"found {SPANS}"])
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(body)
            found = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scan(t.as_py())]
                     for t in batch.column(at)]
            rest = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(found, pa.list_(span))],
                                             names=[f.name for f in fields] + ["found"])

    return src.mapInArrow(lean(run), schema)
