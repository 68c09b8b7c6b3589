"""Quality classifier: regularised quadratic discriminant analysis.

Every whole text becomes a vector of document statistics (byte classes, word and
line shapes, repetition), transformed to be roughly normal (log, logit) and
clipped. The vectors of all documents are written once; the fit and the scores
read them, not the texts again.

Fit: per class, count, sum and matrix of second moments over all labelled
training rows, added up by Spark from one partial per task. A class covariance
is shrunk towards the pooled one and towards the diagonal,
``(1 - a - b) S_k + a S + b diag(S)``. Its Cholesky factor is computed once and
shipped with the model; a score is the logistic function of the difference of
the two classes' log densities plus the log prior odds.

Defined results: null and empty texts get the statistics of an empty document
and are scored. A document without a label, or with a label that is neither 0 nor
1, does not train; repeated labels count each. With rows of one class only every
score is the smoothed share of label 1; without any, 0.5. Extra columns are
ignored; every input row gives one row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import doc_slices, lean, splitmix, stored, text_buffers, word_hashes

THRESHOLD = 0.3
SHRINK_POOLED, SHRINK_DIAGONAL = 0.10, 0.05

FEATURES = (
    "log_words", "word_length", "word_length_spread", "upper", "digits", "punctuation", "symbols", "bars",
    "non_ascii", "distinct_words", "distinct_pairs", "top_word", "distinct_lines", "words_per_line",
    "marked_words", "byte_entropy", "short_words", "long_words", "sentence_ends", "upper_words",
)
D = len(FEATURES)


def _bytes(chars: str) -> np.ndarray:
    out = np.zeros(256)
    out[[ord(c) for c in chars]] = 1
    return out


_UPPER, _LOWER = _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _bytes("abcdefghijklmnopqrstuvwxyz")
_DIGIT, _POINT = _bytes("0123456789"), _bytes(".,;:!?'\"()-")
_SYMBOL, _BAR, _STOP = _bytes("#$%&*+/<=>@[\\]^_`{}~"), _bytes("|"), _bytes(".!?")
_SPACES = _bytes(" \t\n\r\v\f")
_LEAD = np.zeros(256)
_LEAD[0xC0:] = 1
_CLASSES = np.stack([_UPPER, _LOWER, _DIGIT, _POINT, _SYMBOL, _BAR, _STOP, _SPACES, _LEAD], axis=1)


def _logit(part, whole):
    p = (part + 0.5) / (whole + 1.0)
    return np.log(p / np.maximum(1 - p, 1e-9))


def _distinct(values: np.ndarray, owner: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of distinct values and the count of the commonest, per document."""
    if not len(values):
        return np.zeros(docs), np.zeros(docs)
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    first = np.flatnonzero(new)
    run = np.diff(np.append(first, len(v)))
    most = np.zeros(docs)
    np.maximum.at(most, o[first], run)
    return np.bincount(o[first], minlength=docs).astype(float), most


def statistics(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """[documents, D] transformed statistics of the texts of one slice."""
    docs = len(offs) - 1
    base = offs[0]
    data, offs = data[offs[0]:offs[-1]], offs - base
    size = np.diff(offs)
    owner = np.repeat(np.arange(docs), size)
    hist = np.bincount(owner * 256 + data, minlength=docs * 256).reshape(docs, 256).astype(float)
    upper, lower, digit, point, symbol, bar, stop, space, lead = (hist @ _CLASSES).T
    chars = np.maximum(size - space, 0)
    words, s, e, per_doc = word_hashes(data, offs)
    n = per_doc.astype(float)
    wo = np.repeat(np.arange(docs), per_doc)
    length = (e - s).astype(float)
    total = np.bincount(wo, weights=length, minlength=docs)
    square = np.bincount(wo, weights=np.minimum(length, 200.0) ** 2, minlength=docs)
    mean = total / np.maximum(n, 1)
    spread = np.sqrt(np.maximum(square / np.maximum(n, 1) - np.minimum(mean, 200.0) ** 2, 0))
    kinds, top = _distinct(words, wo, docs)
    if len(words) > 1:
        inside = wo[1:] == wo[:-1]
        pair_kinds, _ = _distinct(splitmix(words[:-1] * np.uint64(3) + words[1:])[inside], wo[1:][inside], docs)
    else:
        pair_kinds = np.zeros(docs)
    # lines: order-free sums of word hashes, split where a newline lies between words
    if len(words):
        newline = np.concatenate([[0], np.cumsum(data == 10)])
        head = np.ones(len(words), bool)
        head[1:] = (newline[s[1:]] > newline[e[:-1]]) | (wo[1:] != wo[:-1])
        first = np.flatnonzero(head)
        line = np.add.reduceat(splitmix(words), first)
        lines = np.bincount(wo[first], minlength=docs).astype(float)
        line_kinds, _ = _distinct(line, wo[first], docs)
        ends = data[e - 1]
        letters = ((data[s] | 32) >= 97) & ((data[s] | 32) <= 122) | (data[s] >= 0xC0)
        marked = np.bincount(wo, weights=~letters | (_SYMBOL[ends] > 0), minlength=docs)
        cap = (_UPPER[data[s]] > 0) & (_UPPER[data[np.minimum(s + 1, e - 1)]] > 0)
        caps = np.bincount(wo, weights=cap, minlength=docs)
        short = np.bincount(wo, weights=length <= 3, minlength=docs)
        long_ = np.bincount(wo, weights=length >= 12, minlength=docs)
    else:
        lines = line_kinds = marked = caps = short = long_ = np.zeros(docs)
    p = hist / np.maximum(size, 1)[:, None]
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1)
    out = np.stack([
        np.log1p(n), np.log1p(mean), np.log1p(spread), _logit(upper, upper + lower), _logit(digit, chars),
        _logit(point, chars), _logit(symbol, chars), _logit(bar, chars), _logit(lead, chars), _logit(kinds, n),
        _logit(pair_kinds, np.maximum(n - 1, 0)), _logit(top, n), _logit(line_kinds, lines),
        np.log1p(n / np.maximum(lines, 1)), _logit(marked, n), entropy, _logit(short, n), _logit(long_, n),
        _logit(stop, n), _logit(caps, n)], axis=1)
    return np.clip(out, -12.0, 12.0)


def feature_table(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and ``x``, the statistics of the text."""
    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("_text"))
    kept = [f for f in src.schema if f.name != "_text"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["x array<double>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("_text")
            data, offs = text_buffers(batch.column(at))
            rest = [c for i, c in enumerate(batch.columns) if i != at]
            for lo, hi in doc_slices(offs):
                x = statistics(data, offs[lo:hi + 1])
                flat = pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1, dtype=np.int32) * D, pa.int32()),
                                                pa.array(x.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*[c.slice(lo, hi - lo) for c in rest], flat],
                                                 names=[f.name for f in kept] + ["x"])

    return src.mapInArrow(lean(run), schema)


@dataclass(frozen=True)
class Discriminant:
    """Fitted model; ``factor`` holds each class's Cholesky factor."""

    prior: float                      # smoothed share of label 1
    mean: tuple[np.ndarray, ...] = ()
    factor: tuple[np.ndarray, ...] = ()

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.mean:
            return np.full(len(x), self.prior)
        log = []
        for mu, factor in zip(self.mean, self.factor):
            z = np.linalg.solve(factor, (x - mu).T)
            log.append(-0.5 * (z * z).sum(axis=0) - np.log(np.diag(factor)).sum())
        odds = log[1] - log[0] + math.log(self.prior / (1 - self.prior))
        return 1.0 / (1.0 + np.exp(-np.clip(odds, -700, 700)))


def moments(rows: DataFrame) -> dict[int, np.ndarray]:
    """Per label: count, sums and second moments of (label, x), added up by Spark."""
    width = 1 + D + D * D

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, width))
        for batch in batches:
            y = batch.column("label").to_numpy(zero_copy_only=False)
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, D)
            for k in (0, 1):
                v = x[y == k]
                total[k] += np.concatenate([[len(v)], v.sum(axis=0), (v.T @ v).reshape(-1)])
        at = np.arange(2 * width)
        yield pa.RecordBatch.from_arrays([pa.array(at // width), pa.array(at % width), pa.array(total.reshape(-1))],
                                         names=["label", "i", "v"])

    parts = rows.mapInArrow(lean(run), "label long, i long, v double")
    out = {0: np.zeros(width), 1: np.zeros(width)}
    for r in parts.groupBy("label", "i").agg(F.sum("v").alias("v")).collect():  # 2 * (1 + D + D * D) rows
        out[r["label"]][r["i"]] = r["v"]
    return out


def fit(rows: DataFrame, pooled: float = SHRINK_POOLED, diagonal: float = SHRINK_DIAGONAL) -> Discriminant:
    """rows: (label 0 or 1, x)."""
    got = moments(rows)
    n = [got[k][0] for k in (0, 1)]
    prior = (n[1] + 1.0) / (sum(n) + 2.0)
    if min(n) < 1:
        return Discriminant(prior)
    mean = [got[k][1:1 + D] / n[k] for k in (0, 1)]
    cov = [got[k][1 + D:].reshape(D, D) / n[k] - np.outer(mean[k], mean[k]) for k in (0, 1)]
    both = (n[0] * cov[0] + n[1] * cov[1]) / sum(n)
    factor = []
    for c in cov:
        shrunk = (1 - pooled - diagonal) * c + pooled * both + diagonal * np.diag(np.diag(both)) + 1e-3 * np.eye(D)
        factor.append(np.linalg.cholesky(shrunk))
    return Discriminant(prior, tuple(mean), tuple(factor))


def score_table(features: DataFrame, model: Discriminant) -> DataFrame:
    """Every column but x, and ``score``: the probability of label 1."""
    kept = [f for f in features.schema if f.name != "x"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, D)
            rest = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(model.score(x))], names=[f.name for f in kept] + ["score"])

    return features.mapInArrow(lean(run), schema)


def labelled(features: DataFrame, labels: DataFrame, train, doc_id: str, label: str) -> DataFrame:
    """(label, x) of the labelled training rows."""
    marks = (labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{label}`").cast("long").alias("label"))
             .where(F.col("label").isin(0, 1)).where(train))
    return features.select("doc_id", "x").where(train).join(marks, "doc_id").select("label", "x")


def quality_scores(documents: DataFrame, labels: DataFrame, train, doc_id: str = "doc_id", text: str = "text",
                   label: str = "quality") -> DataFrame:
    """doc_id and score of every row. ``train`` is a predicate Column over
    doc_id: only rows that satisfy it learn from labels."""
    src = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    features = stored(feature_table(src, ["doc_id"]), "quality-features")
    return score_table(features, fit(labelled(features, labels, train, doc_id, label)))


def fit_documents(documents: DataFrame, labels: DataFrame, train, doc_id: str = "doc_id", text: str = "text",
                  label: str = "quality") -> Discriminant:
    """The model alone: only training documents are read into statistics."""
    src = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).where(train)
    return fit(labelled(feature_table(src, ["doc_id"]), labels, train, doc_id, label))


def text_score(model: Discriminant):
    """A column function text -> score, for filters that keep whole rows."""
    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        data, offs = text_buffers(text)
        parts = [model.score(statistics(data, offs[lo:hi + 1])) for lo, hi in doc_slices(offs)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return score
