"""Personal data: base spans against plain regular expressions, added spans, reliabilities."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from ridgeline.llm import pii as M
from ridgeline.llm.q_texts import op12
from ridgeline.llm.registry import QUERIES

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(s):
    d = [int(c) for c in reversed(s)]
    return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


def good(kind, body):
    d = re.sub(r"[^0-9]", "", body)
    if kind == "ip":
        return all(int(p) <= 255 for p in body.split("."))
    if kind == "card":
        return 12 <= len(d) <= 19 and luhn(d)
    return kind != "phone" or 9 <= len(d) <= 15


def base_spans(text):
    return sorted((m.start(), k, m.end()) for k, kind in enumerate(PLAIN) for m in re.finditer(PLAIN[kind], text or "")
                  if good(kind, m.group()))


def line(spans):
    kinds = list(PLAIN)
    return ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans)


def found(df):
    return [(r.doc_id, [(s.start, M.KINDS.index(s.kind), s.end) for s in r.base], [(s.kind, s.start, s.end) for s in r.added])
            for r in M.find_personal(df, keep=["doc_id"]).collect()]


HARD = ["a@b.c._x@y.z", "a@b.c_d@e.f@g.h", "x@y", "@a.b", "a..b@c-d.e-.f", "1.2.3.4.5.6.7.8.9", "999.1.1.1.2.3.4", "000.00.0.0001",
        "4111 1111 1111 1111", "4111-1111 1111--1111", "4111111111111112", "+1 (017) 555-7713", "+1", "+12", "+1 2", "++49 30 1234567.",
        "+1 (017) 555-7713+1 (017) 555-7714", "é 😀 a.b@c.de 1.2.3.4 \x00", "1" * 40 + "@" + "2" * 40 + ".3", "٣.٣.٣.٣ ١٢٣",
        "12345678901234567890123 4111 1111 1111 1111", "a" * 3000, "1 " * 3000, "-" * 3000 + "@x.y", "+" * 300 + "1" * 40]


def test_base_spans_equal_plain(spark, sf001):
    rng = random.Random(5)
    noise = ["".join(rng.choice("01259 .-+()@ab_%é😀") for _ in range(rng.randrange(80))) for _ in range(1500)]
    rows = [(i, t) for i, t in enumerate([*HARD, None, "", *noise])] + [(r.doc_id, r.text) for r in sf001("documents").collect()]
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, `row` int, kind string").repartition(4)
    got = sorted((i, base) for i, base, _ in found(df))
    assert got == sorted((i, base_spans(t)) for i, t in rows)


def test_query_columns(spark, edge_docs, monkeypatch):
    from ridgeline.llm import q_texts

    monkeypatch.setattr(q_texts, "read_table", lambda *a: edge_docs)
    rows = op12(spark, "").collect()
    assert len(rows) == edge_docs.count()
    want = sorted((str(r.doc_id), line(base_spans(r.text))) for r in edge_docs.collect())
    assert sorted((str(r.doc_id), r.spans) for r in rows) == want
    for r in rows:
        assert r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest()
    assert "op12_personal_data" in QUERIES


def test_empty_table(spark, no_docs):
    assert found(no_docs) == []


CASES = {
    "Please call our office tel. (212) 664-7665 before noon.": "(212) 664-7665",
    "The patient's social security number is 536-90-4399, on file.": "536-90-4399",
    "Zahlbar auf Konto DE89 3704 0044 0532 0130 00, danke.": "DE89 3704 0044 0532 0130 00",
    "Write mail to jane.doe [at] posteo [dot] net today.": "jane.doe [at] posteo [dot] net",
    "It was signed by Mr. John Walker yesterday.": "Mr. John Walker",
}
CLEAN = ["see order 212-664-7665x in part=212.664.7665", "serial 000-00-0000 and build 536-90-43991", "DE89 3704 0044 0532 0130 01 is no account",
         "look at the dot on the page", "Drum Roll and Mrs nobody", "version 1.2 of 3.4", "plain prose without anything in it"]


def test_added_spans(spark):
    rows = [(i, t) for i, t in enumerate([*CASES, *CLEAN] * 20)]
    got = {i: added for i, _, added in found(spark.createDataFrame(rows, "doc_id long, text string"))}
    n = len(CASES) + len(CLEAN)
    for i, t in rows:
        want = CASES.get(t)
        assert [t[s:e] for _, s, e in got[i]] == ([want] if want else []), t
    assert len(got) == 20 * n


def test_reliabilities_are_recovered(spark):
    """Votes drawn from known tables: the posterior separates the classes."""
    rng = random.Random(3)
    rows = []
    for _ in range(6000):
        y = rng.random() < 0.3
        right = {"form": 0.9, "check": 0.85, "listed": 0.7, "sample": 0.6, "cue": 0.8, "edges": 0.75}
        rows.append(("card", y, *[(1 if y else -1) * (1 if rng.random() < p else -1) for p in right.values()]))
    df = spark.createDataFrame(rows, "kind string, y boolean, " + ", ".join(f"{j} int" for j in M.LABELERS))
    p = M.estimate(df.groupBy("kind", *M.LABELERS).agg(F.count(F.lit(1)).alias("n")))
    ok, share = df.select(F.avg(((p > 0.5) == F.col("y")).cast("int")), F.avg(p)).first()
    assert ok > 0.93 and share == pytest.approx(0.3, abs=0.03)


def test_no_python_in_the_plan(spark, sf001):
    plan = M.find_personal(sf001("documents"), keep=["doc_id"])._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
