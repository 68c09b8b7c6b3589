"""Spelling variants against a plain version over all pairs."""

import random
import re
import zlib
from collections import Counter

from ridgeline.llm.spelling import scan_group, spelling_forms, word_counts


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(rows, slip=199, factor=5):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % slip == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    out, forms = {}, {}
    for w, n in words.items():
        all_near = sorted((-m, v) for v, m in words.items() if near(w, v))
        best = all_near[0] if all_near else (0, None)
        ok = best[1] is not None and -best[0] >= factor * n
        forms[w] = best[1] if ok else None
        out[w] = [forms[w], n, len(all_near), -best[0] if ok else None]
    for w, row in out.items():
        root = w
        while forms[root]:
            root = forms[root]
        row.append(root)
    return sorted((w, *r) for w, r in out.items())


def got(df, slip=199):
    rows = spelling_forms(word_counts(df, slip_every=slip)).collect()
    return sorted((r.word, r.form, r.n, r.n_near, r.form_n, r.root) for r in rows)


def key(rows):
    return sorted(map(repr, rows))


def test_forms_equal_plain(spark, edge_docs, no_docs):
    rng = random.Random(2)
    stems = ["separate", "aabbaab", "Überfluß", "zzzzzz", "recieve"]
    words = []
    for s in stems:
        for k in range(14):
            w = s
            for _ in range(k % 3):
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice("abé") + w[at:], w[:at] + rng.choice("abÉ") + w[at + 1:]])
            words += [w] * rng.choice([1, 5, 6, 30, 31, 160, 900])
    rng.shuffle(words)
    rows = [(i % 97 if i % 11 else None, " ".join(words[j::60]) + ", " + "x1y") for i, j in enumerate(range(60))]
    rows += [(1, None), (2, "")]
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(4)
    for slip in (199, 3):
        assert key(got(df, slip)) == key(plain(rows, slip))
    edge = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert key(got(edge_docs)) == key(plain(edge))
    assert got(no_docs) == []


def test_a_group_is_counted_without_its_pairs():
    rows = [("a", True, 9, "xa"), ("b", True, 7, "xb"), ("c", False, 9, "xc"), ("", True, 9, "x")]
    assert sorted(scan_group(rows)) == [("x", 2, 9, "xa"), ("xa", 3, 9, "x"), ("xb", 3, 9, "x"), ("xc", 2, 9, "xa")]
