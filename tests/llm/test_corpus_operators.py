"""Jaccard join, line dedup, decontamination, quality, licences and language
model against brute force, and their edge frames."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ridgeline.llm import common as C
from ridgeline.llm import decontamination as D
from ridgeline.llm import license_scan as L
from ridgeline.llm import lm_score as M
from ridgeline.llm import ngram_jaccard as J
from ridgeline.llm import quality as Q
from ridgeline.llm.components import components
from ridgeline.llm.line_dedup import cut_chunks, cut_lines, dedup_lines

WORDS = [f"w{i}" for i in range(400)]


def words_of(t):
    return [w.decode("utf-8", "surrogateescape") for w in (t or "").encode().lower().split()]


# ---------------------------------------------------------------- helpers

def test_word_hashes_are_the_words_in_any_cut():
    texts = ["a  b\tc", "", "Ä b A", "x" * 300 + " y", " lead", "trail ", "é\u00a0è z"] * 3
    col = pa.array([*texts, None])
    data, offs = C.text_buffers(col)
    seen = {}
    for limit in (7, 64, 1 << 20):
        h, s, e, per = C.word_hashes(data, offs, limit=limit)
        got = [bytes(data[a:b]).lower() for a, b in zip(s, e)]
        assert got == [w for t in texts for w in t.encode().lower().split()]
        assert per.tolist() == [len(t.encode().split()) for t in texts] + [0]
        for w, x in zip(got, h):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_bitmap_keeps_its_own_values(spark):
    rng = np.random.default_rng(8)
    own = np.concatenate([rng.integers(-2**63, 2**63 - 1, 3000), np.arange(-5, 500)])
    bits = C.bitmap_of(spark.createDataFrame([(int(x),) for x in own], "h long"), "h")
    assert C.bitmap_has(bits, own).all()
    assert C.bitmap_has(bits, rng.integers(-2**63, 2**63 - 1, 100_000)).mean() < 1e-3
    assert not C.bitmap_has(C.bitmap_of(spark.createDataFrame([], "h long"), "h"), own).any()


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(25)] + [(5, 5), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    want = {x: find(x) for x in parent}
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- Jaccard join

def brute_classes(rows, k, num, den):
    sets = []
    for _, t in rows:
        w = words_of(t)
        sets.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                    a, b = find(i), find(j)
                    parent[max(a, b)] = min(a, b)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return [(d, len(sets[i]), low[find(i)]) for i, (d, _) in enumerate(rows)]


def near_corpus(rng):
    rows = []
    for g in range(14):
        base = [rng.choice(WORDS) for _ in range(rng.choice([8, 12, 25, 60, 140, 300]))]
        for _ in range(rng.choice([1, 2, 6, 14])):
            w = list(base)
            for _ in range(rng.randrange(0, max(2, len(w) // 12))):
                p = rng.randrange(len(w))
                w[p:p + 1] = rng.choice([[], [rng.choice(WORDS)], [w[p], rng.choice(WORDS)]])
            rows.append(" ".join(w))
    rows += ["", None, "one", "ONE", "one two", "one two", "a b c d", "x " * 30]
    rng.shuffle(rows)
    return [(i + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("k,num,den", [(3, 90, 100), (5, 80, 100)])
def test_near_duplicates_against_brute_force(spark, k, num, den, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_ROWS", 5)  # hot keys go through block pairs
    for seed in (1, 2):
        rows = near_corpus(random.Random(seed))
        df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n string")
        got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(df, k, num, den).collect())
        assert got == sorted(brute_classes(rows, k, num, den))
        assert len({c for _, _, c in got}) < len(rows)


def test_parts_never_lose_a_link():
    """Every pair at the threshold shares a key, whatever its sizes."""
    rng = np.random.default_rng(4)
    for num, den in ((90, 100), (80, 100)):
        bands = J.Bands(num, den)
        for _ in range(400):
            n = int(rng.integers(10, 400))
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
            drop = int(rng.integers(0, 1 + n // 10))
            add = int(rng.integers(0, 1 + n // 10))
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, add).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if den * both < num * (len(a) + len(b) - both) or both == len(a) == len(b):
                continue
            ka, kb = ({int(x) for p in bands.plans(len(s)) for x in J.part_keys(s, *p)} for s in (a, b))
            assert ka & kb


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(5)
    for _ in range(100):
        a = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
        b = np.unique(np.concatenate([a[: rng.integers(1, 300)], rng.integers(0, 2**63, 700).astype(np.uint64)]))
        x, y = (np.frombuffer(J.parity_sketch(s), np.uint8) for s in (a, b))
        size = min(len(x), len(y))
        far = int(np.unpackbits(J._fold(x, size) ^ J._fold(y, size)).sum())
        assert far <= len(np.setxor1d(a, b))


def test_near_duplicate_frames(spark, edge_docs, no_docs):
    rows = J.near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id))
    assert by[1] == {(6, 1)} and by[2] == {(6, 1)}
    assert by[3] == {(0, 3)} and by[4] == {(0, 4)} and by[5] == {(0, 5)}
    assert by[6] == by[7] == {(1, 6)} and by[8] == {(by[8].copy().pop()[0], 8)} and by[9].copy().pop()[1] == 8
    assert by[None] == {(1, 6), (0, None)}
    assert J.near_duplicates(no_docs).count() == 0
    kept = sorted(r.doc_id for r in J.drop_near_duplicates(edge_docs).where("doc_id is not null").collect())
    assert kept == [-5, 1, 3, 4, 5, 6, 8, 10, 11, 12]


# ---------------------------------------------------------------- line dedup

def sentence(rng, n=None):
    return " ".join(rng.choice(WORDS) for _ in range(n or rng.randint(4, 8))).capitalize() + "."


def lines_of(text):
    data, offs = C.text_buffers(pa.array([text]))
    h, s, e, doc, nw, hard = cut_lines(data, offs)
    return [bytes(data[a:b]).decode() for a, b in zip(s, e)], h, cut_chunks(h, doc, hard)


def test_chunks_are_shift_resistant_and_multi_line():
    rng = random.Random(2)
    body = " ".join(sentence(rng) for _ in range(200))
    lines, _, last = lines_of(body)
    assert " ".join(lines) == body and (np.diff(last) >= 2).all()
    ends = {lines[i] for i in last}
    moved, _, last2 = lines_of("New start. Of the text. " + body)
    same = ends & {moved[i] for i in last2}
    assert len(same) > 0.95 * len(ends)


def test_repeated_passages_go_and_the_rest_stays(spark):
    rng = random.Random(3)
    passages = [" ".join(sentence(rng) for _ in range(12)) for _ in range(3)]
    rows, clean = [], []
    for i in range(40):
        own = [sentence(rng) for _ in range(rng.randint(20, 30))]
        text = list(own)
        if i % 2 == 0:
            text.insert(rng.randrange(len(text)), ("\n" if i % 4 == 0 else "") + passages[i % 3] + ("\n" if i % 4 == 0 else ""))
        else:
            clean.append(i)
        rows.append((i, " ".join(text), own))
    df = spark.createDataFrame([(i, t, "c") for i, t, _ in rows], "doc_id long, text string, cut string")
    got = {r.doc_id: r for r in dedup_lines(df, report="gone").collect()}
    for i, t, own in rows:
        if i in clean:
            assert got[i].text == t and got[i].gone == []
        else:
            left = got[i].text
            assert all(s in left for s in own), i       # only the passage lost lines
    held = [sum(p in got[i].text for i, _, _ in rows) for p in passages]
    assert held == [1, 1, 1]
    # bytes removed are exactly the reported spans
    for i, t, _ in rows:
        raw = t.encode()
        for s, e in reversed([(g.s, g.e) for g in got[i].gone]):
            raw = raw[:s] + raw[e:]
        assert raw.decode() == got[i].text


def test_passages_inside_a_line_go_to_their_ends(spark):
    rng = random.Random(12)
    rows, parts = [], {}
    for i in range(60):
        passage = [f"p{i}x{rng.randrange(10**6)}" for _ in range((50, 55, 80, 120)[i % 4])]
        for d in (2 * i, 2 * i + 1):
            own = [f"o{d}x{rng.randrange(10**6)}" for _ in range(rng.randint(60, 200))]
            at = rng.randrange(len(own))
            rows.append((d, " ".join(own[:at] + passage + own[at:])))
            parts[d] = " ".join(own)
    rows += [(1000, "same " * 700 + "end of one"), (1001, "start of two " + "same " * 700)]
    left = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, text in rows[:120]:
        assert left[d].split() == (parts[d] if d % 2 else text).split(), d
    assert len(left[1001]) < 100


def test_copies_are_left_whole_on_request(spark):
    rng = random.Random(4)
    base = [sentence(rng) for _ in range(30)]
    near = list(base)
    near[7] = sentence(rng)
    rows = [(1, " ".join(base)), (2, " ".join(base)), (3, " ".join(near)), (4, " ".join(base[:12] + [sentence(rng) for _ in range(40)]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    cut = {r.doc_id: r.text for r in dedup_lines(df).collect()}
    assert cut[1] == rows[0][1] and cut[2] == "" and len(cut[3]) < 0.5 * len(rows[2][1])
    kept = {r.doc_id: r.text for r in dedup_lines(df, copy_share=0.6).collect()}
    assert kept[2] == rows[1][1] and kept[3] == rows[2][1] and len(kept[4]) < len(rows[3][1])


def test_line_dedup_frames(edge_docs, no_docs):
    out = dedup_lines(edge_docs)
    assert out.columns == edge_docs.columns and out.count() == edge_docs.count()
    got, had = ({(r.doc_id, r.text) for r in x.collect() if r.doc_id != 9} for x in (out, edge_docs))
    assert got == had
    left = out.where("doc_id = 9").first().text  # nearly all of it repeats document 8
    assert left.endswith(" tail") and len(left) < 1000
    assert dedup_lines(no_docs, report="x").count() == 0


# ---------------------------------------------------------------- decontamination

def test_planted_passages_and_substitutions(spark):
    rng = random.Random(6)
    items = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randint(15, 50)))) for i in range(20)] + [(90, "tiny item here now"), (91, None), (None, "x y z"), (92, "")]
    want, rows = {}, []
    for d in range(120):
        w = [rng.choice(WORDS) for _ in range(rng.randint(30, 200))]
        if d % 3 == 0:
            i = rng.randrange(20)
            t = items[i][1].split()
            swaps = rng.randrange(0, 1 + len(t) // 8)
            for p in rng.sample(range(len(t)), swaps):
                t[p] = "swapped"
            at = rng.randrange(len(w))
            w[at:at] = [x.upper() for x in t]
            want[d] = (i, at, len(t) - swaps)
        rows.append((d, " ".join(w)))
    rows += [(500, "so tiny item here now then"), (501, None), (None, items[0][1]), (502, ""), (0, rows[0][1])]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {}
    for r in D.overlaps(df, bench).collect():
        got.setdefault(r.doc_id, []).append((r.item_id, r.start_word, r.n_equal, r.item_words))
    assert set(got) - {500} == set(want)
    assert got[500] == [(90, 1, 4, 4)]
    for d, (i, at, same) in want.items():
        assert [g[0] for g in got[d]] == [i]
        assert got[d][0][2] >= min(12, same) and abs(got[d][0][1] - at) <= 12
    kept = D.decontaminate(df, bench)
    assert kept.columns == df.columns and kept.count() == len(rows) - len(want) - 2
    assert D.overlaps(df, bench.where("false")).count() == 0
    assert D.overlaps(df.where("false"), bench).count() == 0


def test_substitutions_at_every_place_of_short_items(spark):
    from itertools import combinations

    rng = random.Random(16)
    items, rows, want = [], [], {}
    for n in range(4, 21):
        t = [f"i{n}x{j}" for j in range(n)]
        items.append((n, " ".join(t)))
        swaps = min(3, n - D.needed(n, D.LEAST, D.IDENTITY))
        for places in combinations(range(n), swaps):
            w = [rng.choice(WORDS) for _ in range(12)]
            w[6:6] = ["swapped" if j in places else x for j, x in enumerate(t)]
            want[len(rows)] = n
            rows.append((len(rows), " ".join(w)))
        over = [f"i{n}x{j}" if j < D.needed(n, D.LEAST, D.IDENTITY) - 1 else "other" for j in range(n)]
        rows.append((len(rows), " ".join(over)))  # one equal word too few
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.item_id for r in D.overlaps(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == want


def test_masks_lose_no_placing_of_mismatches():
    from itertools import combinations

    for n in range(D.SPAN, 25):
        k = n // 4
        differ = np.array([sum(1 << p for p in c) for c in combinations(range(1, n - 1), k)])
        hit = np.zeros(len(differ), bool)
        for m in (int(x, 2) for x in D.MASKS):
            for shift in range(n - m.bit_length() + 1):
                hit |= differ & (m << shift) == 0
        assert hit.all()


def test_spaced_seeds_ignore_masked_places():
    w = np.arange(1, 30, dtype=np.uint64) * np.uint64(7919)
    for m in D.MASKS:
        base = D.seed_hashes(w, m)
        for p, bit in enumerate(m):
            x = w.copy()
            x[10 + p] = 1
            assert (D.seed_hashes(x, m)[10] == base[10]) == (bit == "0")


def test_best_segment():
    e = np.array([0, 1, 1, 1, 0, 1, 1, 1, 1, 0, 0, 0, 1], bool)
    assert D.best_segment(e) == (1, 9, 7)
    assert D.best_segment(np.zeros(4, bool)) [2] == 0


def test_decontamination_frames(spark, edge_docs):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")], "item_id long, text string")
    assert sorted({r.doc_id for r in D.overlaps(edge_docs, bench).collect()}) == [1, 2]


# ---------------------------------------------------------------- quality

def test_classifier_separates_held_out_rows(spark, sf001):
    from ridgeline.llm.q_corpus import document_scores

    docs = C.read_table(spark, "/root/testdata/sf0.01", "documents")
    labels = C.read_table(spark, "/root/testdata/sf0.01", "labels")
    rows = document_scores(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    pos = [r.score for r in held if r.quality == 1]
    neg = [r.score for r in held if r.quality == 0]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc > 0.97
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_statistics_do_not_depend_on_the_slice():
    texts = ["The quick Brown fox.", "", "a | b | c\nline two\nline two", "ÀÉ 12 34", "!!! ###", "One. Two! Three?"]
    data, offs = C.text_buffers(pa.array(texts))
    whole = Q.statistics(data, offs)
    for i, t in enumerate(texts):
        d, o = C.text_buffers(pa.array([t]))
        assert np.allclose(Q.statistics(d, o)[0], whole[i])
    assert np.isfinite(whole).all()


def test_discriminant_against_dense_formula(spark):
    rng = np.random.default_rng(1)
    x0, x1 = rng.normal(size=(300, Q.D)), rng.normal(size=(500, Q.D)) * 0.5 + 1
    rows = [(0, v.tolist()) for v in x0] + [(1, v.tolist()) for v in x1]
    m = Q.fit(spark.createDataFrame(rows, "label long, x array<double>"))
    c0, c1 = np.cov(x0.T, bias=True), np.cov(x1.T, bias=True)
    both = (300 * c0 + 500 * c1) / 800
    want = []
    for mu, c in ((x0.mean(0), c0), (x1.mean(0), c1)):
        s = 0.85 * c + 0.1 * both + 0.05 * np.diag(np.diag(both)) + 1e-3 * np.eye(Q.D)
        z = x1 - mu
        want.append(-0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(s), z) - 0.5 * np.linalg.slogdet(s)[1])
    odds = want[1] - want[0] + math.log(501 / 301)
    assert np.allclose(m.score(x1), 1 / (1 + np.exp(-odds)), atol=1e-6)


def test_quality_frames(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (6, None), (8, 3), (1, 1), (None, 1)], "doc_id long, quality int")
    rows = Q.quality_scores(edge_docs, labels, F.lit(True)).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    one = Q.quality_scores(edge_docs, labels.where("quality = 1"), F.lit(True)).collect()
    assert len({r.score for r in one}) == 1 and one[0].score > 0.5
    assert {r.score for r in Q.quality_scores(edge_docs, labels.where("false"), F.lit(True)).collect()} == {0.5}
    assert Q.quality_scores(no_docs, labels, F.lit(True)).count() == 0
    assert edge_docs.where(Q.text_score(Q.Discriminant(0.5))(F.coalesce("text", F.lit(""))) >= 0.3).count() == edge_docs.count()


# ---------------------------------------------------------------- licences

def brute_licenses(text):
    segs = []
    for s in re.sub(r"([.!?]) ", "\\1\n", text).split("\n") + text.split("\n") + re.split(r"\n[ \t\r]*\n", text):
        if s not in segs:
            segs.append(s)
    out = {}
    for s in segs:
        w = re.sub(r"[^a-z0-9]+", " ", "".join(c.lower() if "A" <= c <= "Z" else c for c in s)).split()
        a = {f"{x} {y}" for x, y in zip(w, w[1:])}
        for k, v in L.TEMPLATES.items():
            b = set(L.template_bigrams(v))
            if a and 200 * len(a & b) >= L.PERCENT * (len(a) + len(b)):
                n, d = out.get(k, (0, 0))
                out[k] = (n + 1, max(d, 2 * len(a & b) / (len(a) + len(b))))
    return out


def test_licences_against_brute_force(spark, edge_docs, no_docs):
    rng = random.Random(9)
    texts = []
    for i in range(120):
        t = [sentence(rng) for _ in range(rng.randint(0, 6))]
        for _ in range(rng.randint(0, 2)):
            lic = rng.choice(list(L.TEMPLATES.values()))
            w = lic.split()
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = rng.choice(["THE", "licence", "x"])
            t.insert(rng.randint(0, len(t)), rng.choice(["", "\n", "\n\n"]) + rng.choice([" ".join(w), " ".join(w).upper(), "\n".join(w)]) + rng.choice(["", "\n", "\n \n"]))
        texts.append(" ".join(t))
    texts += ["All rights reserved. " * 50, "all  RIGHTS--reserved", "", "rights"]
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)] + [(900, None, "z")], "doc_id long, text string, license string")
    got = {}
    for r in L.scan_licenses(df).groupBy("doc_id", "license").agg(F.count(F.lit(1)).alias("n"), F.max("dice").alias("d")).collect():
        got.setdefault(r.doc_id, {})[r.license] = (r.n, r.d)
    for i, t in enumerate(texts):
        want = brute_licenses(t)
        assert got.get(i, {}).keys() == want.keys(), t
        for k in want:
            assert abs(got[i][k][1] - want[k][1]) < 1e-12
    assert 900 not in got
    assert L.scan_licenses(edge_docs).count() == 0 and L.scan_licenses(no_docs).count() == 0


# ---------------------------------------------------------------- language model

def test_base_scores_against_brute_force(spark, sf001):
    docs = sf001("documents")
    rows = {r.doc_id: r for r in M.language_scores(docs, C.crc_mod(F.col("doc_id"), 5) == 1).collect()}
    import zlib
    from collections import Counter

    texts = {r.doc_id: (r.text or "").encode().lower().split() + [None] for r in docs.collect()}
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 5 == 1}
    c = Counter(w for i, t in texts.items() if i not in held for w in t)
    total, kinds = sum(c.values()), len(c)
    assert len(rows) == len(texts)
    for i, t in texts.items():
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i in held, len(t), sum(w in c for w in t), total)
        want = sum(math.log10((c[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in t)
        assert abs(r.base_score - want) < 1e-6 * abs(want)
    gain = [(rows[i].score - rows[i].base_score) / rows[i].n_tokens for i in held]
    assert np.mean(gain) > 0.02  # held-out texts are likelier under the model


def test_model_is_a_distribution_and_gradient_is_right():
    rng = np.random.default_rng(2)
    mass = rng.random(M.SLOTS) * 50
    model = M.Model(mass, (rng.normal(size=(M.FEATURES, M.WIDTH)) * 0.3).astype(np.float32))
    feats = M.contexts(np.array([3, 9, 200, 3, 17]), np.array([0, 2, 5]))
    assert feats[0].tolist() == [255, 3, 255, 200, 3] and (feats[1] - 256).tolist() == [255, 255, 255, 255, 200]
    one = feats[:, 3:4]
    total = sum(np.exp(float(model.forward(one, np.array([s]))[4][0])) for s in range(M.SLOTS))
    assert abs(total - 1) < 1e-4
    a, b, sa, sb, log_p = model.forward(one, np.array([37]))
    a, b = a / sa[:, None], b / sb[:, None]
    f, c, eps = int(one[0, 0]), 37 // M.PER_CLASS, 1e-2
    for out, want in ((c, 1 - a[0, c]), (M.CLASSES + 37, 1 - b[0, 37 % M.PER_CLASS])):
        w = model.weights.copy()
        w[f, out] += eps
        up = M.Model(mass, w).forward(one, np.array([37]))[4][0]
        assert abs((up - log_p[0]) / eps - want) < 0.02


def test_gradient_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(3)
    rows = [(i, bytes(rng.integers(0, 256, rng.integers(1, 80)).astype(np.uint8))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, slots binary")
    mass = np.ones(M.SLOTS)
    g = [M.gradient(df.repartition(n), (mass, None)) for n in (1, 7)]
    assert np.allclose(*g, atol=1e-2)
    n = sum(len(b) for _, b in rows)
    assert g[0][:, M.WIDTH].sum() == n * M.ACTIVE


def test_language_frames(edge_docs, no_docs):
    held = C.crc_mod(F.col("doc_id"), 5) == 1
    rows = M.language_scores(edge_docs, held).collect()
    assert len(rows) == edge_docs.count() and all(np.isfinite([r.score, r.base_score]).all() for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 5)} == {1}
    assert M.language_scores(no_docs, held).count() == 0
    nobody = M.language_scores(edge_docs, F.lit(True)).collect()
    assert all(abs(r.base_score) < 1e-9 and r.train_tokens == 0 and r.n_known == 0 for r in nobody)


def test_repeated_ids_with_other_texts(spark):
    """An id at several texts is several documents: only real copies go."""
    rng = random.Random(4)
    a, b, c, d = (" ".join(f"{n}{rng.randrange(10**6)}" for _ in range(60)) for n in "abcd")
    near = a.rsplit(" ", 1)[0] + " other"
    rows = [(0, near), (5, a), (5, b), (7, c), (7, d), (9, c), (9, c), (11, ""), (11, None)]
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, _name int")
    kept = sorted((r.doc_id, r.text or "") for r in J.drop_near_duplicates(df).collect())
    assert kept == sorted([(0, near), (5, b), (7, c), (7, d), (11, ""), (11, "")])
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(df).collect())
    assert got == sorted([(0, 56, 0), (5, 56, 0), (5, 56, 5), (7, 56, 7), (7, 56, 7), (9, 56, 7), (9, 56, 7), (11, 0, 11), (11, 0, 11)])


def test_shuffle_files_go_when_a_table_is_stored(spark):
    from ridgeline.llm.common import stored

    def shuffled():
        held = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {held.apply(i).getName() for i in range(held.size()) if held.apply(i).getName().startswith("shuffle_")}

    before = shuffled()
    table = stored(spark.range(1000).repartition(7).groupBy((F.col("id") % 10).alias("k")).count(), "shuffle-test")
    assert not shuffled() - before
    assert table.count() == 10


def test_adjacent_chunks_of_a_pair_are_one_repeat():
    from ridgeline.llm.line_dedup import agree, repeats

    own = b"one two\nthree four\nfive six\nseven\nx y"
    mine = own + b" z"
    found, left = repeats([(19, 34, 3), (0, 19, 4), (0, 18, 0)], mine, 0, len(mine), own, 0, len(own), 0)
    assert not left and [f for f in found if not f[3]] == [(0, 34, 7, False)]
    assert [f for f in found if f[3]] == [(0, len(own), 9, True)]
    for n in (200, 2000):  # few bytes and many
        a = b"word " * n
        b = a[:-7] + b"X" + a[-6:]
        assert agree(a, b, False, False) == (len(a) - 11, True) == agree(b, a, False, False)
    assert agree(a, a, False, True) == (0, False)


def test_stored_tables_bound_the_bytes_of_arrow_batches(spark):
    """A batch of long texts stands in the JVM and in every Python worker at once."""
    import pyarrow as pa

    from ridgeline.llm.common import ARROW_BYTES, BATCH_BYTES, stored

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "bytes"])

    before = spark.conf.get(ARROW_BYTES)
    rows = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 10000) as text")
    got = stored(rows.mapInArrow(sizes, "n long, bytes long"), "batch-test").collect()
    assert sum(r["n"] for r in got) == 3000
    assert max(r["bytes"] for r in got) <= BATCH_BYTES + 20_000
    assert spark.conf.get(ARROW_BYTES) == before


def test_only_the_open_side_of_a_run_is_compared_again(monkeypatch):
    from ridgeline.llm import line_dedup

    own = b"x head one two " + b"word " * 400
    mine = b"y head one two " + b"word " * 400
    asked = []
    agree = line_dedup.agree
    monkeypatch.setattr(line_dedup, "agree", lambda *a: asked.append(len(a[0])) or agree(*a))
    found, left = line_dedup.repeats([(7, 10, 0)], mine, 0, len(mine), own, 0, len(own), 0)
    assert not left and found == [(2, len(mine) - 1, 403, True)]
    assert len(asked) == 3  # the head is known at once, the tail after the whole text
    found, left = line_dedup.repeats([(7, 10, 0)], mine[:600], 0, len(mine), own[:600], 0, len(own), 0)
    assert not found and left == [(7, 10, 1)]
