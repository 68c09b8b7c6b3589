"""Outcomes of op8's model for every training token, not only the frequent ones."""

import random

import numpy as np
from pyspark.sql import functions as F

from ridgeline.llm import lm_score as M


def test_branches_are_a_distribution_over_the_tokens_of_a_slot():
    rng = np.random.default_rng(5)
    depth = np.zeros(M.SUFFIXES, np.int64)
    depth[3], depth[9] = 5, 1
    leaf = np.zeros(int((1 << depth).sum()))
    codes = np.unique(rng.integers(0, 2**32, 24).astype(np.int64) & ~1) | 1
    first = np.concatenate([[0], np.cumsum(1 << depth)[:-1]])
    at = first[3] + (codes >> (32 - 5))
    leaf[np.unique(at)] = rng.random(len(np.unique(at))) * 9 + 0.5  # empty leaves stay
    model = M.Branches(M.Trees.of(depth, leaf), (rng.normal(size=1 << 12) * 0.5).astype(np.float32))
    one = codes[np.unique(at, return_index=True)[1]]  # a token of every leaf
    contexts = np.repeat(M.word_contexts(np.array([11, 22, 33]), np.array([0, 3]))[:, 2:], len(one), axis=1)
    slots = np.full(len(one), M.TOP + 3)
    assert abs(np.exp(model.log_p(contexts, slots, one)).sum() - 1) < 1e-6
    plain = M.Branches(model.trees, np.zeros(1 << 12, np.float32))
    assert np.allclose(np.exp(plain.log_p(contexts, slots, one)), leaf[np.unique(at)] / leaf.sum())
    # frequent and unseen tokens take no branch
    assert not model.log_p(contexts, np.full(len(one), 7), one).any() and not model.log_p(contexts, slots, one & ~1).any()


def test_word_gradient_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(6)
    depth = np.full(M.SUFFIXES, 3, np.int64)
    trees = M.Trees.of(depth, np.ones(8 * M.SUFFIXES))
    rows = []
    for _ in range(40):
        n = int(rng.integers(1, 80))
        rows.append((bytes(rng.integers(0, 256, n).astype(np.uint8)), (rng.integers(0, 2**31, n) * 2 + 1).astype("<u4").tobytes()))
    df = spark.createDataFrame(rows, "slots binary, codes binary")
    (g, c), (g7, c7) = (M.word_gradient(df.repartition(n), spark.sparkContext.broadcast(trees), np.zeros(1 << 10, np.float32)) for n in (1, 7))
    assert np.allclose(g, g7, atol=1e-3) and np.allclose(c, c7, atol=1e-3)
    choices = sum(int((np.frombuffer(s, np.uint8) >= M.TOP).sum()) for s, _ in rows) * 3
    assert abs(c.sum() - 0.25 * M.WORD_ACTIVE * choices) < 1e-2


def test_rare_tokens_are_told_apart_by_rare_neighbours(spark):
    """Pairs of rare tokens that share counts, endings and frequent neighbours: only a
    model that knows each token can prefer the pairs it has seen."""
    rng = random.Random(8)
    pairs = [(f"l{i}zz", f"r{i}zz") for i in range(150)]
    texts = []
    for _ in range(10):
        order = pairs[:]
        rng.shuffle(order)
        texts += [" ".join(f"f{rng.randrange(200)} f{rng.randrange(200)} f{rng.randrange(200)} {a} {b}" for a, b in order[k:k + 10]) for k in range(0, 150, 10)]
    frame = " ".join(f"f{i} f{i}" for i in range(200))
    texts += [frame] * 30
    rows = [(i, t) for i, t in enumerate(texts)]
    for i, (a, b) in enumerate(pairs):
        rows += [(10_000 + i, f"f1 {a} {b}"), (20_000 + i, f"f1 {a} {pairs[(i + 7) % 150][1]}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in M.language_scores(df, F.col("doc_id") >= 10_000).collect()}
    assert all(got[10_000 + i].n_known == got[10_000 + i].n_tokens for i in range(150))
    base = sum(got[10_000 + i].base_score - got[20_000 + i].base_score for i in range(150))
    gain = [got[10_000 + i].score - got[20_000 + i].score for i in range(150)]
    assert abs(base) < 1e-6 and np.mean(gain) > 0.2


def test_a_token_has_one_slot_in_all_spellings(spark):
    """The ending is taken from the folded token, as its count is."""
    rows = [(0, "word" + "RY"), (1, "wordry"), (2, "WORDry"), (3, "wordRy wordry")] + [(4 + i, f"filler{i % 90} Filler{i % 90}") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in M.language_scores(df, F.lit(False)).where("doc_id < 3").collect()}
    assert got[0] == got[1] == got[2]
