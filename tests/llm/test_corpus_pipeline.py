"""Stages of the corpus pipeline on planted documents."""

import random

import corpus_pipeline as P


def prose(rng, n):
    return [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(900)) for _ in range(rng.randint(4, 9))).capitalize() + "."
            for _ in range(n)]


def held(part, text):
    """Share of the words of ``part`` that stand in ``text``."""
    words, there = part.split(), set(text.split())
    return sum(w in there for w in words) / len(words)


def test_only_near_copies_pass_line_dedup_whole(spark):
    rng = random.Random(11)
    base, other = prose(rng, 120), prose(rng, 40)
    passage = prose(rng, 12)
    near = list(base)
    near[50] = prose(rng, 1)[0]
    cut_owner = other[:20] + passage + other[20:]
    texts = {1: base, 2: near, 3: base[20:50], 4: base + prose(rng, 60), 5: prose(rng, 20) + passage,
             6: prose(rng, 3) + passage + prose(rng, 3), 7: cut_owner, 8: cut_owner[:-1] + prose(rng, 1)}
    texts = {i: " ".join(t) for i, t in texts.items()}
    df = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    got = {r.doc_id: r.text for r in P.line_dedup(spark, df, "").collect()}
    assert got[2] == texts[2]                       # Jaccard over 0.8: the next stage drops it
    assert held(texts[3], got.get(3, "")) < 0.4     # an excerpt
    assert held(texts[1], got[4]) < 0.2             # a copy with a long tail
    passage = " ".join(passage)
    assert held(passage, got[6]) < 0.6              # a short document around a passage
    # document 7 loses the passage, and so does its copy, which goes in the next stage
    assert held(passage, got[7]) < 0.6 and held(passage, got[8]) < 0.6
    kept = {r.doc_id: r.text for r in P.near_duplicates(spark, spark.createDataFrame(
        [*got.items()], "doc_id long, text string"), "").collect()}
    assert 2 not in kept and 8 not in kept
