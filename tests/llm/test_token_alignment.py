"""Cross-tokenizer alignment against a plain version, and tokenizer A against its file."""

import hashlib
import json
from collections import Counter

import pytest

from ridgeline.llm.q_texts import tokenizer_files
from ridgeline.llm.token_alignment import PATTERN, Aligner, align_tokenizers, byte_alphabet, json_ranks

ODD = ["", None, " ", "\n\n  x", "a▁b", "<|endoftext|> and <s> </s> <unk> <0x0A>", "naïve Ünïcode 😀 \x00   漢字 漢字",
       "x" * 5000, "  two  spaces   ", "'tis we'll it's", "=" * 300, "tab\tand\r\nnewline", "1234567890 12 3", "aab aaab ab"]


@pytest.fixture(scope="module")
def plain():
    import sentencepiece
    from tokenizers import Tokenizer

    bpe, model = tokenizer_files()
    a = Tokenizer.from_file(bpe)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=model)
    alphabet = byte_alphabet()

    def tokens(text):
        if not text:
            return [], []
        x = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
             for i in b.encode(text)]
        want = (" " + text).encode()
        return (x, y) if b"".join(t for _, t in x) == want == b"".join(t for _, t in y) else ([], [])

    def groups(text):
        x, y = tokens(text)
        out, cx, cy, ex, ey = [], [], [], 0, 0
        x, y = x[::-1], y[::-1]
        while x or y:
            if ex <= ey:
                i, t = x.pop()
                cx.append(i)
                ex += len(t)
            else:
                j, t = y.pop()
                cy.append(j)
                ey += len(t)
            if ex == ey and cx and cy:
                out.append((cx, cy))
                cx, cy = [], []
        return out

    return groups


def digest(groups):
    return hashlib.sha256(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups).encode()).hexdigest()


def expected(rows, groups):
    found = [groups(t) for _, t in rows]
    links = [Counter((i, j) for x, y in g for i in x for j in y) for g in found]
    counts = Counter(p for c in links for p in c)
    top = Counter()
    for (i, _), n in counts.items():
        top[i] = max(top[i], n)
    return sorted((str(d), sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(c.values()),
                   sum(m for p, m in c.items() if counts[p] == top[p[0]]), sum(m * counts[p] for p, m in c.items()),
                   digest(g) if g else "") for (d, _), g, c in zip(rows, found, links))


def got(df, **more):
    out = align_tokenizers(df, *tokenizer_files(), keep=["doc_id"], **more).collect()
    return sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in out)


@pytest.mark.parametrize("hot", [1 << 20, 40, 0])
def test_alignment_equals_plain(spark, plain, sf001, hot):
    rows = [(r.doc_id, r.text) for r in sf001("documents").collect()] + [(None, t) for t in ODD] + [(7, "x y"), (7, "x y")]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, a int, row int").repartition(5)
    assert got(df, hot=hot) == expected(rows, plain)


def test_edge_tables(spark, plain, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert got(edge_docs) == expected(rows, plain)
    assert got(no_docs) == []


def test_memo_starts_anew(monkeypatch, plain):
    from ridgeline.llm import token_alignment as M

    monkeypatch.setattr(M, "MEMO", 3)
    tool = Aligner(*tokenizer_files())
    for texts in (["a b c d e", "b c"], ["c d e f g h"], ["a", ""]):
        _, digests, *_ = tool.align(tool.encode(texts))
        assert digests == [digest(plain(t)) if t else "" for t in texts]


def test_ranks_give_the_merges_of_the_file():
    """Each entry, merged by ranks under its own, ends in the two parts that the
    file's merge list names, and the list is in id order: the two merge loops agree."""
    bpe, _ = tokenizer_files()
    with open(bpe, encoding="utf-8") as f:
        spec = json.load(f)["model"]
    alphabet, ranks = byte_alphabet(), json_ranks(bpe)
    merges = [tuple(bytes(alphabet[c] for c in p) for p in (m if isinstance(m, list) else m.split(" "))) for m in spec["merges"]]
    assert [ranks[a + b] for a, b in merges] == sorted(r for b, r in ranks.items() if len(b) > 1)
    for a, b in merges:
        rank, parts = ranks[a + b], [bytes([c]) for c in a + b]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], rank))
            assert ranks.get(parts[best] + parts[best + 1], rank) < rank
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        assert tuple(parts) == (a, b)


def test_split_pattern_over_unicode():
    import tiktoken
    from tokenizers import Tokenizer

    bpe, _ = tokenizer_files()
    a = Tokenizer.from_file(bpe)
    mine = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=json_ranks(bpe), special_tokens={})
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3200 or c % 97 == 0 or 0x1E000 <= c < 0x20000)]
    texts = [f"a{c}b 1{c}2 .{c}, {c} {c}{c}\n{c}x '{c}s {c}" for c in chars]
    assert mine.encode_ordinary_batch(texts, num_threads=4) == [e.ids for e in a.encode_batch(texts, add_special_tokens=False)]
