"""Queries of the operators on words, personal data and tokens: 11, 12 and 13."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.llm.common import read_table
from ridgeline.llm.pii import BASE_KINDS, find_personal
from ridgeline.llm.registry import register
from ridgeline.llm.spelling import spelling_forms, word_counts
from ridgeline.llm.token_alignment import align_tokenizers

# ------------------------------------------------------------------ 11

OP11_SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), runs AS (
  SELECT id, run, count(*) AS n FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents)
  WHERE length(run) >= 6 GROUP BY id, run
), hexed AS (SELECT id, run, n, hex(encode(id || ':' || run)) AS hx FROM runs
), hashed AS (
  SELECT run, n, xor(list_reduce(list_concat([4294967295], list_transform(range(length(hx) // 2), lambda i:
           16 * (instr('0123456789ABCDEF', hx[2 * i + 1]) - 1) + instr('0123456789ABCDEF', hx[2 * i + 2]) - 1)),
           lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h
  FROM hexed, crc_table
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2)
                   ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), shorter AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM shorter a JOIN shorter b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.cut = b.word
  UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.cut = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(m) AS m, arg_max(other, (m, reversed)) AS other
  FROM (SELECT *, -row_number() OVER (ORDER BY encode(other)) AS reversed FROM near) GROUP BY word
), forms AS (
  SELECT w.word, CASE WHEN m >= 5 * w.n THEN other END AS form, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN m >= 5 * w.n THEN m END AS form_n
  FROM words w LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT c.word, c.next, f.form FROM chain c JOIN forms f ON f.word = c.next
)
SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN (SELECT word, root FROM chain WHERE next IS NULL) USING (word)
"""


@register("op11_spelling_variants", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(word_counts(read_table(spark, sf_dir, "documents"), slip_every=199))


# ------------------------------------------------------------------ 12

@register("op12_personal_data")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal(read_table(spark, sf_dir, "documents"), keep=["doc_id"])

    def line(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in BASE_KINDS], F.sha2(line(F.col("base")), 256).alias("base_sha256"),
                        line(F.sort_array(F.concat("base", "added"))).alias("spans"))


# ------------------------------------------------------------------ 13

def tokenizer_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@register("op13_tokenizer_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(read_table(spark, sf_dir, "documents"), *tokenizer_files(), keep=["doc_id"])
