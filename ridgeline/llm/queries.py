"""The registered queries of the operators in this folder, and their SQL."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.llm import q_corpus, q_texts  # noqa: F401  (they register their queries)
from ridgeline.llm.common import crc_mod, read_table
from ridgeline.llm.lm_score import language_scores
from ridgeline.llm.registry import ORACLES, QUERIES, register  # noqa: F401
from ridgeline.llm.secrets import BASE_KINDS, find_secrets
from ridgeline.llm.sentencepiece_codec import encode_map
from ridgeline.llm.topk import top_k
from ridgeline.llm.url_filter import Rule, filter_urls

# ------------------------------------------------------------------ 2

RULES = [Rule("block", "net/"), Rule("allow", "example.net/en/"),
         Rule("block", "example.com/de/"), Rule("allow", "org/fr/")]

OP2_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), rules AS (
  SELECT * FROM (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                        ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')) AS r(verdict, h, p)
), hits AS (
  SELECT page_id, r.h || r.p AS rule, r.verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(r.h || r.p) DESC) AS k
  FROM parts JOIN rules r ON (host = r.h OR suffix(host, '.' || r.h)) AND starts_with(path, r.p)
)
SELECT parts.page_id, host, path, hits.rule, coalesce(hits.verdict, 'allow') AS verdict
FROM parts LEFT JOIN hits ON hits.page_id = parts.page_id AND hits.k = 1
"""


@register("op2_url_filters", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read_table(spark, sf_dir, "pages"), RULES, keep=["page_id"])


# ------------------------------------------------------------------ 4

def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def piece_digests(df: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, covered_bytes: the digest
    columns of the encoded and decoded rows."""
    def finish(c, texts, ids, bounds):
        name = c.text_of
        decoded = c.decode(ids)
        return [
            pa.array([len(x) for x in ids], pa.int64()),
            pa.array([hashlib.sha256(",".join([name[i] for i in x]).encode()).hexdigest() for x in ids]),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded]),
            pa.array([int(b[-1] - b[0]) for b in bounds], pa.int64()),
        ]

    return encode_map(df, model, finish, "n_tokens bigint, ids_sha256 string, decoded_sha256 string, "
                      "covered_bytes bigint", keep=["doc_id"])


@register("op4_sentencepiece")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(read_table(spark, sf_dir, "documents"), default_model())


# ------------------------------------------------------------------ 5

OP5_SQL = """
WITH e AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT DISTINCT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@register("op5_exact_topk", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"), F.pmod(F.col("vec_id"), F.lit(100)) == 0)


# ------------------------------------------------------------------ 6

@register("op6_secret_scans")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(read_table(spark, sf_dir, "documents"), keep=["doc_id"])
    base = F.filter("found", lambda s: s.kind.isin(*BASE_KINDS))

    def line(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("found", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in BASE_KINDS],
                        F.sha2(line(base), 256).alias("base_sha256"), line(F.col("found")).alias("spans"))


# ------------------------------------------------------------------ 8

@register("op8_lm_scoring")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(read_table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 5) == 1)
