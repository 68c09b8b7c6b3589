"""Queries of the operators that read the whole corpus: 1, 3, 7, 9 and 10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.llm.common import crc_mod, read_table
from ridgeline.llm.decontamination import overlaps
from ridgeline.llm.license_scan import PERCENT, TEMPLATES, scan_licenses, template_bigrams
from ridgeline.llm.line_dedup import dedup_lines
from ridgeline.llm.ngram_jaccard import near_duplicates
from ridgeline.llm.quality import THRESHOLD, quality_scores
from ridgeline.llm.registry import register

# ------------------------------------------------------------------ 1

@register("op1_ngram_jaccard")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), k=3, num=90, den=100)


# ------------------------------------------------------------------ 3

@register("op3_decontamination")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


# ------------------------------------------------------------------ 7

def document_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; one document in five (by the crc32 of
    its id) teaches nothing."""
    fold = crc_mod(F.col("doc_id"), 5)
    return (quality_scores(documents, labels, fold != 0)
            .select("doc_id", (fold == 0).alias("held_out"), "score",
                    F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted")))


@register("op7_quality_classifier")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


# ------------------------------------------------------------------ 9

@register("op9_line_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = dedup_lines(read_table(spark, sf_dir, "documents"), report="removed")
    return cut.select("doc_id", F.size("removed").cast("long").alias("n_removed"), "removed", "text")


# ------------------------------------------------------------------ 10

def _op10_sql() -> str:
    rows = ",\n".join("('{}', [{}])".format(k, ", ".join(f"'{b}'" for b in template_bigrams(v)))
                      for k, v in TEMPLATES.items())
    low = "translate(seg, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH t(license, b) AS (VALUES {rows}),
p AS (
  SELECT doc_id, row_number() OVER () AS r,
         list_distinct(list_concat(list_concat(
           string_split(regexp_replace(text, '([.!?]) ', '\1' || chr(10), 'g'), chr(10)), string_split(text, chr(10))),
           string_split_regex(text, '\n[ \t\r]*\n'))) AS segs
  FROM documents WHERE text IS NOT NULL
), s AS (SELECT doc_id, r, unnest(segs) AS seg FROM p),
w AS (SELECT doc_id, r, list_filter(string_split(regexp_replace({low}, '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') AS words FROM s),
g AS (
  SELECT doc_id, r, list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS a
  FROM w WHERE len(words) >= 2
), m AS (
  SELECT doc_id, license, len(list_intersect(a, b)) AS i, len(a) AS na, len(b) AS nb FROM g JOIN t ON list_has_any(a, b)
)
SELECT doc_id, license, count(*) AS n_segments, max(2.0::DOUBLE * i / (na + nb)) AS dice
FROM m WHERE 200 * i >= {PERCENT} * (na + nb) GROUP BY doc_id, license
"""


@register("op10_license_scans", _op10_sql())
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (scan_licenses(read_table(spark, sf_dir, "documents"))
            .groupBy("doc_id", "license").agg(F.count(F.lit(1)).alias("n_segments"), F.max("dice").alias("dice")))
