"""The corpus pipeline: five stages from raw documents to token digests.

Each stage is ``(name, function(spark, docs, sf_dir))``; its result is written as
Parquet and read back as the next stage's documents. All but the last return the
columns they got (``doc_id, text, lang, source, n_chars`` for ``documents``).

1. quality: a document whose quality score is below the classifier's threshold
   goes. The model learns from the labels of the documents at hand.
2. line_dedup: passages that repeat across documents are cut from all but the
   first; documents that stage 3 will drop as near copies keep what they share
   with their original, which that stage needs. A document
   that had words and has none left goes; ``n_chars`` follows the text.
3. near_duplicates: one document of each class of 5-word shingle similarity 0.8
   or more stays, the one with the smallest id.
4. decontamination: documents that hold a benchmark passage go.
5. sentencepiece: every remaining text is encoded and decoded; the digests of
   both are the result.

No stage drops rows for any other reason. Null texts are empty documents to
stages 1, 3 and 5, and pass 2 and 4 unchanged.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.llm.common import crc_mod, read_table
from ridgeline.llm.decontamination import decontaminate
from ridgeline.llm.line_dedup import dedup_lines
from ridgeline.llm.ngram_jaccard import drop_near_duplicates
from ridgeline.llm.quality import THRESHOLD, fit_documents, text_score
from ridgeline.llm.queries import default_model, piece_digests
from ridgeline.session import scratch_path

#: A document of whose words this share repeats one other document may be a copy of
#: it; it is one if the two pass the test of the near-duplicate stage, NEAR.
COPY_SHARE = 0.6
#: Shingle words and least Jaccard coefficient (num, den) of near duplicates.
NEAR = (5, 80, 100)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit_documents(docs, read_table(spark, sf_dir, "labels"), crc_mod(F.col("doc_id"), 5) != 0)
    return docs.where(text_score(model)(F.coalesce("text", F.lit(""))) >= THRESHOLD)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = dedup_lines(docs, copy_share=COPY_SHARE, report="_removed", copy_test=NEAR)
    changed = F.size("_removed") > 0
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(changed, F.char_length("text").cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    return cut.where(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, *NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_digests(docs, default_model())


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("sentencepiece", sentencepiece)]

#: A fitted classifier and a tokenizer are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    base = scratch_path(spark, f"llm/pipeline-{uuid.uuid4().hex}")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.mode("overwrite").parquet(f"{base}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{name}")
    return docs
