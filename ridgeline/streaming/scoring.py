"""Scoring applicant rows as they arrive (Structured Streaming).

The reference scores one applicant at a time as a form is submitted. The
same batch operators (input completion R1, the fitted pipeline, the score
card R2-R5) apply unchanged to a streaming DataFrame: every step is a
per-row projection, so the stream needs no state, no watermark and no
shuffle. Each micro-batch is written with ``foreachBatch`` (any batch
sink, idempotent per epoch id) and the checkpoint location lives in the
shared checkpoint folder, so a restarted query resumes exactly where it
stopped.
"""

from __future__ import annotations

import os

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ridgeline.operators.score import complete_inputs, score_card
from ridgeline.session import checkpoint_dir


def score_applicants(applicants: DataFrame, model: PipelineModel, feature_cols: list[str],
                     defaults: dict[str, float], categories: dict[str, list[str]],
                     dataset_mean: float, key: str) -> DataFrame:
    """Batch or streaming: complete inputs, predict, build the score card."""
    completed = complete_inputs(applicants, feature_cols, defaults, categories, keep=[key])
    predicted = model.transform(completed)
    return score_card(predicted, "prediction", dataset_mean, keep=[key])


def start_scoring_stream(spark: SparkSession, source: DataFrame, model: PipelineModel,
                         feature_cols: list[str], defaults: dict[str, float],
                         categories: dict[str, list[str]], dataset_mean: float, key: str,
                         sink_path: str, name: str = "applicant_scores",
                         trigger_seconds: int | None = None):
    """Start a streaming query writing score cards as Parquet micro-batches.

    ``source`` is a streaming DataFrame (e.g. ``spark.readStream.schema(...)
    .parquet(folder)``). The query checkpoint goes under the shared
    checkpoint folder named by ``spark.checkpoint.dir``."""
    scored = score_applicants(source, model, feature_cols, defaults, categories, dataset_mean, key)

    def write(batch: DataFrame, epoch_id: int) -> None:
        # a replayed epoch replaces its folder, so its rows are there once
        batch.write.mode("overwrite").parquet(os.path.join(sink_path, f"epoch={epoch_id}"))

    writer = (scored.writeStream.queryName(name)
              .option("checkpointLocation", os.path.join(checkpoint_dir(spark), "streams", name))
              .foreachBatch(write))
    if trigger_seconds:
        writer = writer.trigger(processingTime=f"{trigger_seconds} seconds")
    return writer.start()
