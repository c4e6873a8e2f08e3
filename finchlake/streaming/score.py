"""Scoring of text that arrives as a stream of files."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from finchlake.plans.model import score


def read_text_stream(
    spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Parquet files landing in ``folder`` as a streaming frame."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def score_stream(
    model: PipelineModel, texts: DataFrame, out: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Write every incoming row with its predicted label to ``out``.

    Each row is scored by itself, so the query keeps no state. With ``once`` it stops when all files
    present have been scored.
    """
    writer = (
        score(model, texts).writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
    )
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
