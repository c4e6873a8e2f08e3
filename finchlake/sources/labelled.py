"""Labelled-text files and the error log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finchlake.operators.metrics import with_outcome
from finchlake.sources.records import parsed, tsv_records

LABELLED_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("text", T.StringType()),
])

# Quotes are doubled inside a quoted field and a quoted field may span lines.
_TSV = {
    "sep": "\t", "quote": '"', "escape": '"', "encoding": "UTF-8", "header": "false",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "emptyValue": "",
}


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """label, text from tab-separated files with columns id, label, text and no header.

    Quoted line breaks keep a file from being split: one task a file. :func:`read_labelled_pieces` has no such limit.
    """
    options = {**_TSV, "multiLine": "true", "nullValue": "\x00"}
    return spark.read.schema(LABELLED_SCHEMA).options(**options).csv(path).select("label", "text")


def read_labelled_pieces(spark: SparkSession, path: str) -> DataFrame:
    """The rows of :func:`read_labelled_with_id` (id, label, text), each file read by as many tasks as it has splits."""
    options = {**_TSV, "nullValue": "\x00"}
    rows = parsed(tsv_records(spark, path), LABELLED_SCHEMA, options)
    return rows.withColumn("id", F.col("id").cast("long"))


def read_labelled_with_id(spark: SparkSession, path: str) -> DataFrame:
    """Like :func:`read_labelled` but keeps the leading id as the row's order key."""
    options = {**_TSV, "multiLine": "true", "nullValue": "\x00"}
    rows = spark.read.schema(LABELLED_SCHEMA).options(**options).csv(path)
    return rows.withColumn("id", F.col("id").cast("long"))


def write_labelled(df: DataFrame, path: str) -> None:
    """Write id, label, text in the format that :func:`read_labelled` reads."""
    df.select(F.col("id").cast("string"), "label", "text").write.options(**_TSV).csv(path)


def write_error_log(predictions: DataFrame, path: str, scores: DataFrame | None = None) -> None:
    """Every evaluated row under ``path/rows``, partitioned by fold and outcome; scores beside it.

    ``predictions`` holds id, fold, true, pred and usually text.
    """
    log = with_outcome(predictions)
    log.write.partitionBy("fold", "outcome").mode("overwrite").parquet(f"{path}/rows")
    if scores is not None:
        scores.write.mode("overwrite").parquet(f"{path}/scores")


def read_error_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows")
