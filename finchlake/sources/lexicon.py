"""Opinion word lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finchlake.functions.patterns import SPACE

_LINES = {"encoding": "ISO-8859-1", "sep": "\x01", "quote": "", "comment": "",
          "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct lowercase words of Latin-1 files with one word a line and ``;`` comment lines."""
    lines = spark.read.schema("line string").options(**_LINES).csv(path)
    word = F.regexp_replace(F.col("line"), f"^{SPACE}+|{SPACE}+$", "")
    words = lines.select(word.alias("word")).where((F.col("word") != "") & ~F.col("word").startswith(";"))
    return words.select(F.lower("word").alias("word")).distinct()


def write_word_list(df: DataFrame, path: str) -> None:
    """Write the single string column ``line`` as Latin-1 lines."""
    df.select("line").write.options(
        encoding="ISO-8859-1", sep="\x01", quote="", emptyValue="",
        ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
    ).csv(path)


def read_lexicon(spark: SparkSession, pos_path: str, neg_path: str) -> DataFrame:
    """word, polarity; a word in both lists appears twice."""
    pos = read_word_list(spark, pos_path).withColumn("polarity", F.lit("pos"))
    neg = read_word_list(spark, neg_path).withColumn("polarity", F.lit("neg"))
    return pos.unionByName(neg)
