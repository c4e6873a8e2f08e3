"""Helpers that the operators of this folder share.

Operators pack every input column into one struct before they add columns of their own, so a column of
the input can never clash with an internal name; outputs replace input columns of the same name.
"""

from __future__ import annotations

import json

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW = "row"
ROWS_PER_BATCH = 1_000
ROWS_PER_RANGE = 50_000
MAX_RANGES = 20_000
SAMPLED_KEYS = 200_000   # keys that choose the cuts of text keys; every row is dealt by them


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """``row`` (all columns of ``df``) and the given expressions over the columns of ``df``."""
    whole = F.struct(*[F.col(_quoted(c)) for c in df.columns]).alias(ROW)
    return df.select(whole, *[c.alias(name) for name, c in columns.items()])


def unpacked(df: DataFrame, outputs: list[str], fields: list[str] | None = None) -> DataFrame:
    """The packed columns again, followed by ``outputs``, which win over packed columns of the same name."""
    taken = {name.lower() for name in outputs}
    names = fields or df.schema[ROW].dataType.fieldNames()
    kept = [F.col(ROW).getField(f).alias(f) for f in names if f.lower() not in taken]
    return df.select(*kept, *outputs)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(_quoted(name)).cast("string"), F.lit(""))


def column(name: str) -> Column:
    return F.col(_quoted(name))


def identity(*columns: Column) -> tuple[Column, Column]:
    """128 bits that name a row by its content: equal rows have equal ones, nulls included."""
    return F.xxhash64(F.lit(11), *columns), F.xxhash64(F.lit(23), *columns)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def range_count(df: DataFrame, least: int) -> int:
    """How many key ranges the rows of ``df`` are worth: one for ROWS_PER_RANGE of them, between ``least`` and MAX_RANGES."""
    return max(least, min(MAX_RANGES, -(-df.count() // ROWS_PER_RANGE)))


def key_ranges(df: DataFrame, key: str, parts: int):
    """A function that adds ``part``, rising with ``key``, to a frame; parts hold about equal row counts.

    The cuts are quantiles of the key column, which is all that is read for them; for keys that are no numbers,
    those of a bounded number of distinct keys, chosen by their hash. A part is a pure function of the key, so
    recomputed tasks agree. Null keys come first.
    """
    kind = df.schema[key].dataType
    if not isinstance(kind, (T.NumericType, T.TimestampType)):
        return _text_ranges(df, key, parts)
    place = F.coalesce(column(key).cast("double"), F.lit(float("-inf")))
    cuts: list[float] = []
    if parts > 1:
        shares = [i / parts for i in range(1, parts)]
        cuts = sorted(set(df.select(place.alias("_k")).approxQuantile("_k", shares, 0.1 / parts)))
    cuts = [c for c in cuts if c != float("-inf")]

    def add(frame: DataFrame) -> DataFrame:
        if not cuts:
            return frame.withColumn("part", F.lit(0))
        edges = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="_place", outputCol="part")
        placed = edges.transform(frame.withColumn("_place", place)).drop("_place")
        return placed.withColumn("part", F.col("part").cast("int"))

    return add


def _text_ranges(df: DataFrame, key: str, parts: int):
    """:func:`key_ranges` for keys compared as text, in the order of their UTF-8 bytes."""
    name = column(key).cast("string")
    keys = df.select(name.alias("_k")).where("_k IS NOT NULL").distinct()
    picked = sorted((r["_k"] for r in keys.orderBy(F.xxhash64("_k"), "_k").limit(SAMPLED_KEYS).collect()),
                    key=lambda k: k.encode("utf-8"))
    places = sorted({len(picked) * i // parts for i in range(1, parts)} - {0})
    cuts = [picked[i] for i in places if i < len(picked)]
    width = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i:i + width] for i in range(0, len(cuts), width)]

    def add(frame: DataFrame) -> DataFrame:
        if not cuts:
            return frame.withColumn("part", F.lit(0))
        table = F.from_json(F.lit(json.dumps(groups)), "array<array<string>>")
        group = F.size(F.filter(table, lambda g: g[0] <= name)) - 1
        within = F.size(F.filter(F.get(table, group), lambda c: c <= name))
        part = F.when(name.isNull() | (group < 0), F.lit(0)).otherwise(group * width + within)
        return frame.withColumn("part", part.cast("int"))

    return add


def small_batches(df: DataFrame) -> None:
    """Let the session send whole texts to Python in batches of at most ROWS_PER_BATCH rows.

    Spark's default of 10,000 rows takes a Python worker several hundred MB for texts of some kilobytes.
    The setting is only ever lowered; it changes no result.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= ROWS_PER_BATCH:
        conf.set(name, str(ROWS_PER_BATCH))
