"""Quoted tab-separated records from files that many tasks read piece by piece.

A line break inside quotes does not end a record, so whether a line starts one depends on all lines before it.
Each line is a function from "starts inside quotes" to "ends inside quotes": it keeps the state, swaps it or sets
it. Such functions are put together by sums of swaps since the last line that sets, first for the pieces of a
file, then for the lines of a piece; no task reads more than its piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finchlake.session import written


def _closes(field: Column) -> Column:
    """True if a quote that is not doubled stands in the field."""
    return F.replace(field, F.lit('""'), F.lit("")).contains('"')


def _ends_inside(line: Column, starts_inside: bool, sep: str) -> Column:
    """Whether the quotes are open after the line; a quote opens a field only as its first character."""
    return F.aggregate(
        F.split(line, sep, -1), F.lit(starts_inside),
        lambda inside, field: F.when(inside, ~_closes(field)).otherwise(
            field.startswith('"') & ~_closes(F.substring(field, 2, 2_000_000_000))))


def tsv_records(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """value: one row per record of the files under ``path``, its line breaks kept, empty lines left out.

    Lines end in ``\\n`` or ``\\r\\n``. Quotes are doubled inside a quoted field. Quotes still open at the end of
    a file end with it. Files without rows give none.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), "value")
    quoted = F.col("value").contains('"')
    fresh = F.when(quoted, _ends_inside(F.col("value"), False, sep)).otherwise(F.lit(False))
    open_ = F.when(quoted, _ends_inside(F.col("value"), True, sep)).otherwise(F.lit(True))
    lines = lines.withColumn("_fresh", fresh).withColumn("_open", open_)
    lines = lines.withColumn("swap", (F.col("_fresh") & ~F.col("_open")).cast("int")).withColumn(
        "sets", F.when(F.col("_fresh") == F.col("_open"), F.col("_fresh").cast("int"))).drop("_fresh", "_open")
    pieces = _entry_states(_piece_functions(lines))

    # Both sides are dealt by piece, which the windows below need anyway.
    by_piece = Window.partitionBy("file", "block").orderBy("seq")
    before = by_piece.rowsBetween(Window.unboundedPreceding, -1)
    so_far = by_piece.rowsBetween(Window.unboundedPreceding, 0)
    known = lines.join(pieces.hint("shuffle_hash"), ["file", "block"])
    known = known.withColumn("swaps", F.sum("swap").over(so_far))
    known = known.withColumn("base", F.when(F.col("sets").isNotNull(), (F.col("sets") + F.col("swaps")) % 2))
    state = (F.coalesce(F.last("base", True).over(before), F.col("entry"))
             + F.coalesce(F.sum("swap").over(before), F.lit(0))) % 2
    after = (F.coalesce(F.last("base", True).over(so_far), F.col("entry")) + F.col("swaps")) % 2
    known = known.withColumn("inside", state == 1).withColumn("stays", after == 1)
    start = F.when(~F.col("inside"), F.struct("block", "seq"))
    parts = written(known.withColumn("start", F.last(start, True).over(so_far)).select(
        "file", "block", "seq", "value", "start", (~F.col("inside") & ~F.col("stays")).alias("whole")), "tsv-lines")

    # Only records of several lines are grouped; a record's start may lie in an earlier piece.
    last_starts = parts.where(F.col("start").isNotNull()).groupBy("file", "block").agg(F.max("start").alias("last"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = parts.select("file", "block").distinct().join(last_starts, ["file", "block"], "left")
    carried = blocks.select("file", "block", F.last("last", True).over(earlier).alias("carried"))
    fragments = parts.where(~F.col("whole")).join(carried, ["file", "block"])
    several = fragments.groupBy("file", F.coalesce("start", "carried").alias("start")).agg(
        F.array_sort(F.collect_list(F.struct("block", "seq", "value"))).alias("lines"))
    joined = several.select(F.array_join(F.transform("lines", lambda p: p["value"]), "\n").alias("value"))
    records = parts.where("whole").select("value").unionByName(joined)
    return records.select(F.regexp_replace("value", r"\r\z", "").alias("value")).where("value <> ''")


def _piece_functions(lines: DataFrame) -> DataFrame:
    """file, block, swaps, base: each piece as one function of the state it starts in."""
    # Swaps after the last line that sets = all swaps less those up to it, which needs an order; the line's
    # own number gives it, within partial sums of the one task that read the piece.
    in_piece = Window.partitionBy("file", "block").orderBy("seq")
    sums = lines.select("file", "block", "seq", "swap", "sets").withColumn(
        "swaps", F.sum("swap").over(in_piece.rowsBetween(Window.unboundedPreceding, 0)))
    base = F.when(F.col("sets").isNotNull(), F.struct("seq", ((F.col("sets") + F.col("swaps")) % 2).alias("base")))
    return sums.groupBy("file", "block").agg(F.sum("swap").alias("swaps"), F.max(base)["base"].alias("base"))


def _entry_states(pieces: DataFrame) -> DataFrame:
    """file, block, entry: 1 if the piece starts inside quotes. One row a piece, windows by file."""
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    run = pieces.withColumn("run", F.sum("swaps").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    # After a piece with a setting line the state is base + its swaps, whatever came before.
    anchor = F.when(F.col("base").isNotNull(), (F.col("base") + F.col("swaps") + F.col("run")) % 2)
    run = run.withColumn("anchor", anchor)
    entry = (F.coalesce(F.last("anchor", True).over(before), F.lit(0))
             + F.coalesce(F.sum("swaps").over(before), F.lit(0))) % 2
    return run.select("file", "block", entry.alias("entry"))


def parsed(records: DataFrame, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """The fields of ``records(value)`` as columns, by Spark's own parser of one record."""
    return records.select(F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "), options).alias("r")).select("r.*")
