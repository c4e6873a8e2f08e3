"""Operator 7: line dedup with levelled sorted runs of line hashes.

Lines arrive in batches of documents. Every batch is reduced to (hash, number of documents), merge-anti-
joined with the runs of hashes that are already known to be too frequent, and written as a sorted run of
its own. As soon as a level holds ``fan`` runs they are merged into one of the next level, counts added
up; hashes that reach the limit there go to the runs of settled hashes and leave the counting. So every
count is rewritten once per level, however many batches come, and a very common line is counted in few.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finchlake.llm.common import identity, packed, text_or_empty, unpacked
from finchlake.session import fresh_path, written

# Fixed values of the line key: what is stripped at both ends, and the letters that lose their case.
STRIPPED = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(STRIPPED)), UPPER, LOWER)


def line_hash(line: Column) -> Column:
    """The 128-bit hash of a line's key; null for an empty key, which is never a repeated line."""
    key = line_key(line)
    return F.when(key != "", F.unhex(F.md5(key)))


class LineRuns:
    """The levels of sorted runs; each run is a written table (h, n) sorted by h, n documents hold h."""

    def __init__(self, spark: SparkSession, limit: int, fan: int = 3):
        self.spark, self.limit, self.fan = spark, limit, fan
        self.levels: list[list[DataFrame]] = [[]]
        self.settled: list[DataFrame] = []

    def _run(self, counts: DataFrame) -> DataFrame:
        path = fresh_path(self.spark, "line-run")
        counts.sortWithinPartitions("h").write.parquet(path)
        return self.spark.read.schema(counts.schema).parquet(path)

    def unsettled(self, batch: DataFrame) -> DataFrame:
        """The rows of ``batch`` (h, n) whose hash is in no settled run."""
        for run in self.settled:
            batch = batch.join(run.hint("merge"), "h", "left_anti")
        return batch

    def add(self, batch: DataFrame) -> None:
        """Count a batch (h, n; one row per hash) that the runs do not hold yet."""
        self.levels[0].append(self._run(self.unsettled(batch)))
        level = 0
        while len(self.levels[level]) >= self.fan:
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._compacted(self.levels[level]))
            self.levels[level] = []
            level += 1

    def _compacted(self, runs: list[DataFrame]) -> DataFrame:
        merged = written(self._merged(runs), "line-merge")
        self.settled.append(self._run(merged.where(F.col("n") >= self.limit).select("h")))
        if len(self.settled) >= self.fan:
            self.settled = [self._run(reduce(DataFrame.union, self.settled).distinct())]
        return self._run(merged.where(F.col("n") < self.limit))

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.union, runs).groupBy("h").agg(F.sum("n").alias("n"))

    def frequent(self) -> DataFrame:
        """h of every line found in at least ``limit`` documents of all batches."""
        runs = [run for level in self.levels for run in level]
        parts = [self._merged(runs).where(F.col("n") >= self.limit).select("h")] if runs else []
        # A hash that settled may have been counted again in part: batches beside it in its level.
        return reduce(DataFrame.union, [*parts, *self.settled]).distinct()


def drop_repeated_lines(
    df: DataFrame, text: str, limit: int = 10, batches: int = 4, fan: int = 3
) -> DataFrame:
    """``df`` without the lines whose key is found in at least ``limit`` documents (rows).

    ``text`` is replaced by the other lines joined by ``\\n``; ``n_lines`` (before) and ``n_dropped``
    are added. A null or empty text is one empty line and becomes empty; a document whose lines all go
    becomes empty. A key counts once per row, repeated rows count each. Empty keys never go. Nulls in
    other columns do not matter. An empty table gives no rows.
    """
    keys = identity(*[F.col(f"`{c}`") for c in df.columns])
    docs = packed(df, text=text_or_empty(text), a=keys[0], b=keys[1])
    lines = docs.select("a", "b", lines_of(F.col("text")).alias("lines"))
    hashes = F.filter(F.transform("lines", line_hash), lambda h: h.isNotNull())
    batch_of = F.pmod("a", F.lit(batches)).cast("int").alias("batch")
    seen = lines.select(batch_of, F.explode_outer(F.array_distinct(hashes)).alias("h"))
    seen = seen.where(F.col("h").isNotNull()).groupBy("batch", "h").agg(F.count(F.lit(1)).alias("n"))
    path = fresh_path(df.sparkSession, "line-batches")
    seen.write.partitionBy("batch").parquet(path)
    arrived = df.sparkSession.read.schema("h binary, n long, batch int").parquet(path)

    runs = LineRuns(df.sparkSession, limit, fan)
    for batch in range(batches):
        runs.add(arrived.where(F.col("batch") == batch).select("h", "n"))
    frequent = written(runs.frequent(), "line-frequent")

    placed = lines.select("a", "b", F.posexplode_outer(F.transform("lines", line_hash)).alias("pos", "h"))
    found = placed.where(F.col("h").isNotNull()).join(frequent, "h", "left_semi")
    dropped = found.groupBy("a", "b").agg(F.collect_set("pos").alias("dropped"))
    joined = docs.join(dropped, ["a", "b"], "left").withColumn("lines", lines_of(F.col("text")))
    n_lines = F.size("lines")
    kept = F.array_except(F.sequence(F.lit(0), n_lines - 1), F.coalesce("dropped", F.array().cast("array<int>")))
    pieces = F.transform(kept, lambda i: F.get(F.col("lines"), i))
    out = joined.select(
        "row", F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.array_join(pieces, "\n")).alias(text),
        n_lines.cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )
    return unpacked(out, [text, "n_lines", "n_dropped"], df.columns)
