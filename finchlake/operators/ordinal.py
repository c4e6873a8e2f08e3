"""Global row positions, contiguous splits and folds without a one-partition window."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finchlake.session import written

ROWS_PER_BUCKET = 100_000
MAX_BUCKETS = 20_000
ROW_BITS = 33   # monotonically_increasing_id keeps the row's number in its partition in so many low bits


def ordinal(df: DataFrame, key: str, into: str = "ord", buckets: int | None = None) -> tuple[DataFrame, int]:
    """Add the 0-based position of every row in ``key`` order; also return the row count.

    ``key`` must be a unique number. Its quantiles cut the key range into buckets of about equal size
    however the keys are spread; rows are numbered within their bucket and shifted by the number of
    rows in earlier buckets. The passes for quantiles and bucket sizes read the key column only, and
    the bucket is a pure function of the key, so a recomputed task gives the same numbers.
    """
    keys = df.select(F.col(key).cast("double").alias("_k"))
    total = df.count()
    if buckets is None:
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = min(MAX_BUCKETS, max(tasks, -(-total // ROWS_PER_BUCKET)))
    cuts: list[float] = []
    if buckets > 1 and total > 1:
        shares = [i / buckets for i in range(1, buckets)]
        cuts = sorted(set(keys.approxQuantile("_k", shares, 0.1 / buckets)))

    def bucketed(frame: DataFrame) -> DataFrame:
        if not cuts:
            return frame.withColumn("_b", F.lit(0))
        edges = Bucketizer(
            splits=[float("-inf"), *cuts, float("inf")], inputCol="_k", outputCol="_b"
        )
        placed = edges.transform(frame.withColumn("_k", F.col(key).cast("double")))
        return placed.withColumn("_b", F.col("_b").cast("int")).drop("_k")

    sizes = {r["_b"]: r["n"] for r in
             bucketed(df.select(key)).groupBy("_b").agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, run = [], 0
    for b in range(len(cuts) + 1):
        starts.append(run)
        run += sizes.get(b, 0)
    shifts = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<long>")
    offset = F.get(shifts, F.col("_b"))
    within = F.row_number().over(Window.partitionBy("_b").orderBy(key)) - 1
    return bucketed(df).withColumn(into, offset + within).drop("_b"), total


def positions(df: DataFrame, by: list[str | Column], into: str = "ord") -> tuple[DataFrame, int]:
    """Add the 0-based position of every row in the order ``by``, for keys of any kind; also the row count.

    ``by`` holds columns or sort expressions (text, several columns, descending). Rows are dealt to ranges of
    the order, sorted within them and written once, with the number that Spark gives a row of a range; ranges
    are then shifted by the sizes of the earlier ones, one number each. One exchange, and no range holds more
    than its part of the rows unless they are equal in ``by``; such ties get neighbouring positions in any
    order. Being written, positions stay when a task is repeated. An empty table gives no rows.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(MAX_BUCKETS, max(tasks, -(-df.count() // ROWS_PER_BUCKET)))
    ranged = df.repartitionByRange(ranges, *by).sortWithinPartitions(*by)
    numbered = written(ranged.withColumn("_at", F.monotonically_increasing_id()), "positions")
    part = F.shiftright("_at", ROW_BITS).cast("int")
    sizes = {r["part"]: r["n"] for r in numbered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, total = [], 0
    for i in range(ranges):
        starts.append(total)
        total += sizes.get(i, 0)
    shifts = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<long>")
    within = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return numbered.withColumn(into, F.get(shifts, part) + within).drop("_at"), total


def train_size(total: int, share: float) -> int:
    return int(share * total)


def is_train(total: int, share: float, ord_col: str = "ord") -> Column:
    """True for the contiguous first part of the rows."""
    return F.col(ord_col) < train_size(total, share)


def fold_width(total: int, folds: int) -> int:
    return int(total / folds) + 1


def fold_id(total: int, folds: int, ord_col: str = "ord", legacy_tail: bool = False) -> Column:
    """Contiguous fold number; null for a row that is never tested.

    The fold width may leave fewer folds than asked for. With ``legacy_tail`` the very last row
    belongs to no test fold.
    """
    fold = F.floor(F.col(ord_col) / fold_width(total, folds)).cast("int")
    if legacy_tail:
        return F.when(F.col(ord_col) < total - 1, fold)
    return fold
