"""Documents to rows and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def laid_out(df: DataFrame, key: str) -> DataFrame:
    """``df`` hash-partitioned by ``key`` into the configured number of shuffle partitions.

    Meant for documents while they are one compact row each: whatever is later exploded from them and
    grouped by ``key`` (and more) needs no further exchange. The number is explicit because the size
    of the texts says little about the size of what is exploded from them.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, key)


def spread(scan: DataFrame) -> DataFrame:
    """A plain table scan, spread over all cores if its files give fewer splits than there are cores.

    Cleaning and tokenizing cost far more CPU per byte than an exchange, so a few large row groups
    would leave most of a cluster idle. A scan with enough splits is left alone.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def element_rows(df: DataFrame, keep: list[str], array: str | Column, into: str) -> DataFrame:
    """One row per element of ``array``.

    An inner explode makes the optimizer infer a filter on the array's size, which it pushes below the
    projections that compute the array, so that they run twice. The outer form with a filter on the
    element gives the same rows without that.
    """
    rows = df.select(*keep, F.explode_outer(array).alias(into))
    return rows.where(F.col(into).isNotNull())


def exploded(df: DataFrame, key: str, tokens: str) -> DataFrame:
    """key, pos, token: one row per token with its position."""
    rows = df.select(key, F.posexplode_outer(tokens).alias("pos", "token"))
    return rows.where(F.col("token").isNotNull())


def collected(df: DataFrame, key: str, token: str, into: str) -> DataFrame:
    """Back from one row per token to one array per document (a document's own tokens only)."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", F.col(token).alias("_t"))))
    return df.groupBy(key).agg(F.transform(ordered, lambda s: s["_t"]).alias(into))
