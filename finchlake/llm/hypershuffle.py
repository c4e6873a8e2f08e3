"""Operator 3: uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Rows lie in blocks. How many rows of each block go to each shard is drawn first, as a matrix whose rows
sum to the block sizes and whose columns sum to the shard sizes, with the probability that a uniform
shuffle gives it. Then every block is permuted locally and cut by its row of the matrix, the rows are
exchanged, and each shard is permuted again. Only the block sizes reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finchlake.llm.common import column, packed, shuffle_partitions, unpacked

ROWS_PER_BLOCK = 200_000


def draw_hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` items taken without return from ``good`` + ``bad`` are good.

    Inverts the distribution over its support, or where that is long, over twelve standard deviations
    around the mean; what lies beyond is smaller than a double can show. Unlike numpy's own sampler it
    has no limit on the counts.
    """
    low, high = max(0, drawn - bad), min(good, drawn)
    if low == high:
        return low
    total = good + bad
    share = good / total
    mean = drawn * share
    spread = (drawn * share * (1 - share) * (total - drawn) / max(1, total - 1)) ** 0.5
    low, high = max(low, int(mean - 12 * spread) - 12), min(high, int(mean + 12 * spread) + 12)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log((good - k) * (drawn - k)) - np.log((k + 1) * (bad - drawn + k + 1))
    logs = np.concatenate(([0.0], np.cumsum(steps)))
    sums = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(sums, rng.random() * sums[-1], side="right").clip(0, high - low))


def communication_matrix(blocks: Sequence[int], shards: Sequence[int], seed: int) -> list[list[int]]:
    """Rows drawn one after another, cells of a row one after another: the exact joint distribution."""
    if sum(blocks) != sum(shards):
        raise ValueError("block and shard sizes have different sums")
    rng = np.random.default_rng(seed)
    left = list(shards)
    matrix = []
    for size in blocks:
        row, others, need = [], sum(left), size
        for s, room in enumerate(left):
            others -= room
            take = draw_hypergeometric(rng, room, others, need)
            row.append(take)
            left[s] -= take
            need -= take
        matrix.append(row)
    return matrix


def even_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def hypergeometric_shuffle(
    df: DataFrame, keys: list[str], shards: int, seed: int = 20_011, blocks: int | None = None
) -> DataFrame:
    """``df`` with ``shard`` (from 0; shard sizes at most one apart) and ``slot`` (gapless from 0 in a shard).

    ``keys`` name a row; the permutations are orders of its hashes, so reruns and recomputed tasks agree.
    Null keys are hashed like any other value. Rows with equal keys meet in one block and are told apart
    by their other columns; fully equal rows are interchangeable. An empty table gives no rows. Columns
    of ``df`` named shard or slot are replaced.
    """
    ids = [column(k) for k in keys]

    def placed(frame: DataFrame, n_blocks: int) -> DataFrame:
        return packed(
            frame,
            block=F.pmod(F.xxhash64(F.lit(seed), *ids), F.lit(n_blocks)).cast("int"),
            first=F.xxhash64(F.lit(seed + 1), *ids), second=F.xxhash64(F.lit(seed + 2), *ids),
        )

    total = df.count()
    n_blocks = blocks or max(shuffle_partitions(df), -(-total // ROWS_PER_BLOCK))
    sizes = {r["block"]: r["n"] for r in
             placed(df.select(*ids), n_blocks).groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()}
    matrix = communication_matrix(
        [sizes.get(b, 0) for b in range(n_blocks)], even_sizes(total, shards), seed
    )
    # A row of the matrix as running sums: the local position is compared with them.
    cells = ";".join(",".join(map(str, np.cumsum(row))) for row in matrix)
    bounds = df.sparkSession.range(n_blocks).select(
        F.col("id").cast("int").alias("block"),
        F.split(F.get(F.split(F.lit(cells), ";"), F.col("id").cast("int")), ",").cast("array<long>").alias("ends"),
    )

    def sharded(frame: DataFrame, tie: list) -> DataFrame:
        local = Window.partitionBy("block").orderBy("first", *tie)
        ranked = placed(frame, n_blocks).withColumn("position", F.row_number().over(local) - 1)
        return ranked.join(F.broadcast(bounds), "block").withColumn(
            "shard", F.size(F.filter("ends", lambda e: e <= F.col("position")))
        ).withColumn("cell", F.pmod("second", F.lit(n_blocks)).cast("int"))

    # The order of rows with equal keys does not change the counts, so these need the keys alone.
    counts = sharded(df.select(*ids), []).groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(
        F.sum("n").over(Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    starts = counts.select("shard", "cell", before.alias("start"))
    tie = [F.xxhash64(F.lit(seed + 3), F.col("row"))]
    within = Window.partitionBy("shard", "cell").orderBy("second", "first", *tie)
    ranked = sharded(df, tie).withColumn("rank", F.row_number().over(within) - 1)
    slotted = ranked.join(starts, ["shard", "cell"]).withColumn("slot", (F.col("start") + F.col("rank")).cast("long"))
    return unpacked(slotted, ["shard", "slot"], df.columns)
