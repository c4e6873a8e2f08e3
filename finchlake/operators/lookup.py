"""Joins of a large fact table with a keyed dimension, safe against hot keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finchlake.operators.pieces import replaced

ROWS_PER_TASK = 1_000_000   # facts of one key that a task may hold before the key is salted
MOST_HOT = 1_000_000        # and the most keys that the salts are told for
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(df: DataFrame) -> bool:
    """True when ``df`` is proven small: it is counted and measured, never assumed.

    Only BROADCAST_ROWS + 1 rows are looked at, so the check itself is bounded.
    """
    width = reduce(
        lambda a, b: a + b,
        [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 16 for c in df.columns],
    )
    seen = df.limit(BROADCAST_ROWS + 1).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")
    ).first()
    return seen["n"] <= BROADCAST_ROWS and seen["bytes"] <= BROADCAST_BYTES


def hot_keys(dim: DataFrame, keys: list[str], weight: str, rows_per_task: int) -> DataFrame:
    """``keys`` and ``_salts`` of the keys with more than ``rows_per_task`` facts (``weight``).

    The salts follow the facts, so a task holds about as many rows of a key however often it occurs. Where
    the facts would give more than MOST_HOT such keys, the limit is the MOST_HOT-th part of all facts:
    fewer keys than that can exceed it, so broadcasting the table is always safe.
    """
    share = dim.agg((F.sum(weight) / MOST_HOT).alias("share")).scalar()
    limit = F.greatest(F.lit(float(rows_per_task)), F.coalesce(share, F.lit(0.0)))
    return dim.where(F.col(weight) > limit).select(
        *keys, F.ceil(F.col(weight) / limit).cast("int").alias("_salts"))


def _salted_join(
    facts: DataFrame, dim: DataFrame, keys: list[str], hot: DataFrame, spread: Column, how: str
) -> DataFrame:
    """Facts of a hot key go to as many tasks as it has salts; only its few rows of ``dim`` are repeated."""
    hot = F.broadcast(hot)
    salts = F.coalesce("_salts", F.lit(1))
    left = facts.join(hot, keys, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(spread), salts).cast("int")).drop("_salts")
    right = dim.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def weighted_lookup(
    facts: DataFrame, dim: DataFrame, key: str, weight: str, spread: Column, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Inner join of ``facts`` with the unique-keyed ``dim``, hot keys salted.

    ``weight`` is the number of facts per key and ``spread`` any column expression that varies within
    a key (such as the id of the row). Where ``dim`` is small, Spark still turns this into a broadcast join.
    """
    hot = hot_keys(dim, [key], weight, rows_per_task)
    return _salted_join(facts, dim, [key], hot, spread, "inner")


def keyed_lookup(
    facts: DataFrame, dim: DataFrame, keys: list[str], spread: Column, how: str = "left",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join ``facts`` with the unique-keyed ``dim``: broadcast if ``dim`` is proven small.

    A larger ``dim`` is joined by shuffle with its hot keys, found by counting the facts, salted.
    """
    if fits_broadcast(dim):
        return facts.join(F.broadcast(dim), keys, how)
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    counts = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return _salted_join(facts, dim, keys, hot_keys(counts, keys, "_n", rows_per_task), spread, how)


def substitute_tokens(
    df: DataFrame, key: str, tokens: str, mapping: DataFrame, into: str | None = None
) -> DataFrame:
    """Replace every token found in ``mapping(token, replacement)``; others stay.

    Returns ``df`` with ``into`` (by default ``tokens`` itself) replaced; ``key`` must be unique. Documents are
    dealt to pieces, whose distinct tokens meet ``mapping``: no row is exchanged, sorted or collected by token.
    """
    into = into or tokens
    size = df.agg(F.sum(F.octet_length(F.array_join(tokens, " ")))).first()[0] or 0
    if into == tokens and set(df.columns) == {key, tokens}:
        return replaced(df, key, tokens, mapping, size, by_row=True).select(*df.columns)
    arrays = replaced(df.select(key, F.col(tokens).alias("_sub")), key, "_sub", mapping, size, by_row=False)
    empty = F.array().cast("array<string>")
    return (
        df.join(arrays, key, "left")
        .withColumn(into, F.coalesce("_sub", empty))
        .drop("_sub")
    )
