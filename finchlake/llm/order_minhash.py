"""Operator 10: Order MinHash fingerprints, sensitive to edit distance.

A text is the sequence of its character k-mers, each numbered by how often it has occurred before. Every
entry of the fingerprint takes the few k-mers that are smallest in a random order, puts them back in text
order and hashes that tuple, so two texts agree in an entry only if they share k-mers in the same order.
The random orders are cells of one hash ring: the smallest at or after the start of a cell are taken, which
costs one hash per k-mer instead of one per entry, and leaves no entry empty in a short text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finchlake.llm.common import column, key_ranges, range_count, shuffle_partitions, small_batches, text_or_empty

K = 8               # code points of a k-mer
CELLS_LOG2 = 6
CELLS = 1 << CELLS_LOG2
TUPLE = 2           # k-mers of an entry
LIKELY = 16         # candidates per cell that are sorted at first
BASE = np.uint64(0x9E3779B97F4A7C15)
SHIFT = np.uint64(64 - CELLS_LOG2)
STARTS = np.arange(CELLS, dtype=np.uint64) << SHIFT
OUT = ("key string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def kmer_hashes(text: str, k: int = K) -> np.ndarray:
    """A hash of each k-mer in text order; a shorter text is one k-mer, an empty one has none."""
    h = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
    if not len(h):
        return h
    k = min(k, len(h))
    # Windows of 1, 2, 4 ... are joined to windows of k.
    out, done, power, width, factor = None, 0, h, 1, BASE
    with np.errstate(over="ignore"):
        while k:
            if k & 1:
                if out is None:
                    out = power
                else:
                    n = len(h) - done - width + 1
                    out = out[:n] * factor + power[done:done + n]
                done += width
            k >>= 1
            if k:
                power = power[:len(power) - width] * factor + power[width:]
                width, factor = 2 * width, factor * factor
        return mixed(out)


def occurrence_hashes(kmers: np.ndarray) -> np.ndarray:
    """A hash of each (k-mer, number of earlier occurrences)."""
    order = np.argsort(kmers, kind="stable")
    ordered = kmers[order]
    again = np.flatnonzero(ordered[1:] == ordered[:-1]) + 1
    if not len(again):
        return kmers
    first = np.ones(len(kmers), dtype=bool)
    first[again] = False
    index = np.arange(len(kmers))
    number = index - np.maximum.accumulate(np.where(first, index, 0))
    out = kmers.copy()
    with np.errstate(over="ignore"):
        out[order[again]] = mixed(ordered[again] + number[again].astype(np.uint64) * BASE)
    return out


def _ring(numbered: np.ndarray) -> np.ndarray:
    """Positions of the TUPLE smallest at or after every cell's start, one row per cell."""
    n = len(numbered)
    if n > 4 * CELLS * LIKELY:
        # Enough k-mers: those near the cell starts nearly always suffice, and they are few.
        span = np.uint64(((1 << 64) // n) * LIKELY)
        near = np.flatnonzero((numbered & ((np.uint64(1) << SHIFT) - np.uint64(1))) < span)
        counts = np.bincount((numbered[near] >> SHIFT).astype(np.int64), minlength=CELLS)
        if counts.min() < TUPLE:
            near = np.arange(n)
    else:
        near = np.arange(n)
    sorted_near = near[np.argsort(numbered[near], kind="stable")]
    at = np.searchsorted(numbered[sorted_near], STARTS)
    take = min(TUPLE, len(sorted_near))
    return sorted_near[(at[:, None] + np.arange(take)) % len(sorted_near)]


def signature(text: str) -> np.ndarray:
    """CELLS numbers of 16 bits; texts without a k-mer have zeros."""
    kmers = kmer_hashes(text)
    if not len(kmers):
        return np.zeros(CELLS, dtype="<u2")
    chosen = np.sort(_ring(occurrence_hashes(kmers)), axis=1)
    entry = np.zeros(CELLS, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(chosen.shape[1]):
            entry = mixed(entry * BASE + kmers[chosen[:, j]])
    return (entry >> np.uint64(48)).astype("<u2")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.count_nonzero(a == b)) / CELLS


def edited_text(text: str, following: str) -> str:
    """``text`` with its second half replaced by as many first code points of ``following``, or all."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def order_minhash(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` with n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one with the next smaller ``key``, after the last the first. Rows lie in key
    ranges, sorted; the only row that a range needs from another is the first of the range below, which is
    sent to both, so every text is exchanged once. A null text is empty, null keys come last, rows with
    equal keys are in text order. A table of one row has itself as next; an empty table gives no rows.
    """
    small_batches(df)
    docs = df.select(column(key).alias("key"), text_or_empty(text).alias("text"))
    ranges = range_count(df, 3 * shuffle_partitions(df))
    add_part = key_ranges(docs, "key", ranges)
    tops = {r["part"]: r["top"] for r in
            add_part(docs.select("key")).groupBy("part").agg(F.max("key").alias("top")).collect()}
    parts = sorted(tops)
    kind = df.schema[key].dataType.simpleString()
    sent = [(p, tops[p], parts[(i + 1) % len(parts)]) for i, p in enumerate(parts)]
    halo = df.sparkSession.createDataFrame(sent, f"part int, top {kind}, also int")
    joined = add_part(docs).join(F.broadcast(halo), "part")
    once = F.struct(F.col("part"), F.lit(False).alias("halo"))
    twice = F.array(once, F.struct(F.col("also").alias("part"), F.lit(True).alias("halo")))
    dealt = joined.select(
        "key", "text", F.explode(F.when(F.col("key").eqNullSafe(F.col("top")), twice).otherwise(F.array(once))).alias("to"))
    placed = dealt.select("to.part", "to.halo", "key", "text").repartition(
        max(shuffle_partitions(df), ranges // 3), "part")
    ordered = placed.sortWithinPartitions("part", "halo", F.col("key").desc_nulls_last(), "text")

    def scan(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in OUT.split(", ")]
        last, ended = None, None  # (part, key, text, signature) that waits for its next; part that is done

        def row(current, following: str, next_signature: np.ndarray) -> tuple:
            _, k, t, own = current
            edited = edited_text(t, following)
            changed = signature(edited)
            return (k, len(t), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                    own.tobytes().hex(), changed.tobytes().hex(), likeness(own, changed), likeness(own, next_signature))

        for batch in batches:
            out = []
            for p, h, k, t in zip(batch["part"].tolist(), batch["halo"].tolist(), batch["key"], batch["text"]):
                if h and p == ended:
                    continue  # other rows with the key of the row that closed the range
                own = signature(t)
                if last is not None:
                    out.append(row(last, t, own))
                last, ended = ((p, k, t, own), None) if not h else (None, p)
                if len(out) == 512:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=names)

    found = ordered.select("part", "halo", F.col("key").cast("string").alias("key"), "text").mapInPandas(scan, OUT)
    return found.withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)
