"""Operator 11: importance weights of documents towards a target corpus, by bit-sliced aggregation.

Words (or runs of them) hash to buckets. A bucket's gain is the rounded log ratio of its share in the
target to its share in the source, and a document's weight the sum of the gains of its features. The sum is
taken over bit planes: plane j of a document holds a bit for every bucket whose count has bit j set, and the
gains have one plane per bit and sign. Plane by plane, the bits that both have are counted and weighed by
the power of two they stand for, so weights are exact integers. A part of the documents with the highest
weights, disturbed by Gumbel noise that depends on the key alone, is drawn.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from finchlake.llm.common import column, small_batches, text_or_empty, unpacked
from finchlake.operators.ordinal import positions
from finchlake.session import written

BUCKETS = 10_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]++"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ROWS_AT_A_TIME = 256   # documents whose planes are held at once
OUTPUTS = ["n_features", "weight", "score", "rank"]


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def feature_buckets(found: Column, longest: int, buckets: int) -> Column:
    """The bucket of every run of 1 to ``longest`` words, repeats included."""
    def bucket(feature: Column) -> Column:
        return F.pmod(F.crc32(feature.cast("binary")), F.lit(buckets)).cast("int")

    def runs(n: int) -> Column:
        starts = F.when(F.size(found) >= n, F.sequence(F.lit(1), F.size(found) - (n - 1))).otherwise(
            F.array().cast("array<int>"))
        return F.transform(starts, lambda i: bucket(F.array_join(F.slice(found, i, n), " ")))

    return F.concat(F.transform(found, bucket), *[runs(n) for n in range(2, longest + 1)])


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs in ``features(buckets)``: one number a bucket, whatever the corpus."""
    rows = features.select(F.explode("buckets").alias("b")).groupBy("b").agg(F.count(F.lit(1)).alias("n")).collect()
    out = np.zeros(buckets, dtype=np.int64)
    for r in rows:
        out[r["b"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(((t + 1) (S + n)) / ((s + 1) (T + n)))) of every bucket, in doubles."""
    n = len(source)
    above = (target + 1.0) * (float(source.sum()) + n)
    below = (source + 1.0) * (float(target.sum()) + n)
    return np.floor(1000 * np.log(above / below)).astype(np.int64)


def packed_bits(ones: np.ndarray) -> np.ndarray:
    """Rows of 0 and 1 as rows of 64-bit words."""
    bits = np.zeros((ones.shape[0], -(-ones.shape[1] // 64) * 64), dtype=np.uint8)
    bits[:, :ones.shape[1]] = ones
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def bit_planes(values: np.ndarray) -> list[np.ndarray]:
    """The planes of the non-negative ``values`` (rows x columns), lowest bit first."""
    return [packed_bits((values >> j) & 1) for j in range(int(values.max(initial=0)).bit_length())]


class Weigher:
    """Weights of documents from the planes of their bucket counts and the signed planes of the gains."""

    def __init__(self, gain: np.ndarray):
        self.buckets = len(gain)
        self.planes = [   # sign, power of two, plane
            (sign, k, plane[0]) for sign in (1, -1)
            for k, plane in enumerate(bit_planes(np.maximum(sign * gain, 0)[None, :]))]

    def weights(self, documents: list[np.ndarray]) -> np.ndarray:
        n = len(documents)
        sizes = np.array([len(d) for d in documents])
        flat = np.concatenate(documents).astype(np.int64) if sizes.sum() else np.zeros(0, dtype=np.int64)
        counts = np.bincount(np.repeat(np.arange(n), sizes) * self.buckets + flat, minlength=n * self.buckets)
        counts = counts.reshape(n, self.buckets)
        total, largest = np.zeros(n, dtype=np.int64), counts.max(axis=1, initial=0)
        for j in range(int(largest.max(initial=0)).bit_length()):
            held = np.flatnonzero(largest >= 1 << j)   # only documents with a count that long have this plane
            own = packed_bits((counts[held] >> j) & 1)
            for sign, k, bits in self.planes:
                total[held] += sign * (np.bitwise_count(own & bits).sum(axis=1, dtype=np.int64) << (j + k))
        return total


def noise(seed: int, key: Column) -> Column:
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of sha256 of ``seed:key``."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def importance_resample(
    df: DataFrame, key: str, text: str, target: DataFrame, target_text: str, buckets: int = BUCKETS,
    longest: int = 1, seed: int = 2024, least_words: int = 20, percent: int = 10, keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` of ``df`` (all but the text) with ``n_features``, ``weight``, ``score`` and ``rank``.

    Columns of these four names are replaced. A document's weight is the sum of its features' gains.

    ``percent`` of the rows with at least ``least_words`` words are drawn and ranked from 1 on by descending
    score, then by ``key`` (null last); other rows have a null rank. A null text has no features and weight
    0; rows that repeat are weighed and drawn each; rows equal in score and key are interchangeable. Without
    target texts, all gains come from the source. An empty table gives no rows. Memory is bounded by the
    planes of ROWS_AT_A_TIME documents and the bucket numbers of a batch; the driver sees one number a bucket.
    """
    small_batches(df)
    keep = [c for c in df.columns if c != text] if keep is None else keep
    kept = F.struct(F.lit(0).alias("any"), *[column(c).alias(c) for c in keep])
    found = df.select(kept.alias("row"), column(key).alias("key"), words(text_or_empty(text)).alias("found"))
    held = written(found.select(
        "row", "key", F.size("found").alias("n_words"), feature_buckets(F.col("found"), longest, buckets).alias("buckets"),
    ), "buckets")
    wanted = target.select(feature_buckets(words(text_or_empty(target_text)), longest, buckets).alias("buckets"))
    weigher = df.sparkSession.sparkContext.broadcast(
        Weigher(gains(bucket_counts(held, buckets), bucket_counts(wanted, buckets))))

    @F.pandas_udf(LongType())
    def weighed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            parts = [weigher.value.weights(list(batch.iloc[at:at + ROWS_AT_A_TIME]))
                     for at in range(0, len(batch), ROWS_AT_A_TIME)]
            yield pd.Series(np.concatenate(parts) if parts else [], dtype="int64")

    scored = held.select(
        "row", "key", "n_words", F.size("buckets").cast("long").alias("n_features"), weighed("buckets").alias("weight"))
    scored = written(scored.withColumn("score", F.col("weight") + noise(seed, F.col("key"))), "weights")
    fit = F.col("n_words") >= least_words
    order = [F.desc("score"), F.asc_nulls_last("key")]
    ranked, n = positions(scored.where(fit), order, "rank")
    drawn = F.when(F.col("rank") < percent * n // 100, F.col("rank") + 1).cast("long")
    rest = scored.where(~fit).withColumn("rank", F.lit(None).cast("long"))
    return unpacked(ranked.withColumn("rank", drawn).unionByName(rest), OUTPUTS, keep)
