"""Operator 5: near-duplicate documents by ProbMinHash over weighted word shingles.

A text is the set of its five-word shingles, weighted by how often they occur. Every shingle is a Poisson
process whose rate is its weight; each arrival falls on a random register, and a register keeps the
shingle that arrives first. Shingles stop as soon as their next arrival comes after all registers are
taken. Two texts agree in a register with the probability Jaccard similarity of their weights. Registers
are banded into bucket keys; texts that share a bucket are compared exactly.

Exact copies are one node. In a bucket, texts are compared with its most central one, that which lies in
the largest buckets, not with each other; where a bucket still holds several components after that, the
texts of the smaller ones are held against all texts of other components. Of these pairs, only those are
compared exactly whose sketches, four bits of each register, leave a similarity of SIMILAR possible at
SURE standard deviations. So a large group of copies costs one comparison each, and links beside its
centre still count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StructType

from finchlake.llm.common import column, packed, small_batches, text_or_empty, unpacked
from finchlake.llm.components import component_labels
from finchlake.llm.order_minhash import mixed
from finchlake.session import written

WORDS = 5
SIMILAR = 0.8
BANDS = 30
ROWS = 6
REGISTERS = 512                  # the first BANDS * ROWS are banded, the sketch holds all
SKETCH = REGISTERS // 16         # longs of 16 registers, four bits each
SURE = 3.5
CHUNK_BYTES = 500_000            # characters hashed at a time: what a worker holds, and keeps, beside its batch
ODD = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD1342543DE82EF95)
# ASCII letters, digits, the underscore and every byte of other characters make words.
IN_WORD = np.zeros(256, dtype=bool)
IN_WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = True


def _powers(n: int) -> np.ndarray:
    out = np.full(n, ODD, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def weighted_shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc, shingle, weight: the distinct shingles of each text, in order, and how often they occur.

    Words are lower-cased runs of word characters. A text of fewer than five words is one shingle; a text
    without words has none.
    """
    encoded = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\0".join(encoded) + b"\0", dtype=np.uint8)
    inside = IN_WORD[raw]
    first = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    last = np.flatnonzero(inside & ~np.concatenate((inside[1:], [False])))
    size = last - first + 1
    at = np.concatenate(([0], np.cumsum(size)[:-1]))
    place = np.arange(int(size.sum())) - np.repeat(at, size)
    letters = raw[inside].astype(np.uint64) + np.uint64(1)
    words = mixed(np.add.reduceat(letters * _powers(int(size.max()))[place], at) + size.astype(np.uint64) * STEP)
    begins = np.concatenate(([0], np.cumsum([len(e) + 1 for e in encoded])[:-1]))
    doc = np.searchsorted(begins, first, side="right") - 1
    index = np.searchsorted(doc, np.arange(len(texts) + 1))
    n_words = np.diff(index)
    # Windows that start in a text and end in it; for short texts, one that is filled up with zeros.
    padded = np.concatenate((words, np.zeros(WORDS, np.uint64)))
    left = index[doc + 1] - np.arange(len(words))
    starts = np.flatnonzero((left >= WORDS) | ((np.arange(len(words)) == index[doc]) & (n_words[doc] < WORDS)))
    shingle = np.zeros(len(starts), np.uint64)
    for j in range(WORDS):
        shingle = shingle * ODD + np.where(left[starts] > j, padded[starts + j], np.uint64(0))
    shingle, doc = mixed(shingle), doc[starts]
    order = np.lexsort((shingle, doc))
    shingle, doc = shingle[order], doc[order]
    new = np.concatenate(([True], (shingle[1:] != shingle[:-1]) | (doc[1:] != doc[:-1])))
    where = np.flatnonzero(new)
    return doc[where], shingle[where], np.diff(np.concatenate((where, [len(shingle)])))


def prob_minhash(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """The registers of ``n`` texts, one row each: the shingle that came first, 0 where there is none."""
    soonest = np.full(n * m, np.inf)
    winner = np.zeros(n * m, np.uint64)
    time = np.zeros(len(doc))
    rate = weight.astype(np.float64)
    seed = shingle
    while len(doc):
        seed = mixed(seed + ODD)
        arrived = mixed(seed ^ STEP)
        time = time - np.log1p(-(seed >> np.uint64(11)).astype(np.float64) * 2.0**-53) / rate
        register = doc * m + (arrived % np.uint64(m)).astype(np.int64)
        np.minimum.at(soonest, register, time)
        won = soonest[register] == time
        winner[register[won]] = shingle[won]
        going = time < soonest.reshape(n, m).max(axis=1)[doc]
        doc, shingle, rate, time, seed = doc[going], shingle[going], rate[going], time[going], seed[going]
    return winner.reshape(n, m)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """BANDS bucket keys of each row; the number of the band is part of the key."""
    bands = registers[:, :BANDS * ROWS].reshape(len(registers), BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * STEP + np.zeros((len(registers), 1), np.uint64)
    for j in range(ROWS):
        key = mixed(key * ODD + bands[:, :, j])
    return key.view(np.int64)


def sketches(registers: np.ndarray) -> np.ndarray:
    """Four bits of each register, sixteen to a long; unequal registers differ in them 15 times of 16."""
    bits = mixed(registers + STEP) & np.uint64(15)
    shifted = bits.reshape(len(registers), SKETCH, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(4))
    return np.bitwise_or.reduce(shifted, axis=2).view(np.int64)


def differing(x: str, y: str) -> Column:
    """The number of registers whose four bits differ, from two columns of sketches."""
    total = None
    for i in range(SKETCH):
        z = F.get(F.col(x), i).bitwiseXOR(F.get(F.col(y), i))
        z = z.bitwiseOR(F.shiftrightunsigned(z, 1))
        z = z.bitwiseOR(F.shiftrightunsigned(z, 2)).bitwiseAND(F.lit(0x1111111111111111))
        total = F.bit_count(z) if total is None else total + F.bit_count(z)
    return total


def most_differing(least: float) -> int:
    """The count of differing registers that a pair of similarity ``least`` passes only beyond SURE deviations."""
    p = (1 - least) * 15 / 16
    return int(REGISTERS * p + SURE * (REGISTERS * p * (1 - p)) ** 0.5)


def slices(texts: pd.Series) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= CHUNK_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


LONGS = ArrayType(LongType())


@F.pandas_udf(StructType().add("buckets", LONGS).add("sketch", LONGS))
def signatures(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        rows: list = []
        for part in slices(batch):
            doc, shingle, weight = weighted_shingles(part)
            registers = prob_minhash(doc, shingle, weight, len(part))
            some = np.isin(np.arange(len(part)), doc)
            rows.extend((k, b) if s else (None, None) for k, b, s in zip(band_keys(registers), sketches(registers), some))
        yield pd.DataFrame(rows, columns=["buckets", "sketch"])


@F.pandas_udf(StructType().add("shingles", BinaryType()).add("weights", BinaryType()))
def shingle_sets(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        rows = []
        for part in slices(batch):
            doc, shingle, weight = weighted_shingles(part)
            index = np.searchsorted(doc, np.arange(len(part) + 1))
            rows += [(shingle[a:b].tobytes(), b"" if (weight[a:b] == 1).all() else weight[a:b].astype("<u4").tobytes())
                     for a, b in zip(index[:-1], index[1:])]
        yield pd.DataFrame(rows, columns=["shingles", "weights"])


def probability_jaccard(x: np.ndarray, wx: np.ndarray, y: np.ndarray, wy: np.ndarray) -> float:
    """Exact: the sum over common shingles d of 1 / sum over all e of max(x_e / x_d, y_e / y_d)."""
    _, ix, iy = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if not len(ix):
        return 0.0
    a, b = wx[ix].astype(np.float64), wy[iy].astype(np.float64)
    only_x, only_y = wx.sum() - a.sum(), wy.sum() - b.sum()
    order = np.argsort(a / b)
    a, b = a[order], b[order]
    ratio = a / b
    lower = np.searchsorted(ratio, ratio, side="left")
    x_above = only_x + a.sum() - np.concatenate(([0.0], np.cumsum(a)))[lower]
    y_below = only_y + np.concatenate(([0.0], np.cumsum(b)))[lower]
    return float((1.0 / (x_above / a + y_below / b)).sum())


@F.pandas_udf(DoubleType())
def pair_similarity(xs: pd.Series, xw: pd.Series, ys: pd.Series, yw: pd.Series) -> pd.Series:
    def load(shingles: bytes, weights: bytes) -> tuple[np.ndarray, np.ndarray]:
        s = np.frombuffer(shingles, "<u8")
        return s, np.frombuffer(weights, "<u4") if weights else np.ones(len(s), "<u4")

    return pd.Series([probability_jaccard(*load(a, b), *load(c, d)) for a, b, c, d in zip(xs, xw, ys, yw)], dtype=float)


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (x, y) whose texts have a probability Jaccard similarity of at least ``least``."""
    left = sets.select(F.col("node").alias("x"), F.col("s").alias("xs"))
    right = sets.select(F.col("node").alias("y"), F.col("s").alias("ys"))
    similar = pair_similarity("xs.shingles", "xs.weights", "ys.shingles", "ys.weights")
    return pairs.join(left, "x").join(right, "y").withColumn("similarity", similar).where(
        F.col("similarity") >= least).select("x", "y")


def text_node(text: str):
    return F.unhex(F.md5(F.encode(text_or_empty(text), "UTF-8")))


def _classes(df: DataFrame, key: str, text: str, least: float) -> tuple[DataFrame, DataFrame]:
    """key, node of every row; node, class_id, class_size, chosen (key and node of one row) of every text."""
    small_batches(df)
    signed = written(df.select(
        column(key).alias("key"), text_node(text).alias("node"), signatures(text_or_empty(text)).alias("s"),
    ).select("key", "node", "s.buckets", "s.sketch"), "signatures")
    nodes = signed.groupBy("node").agg(
        F.min("key").alias("key"), F.count(F.lit(1)).alias("n"), F.first("buckets").alias("buckets"),
        F.first("sketch").alias("sketch"))
    placed = nodes.select("node", F.explode("buckets").alias("bucket"))
    # Tables by bucket are written before they are joined: between two plain exchanges Spark splits a hot bucket.
    sizes = written(placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1), "bucket-sizes")
    crowded = written(placed.join(sizes, "bucket"), "crowded")

    weight = crowded.groupBy("node").agg(F.sum("size").alias("weight"))
    central = written(crowded.join(weight, "node").groupBy("bucket").agg(
        F.max(F.struct("weight", "node")).getField("node").alias("y")), "bucket-centres")
    pairs = crowded.join(central, "bucket").where(F.col("node") != F.col("y")).select(
        F.col("node").alias("x"), "y").distinct()

    wanted = crowded.select("node").distinct().join(nodes.select("node", "key"), "node")
    texts = df.select(column(key).alias("key"), text_node(text).alias("node"), text_or_empty(text).alias("text"))
    matched = texts.join(wanted.withColumnRenamed("key", "k"), (texts["node"] == wanted["node"]) & F.col("key").eqNullSafe(F.col("k")))
    sets = written(matched.select(texts["node"], "text").dropDuplicates(["node"]).select(
        "node", shingle_sets("text").alias("s")), "shingle-sets")

    links = written(verified(pairs, sets, least), "near-links")
    labels = component_labels(links)
    rest = verified(_cross_pairs(crowded, labels, nodes.select("node", "sketch", "buckets"), least), sets, least)
    more = written(rest, "near-links")
    if not more.isEmpty():
        labels = component_labels(links.union(more))

    labelled = nodes.select("node", "key", "n").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    first = F.min(F.struct(F.col("key").isNull().alias("unnamed"), "key", "node"))
    classes = labelled.groupBy("label").agg(
        F.min("key").alias("class_id"), F.sum("n").alias("class_size"), first.alias("chosen"))
    of_node = labelled.select("node", "label").join(classes, "label").select(
        "node", "class_id", "class_size", "chosen")
    return signed.select("key", "node"), of_node


def near_duplicate_classes(df: DataFrame, key: str, text: str, least: float = SIMILAR) -> DataFrame:
    """``key``, ``class_id`` (smallest key of the class), ``class_size``: one row per row of ``df``.

    Equal texts are in one class, and so are texts linked, directly or over others, by a similarity of at
    least ``least``. A null text counts as an empty one. Texts without words are linked to equal ones
    only. Rows with a null key belong to classes; a class of such rows only has a null id. An empty table
    gives no rows.
    """
    rows, of_node = _classes(df, key, text, least)
    return rows.join(of_node, "node").select(F.col("key").alias(key), "class_id", "class_size")


def _cross_pairs(crowded: DataFrame, labels: DataFrame, sketched: DataFrame, least: float) -> DataFrame:
    """Pairs of different components that share a bucket and may be similar by their sketches.

    One of the two lies outside the bucket's largest component, whose texts need not meet each other.
    """
    labelled = crowded.select("bucket", "node").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    mixed_ones = written(labelled.groupBy("bucket").agg(F.min("label").alias("a"), F.max("label").alias("b")).where(
        F.col("a") != F.col("b")).select("bucket"), "mixed-names")
    members = written(labelled.join(mixed_ones, "bucket").join(sketched, "node"), "mixed-buckets")
    largest = written(members.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket").agg(
        F.max(F.struct("n", "label")).getField("label").alias("largest")), "largest-components")
    marked = members.join(largest, "bucket")
    small = marked.where(F.col("label") != F.col("largest")).select(
        F.col("bucket").alias("b"), F.col("node").alias("x"), F.col("label").alias("lx"), F.col("sketch").alias("sx"),
        F.col("buckets").alias("bx"))
    every = marked.select("bucket", F.col("node").alias("y"), F.col("label").alias("ly"), F.col("sketch").alias("sy"),
                          F.col("buckets").alias("by"), "largest")
    met = small.join(every, (F.col("b") == F.col("bucket")) & (F.col("lx") != F.col("ly")) & (
        (F.col("ly") == F.col("largest")) | (F.col("x") < F.col("y"))) & (differing("sx", "sy") <= most_differing(least)) & (
        F.array_min(F.array_intersect("bx", "by")) == F.col("b")))  # once, not in every bucket they share
    return met.select("x", "y").distinct()


def one_of_each_class(df: DataFrame, key: str, text: str, least: float = SIMILAR) -> DataFrame:
    """One row of each class of near duplicates: that with the smallest key, of equal rows the first.

    Nulls and empty tables as in :func:`near_duplicate_classes`; a null key is chosen only if the class
    has no other.
    """
    _, of_node = _classes(df, key, text, least)
    chosen = of_node.select(F.col("chosen.key").alias("k"), F.col("chosen.node").alias("n")).distinct()
    rows = packed(df, key=column(key), node=text_node(text))
    found = rows.join(chosen, F.col("key").eqNullSafe(F.col("k")) & (F.col("node") == F.col("n")), "left_semi")
    nth = F.row_number().over(Window.partitionBy("key", "node").orderBy(F.lit(1)))
    return unpacked(found.withColumn("nth", nth).where(F.col("nth") == 1), [], df.columns)
