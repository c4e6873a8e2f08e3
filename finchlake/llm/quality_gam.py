"""Operator 13: quality of texts by a generalised additive model with pairwise interactions.

A text becomes a few dozen numbers: what its characters, words and lines are like and how much they repeat.
Each number falls into one of a few bins, cut at quantiles of the training rows. The model has one table of
values per number and, for the pairs that explain most of what is left, one table over both numbers' bins.
Tables are learned by cyclic boosting: number after number, a tree of at most four leaves is fitted to the
gradients, summed per bin, and a fraction of its leaves is added to the table; then pair after pair in the
same way with trees that cut both numbers once. A score is the logistic of the sum of the looked-up values.

The labelled rows that it learns from are a bounded sample: at most ``most_rows`` of each class, by a hash.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from finchlake.llm.common import column, packed, small_batches, text_or_empty, unpacked

MOST_ROWS = 10_000   # labelled rows of each class that the model learns from, at most
BINS, PAIRS = 32, 10
ROUNDS, PAIR_ROUNDS = 80, 40
RATE, SHRINK, LEAST = 0.2, 1.0, 5   # share of a tree that is added; weight of the prior; rows of a leaf, at least

FEATURES = [
    "characters", "words", "lines", "word_length", "longest_word", "letters", "capitals", "digits", "spaces",
    "stops", "signs", "beyond_ascii", "capital_words", "signed_words", "lettered_words", "distinct_words",
    "repeated_words", "top_word", "distinct_pairs", "distinct_lines", "top_line", "line_length", "ended_lines",
    "sentence_length", "entropy", "packed_size",
]

LETTER, CAPITAL, DIGIT, SPACE, STOP, SIGN = range(6)
COMMON = 0x2FFF
_STOPS = ".,;:!?'\"()-’“”«»¿¡…"


def _classes() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110000, SIGN, dtype=np.uint8)
    for c in range(0x110000):
        sign = chr(c)
        if sign.isalpha():
            table[c] = CAPITAL if sign.isupper() else LETTER
        elif sign.isdigit():
            table[c] = DIGIT
        elif sign.isspace():
            table[c] = SPACE
    table[[ord(c) for c in _STOPS]] = STOP
    return table


_table: np.ndarray | None = None


def features(text: str | None) -> list[float]:
    """The numbers of a whole text, in the order of FEATURES; a null text is an empty one."""
    global _table
    if _table is None:
        _table = _classes()
    text = text or ""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")
    n = max(1, len(points))
    kinds = np.bincount(_table[points], minlength=6)
    letters = max(1, int(kinds[LETTER] + kinds[CAPITAL]))
    used = np.bincount(np.minimum(points, COMMON))   # characters beyond COMMON count as one
    used = used[used > 0] / n
    words = text.split()
    n_words = max(1, len(words))
    count = Counter(words)
    sizes = np.array([len(w) for w in words] or [0])
    pairs = len(set(zip(words, words[1:])))
    lines = [line for line in text.split("\n") if line.strip()]
    n_lines = max(1, len(lines))
    line_count = Counter(lines)
    raw = text.encode("utf-8", "replace")
    return [
        math.log1p(len(points)), math.log1p(len(words)), math.log1p(len(lines)),
        float(sizes.mean()), math.log1p(float(sizes.max())),
        letters / n if words else 0.0, kinds[CAPITAL] / letters, kinds[DIGIT] / n, kinds[SPACE] / n,
        kinds[STOP] / n, kinds[SIGN] / n, float((points > 127).sum()) / n,
        sum(k for w, k in count.items() if w.isupper() and len(w) > 1) / n_words if kinds[CAPITAL] else 0.0,
        sum(k for w, k in count.items() if not (w[-1].isalnum() or w[-1] in ".,")) / n_words,
        sum(k for w, k in count.items() if w.isalpha()) / n_words,
        len(count) / n_words, sum(a == b for a, b in zip(words, words[1:])) / n_words,
        max(count.values(), default=0) / n_words, pairs / n_words,
        len(line_count) / n_lines, max(line_count.values(), default=0) / n_lines,
        math.log1p(len(text) / n_lines), sum(k for w, k in line_count.items() if w.rstrip()[-1] in ".!?…\"”»") / n_lines,
        math.log1p(len(words) / max(1, len(re.findall(r"[.!?]+", text)))),
        float(-(used * np.log2(used)).sum()) if len(points) else 0.0,
        len(zlib.compress(raw, 1)) / max(1, len(raw)),
    ]


def _leaves(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int) -> np.ndarray:
    """The values of a tree of the given depth over neighbouring bins, from sums of gradients, curvatures and rows."""
    whole = np.full(len(g), g.sum() / (h.sum() + SHRINK))
    if depth == 0 or len(g) < 2:
        return whole
    left_g, left_h, left_n = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gain = left_g ** 2 / (left_h + SHRINK) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + SHRINK)
    gain[(left_n < LEAST) | (n.sum() - left_n < LEAST)] = -1.0
    cut = int(gain.argmax())
    if gain[cut] <= g.sum() ** 2 / (h.sum() + SHRINK) + 1e-9:
        return whole
    return np.concatenate([_leaves(g[:cut + 1], h[:cut + 1], n[:cut + 1], depth - 1),
                           _leaves(g[cut + 1:], h[cut + 1:], n[cut + 1:], depth - 1)])


def _quadrants(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """The values of the best tree that cuts both numbers once, and how much it gains."""
    def corners(x: np.ndarray) -> list[np.ndarray]:
        up = x.cumsum(0).cumsum(1)
        a, right, below, total = up[:-1, :-1], up[:-1, -1:], up[-1:, :-1], up[-1, -1]
        return [a, right - a, below - a, total - right - below + a]

    parts = list(zip(corners(g), corners(h), corners(n)))
    gain = sum(a ** 2 / (b + SHRINK) for a, b, _ in parts)
    gain[np.any([(c > 0) & (c < LEAST) for _, _, c in parts], axis=0)] = -1.0
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    if gain[i, j] <= 0:
        return np.zeros_like(g), 0.0
    values = [a[i, j] / (b[i, j] + SHRINK) for a, b, _ in parts]
    out = np.empty_like(g)
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = values
    return out, float(gain[i, j])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class AdditiveModel:
    """Cuts and one table per number, one table per chosen pair of numbers."""

    base: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, rows[:, j], side="left") for j, c in enumerate(self.cuts)], axis=1)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Scores of rows of numbers: the values of their bins, added up."""
        total = np.full(len(rows), self.base)
        if self.cuts and len(rows):
            bins = self.bins(rows)
            for j, table in enumerate(self.tables):
                total += table[bins[:, j]]
            for (a, b), table in zip(self.pairs, self.pair_tables):
                total += table[bins[:, a], bins[:, b]]
        return _logistic(total)


def fit(rows: np.ndarray, good: np.ndarray, bins: int = BINS, pairs: int = PAIRS) -> AdditiveModel:
    """The model of labelled rows of numbers. Rows of one class only, or none, give their share alone."""
    n_good, n = int(good.sum()), len(good)
    model = AdditiveModel(math.log((n_good + 1) / (n - n_good + 1)))
    if not 0 < n_good < n:
        return model
    shares = np.linspace(0, 1, bins + 1)[1:-1]
    model.cuts = [np.unique(np.quantile(rows[:, j], shares, method="lower")) for j in range(rows.shape[1])]
    at = model.bins(rows)
    sizes = [len(c) + 1 for c in model.cuts]
    model.tables = [np.zeros(s) for s in sizes]
    total = np.full(n, model.base)

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        p = _logistic(total)
        return good - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(ROUNDS):
        for j, size in enumerate(sizes):
            g, h = gradients()
            sums = [np.bincount(at[:, j], weights=w, minlength=size) for w in (g, h, None)]
            step = RATE * _leaves(*sums, depth=2)
            model.tables[j] += step
            total += step[at[:, j]]

    def over_pair(a: int, b: int) -> tuple[np.ndarray, float]:
        g, h = gradients()
        both, shape = at[:, a] * sizes[b] + at[:, b], (sizes[a], sizes[b])
        return _quadrants(*[np.bincount(both, weights=w, minlength=shape[0] * shape[1]).reshape(shape).astype(float)
                            for w in (g, h, None)])

    wide = [j for j, s in enumerate(sizes) if s > 1]
    gain = {(a, b): over_pair(a, b)[1] for i, a in enumerate(wide) for b in wide[i + 1:]}
    model.pairs = sorted(sorted(gain), key=lambda ab: -gain[ab])[:pairs]
    model.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(model.pairs):
            step = RATE * over_pair(a, b)[0]
            model.pair_tables[k] += step
            total += step[at[:, a], at[:, b]]
    return model


def _features_of(text: Column) -> Column:
    @F.pandas_udf(ArrayType(DoubleType()))
    def numbers(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([features(t) for t in batch], dtype=object)

    return numbers(text)


def fit_quality(
    df: DataFrame, key: str, text: str, labels: DataFrame, label: str, may_train: Column, most_rows: int = MOST_ROWS
) -> AdditiveModel:
    """The model of the rows of ``labels(key, label)`` for which ``may_train`` holds, with their whole texts.

    Labels other than 0 and 1 are passed over; a key with several texts or labels counts with each. Of each
    class at most ``most_rows`` rows are used, chosen by a hash of the key, so repeated fits agree.
    """
    small_batches(df)
    given = labels.select(column(key).alias("key"), column(label).cast("int").alias("good"))
    given = given.where(F.col("good").isin(0, 1) & F.col("key").isNotNull())
    chosen = None
    for value in (0, 1):
        some = given.where(F.col("good") == value).join(
            df.where(may_train).select(column(key).alias("key")).distinct(), "key", "left_semi")
        some = some.orderBy(F.xxhash64("key"), "key").limit(most_rows)
        chosen = some if chosen is None else chosen.unionByName(some)
    texts = df.select(column(key).alias("key"), text_or_empty(text).alias("text"))
    # The chosen rows are bounded, and so is what is broadcast and what the driver gets: numbers, not texts.
    met = texts.join(F.broadcast(chosen), "key").select("key", "good", _features_of(F.col("text")).alias("numbers"))
    met = met.toPandas()
    rows = np.array(met["numbers"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    order = np.lexsort([*rows.T, met["good"].to_numpy(dtype=float)])   # a rerun adds the same numbers in the same order
    return fit(rows[order], met["good"].to_numpy(dtype=float)[order])


def with_quality(df: DataFrame, text: str, model: AdditiveModel, threshold: float = 0.7) -> DataFrame:
    """``df`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on). Null texts are empty ones.

    Equal texts have equal scores; an empty table gives no rows; columns of the same names are replaced.
    """
    small_batches(df)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(DoubleType())
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            rows = np.array([features(t) for t in batch], dtype=float).reshape(-1, len(FEATURES))
            yield pd.Series(shared.value.scores(rows), dtype=float)

    out = packed(df, text=text_or_empty(text)).select("row", scored("text").alias("score"))
    return unpacked(out.withColumn("predicted", (F.col("score") >= threshold).cast("int")), ["score", "predicted"], df.columns)
