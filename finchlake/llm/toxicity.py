"""Operator 1: toxicity of texts whose offending words may be disguised.

A noisy channel writes letters as look-alike digits and signs, repeats them or spaces them out. Where a
text shows such noise, the noisy stretch becomes a lattice of readings for each character, and a Viterbi
search takes the path that a character language model and the channel make likeliest. Characters with one
reading have a lattice of one path, so clean words stay as they are. The restored text is scored by the
words and word beginnings that mark toxic texts among the labelled rows.

The language model counts the character trigrams of all texts. The marks are learned from a bounded
sample of the labelled rows; a word counts by the different contexts it stands in, so that the words of
one text that was copied many times do not pass for marks.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from finchlake.llm.common import column, packed, small_batches, text_or_empty, unpacked
from finchlake.session import written

# What a sign may stand for, and letters of other scripts that look like Latin ones.
READINGS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "#": "h", "%": "x",
    "€": "e", "£": "l", "¡": "i", "¢": "c", "¥": "y", "§": "s", "*": "aeiou",
}
LOOK_ALIKES = dict(zip("аеорсхуіјѕкмтοαικνρτ", "aeopcxyijskmtoaikvpt"))
INVISIBLE = "­​‌‍⁠﻿"

SYMBOLS = 28                       # word boundary, a to z, any other letter or digit
OTHER = 27
READ, LITERAL = math.log(0.5), math.log(0.03)
DROP_REPEAT, KEEP_REPEAT, DROP_DOUBLE = math.log(0.6), math.log(0.4), math.log(0.05)
DROP_SPACE, KEEP_SPACE = math.log(0.85), math.log(0.15)

PREFIXES = (3, 4, 5, 6, 7)
TRAIN_POSITIVE, TRAIN_NEGATIVE = 3_000, 9_000   # most labelled rows that the marks are learned from
FIT_POSITIVE, FIT_NEGATIVE = 1_500, 4_500       # and that the weights of the score are fitted on
LEAST_CONTEXTS = 3
LEAST_WEIGHT = 1.0


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By code point: the lower-case letter or digit (a space for others), the symbol, whether sign or space."""
    plain = np.full(0x110000, 32, dtype="<u4")
    symbol = np.zeros(0x110000, dtype=np.int32)
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000:
            continue
        low = chr(c).lower()[0]
        if low.isalpha() or 48 <= c < 58:
            plain[c] = ord(low)
            base = unicodedata.normalize("NFKD", low)[0] if c > 127 else low
            symbol[c] = ord(base) - 96 if "a" <= base <= "z" else OTHER
    sign = np.zeros(0x110000, dtype=bool)
    sign[[ord(c) for c in (*READINGS, *LOOK_ALIKES, *INVISIBLE)]] = True
    space = np.zeros(0x110000, dtype=bool)
    space[[9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x2028, 0x2029, 0x3000, *range(0x2000, 0x200B)]] = True
    return plain, symbol, sign, space


_cache: dict = {}


def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    if "tables" not in _cache:
        _cache["tables"] = _tables()
    return _cache["tables"]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def trigram_counts(df: DataFrame, text: str) -> np.ndarray:
    """How often each of the SYMBOLS**3 character trigrams stands in all texts."""
    size = SYMBOLS ** 3

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        symbol = tables()[1]
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for at in range(0, len(batch), 256):
                # Two boundaries around every text: the counts are the same however the texts are dealt.
                s = symbol[code_points("\n\n" + "\n\n".join(batch["text"].iloc[at:at + 256]) + "\n\n")]
                if len(s) > 2:
                    total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=size)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"gram": seen, "n": total[seen]})

    grams = df.select(text_or_empty(text).alias("text")).mapInPandas(count, "gram int, n long")
    rows = grams.groupBy("gram").agg(F.sum("n").alias("n")).collect()  # at most SYMBOLS**3
    out = np.zeros(size)
    for r in rows:
        out[r["gram"]] = r["n"]
    return out.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


def language_model(counts: np.ndarray, pull: float = 5.0) -> np.ndarray:
    """log P(c | a, b), each order drawn towards the one below."""
    one = counts.sum(axis=(0, 1)) + 1.0
    one = one / one.sum()
    two = counts.sum(axis=0)
    two = (two + pull * one) / (two.sum(axis=1, keepdims=True) + pull)
    three = (counts + pull * two[None]) / (counts.sum(axis=2, keepdims=True) + pull)
    return np.log(three)


def restore(span: str, model: list) -> str:
    """The likeliest reading of a noisy stretch; words are parted by spaces.

    ``model[a][b][c]`` is log P(c | a, b). A state of the search is the last two symbols; every character
    adds the readings of its own and nothing is pruned, so the path found is the best one. Signs inside a
    stretch that have no reading are separators, like spaces, which may be noise or word ends.
    """
    lower, symbol = tables()[:2]
    best = {(0, 0): (0.0, None)}
    last, run = "", 0
    chars = [c for c in span if c not in INVISIBLE]
    for place, char in enumerate(chars):
        run = run + 1 if char == last else 1
        last = char
        plain = chr(lower[ord(char)])
        options: list[tuple[str | None, float]] = []
        if char in READINGS:
            options = [(c, READ - math.log(len(READINGS[char]))) for c in READINGS[char]]
            options.append((char, LITERAL) if char.isdigit() else (" ", LITERAL))
            if run > 1:
                options.append((None, DROP_REPEAT))
        elif char in LOOK_ALIKES:
            options = [(LOOK_ALIKES[char], READ), (plain, LITERAL)]
        elif plain == " ":
            options = [(None, DROP_SPACE), (" ", KEEP_SPACE)]
        elif run > 1:
            long_run = run > 2 or (place + 1 < len(chars) and chars[place + 1] == char)
            options = [(plain, KEEP_REPEAT), (None, DROP_REPEAT)] if long_run else [(plain, 0.0), (None, DROP_DOUBLE)]
        else:
            options = [(plain, 0.0)]
        reached: dict = {}
        for (a, b), (score, path) in best.items():
            for letter, cost in options:
                if letter is None:
                    state, value, way = (a, b), score + cost, path
                else:
                    c = int(symbol[ord(letter)])
                    if c == 0 and b == 0:
                        state, value, way = (a, b), score + cost, path
                    else:
                        state, value, way = (b, c), score + cost + model[a][b][c], (letter, path)
                held = reached.get(state)
                if held is None or value > held[0]:
                    reached[state] = (value, way)
        best = reached
    ends = [(v if b == 0 else v + model[a][b][0], way) for (a, b), (v, way) in best.items()]
    way, letters = max(ends, key=lambda e: e[0])[1], []
    while way is not None:
        letters.append(way[0])
        way = way[1]
    return "".join(reversed(letters))


# What real addresses hold or end in; other signs in words are noise.
ADDRESS = re.compile(r"://|\bwww\.|\w@[\w.-]*\w\.(?:[a-z]{2}|com|org|net|edu|gov|mil|int|info|biz)\b")
MOST_SEPARATORS = 3


def spelled_out(codes: np.ndarray, part_of: np.ndarray) -> np.ndarray:
    """Which places lie in three and more single characters that are parted by one separator, or by up to
    MOST_SEPARATORS of them that are the same all along."""
    places = np.flatnonzero(part_of)
    covered = np.zeros(len(codes) + 1, dtype=np.int32)
    if len(places) >= 3:
        edge = np.concatenate(([False], part_of, [False]))
        alone = (~edge[:-2] & ~edge[2:])[places]
        gap = np.diff(places)
        first, second = gap[:-1], gap[1:]
        three = alone[:-2] & alone[1:-1] & alone[2:] & (first == second) & (first <= MOST_SEPARATORS + 1)
        at, wide = places[:-2], first > 2
        for step in range(1, MOST_SEPARATORS + 1):
            inside = three & wide & (step < first)
            here = at[inside]
            three[inside] = codes[here + step] == codes[here + first[inside] + step]
        np.add.at(covered, at[three], 1)
        np.add.at(covered, places[2:][three] + 1, -1)
    return np.cumsum(covered[:-1]) > 0


def _read(stretch: str, model: list) -> str:
    """A stretch as words: plain words, numbers and signs as they stand, others restored."""
    plain = stretch.isalpha() and stretch.isascii() and re.search(r"(.)\1\1", stretch) is None
    if plain or stretch.isdigit() or not any(c.isalpha() for c in stretch):
        return tables()[0][code_points(stretch)].tobytes().decode("utf-32-le")
    # A sign at the very end is as often punctuation; a sentence may end in the stretch.
    return restore(stretch.rstrip("!"), model)


def restored_text(text: str, model: list, known: dict[str, str]) -> str:
    """The whole text as lower-case words, parted by spaces; noisy stretches restored.

    ``known`` remembers stretches. Noise is a sign or digit in a token with letters, a letter three times
    in a row, or three and more single characters in a row. Web and mail addresses stay; an equals sign
    parts words, unless it stands between single characters.
    """
    if not text:
        return ""
    lower, symbol, sign, space = tables()
    codes = code_points(text)
    plain = lower[codes]
    letter = symbol[codes] > 0
    signs = sign[codes]
    inked = ~space[codes]
    part_of = letter | signs
    noisy = signs & inked
    noisy[2:] |= letter[2:] & (plain[2:] == plain[1:-1]) & (plain[1:-1] == plain[:-2])
    spelled = spelled_out(codes, part_of)
    noisy |= spelled
    if not noisy.any():
        return plain.tobytes().decode("utf-32-le")
    # Tokens are runs without white space; a run of spelled characters joins its tokens.
    joined = inked | spelled
    padded = np.concatenate(([False], joined, [False]))
    change = np.flatnonzero(padded[1:] != padded[:-1])
    starts, stops = change[::2], change[1::2]
    hit = np.unique(np.searchsorted(starts, np.flatnonzero(noisy), side="right") - 1)
    out, done = [], 0
    for i in hit.tolist():
        a, b = int(starts[i]), int(stops[i])
        if not letter[a:b].any():
            continue
        span = text[a:b].lower()
        restored = known.get(span)
        if restored is None:
            bare = span.strip(".,;:?\"')]}>")
            if ADDRESS.search(bare):
                restored = lower[code_points(span)].tobytes().decode("utf-32-le")
            else:
                parts = [p for p in bare.split("=") if p]
                spaced = all(len(p) == 1 for p in parts)
                restored = " ".join(_read(p, model) for p in ([bare] if spaced else parts))
            if len(known) > 100_000:
                known.clear()
            known[span] = restored
        out.append(plain[done:a].tobytes().decode("utf-32-le"))
        out.append(restored)
        done = b
    out.append(plain[done:].tobytes().decode("utf-32-le"))
    return "".join(out)


def marks_of(word: str) -> list[str]:
    """The features of a word: itself between spaces, and its beginnings after one."""
    return [f" {word} ", *(f" {word[:n]}" for n in PREFIXES if n < len(word))]


@dataclass
class Detector:
    """What scoring needs, of bounded size: the language model, the marks and the weights of the score."""

    model: np.ndarray
    marks: dict[str, float]
    weights: np.ndarray

    def features(self, restored: str) -> np.ndarray:
        """1, the two highest mark weights of different places, their sum, the words, and sum per word."""
        best: dict[int, float] = {}
        for end, (size, weight) in self.automaton().iter(f" {restored} "):
            start = end - size
            if best.get(start, 0.0) < weight:
                best[start] = weight
        top = sorted(best.values(), reverse=True)[:2] + [0.0, 0.0]
        total, words = sum(best.values()), len(restored.split())
        return np.array([1.0, top[0], top[1], math.log1p(total), math.log1p(words), 10 * total / (words + 20)])

    def automaton(self):
        if not hasattr(self, "_automaton"):
            import ahocorasick

            self._automaton = ahocorasick.Automaton()
            for mark, weight in self.marks.items():
                self._automaton.add_word(mark, (len(mark), weight))
            self._automaton.add_word("\0", (1, 0.0))
            self._automaton.make_automaton()
        return self._automaton

    def lists(self) -> list:
        if not hasattr(self, "_lists"):
            self._lists, self._known = self.model.tolist(), {}
        return self._lists

    def restored(self, text: str) -> str:
        model = self.lists()
        return restored_text(text, model, self._known)

    def score(self, text: str) -> float:
        z = float(self.features(self.restored(text)) @ self.weights)
        return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, z))))

    def __getstate__(self) -> dict:
        return {"model": self.model, "marks": self.marks, "weights": self.weights}


def _word_hash(word: str) -> int:
    out = 0
    for c in word:
        out = (out * 1_000_003 ^ ord(c)) & 0xFFFFFFFF
    return out


def _mark_rows(batches: Iterable[pd.DataFrame], shared) -> Iterator[pd.DataFrame]:
    """mark, docs, bits: documents that hold it and a bitmap of its contexts, for each batch."""
    for batch in batches:
        docs: dict[str, int] = {}
        bits: dict[str, int] = {}
        for text in batch["text"]:
            words = shared.value.restored(text).split()
            hashes = [_word_hash(w) for w in words]
            seen = set()
            for i, word in enumerate(words):
                around = (hashes[i - 1] if i else 0) * 31 + (hashes[i + 1] if i + 1 < len(words) else 0)
                bit = 1 << ((around * 0x9E3779B97F4A7C15 >> 40) & 63)
                for mark in marks_of(word):
                    bits[mark] = bits.get(mark, 0) | bit
                    seen.add(mark)
            for mark in seen:
                docs[mark] = docs.get(mark, 0) + 1
        signed = [b - (1 << 64) if b >> 63 else b for b in (bits[m] for m in docs)]
        yield pd.DataFrame({"mark": list(docs), "docs": list(docs.values()), "bits": np.array(signed, dtype=np.int64)})


def fit_detector(df: DataFrame, key: str, text: str, labels: DataFrame, label: str, may_train: Column) -> Detector:
    """Learn from the labelled rows for which ``may_train`` holds, and from all texts for the language model.

    The rows with the smallest hashes of their key are taken, up to the documented numbers; one part
    teaches the marks, the other the weights. Without a toxic and a clean row in both, every score is 0.
    Labels of a null key are not used; of several labels of a key the highest counts.
    """
    small_batches(df)
    spark = df.sparkSession
    model = language_model(trigram_counts(df, text))
    none = Detector(model, {}, np.array([-40.0, 0.0, 0.0, 0.0, 0.0, 0.0]))
    named = labels.where(column(key).isNotNull() & may_train).groupBy(column(key).alias("key")).agg(
        F.max(column(label)).alias("toxic")).where(F.col("toxic").isin(0, 1))
    drawn = named.select("key", "toxic", F.xxhash64(F.lit(3), "key").alias("h"), (F.pmod(F.xxhash64(F.lit(5), "key"), F.lit(3)) == 0).alias("fits"))
    parts = [
        drawn.where((F.col("toxic") == toxic) & (F.col("fits") == fits)).orderBy("h", "key").limit(most)
        for toxic, fits, most in ((1, False, TRAIN_POSITIVE), (0, False, TRAIN_NEGATIVE), (1, True, FIT_POSITIVE), (0, True, FIT_NEGATIVE))
    ]
    chosen = parts[0].union(parts[1]).union(parts[2]).union(parts[3]).select("key", "toxic", "fits")
    rows = df.select(column(key).alias("key"), text_or_empty(text).alias("text"))
    sample = written(rows.join(F.broadcast(chosen), "key").repartition("key"), "toxicity-sample")
    sizes = {(r["toxic"], r["fits"]): r["n"] for r in
             sample.groupBy("toxic", "fits").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 4:
        return none
    shared = spark.sparkContext.broadcast(none)

    def counted(toxic: int) -> DataFrame:
        def scan(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            return _mark_rows(batches, shared)

        part = sample.where((F.col("toxic") == toxic) & ~F.col("fits")).select("text")
        return part.mapInPandas(scan, "mark string, docs long, bits long").groupBy("mark").agg(
            F.sum("docs").alias("docs"), F.bit_or("bits").alias("bits"))

    # Marks are weighed in Spark; those of the documented sample with enough weight are all kept.
    positive = counted(1).where((F.col("docs") >= LEAST_CONTEXTS) & (F.bit_count("bits") >= LEAST_CONTEXTS))
    clean = counted(0).select("mark", F.col("docs").alias("clean_docs"))
    # Distinct values from a 64-bit bitmap of their hashes.
    contexts = 64.0 * F.log(64.0 / F.greatest(64 - F.bit_count("bits"), F.lit(0.5)))
    pos, neg = F.least(F.col("docs").cast("double"), contexts), F.coalesce(F.col("clean_docs"), F.lit(0))
    gain = F.log((pos + 0.5) / (sizes[1, False] + 1)) - F.log((neg + 0.5) / (sizes[0, False] + 1))
    weighed = positive.join(clean, "mark", "left").select(
        "mark", (gain - F.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))).alias("weight"))
    best = weighed.where(F.col("weight") > LEAST_WEIGHT).toArrow()
    marks = dict(sorted(zip(*(c.to_pylist() for c in best.columns))))
    partial = Detector(model, marks, none.weights)
    told = spark.sparkContext.broadcast(partial)

    def measured(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [told.value.features(told.value.restored(t)) for t in batch["text"]]
            yield pd.DataFrame({"x": rows, "y": batch["toxic"].to_numpy(float)})

    fitted = sample.where("fits").select("text", F.col("toxic").cast("int").alias("toxic")).mapInPandas(
        measured, "x array<double>, y double").toPandas()
    return Detector(model, partial.marks, logistic_weights(np.array(list(fitted["x"])), fitted["y"].to_numpy()))


def logistic_weights(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge, on few columns."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * len(y) ** 0.5 * np.eye(len(w)),
                               x.T @ (y - p) - ridge * len(y) ** 0.5 * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def with_toxicity(df: DataFrame, text: str, detector: Detector, threshold: float = 0.7) -> DataFrame:
    """``df`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on). Null texts are empty ones.

    Equal texts have equal scores; an empty table gives no rows; columns of the same names are replaced.
    """
    small_batches(df)
    shared = df.sparkSession.sparkContext.broadcast(detector)

    @F.pandas_udf(DoubleType())
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([shared.value.score(t) for t in batch], dtype=float)

    out = packed(df, text=text_or_empty(text)).select("row", scored("text").alias("score"))
    return unpacked(out.withColumn("predicted", (F.col("score") >= threshold).cast("int")), ["score", "predicted"], df.columns)
