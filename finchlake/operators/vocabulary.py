"""Jobs over the distinct words of a corpus: counts, stems, lemmas and spelling corrections.

Each returns a mapping keyed by word, computed once per distinct word, to be applied with
:func:`finchlake.operators.lookup.substitute_tokens`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finchlake.constants import DETACHMENT_RULES, IRREGULAR_LEMMAS
from finchlake.functions.stem import porter_stem
from finchlake.functions.text import literal_map
from finchlake.operators.rows import element_rows, laid_out


IN_ROW_LEMMAS = 20_000


def word_counts(df: DataFrame, tokens: str) -> DataFrame:
    """word, n over all token arrays (partial aggregation absorbs frequent words)."""
    words = element_rows(df, [], tokens, "word")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def stem_map(words: DataFrame) -> DataFrame:
    """token, replacement for the words of ``words(word)`` that stemming changes.

    Words are lowercased; words of one or two letters stay as they are.
    """
    stemmed = words.select("word").distinct().withColumn("_s", porter_stem(F.lower("word")))
    return stemmed.where(F.col("_s") != F.col("word")).select(
        F.col("word").alias("token"), F.col("_s").alias("replacement")
    )


def lemma_map(tagged: DataFrame, dictionary: DataFrame, irregular: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """word, wn_class, lemma by WordNet's detachment rules, validated against ``dictionary(word)``.

    A lemma is the word itself or the word with one class-specific ending detached, if the dictionary
    holds it; the shortest one wins, then alphabetical order. Words without one stay out of the result.
    ``irregular`` (by class, :data:`finchlake.constants.IRREGULAR_LEMMAS` for English) goes before the rules.
    """
    pairs = tagged.select("word", "wn_class").distinct()
    candidates = [F.struct(F.lit("*").alias("cls"), F.col("word").alias("form"))]
    for cls, suffix, ending in DETACHMENT_RULES:
        base = F.substring(F.col("word"), F.lit(1), F.length("word") - len(suffix))
        form = F.when(
            (F.col("wn_class") == cls) & F.col("word").endswith(suffix)
            & (F.length("word") > len(suffix)),
            F.concat(base, F.lit(ending)),
        )
        candidates.append(F.struct(F.lit(cls).alias("cls"), form.alias("form")))
    forms = pairs.select("word", "wn_class", F.explode(F.array(*candidates)).alias("c")).select(
        "word", "wn_class", F.col("c.form").alias("form")
    ).where(F.col("form").isNotNull())
    known = forms.join(dictionary.select(F.col("word").alias("form")).distinct(), "form", "left_semi")
    best = F.min(F.struct(F.length("form").alias("len"), F.col("form").alias("form")))
    regular = known.groupBy("word", "wn_class").agg(best.alias("b")).select(
        "word", "wn_class", F.col("b.form").alias("lemma")
    )
    if not irregular:
        return regular
    listed = literal_map({f"{c}:{w}": lemma for c, words in irregular.items() for w, lemma in words.items()})
    form = listed[F.concat_ws(":", "wn_class", "word")]
    odd = pairs.select("word", "wn_class", form.alias("lemma")).where(F.col("lemma").isNotNull())
    return regular.join(F.broadcast(odd.select("word", "wn_class")), ["word", "wn_class"], "left_anti").unionByName(odd)


def lemma_literals(lemmas: DataFrame, limit: int = IN_ROW_LEMMAS) -> dict[str, str] | None:
    """class:word -> lemma of the words that lemmas change, if there are at most ``limit`` of them, else None.

    At most ``limit`` + 1 rows ever reach the driver. With the result, tokens are lemmatized inside the row.
    """
    rows = lemmas.where(F.col("lemma") != F.col("word")).select("word", "wn_class", "lemma").limit(limit + 1).collect()
    return None if len(rows) > limit else {f"{r['wn_class']}:{r['word']}": r["lemma"] for r in rows}


def _deletions(word, position_count):
    """The word without its i-th letter, for every i."""
    return F.transform(
        F.sequence(F.lit(1), position_count),
        lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))),
    )


def _two_edit_keys(word):
    """The word and all its variants with one or two letters deleted."""
    once = F.when(F.length(word) > 1, _deletions(word, F.length(word))).otherwise(F.array(F.lit("")))
    twice = F.flatten(F.transform(
        once,
        lambda w: F.when(F.length(w) > 1, _deletions(w, F.length(w))).otherwise(F.array(F.lit(""))),
    ))
    return F.array_distinct(F.concat(F.array(word), once, twice))


SHORT = 8  # known words up to this length are found by deletions, longer ones by their pieces


def _known_keys(word):
    """Keys under which a known word is found by every word at most two edits away.

    A short word has its variants with up to two letters deleted. A longer one is cut into three pieces,
    of which two edits leave one whole: its key names the word's length, the piece's number and the piece.
    """
    size, third = F.length(word), F.floor(F.length(word) / 3).cast("int")
    pieces = F.transform(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda j: F.concat_ws(
        ":", size.cast("string"), j.cast("string"),
        F.substring(word, j * third + 1, F.when(j == 2, size - 2 * third).otherwise(third))))
    deleted = F.transform(_two_edit_keys(word), lambda k: F.concat(F.lit("d:"), k))
    return F.when(size <= SHORT, deleted).otherwise(F.array_distinct(pieces))


def _sought_keys(word):
    """The keys of all known words that may be at most two edits away; their number has a fixed bound."""
    size = F.length(word)
    lengths = F.filter(F.sequence(size - 2, size + 2), lambda n: n > SHORT)

    def piece(n, j, shift):
        third = F.floor(n / 3).cast("int")
        start, width = j * third + shift, F.when(j == 2, n - 2 * third).otherwise(third)
        key = F.concat_ws(":", n.cast("string"), j.cast("string"), F.substring(word, start + 1, width))
        return F.when((start >= 0) & (start + width <= size), key)

    moved = F.flatten(F.flatten(F.transform(lengths, lambda n: F.transform(
        F.array(F.lit(0), F.lit(1), F.lit(2)),
        lambda j: F.transform(F.sequence(F.lit(-2), F.lit(2)), lambda shift: piece(n, j, shift))))))
    deleted = F.when(
        size <= SHORT + 2, F.transform(_two_edit_keys(word), lambda k: F.concat(F.lit("d:"), k)),
    ).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(deleted, F.array_compact(moved)))


def _swapped(a, b):
    """True if two words of equal length differ by two neighbouring letters that changed places."""
    unequal = F.filter(
        F.sequence(F.lit(1), F.length(a)),
        lambda i: F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1)))
    first, second = F.get(unequal, 0), F.get(unequal, 1)
    return (F.length(a) == F.length(b)) & (F.size(unequal) == 2) & (second == first + 1) & (
        F.substring(a, first, F.lit(1)) == F.substring(b, second, F.lit(1))) & (
        F.substring(a, second, F.lit(1)) == F.substring(b, first, F.lit(1)))


def spelling_map(words: DataFrame, dictionary: DataFrame, max_edits: int = 2) -> DataFrame:
    """token, replacement for words that are not in ``dictionary(word, n)``.

    Only words of letters, of any alphabet, take part. A dictionary word one edit away (replace, delete,
    insert, swap of neighbours) wins over one two edits away (Levenshtein); among equals the more frequent
    one wins, then the alphabetically last. Words without a candidate stay out of the result. The keys of
    a word are bounded in number, so a very long word costs no more than its length.
    """
    letters = F.col("word").rlike(r"^\p{L}+$")
    known = dictionary.where(letters).select(F.col("word").alias("candidate"), "n")
    unknown = (
        words.where(letters).select("word").distinct()
        .join(dictionary.select("word"), "word", "left_anti")
        .select(F.col("word").alias("token"))
    )
    # Every word becomes many keys, so the words are spread before they are expanded.
    known, unknown = laid_out(known, "candidate"), laid_out(unknown, "token")
    met = element_rows(unknown, ["token"], _sought_keys(F.col("token")), "key").join(
        element_rows(known, ["candidate", "n"], _known_keys(F.col("candidate")), "key"), "key")
    apart = F.levenshtein(F.col("token"), F.col("candidate"), 2)
    pairs = met.select("token", "candidate", "n", apart.alias("apart")).where(F.col("apart") > 0)
    edits = F.when(F.col("apart") == 1, 1).when(_swapped(F.col("token"), F.col("candidate")), 1).otherwise(2)
    near = pairs.select("token", "candidate", "n", edits.alias("edits")).where(F.col("edits") <= max_edits)
    best = F.max(F.struct(-F.col("edits"), "n", "candidate"))
    return near.groupBy("token").agg(best.alias("b")).select("token", F.col("b.candidate").alias("replacement"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
