"""String clean-up as Column -> Column functions (narrow, JVM-side, usable on batch and stream)."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from finchlake.constants import CONTRACTIONS, SLANG
from finchlake.functions.patterns import (
    DIGIT, NOT_SPACE, NOT_SPACES, ODD_RUN, SPACE_SET, WORD, WORD_SET, alternation,
)


def as_text(col: Column) -> Column:
    """Null becomes the empty string, anything else its string form."""
    return F.coalesce(col.cast("string"), F.lit(""))


def literal_map(mapping: dict[str, str]) -> Column:
    """A small dictionary as one literal, parsed once by the optimizer."""
    pairs = "\x02".join(f"{k}\x03{v}" for k, v in mapping.items())
    return F.str_to_map(F.lit(pairs), F.lit("\x02"), F.lit("\x03"))


def bind(col: Column, body: Callable[[Column], Column]) -> Column:
    """``body(col)`` with ``col`` evaluated once, however often the body refers to it.

    Composed functions would otherwise repeat their input in the expression tree, which then grows
    exponentially with the number of steps. ``body`` may use its argument and columns, but not the
    variable of an enclosing higher-order function; pass such a value in as a field of a struct.
    """
    return F.get(F.transform(F.array(col), body), F.lit(0))


def rewrite_matches(
    col: Column, pattern: str, rewrite: Callable[[Column], Column], marks: str | None = None, first: str | None = None
) -> Column:
    """Replace every match of ``pattern`` by ``rewrite(match)`` in one left-to-right pass.

    The text is cut at the matches and stitched together again, so a replacement is never itself
    matched, which a chain of ``replace`` calls cannot guarantee. Texts without a match skip the work.
    ``marks`` is a cheaper pattern that is found in every text with a match. ``split`` would compile the
    pattern for every row, so the gaps come from the matcher too, whose pattern is compiled once.
    ``first`` is a set of characters, one of which starts every match: gaps are then passed over by runs of
    other characters, where the pattern is not tried.
    """
    gap = ".*?" if first is None else rf"(?:[^{first}]++|(?!{ungrouped(pattern)}).)*+"
    units = F.lit(rf"(?s)\G({gap})({ungrouped(pattern)}|\z)")

    def stitch(text: Column) -> Column:
        gaps = F.regexp_extract_all(text, units, F.lit(1))
        found = F.regexp_extract_all(text, units, F.lit(2))
        stitched = F.array_join(F.zip_with(gaps, found, lambda gap, match: F.when(
            match == "", gap).otherwise(F.concat(gap, rewrite(match)))), "")
        skip = F.lit(False) if marks is None else ~text.rlike(marks)
        return F.when(skip, text).when(text.rlike(pattern), stitched).otherwise(text)

    return bind(col, stitch)


def first_letters(words: Iterable[str]) -> str:
    """The first characters of the words, as a set for a character class."""
    return "".join(rf"\x{{{ord(c):x}}}" for c in sorted({w[0] for w in words if w}))


def ungrouped(pattern: str) -> str:
    """``pattern`` for use inside another one; its groups must not capture."""
    if re.search(r"(?<!\\)\((?!\?)", pattern):
        raise ValueError("the pattern of a rewrite must not capture")
    return pattern


def remove_urls(col: Column) -> Column:
    def removed(text: Column) -> Column:
        without = F.regexp_replace(text, rf"http{NOT_SPACES}|www\.{NOT_SPACES}", " ")
        return F.when(text.contains("http") | text.contains("www."), without).otherwise(text)

    return bind(col, removed)


def remove_mentions(col: Column) -> Column:
    return F.regexp_replace(col, f"@{WORD}+", " ")


def hashtag_words(tag: Column) -> Column:
    """``#HappyDay`` -> ``happy day``, ``#snake_case`` -> ``snake case``."""
    bare = F.regexp_replace(tag, "^#+", "")
    spaced = F.regexp_replace(bare, "([a-z])([A-Z])", "$1 $2")
    return F.lower(F.translate(spaced, "_", " "))


def hashtags(col: Column, mode: str = "split") -> Column:
    """Split hashtags into words, remove them, or keep them."""
    pattern = f"#{WORD}+"
    if mode == "keep":
        return col
    if mode == "remove":
        return F.regexp_replace(col, pattern, " ")
    if mode == "split":
        pad = F.lit(" ")
        return rewrite_matches(col, pattern, lambda tag: F.concat(pad, hashtag_words(tag), pad), first="#")
    raise ValueError(f"hashtag mode must be split, remove or keep, not {mode!r}")


def lowercase(col: Column) -> Column:
    return F.lower(col)


def remove_punctuation(col: Column) -> Column:
    return F.regexp_replace(col, f"[^{WORD_SET}{SPACE_SET}]", "")


def remove_digits(col: Column) -> Column:
    return F.regexp_replace(col, DIGIT, "")


def expand_contractions(col: Column, mapping: dict[str, str] = CONTRACTIONS) -> Column:
    """Longest contraction first, case-sensitive, also inside longer words."""
    table = literal_map(mapping)
    return rewrite_matches(col, alternation(list(mapping)), lambda found: table[found], first=first_letters(mapping))


def space_words(col: Column) -> Column:
    """Words between white space, without empty ones."""
    return F.regexp_extract_all(col, F.lit(NOT_SPACES), F.lit(0))


def squeeze_space(col: Column) -> Column:
    """Every run of white space becomes one space; none is left at either end."""
    return F.trim(F.regexp_replace(col, ODD_RUN, " "))


def replace_slang(col: Column, mapping: dict[str, str] = SLANG) -> Column:
    """Replace white-space-delimited words found in ``mapping``; white space is normalised."""
    table = literal_map(mapping)
    first = first_letters(mapping)
    word = rf"(?=[{first}])(?<![^ ])(?:{alternation(list(mapping))})(?![^ ])"
    return rewrite_matches(squeeze_space(col), word, lambda found: table[found], first=first)


def squeeze_elongation(col: Column) -> Column:
    """Three or more equal characters in a row become two; white space is normalised."""
    return F.regexp_replace(squeeze_space(col), rf"({NOT_SPACE})\1{{2,}}", "$1$1")
