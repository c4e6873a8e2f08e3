"""Unicode normalisation, emoji names and HTML entities."""

from __future__ import annotations

import html.entities
import re
import unicodedata
import zlib
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from finchlake.constants import (
    EMOJI_ACTIONS, EMOJI_BLOCKS, EMOJI_CLDR_NAMES, EMOJI_HAIR, EMOJI_JOINED, EMOJI_PART_FLAGS, EMOJI_PROFESSIONS,
    EMOJI_ROLES, EMOJI_STATES, EMOJI_SYMBOLS, REGIONS_WITHOUT_FLAG, SKIN_TONES,
)
from finchlake.functions.text import bind, rewrite_matches

# Characters that NFKC never changes and that never combine with a neighbour: ASCII, most of Latin-1,
# Latin Extended-A without its ligatures, basic Cyrillic, the common curly quotes and dashes,
# CJK ideographs, Hangul syllables and the pictograph blocks. Any other character sends the text to
# the normaliser.
_STABLE = (
    r"\x{00}-\x{9f}\x{a1}-\x{a7}\x{a9}\x{ab}-\x{ae}\x{b0}\x{b1}\x{b6}\x{b7}\x{bb}\x{bf}-\x{131}"
    r"\x{134}-\x{13e}\x{141}-\x{148}\x{14a}-\x{17e}\x{400}-\x{482}\x{2013}\x{2014}\x{2018}-\x{201d}"
    r"\x{4e00}-\x{9fff}\x{ac00}-\x{d7a3}\x{1f300}-\x{1faff}"
)
MAYBE_UNNORMALISED = rf"(?![\x{{00}}-\x{{9f}}])[^{_STABLE}]"   # ASCII fails the first test


def normalize_nfkc(col: Column) -> Column:
    """NFKC form of the text, by the normaliser among Spark's own jars.

    Only texts that hold a character outside the stable ranges are sent through it, inside the row and with
    no Python. Spark has no function of its own for normal forms.
    """
    composed = F.reflect(
        F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), F.coalesce(col, F.lit("")), F.lit(True)
    )
    return F.when(col.rlike(MAYBE_UNNORMALISED), composed).otherwise(col)


_BUCKETS = 256   # at least


def _bucket_count(names: dict[str, str]) -> int:
    """A power of two that leaves most buckets without any name, however large the table."""
    return max(_BUCKETS, 1 << (4 * len(names)).bit_length())


def _name_buckets(names: dict[str, str], count: int) -> Column:
    """A table of names as one literal: buckets by CRC-32, each a short string of name and value."""
    buckets = [""] * count
    for name, value in names.items():
        buckets[zlib.crc32(name.encode()) % count] += f"\x02{name}\x03{value}"
    return F.split(F.lit("\x04".join(buckets)), "\x04")


def named_value(names: dict[str, str], name: Column) -> Column:
    """The value of ``name``, null if it has none; reads one bucket, however large the table."""
    count = _bucket_count(names)
    place = F.pmod(F.crc32(F.encode(name, "UTF-8")), F.lit(count)).cast("int")
    found = F.struct(F.get(_name_buckets(names, count), place).alias("bucket"),
                     F.concat(F.lit("\x02"), name, F.lit("\x03")).alias("sought"))
    return bind(found, lambda f: F.when(
        f["bucket"].contains(f["sought"]),
        F.substring_index(F.substring(
            f["bucket"], F.position(f["sought"], f["bucket"]) + F.length(f["sought"]), F.length(f["bucket"]),
        ), "\x02", 1),
    ))


def reference_number(ref: Column, highest_digits: int = 7) -> Column:
    """The code point of ``&#n;`` or ``&#xn;``, of any number of digits; 0x110000 if it is too large."""
    is_hex = ref.rlike("^&#[xX]")
    digits = F.regexp_extract(ref, "^&#[xX]?0*([0-9a-fA-F]*)", 1)
    short = F.length(digits) <= highest_digits
    value = F.conv(F.when(digits == "", F.lit("0")).otherwise(digits), 16, 10).cast("long")
    decimal = F.try_to_number(F.when(digits == "", F.lit("0")).otherwise(digits), F.lit("9999999"))
    return F.when(~short, F.lit(0x110000)).when(is_hex, value).otherwise(decimal.cast("long"))


def code_point(number: Column) -> Column:
    """The character with this number; ``number`` must be one of a character."""
    return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")


CP1252 = [bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0)]
# Names that also count without a semicolon, the longest first.
_BARE = sorted((n for n in html.entities.html5 if not n.endswith(";")), key=len, reverse=True)
_REFERENCE = r"&(?:#[xX][0-9a-fA-F]++;?|#[0-9]++;?|[A-Za-z][A-Za-z0-9]*+;?)"


def _decoded(ref: Column) -> Column:
    number = reference_number(ref)
    no_character = (
        number.between(1, 8) | (number == 0xB) | number.between(0xE, 0x1F) | (number == 0x7F)
        | number.between(0xFDD0, 0xFDEF) | (number.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    )
    latin = F.split(F.lit("|".join(CP1252)), r"\|")
    numeric = (
        F.when(number.between(0x80, 0x9F), F.get(latin, (number - 0x80).cast("int")))
        .when((number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF), F.lit("\ufffd"))
        .when(no_character, F.lit(""))
        .otherwise(code_point(F.when(number <= 0x10FFFF, number)))
    )
    name = F.substring(ref, 2, 100_000_000)
    bare = F.regexp_extract(ref, "^&(" + "|".join(_BARE) + ")", 1)
    legacy = F.when(bare != "", F.concat(
        named_value(html.entities.html5, bare), F.substring(ref, F.length(bare) + 2, F.length(ref))))
    named = F.coalesce(named_value(html.entities.html5, name), legacy, ref)
    return F.when(ref.startswith("&#"), numeric).otherwise(named)


def unescape_html(col: Column) -> Column:
    """Decode named and numeric character references as HTML 5 does; texts without ``&`` skip it."""
    return bind(col, lambda t: F.when(t.contains("&"), rewrite_matches(t, _REFERENCE, _decoded, first="&")).otherwise(t))


def _code_points(ranges: str):
    for part in ranges.split():
        first, _, last = part.partition("-")
        yield from range(int(first, 16), int(last or first, 16) + 1)


@lru_cache(maxsize=1)
def emoji_names() -> dict[str, str]:
    """Emoji -> name, from the Unicode character names with the CLDR exceptions."""
    names = {}
    for point in _code_points(EMOJI_SYMBOLS + " " + EMOJI_BLOCKS):
        name = unicodedata.name(chr(point), "")
        if name:
            names[chr(point)] = name.lower().replace(" ", "_")
    names.update({base: f"person_{action}" for base, action in EMOJI_ACTIONS.items()})
    names.update(EMOJI_ROLES)
    names.update(EMOJI_CLDR_NAMES)
    return names


_ZWJ, _TONE = "\u200d", "\x05"  # _TONE: where the skin tones go in a name, if not at its end


@lru_cache(maxsize=1)
def emoji_sequences() -> dict[str, str]:
    """Emoji of several joined code points -> name, without variation selectors and skin tones."""
    people = {"👨": "man", "👩": "woman", "🧑": "person"}
    names = {_ZWJ.join(parts): name for parts, name in EMOJI_JOINED.items()}
    for person, word in people.items():
        prefix = "" if word == "person" else f"{word}_"
        names.update({f"{person}{_ZWJ}{o}": prefix + role for o, role in EMOJI_PROFESSIONS.items()})
        names.update({f"{person}{_ZWJ}{o}": f"{word}_{state}" for o, state in EMOJI_STATES.items()})
        names.update({f"{person}{_ZWJ}{o}": f"{word}{_TONE}_{hair}" for o, hair in EMOJI_HAIR.items()})
        for other, second in people.items():
            pair = f"{word}_{second}"
            names[_ZWJ.join([person, "❤", other])] = f"couple_with_heart_{pair}"
            names[_ZWJ.join([person, "❤", "💋", other])] = f"kiss_{pair}"
    for sign, word in [("♀", "woman"), ("♂", "man")]:
        names.update({f"{base}{_ZWJ}{sign}": f"{word}_{action}" for base, action in EMOJI_ACTIONS.items()})
        names.update({f"{base}{_ZWJ}{sign}": f"{word}_{role}" for base, role in EMOJI_ROLES.items()})
        for base in "👱🧔":  # looks, not actions: the tone belongs to the person
            names[f"{base}{_ZWJ}{sign}"] = f"{word}{_TONE}_{EMOJI_ACTIONS[base]}"
            names[base] = f"person{_TONE}_{EMOJI_ACTIONS[base]}"
    words = {**people, "👦": "boy", "👧": "girl"}
    for parents in ["👨", "👩", "👨👩", "👨👨", "👩👩"]:
        for children in ["👦", "👧", "👧👦", "👦👦", "👧👧"]:
            family = parents + children
            names[_ZWJ.join(family)] = "_".join(["family", *(words[p] for p in family)])
    return names


# Two dense tables indexed by code point keep the lookup constant-time inside the JVM.
_SYMBOL_BASE, _SYMBOL_END = 0x203C, 0x3299
_PICTO_BASE, _PICTO_END = 0x1F004, 0x1FAFF
_EMOJI_SET = r"\x{a9}\x{ae}\x{203c}-\x{3299}\x{1f004}-\x{1f3fa}\x{1f400}-\x{1faff}"
_PYTHON_EMOJI_SET = "[\xa9\xae\u203c-\u3299\U0001f004-\U0001f3fa\U0001f400-\U0001faff]"  # the same for Python
_EMOJI_UNIT = rf"[{_EMOJI_SET}]\x{{fe0f}}?[\x{{1f3fb}}-\x{{1f3ff}}]?(?:\x{{200d}}(?=[{_EMOJI_SET}]))?"
_TONES = r"\x{1f3fb}-\x{1f3ff}"
_FLAG = r"[\x{1f1e6}-\x{1f1ff}]{2}"
_KEYCAP = r"[0-9#*]\x{fe0f}?\x{20e3}"
_PART_FLAG = r"\x{1f3f4}[\x{e0061}-\x{e007a}]{5}\x{e007f}"


def _sequence_pattern(sequences) -> str:
    """Any of the sequences, longer ones first, each code point with its selector and tone; by first code point."""
    def unit(char: str) -> str:
        return char if char == _ZWJ else rf"\x{{{ord(char):x}}}\x{{fe0f}}?[{_TONES}]?"

    rests: dict[str, list[str]] = {}
    for sequence in sorted(sequences, key=len, reverse=True):
        rests.setdefault(sequence[0], []).append("".join(map(unit, sequence[1:])))
    return "|".join(f"{unit(first)}(?:{'|'.join(found)})" for first, found in rests.items())


def _dense(names: dict[str, str], base: int, end: int) -> Column:
    """Names by offset as one array literal (constant-folded by the optimizer)."""
    return F.split(F.lit("|".join(names.get(chr(p), "") for p in range(base, end + 1))), r"\|")


def _emoji_name(point: Column, names: dict[str, str]) -> Column:
    return (
        F.when(point >= _PICTO_BASE,
               F.get(_dense(names, _PICTO_BASE, _PICTO_END), point - _PICTO_BASE))
        .when(point >= _SYMBOL_BASE,
              F.get(_dense(names, _SYMBOL_BASE, _SYMBOL_END), point - _SYMBOL_BASE))
        .when(point == 0xA9, F.lit(names.get("\xa9", "")))
        .otherwise(F.lit(names.get("\xae", "")))
    )


def _region_name(flag: Column) -> Column:
    """The name of the region whose two letters make up the flag, from the locale data among Spark's jars; or null."""
    letters = [F.char(F.ascii(F.substring(flag, at, 1)) - 0x1F1E6 + 65) for at in (1, 2)]

    def name(code: Column) -> Column:
        found = F.reflect(F.lit("com.ibm.icu.util.ULocale"), F.lit("getDisplayCountry"),
                          F.concat(F.lit("und-"), code), F.lit("en"))
        return F.when((found != code) & ~code.isin(*REGIONS_WITHOUT_FLAG.split()), F.translate(found, " ", "_"))

    return bind(F.concat(*letters), name)


def _emoji_unit_text(unit: Column, names: dict[str, str], sequences: dict[str, str]) -> Column:
    spelled = F.transform(
        F.array_distinct(F.regexp_extract_all(unit, F.lit(f"[{_TONES}]"), F.lit(0))),
        lambda t: F.concat(F.lit("_"), F.get(F.array(*[F.lit(n) for n in SKIN_TONES]), F.ascii(t) - 0x1F3FB)),
    )
    part_flag = F.element_at(
        F.create_map(*[F.lit(x) for pair in EMOJI_PART_FLAGS.items() for x in pair]),
        F.array_join(F.transform(F.regexp_extract_all(unit, F.lit(r"[\x{e0061}-\x{e007a}]"), F.lit(0)),
                                 lambda c: F.char(F.ascii(c) - 0xE0000)), ""))
    sequence = named_value(sequences, F.regexp_replace(unit, rf"[\x{{fe0f}}{_TONES}]", ""))
    letter = _emoji_name(F.ascii(F.substring(unit, 2, 1)), names)
    parts = F.struct(
        unit.alias("unit"),
        F.coalesce(sequence, F.concat(_emoji_name(F.ascii(unit), names), F.lit(_TONE))).alias("name"),
        F.array_join(spelled, "").alias("tone"),
    )

    def joined(p: Column) -> Column:
        placed = F.when(p["name"].contains(_TONE), F.replace(p["name"], F.lit(_TONE), p["tone"])).otherwise(
            F.concat(p["name"], p["tone"]))
        return F.when(p["name"] == _TONE, p["unit"]).otherwise(F.concat(F.lit(":"), placed, F.lit(":")))

    two_letters = F.concat(F.lit(":"), _emoji_name(F.ascii(unit), names), F.lit("::"), letter, F.lit(":"))
    flag = F.coalesce(F.concat(F.lit(":"), _region_name(unit), F.lit(":")), two_letters)
    return (
        F.when(unit.rlike(f"^{_FLAG}$"), flag)
        .when(unit.rlike(r"\x{20e3}$"), F.concat(F.lit(":keycap_"), F.substring(unit, 1, 1), F.lit(":")))
        .when(unit.rlike(r"\x{e007f}$"), F.coalesce(F.concat(F.lit(":"), part_flag, F.lit(":")), unit))
        .otherwise(bind(parts, joined))
    )


def emoji_to_text(col: Column, extra_names: dict[str, str] | None = None) -> Column:
    """Emoji become their names; every colon, also one that was in the text, becomes a space.

    The longest known sequence counts: joined emoji, flags, keycaps and skin tones have one name. Parts of an
    unknown sequence are spelled one by one. ``extra_names`` overrides or adds names, of single code points
    or of joined ones (without variation selectors and skin tones).
    """
    extra = extra_names or {}
    names = {**emoji_names(), **{e: name for e, name in extra.items() if len(e) == 1}}
    sequences = {**emoji_sequences(), **{e: name for e, name in extra.items() if len(e) > 1 or e in emoji_sequences()}}
    known = _sequence_pattern(s for s in sequences if len(s) > 1)
    # One class tells most characters apart from those that may start an emoji, before any sequence is tried.
    others = sorted({s[0] for s in sequences if not re.match(_PYTHON_EMOJI_SET, s[0])})
    starts = _EMOJI_SET + "".join(rf"\x{{{ord(c):x}}}" for c in others)
    pattern = rf"{_KEYCAP}|(?=[{starts}])(?:{_FLAG}|{_PART_FLAG}|{known}|{_EMOJI_UNIT})"
    spelled = rewrite_matches(
        col, pattern, lambda unit: _emoji_unit_text(unit, names, sequences),
        marks=rf"(?![\x{{00}}-\x{{a8}}])[{starts}]", first=f"0-9#*{starts}")
    return F.translate(spelled, ":", " ")
