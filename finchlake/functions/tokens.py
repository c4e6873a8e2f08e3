"""Tokenizers and token-array functions (Column -> Column)."""

from __future__ import annotations

import html.entities
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from finchlake.constants import (
    CONNECTIVES, NEGATIONS, SENTENCE_ENDS, STOPWORDS, WORDNET_CLASSES,
)
from finchlake.functions.patterns import (
    EMOTICON, NOT_SPACE, SPACE, SPACE_SET, TWEET_TOKEN, WORD, alternation,
)
from finchlake.functions.text import bind, rewrite_matches, space_words
from finchlake.functions.unicode import code_point, named_value, reference_number

_SEP = "\x01"  # joins tokens that may contain spaces; never part of a token


# ---------------------------------------------------------------- tweet tokenizer

def _tokenizer_entities(col: Column) -> Column:
    """Decode ``&name;`` and ``&#n;`` as the tweet tokenizer does; unknown references vanish."""
    names = {n: chr(p) for n, p in html.entities.name2codepoint.items()}
    cp1252 = F.split(
        F.lit("|".join(bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0))), r"\|"
    )

    def decode(ref: Column) -> Column:
        numbered = ref.rlike("^&#(?:[xX][0-9a-fA-F]+|[0-9]+);$")
        number = F.when(numbered, reference_number(ref))
        char = (
            F.when(number.between(0x80, 0x9F), F.get(cp1252, (number - 0x80).cast("int")))
            .when(number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF),
                  code_point(F.when(number <= 0x10FFFF, number)))
        )
        named = named_value(names, F.regexp_extract(ref, "^&(.*);$", 1))
        return F.coalesce(F.when(ref.startswith("&#"), char).otherwise(named), F.lit(""))

    unit = rf"&[^&;{SPACE_SET}]+;"
    return bind(
        col, lambda t: F.when(t.contains("&"), rewrite_matches(t, unit, decode, first="&")).otherwise(t)
    )


def tweet_tokens(col: Column, lowercase: bool = True, folded: bool = False) -> Column:
    """Tokens of a tweet: URLs, emoticons, handles, hashtags and words stay whole.

    Character runs of three and more count as three, handles are kept, and everything but emoticons
    is lowercased. ``folded`` says that the text is lowercase already, which saves a pass over the
    tokens.
    """
    decoded = _tokenizer_entities(col)
    squeezed = F.regexp_replace(F.lower(decoded) if folded else decoded, r"(.)\1{3,}", "$1$1$1")
    tokens = F.regexp_extract_all(squeezed, F.lit(TWEET_TOKEN), F.lit(0))
    if folded or not lowercase:
        return tokens

    def lower_all(found: Column) -> Column:
        face = F.exists(found, lambda t: (F.lower(t) != t) & t.rlike(EMOTICON))
        careful = F.transform(found, lambda t: F.when(t.rlike(EMOTICON), t).otherwise(F.lower(t)))
        return F.when(face, careful).otherwise(F.transform(found, F.lower))

    return bind(tokens, lower_all)


# ---------------------------------------------------------------- word tokenizer

# Penn-Treebank-style splitting as an ordered list of (pattern, replacement); rules that cannot meet in one place
# share a pattern. Conditions on what precedes are checked after the first literal character has matched.
_TREEBANK = [
    (r"[;@#$%&?!*\[\](){}<>\"«»“”‘’„`]|[:,](?=[^0-9]|$)|\.{2,}|--+", " $0 "),
    (rf"\.(?<=[^.{SPACE_SET}]\.)(?=[{SPACE_SET}]|$)", " . "),
]
# For texts with an apostrophe.
_CLITICS = [
    (rf"'(?<=[^{SPACE_SET}']')(?=[{SPACE_SET}]|$)", " ' "),
    (rf"(?i)('(?<=[^{SPACE_SET}']')(?:s|m|d|ll|re|ve)|n(?<=[^{SPACE_SET}']n)'t)(?![^{SPACE_SET}])", " $1"),
]
_JOINED_WORDS = (
    rf"(?=[cgwlCGWL])(?i:can(?=not(?![^{SPACE_SET}]))|(?:gon|wan)(?=na(?![^{SPACE_SET}]))"
    rf"|got(?=ta(?![^{SPACE_SET}]))|(?:gim|lem)(?=me(?![^{SPACE_SET}])))(?<![^{SPACE_SET}].{{3}})"
)
_BEFORE_CORE, _AFTER_CORE = r"[(\[{\"'“‘«]", r"[)\]}\"'”’»,;:]+"


def word_core(word: Column) -> Column:
    """A word without the brackets, quotes and commas around it."""
    return F.regexp_replace(F.regexp_replace(word, f"^{_BEFORE_CORE}+", ""), f"{_AFTER_CORE}$", "")


def word_cores(col: Column) -> Column:
    """The cores of all words of the text, without empty ones, by one pass over the text."""
    around = rf"{_BEFORE_CORE}(?<![^{SPACE_SET}].){_BEFORE_CORE}*|{_AFTER_CORE}(?![^{SPACE_SET}])"
    return space_words(F.regexp_replace(col, around, ""))


def is_stopped(core: Column) -> Column:
    """True for a word with one final full stop."""
    return core.rlike(r"[^.]\.$")


def stopless(core: Column) -> Column:
    """The lowercase word without its one final full stop."""
    return F.lower(F.regexp_replace(core, r"(?<=[^.])\.$", ""))


def word_pairs(col: Column) -> Column:
    """struct(w, n) of every run between white space and the next one, empty after the last."""
    return bind(space_words(col), lambda found: F.zip_with(
        found, F.slice(found, 2, F.greatest(F.size(found), F.lit(1))),
        lambda w, n: F.struct(w.alias("w"), F.coalesce(n, F.lit("")).alias("n"))))


def closed_word(pair: Column, abbreviation: Column, starter: Column) -> Column:
    """The word of the pair, with a space before its full stop if that ends a sentence.

    It does so at the end of the text and after any word that is neither an abbreviation nor an initial;
    after those only if the next word is capitalised and a known sentence starter.
    """
    core = word_core(pair["w"])
    inside = (abbreviation | core.rlike(r"^\p{L}\.$")) & (pair["n"] != "")
    ends = is_stopped(core) & (~inside | (starter & word_core(pair["n"]).rlike(r"^\p{Lu}")))
    closed = F.when(ends, F.regexp_replace(pair["w"], r"\.([)\]}\"'”’»,;:]*)$", " .$1")).otherwise(pair["w"])
    return F.when(pair["w"].contains("."), closed).otherwise(pair["w"])


def split_stops(col: Column, learned: dict[str, str]) -> Column:
    """The text with a space before the full stops that end a sentence, by words looked up inside the row.

    ``learned`` comes from :func:`finchlake.operators.sentences.literals`.
    """
    def known(kind: str, word: Column) -> Column:
        if not learned:
            return F.lit(False)
        return named_value(learned, F.concat(F.lit(f"{kind}:"), stopless(word_core(word)))).isNotNull()

    return F.array_join(F.transform(
        word_pairs(col), lambda p: closed_word(p, known("a", p["w"]), known("s", p["n"]))), " ")


def word_tokens(col: Column, merge_contractions: bool = False, stops_split: bool = False) -> Column:
    """Treebank-style word tokens: punctuation and clitics are split off.

    With ``merge_contractions`` words with an inner apostrophe (``'`` or ``’``) stay whole. ``stops_split``
    says that sentence ends are split off already (:func:`split_stops`), so that other full stops stay.
    """
    if merge_contractions:
        pattern = rf"{WORD}+(?:['’]{WORD}++)*+|{NOT_SPACE}"
        return F.regexp_extract_all(col, F.lit(pattern), F.lit(0))
    for pattern, replacement in _TREEBANK:
        if stops_split and replacement == " . ":
            continue
        col = F.regexp_replace(col, pattern, replacement)

    def clitics(text: Column) -> Column:
        split = text
        for pattern, replacement in _CLITICS:
            split = F.regexp_replace(split, pattern, replacement)
        return F.when(text.contains("'"), split).otherwise(text)

    return space_words(F.regexp_replace(bind(col, clitics), _JOINED_WORDS, "$0 "))


# ---------------------------------------------------------------- negation and contrast

def join_negations(
    col: Column, words: Iterable[str] = NEGATIONS, merge_contractions: bool = False
) -> Column:
    """``not good`` -> ``not_good``; the word after a negation is consumed, also if it is one.

    Tokens hold no spaces, so the scan is one left-to-right, non-overlapping replacement over the
    space-joined tokens, which stays linear in the text length.
    """
    words = list(words)
    if merge_contractions:
        words += [w.replace("’", "'") for w in words if "’" in w]
    joined = F.array_join(word_tokens(F.lower(col), merge_contractions), " ")
    return F.regexp_replace(
        joined, rf"(?<![^ ])(?:{alternation(words)}) ([a-zA-Z]+)(?![^ ])", "not_$1"
    )


def _mark_scopes(joined: Column, sep: str, prefix: str, connectives: list[str], end: str) -> Column:
    """Prefix the tokens between a connective and the next sentence end.

    A match starts at a connective or where the previous match ended (``\\G``), walks over tokens
    that are never prefixed, and takes one token to prefix; it fails at a sentence end, so marking
    resumes only at a later connective. Linear in the text length.
    """
    token_end = rf"(?={sep}|$)"
    skipped = rf"(?:(?:{alternation(connectives)})|{SPACE}*){token_end}"
    return F.regexp_replace(
        joined,
        rf"((?:\G(?<!^)|(?<=^|{sep})(?:{alternation(connectives)})(?={sep}))"
        rf"(?:{sep}{skipped})*+{sep})(?!{end})(?!{skipped})([^{sep}]+)",
        f"$1{prefix}$2",
    )


def mark_contrast_text(col: Column, connectives: list[str] = CONNECTIVES) -> Column:
    """Text form: ``contrast_`` prefix until a token that starts with ``.``, ``!`` or ``?``."""
    joined = F.array_join(word_tokens(F.lower(col)), " ")
    return _mark_scopes(joined, " ", "contrast_", connectives, "[.!?]")


def mark_contrast_tokens(tokens: Column, connectives: list[str] = CONNECTIVES) -> Column:
    """Token form: ``BUT_`` prefix until a token equal to ``.``, ``!`` or ``?``."""
    end = rf"(?:{alternation(SENTENCE_ENDS)})(?={_SEP}|$)"
    marked = _mark_scopes(F.array_join(tokens, _SEP), _SEP, "BUT_", connectives, end)
    return F.when(F.size(tokens) > 0, F.split(marked, _SEP, -1)).otherwise(tokens)


# ---------------------------------------------------------------- tags, stop words, sentences

def wordnet_class(tag: Column) -> Column:
    """Penn tag -> WordNet class letter, noun by default."""
    branches = F
    for initial, letter in WORDNET_CLASSES.items():
        branches = branches.when(tag.startswith(initial), F.lit(letter))
    return branches.otherwise(F.lit("n"))


def tag_by_ending(token: Column) -> Column:
    """A Penn tag guessed from the ending, for texts that come without tags."""
    return (
        F.when(token.endswith("ing"), "VBG").when(token.endswith("ed"), "VBD")
        .when(token.endswith("ly"), "RB").when(token.endswith("er"), "JJR")
        .when(token.endswith("est"), "JJS").otherwise("NN")
    )


def lemmatized(tokens: Column, lemmas: dict[str, str], tag: Callable[[Column], Column] = tag_by_ending) -> Column:
    """Tokens replaced by their lemma from ``lemmas`` (class:word -> lemma) inside the row; others stay.

    The table is one literal in buckets, of which a token reads one, so it suits streams and fitted stages.
    """
    if not lemmas:
        return tokens
    return F.transform(tokens, lambda t: F.coalesce(
        named_value(lemmas, F.concat(wordnet_class(tag(t)), F.lit(":"), t)), t))


def drop_stopwords(
    tokens: Column,
    keep_negations: bool = True,
    stopwords: Iterable[str] = STOPWORDS,
    negations: Iterable[str] = NEGATIONS,
) -> Column:
    dropped = set(stopwords) - (set(negations) if keep_negations else set())
    return F.filter(tokens, lambda t: ~t.isin(*sorted(dropped)))


def sentences(col: Column) -> Column:
    """Pieces between runs of ``.``, ``!`` and ``?``, trimmed, without empty ones."""
    trimmed = F.transform(
        F.split(col, "[.!?]+", -1), lambda s: F.regexp_replace(s, f"^{SPACE}+|{SPACE}+$", "")
    )
    return F.filter(trimmed, lambda s: s != "")


def sentence_stats(col: Column) -> Column:
    """struct(min, max, mean) of the sentence lengths in tokens; all zero without a sentence."""
    sizes = F.filter(
        F.transform(sentences(col), lambda s: F.size(tweet_tokens(s, lowercase=False))),
        lambda n: n > 0,
    )

    def summary(found: Column) -> Column:
        total = F.aggregate(found, F.lit(0), lambda acc, n: acc + n)
        return F.struct(
            F.coalesce(F.array_min(found), F.lit(0)).alias("min"),
            F.coalesce(F.array_max(found), F.lit(0)).alias("max"),
            F.when(F.size(found) > 0, total / F.size(found)).otherwise(F.lit(0.0)).alias("mean"),
        )

    return bind(sizes, summary)


def length_tokens(stats: Column) -> Column:
    """``MIN_LEN<k>``, ``MAX_LEN<k>``, ``MEAN_LEN<k>`` with k the length in steps of five."""
    def one(stat: Column, name: str) -> Column:
        step = F.floor(stat[name.lower()] / 5).cast("string")
        return F.concat(F.lit(f"{name}_LEN<"), step, F.lit(">"))

    return bind(stats, lambda s: F.array(one(s, "MIN"), one(s, "MAX"), one(s, "MEAN")))


# ---------------------------------------------------------------- n-grams

def token_ngrams(tokens: Column, n: int) -> Column:
    """Runs of ``n`` neighbouring tokens joined by a space; empty when there are too few."""
    def grams(found: Column) -> Column:
        count = F.greatest(F.size(found) - (n - 1), F.lit(0))
        out = F.slice(found, 1, count)
        for k in range(1, n):
            out = F.zip_with(
                out, F.slice(found, k + 1, count), lambda left, right: F.concat_ws(" ", left, right)
            )
        return out

    return bind(tokens, grams)


def clean_chars(col: Column) -> Column:
    """What character n-grams are cut from: lowercase text, runs of white space as one space."""
    return F.regexp_replace(F.lower(col), f"{SPACE}{SPACE}+", " ")


def char_windows(col: Column, size: int = 5) -> Column:
    """At every character the window of up to ``size`` characters starting there.

    The text is lowercased and runs of white space become one space. One zero-width regex pass finds
    all windows; the first class keeps a window from starting inside a surrogate pair.
    """
    clean = clean_chars(col)
    pattern = rf"(?s)(?=([^\x{{DC00}}-\x{{DFFF}}].{{0,{size - 1}}}))"
    return F.regexp_extract_all(clean, F.lit(pattern), F.lit(1))


def window_grams(window: Column, low: int = 3, high: int = 5) -> Column:
    """The n-grams that start where the window starts."""
    grams = [F.when(F.length(window) >= n, F.substring(window, 1, n)) for n in range(low, high + 1)]
    return F.array_compact(F.array(*grams))


def char_ngrams(col: Column, low: int = 3, high: int = 5) -> Column:
    """All character n-grams of the text as one array (for in-row hashing)."""
    clean = clean_chars(col)

    def pattern(n: int) -> Column:
        return F.lit(rf"(?s)(?=([^\x{{DC00}}-\x{{DFFF}}].{{{n - 1}}}))")

    return bind(clean, lambda text: F.concat(
        *[F.regexp_extract_all(text, pattern(n), F.lit(1)) for n in range(low, high + 1)]
    ))


# ---------------------------------------------------------------- lexicon

def count_hits(tokens: Column, words: Iterable[str]) -> Column:
    """Number of tokens in a word list known to the driver (a hash-set test in every row)."""
    words = sorted(set(words))
    if not words:
        return F.lit(0)
    return F.size(F.filter(tokens, lambda t: t.isin(*words)))


def lexicon_markers(pos_hits: Column, neg_hits: Column) -> Column:
    return F.concat(
        F.array_repeat(F.lit("LEX_POS"), pos_hits), F.array_repeat(F.lit("LEX_NEG"), neg_hits)
    )
