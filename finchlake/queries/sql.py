"""Building blocks of the check queries: plain SQL over the given tables, one CTE per step."""

from __future__ import annotations

from finchlake.constants import CONNECTIVES, CONTRACTIONS, NEGATIONS, SLANG
from finchlake.functions.patterns import SPACE_SET, alternation
from finchlake.queries.fixtures import EMOJI_ENDINGS, FOLDS, LEXICON, SENTENCE_ENDINGS, SUFFIXES

S = SPACE_SET
W = r"[\p{L}\p{N}_]"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def words(values) -> str:
    return "(" + ", ".join(text(v) for v in values) + ")"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(dict.fromkeys(ctes)) + "\n"


def case_of(mapping: dict[str, str], subject: str) -> str:
    arms = " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in mapping.items())
    return f"CASE {subject} {arms} ELSE {subject} END"


NOISY = "noisy AS (SELECT doc_id, text || CASE doc_id % 8 " + " ".join(
    f"WHEN {i} THEN {text(s)}" for i, s in enumerate(SUFFIXES)
) + " END AS text FROM documents)"

WITH_EMOJI = "with_emoji AS (SELECT doc_id, text || ' so: ' || CASE doc_id % 30 " + " ".join(
    f"WHEN {i} THEN {text(e)}" for i, e in enumerate(EMOJI_ENDINGS)
) + " END AS text FROM documents)"

# The normal forms of the endings in fixtures.FORM_ENDINGS, in their order, written out.
FORMS = [
    "Abc123", "ff fi fl ffi ffl st", "x2 y3 z1 4 2", "1⁄2 1⁄4 3⁄4 1⁄3", "No TM SM TEL", "IV ix XII", "1 20 a Z",
    "kg km ln 株式会社", "アイウ \u30ac \u30d1", "\uac00 \uac01", "\u00e9 \u1ed1 \u00f1", "\u1ead q\u0323\u0307",
    "\u00c5 Ω K", "s \u1e69", "a b c d e", "... .. !! ??", "Ab C D 9", "صلى الله عليه وسلم لا ب", "豈 來",
    "D\u017d d\u017e LJ ʼn", " \u0301  \u0308  \u0304  \u0327", "ـ\u064e  \u0651", "\u304c \u30d1",
    "क\u093c क\u093c ড\u09bc", "a o μ h w", "〜 ~ \u3099 ー", "\ud558 \uac01", "(一) 秘 1月 0点", "# @ {} ¥",
    "plain \u00e9 ß ж 漢",
]
WITH_FORMS = "with_forms AS (SELECT doc_id, " + "nfc_normalize(text) || ' so: ' || CASE doc_id % 30 " + " ".join(
    f"WHEN {i} THEN {text(e)}" for i, e in enumerate(FORMS)
) + " END AS text FROM documents)"

LABELLED = (
    "labelled AS (SELECT n.doc_id, CASE WHEN l.quality = 1 THEN 'positive' ELSE 'negative' END AS label, "
    "n.text FROM noisy n JOIN labels l ON l.doc_id = n.doc_id)"
)


def nfkc(e: str) -> str:
    """Compatibility forms that occur in the texts: full-width letters, a ligature, an ellipsis."""
    e = f"nfc_normalize({e})"
    for old, new in [("Ｆ", "F"), ("ｆ", "f"), ("ｕ", "u"), ("ｌ", "l"), ("ﬁ", "fi"), ("…", "...")]:
        e = f"replace({e}, '{old}', '{new}')"
    return e


def no_urls(e: str) -> str:
    return rf"regexp_replace({e}, 'http[^{S}]+|www\.[^{S}]+', ' ', 'g')"


def emoji(e: str) -> str:
    return f"replace(replace({e}, '\U0001F600', ':grinning_face:'), ':', ' ')"


# The names of the emoji that end the texts, written out, longer sequences before their parts.
EMOJI_NAMES = [
    ("👨‍👩‍👧‍👦", "family_man_woman_girl_boy"), ("👩‍👧", "family_woman_girl"), ("🏳️‍🌈", "rainbow_flag"),
    ("🏴‍☠️", "pirate_flag"), ("🇫🇷", "France"), ("🇺🇸", "United_States"), ("🇨🇮", "Côte_d’Ivoire"),
    ("🏴󠁧󠁢󠁥󠁮󠁧󠁿", "England"), ("1️⃣", "keycap_1"), ("#⃣", "keycap_#"), ("👩‍💻", "woman_technologist"),
    ("🧑🏽‍🚀", "astronaut_medium_skin_tone"), ("👨🏿‍🦰", "man_dark_skin_tone_red_hair"),
    ("🏃🏻‍♀️", "woman_running_light_skin_tone"), ("🤷‍♂️", "man_shrugging"), ("👮‍♀️", "woman_police_officer"),
    ("👩‍❤️‍💋‍👨", "kiss_woman_man"), ("👩🏻‍🤝‍👩🏿", "women_holding_hands_light_skin_tone_dark_skin_tone"),
    ("❤️‍🔥", "heart_on_fire"), ("😮‍💨", "face_exhaling"), ("🧔🏼", "person_medium-light_skin_tone_beard"),
    ("👍🏾", "thumbs_up_medium-dark_skin_tone"), ("👩‍", "woman"), ("❤️", "red_heart"), ("😀", "grinning_face"),
    ("😂", "face_with_tears_of_joy"), ("🔥", "fire"), ("☀️", "sun"), ("©", "copyright"),
    ("🇦", "regional_indicator_symbol_letter_a"),
]


def emoji_sequences(e: str) -> str:
    for found, name in EMOJI_NAMES:
        e = f"replace({e}, '{found}', ':{name}:')"
    return f"replace({e}, ':', ' ')"


def no_digits(e: str) -> str:
    return rf"regexp_replace({e}, '\p{{Nd}}', '', 'g')"


def rewrite(e: str, pattern: str, each: str) -> str:
    """Replace matches of ``pattern``; ``each`` is SQL over the match ``m``."""
    gaps, hits = f"string_split_regex({e}, {text(pattern)})", f"regexp_extract_all({e}, {text(pattern)})"
    fills = f"list_append(list_transform({hits}, lambda m: {each}), '')"
    return (
        f"array_to_string(list_transform(list_zip({gaps}, {fills}), lambda z: z[1] || z[2]), '')"
    )


def hashtag_split(e: str) -> str:
    bare = "regexp_replace(m, '^#+', '')"
    spaced = rf"regexp_replace({bare}, '([a-z])([A-Z])', '\1 \2', 'g')"
    return rewrite(e, f"#{W}+", f"' ' || lower(replace({spaced}, '_', ' ')) || ' '")


def slang(e: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({e}, '[^{S}]+'), "
        f"lambda w: {case_of(SLANG, 'w')}), ' ')"
    )


def contractions(e: str) -> str:
    return rewrite(e, alternation(list(CONTRACTIONS)), case_of(CONTRACTIONS, "m"))


def clean(e: str) -> str:
    return slang(no_digits(f"lower({emoji(hashtag_split(no_urls(nfkc(e))))})"))


def squeezed(name: str, source: str, keep: int) -> str:
    """CTE ``name(doc_id, text)``: character runs cut to ``keep``, found as islands of equal characters."""
    return (
        f"{name}_c AS (SELECT doc_id, unnest(c) AS c, unnest(range(len(c))) AS pos FROM "
        f"(SELECT doc_id, string_split(text, '') AS c FROM {source})),\n"
        f"{name}_i AS (SELECT doc_id, c, pos, pos - row_number() OVER "
        f"(PARTITION BY doc_id, c ORDER BY pos) AS island FROM {name}_c),\n"
        f"{name}_r AS (SELECT doc_id, c, pos, row_number() OVER "
        f"(PARTITION BY doc_id, c, island ORDER BY pos) AS k FROM {name}_i),\n"
        f"{name} AS (SELECT doc_id, string_agg(c, '' ORDER BY pos) AS text FROM {name}_r "
        f"WHERE k <= {keep} OR c = chr(10) GROUP BY doc_id)"
    )


# Tweet token classes for RE2, which has no look-around: e-mail addresses go before bare domains.
_T = r"[\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{200c}\x{200d}]"
_L = r"\p{L}\p{M}\p{Nl}\x{203f}\x{2040}\x{2054}\x{fe33}\x{fe34}\x{fe4d}-\x{fe4f}\x{ff3f}\x{200c}\x{200d}"
_TS = _T[1:-1]
TWEET_RE = "(?i)" + "|".join([
    rf"(?:https?:(?:/{{1,3}}|[a-z0-9%])|[a-z0-9.\-]+[.][a-z]{{2,13}}/)[^{S}()<>{{}}\[\]]+"
    rf"[^{S}`!()\[\]{{}};:'\".,<>?«»“”‘’]",
    rf"[{_TS}.+\-]+@[{_TS}\-]+\.(?:[{_TS}\-]\.?)+[{_TS}\-]",
    r"[a-z0-9]+(?:[.\-][a-z0-9]+)*[.][a-z]{2,13}\b/?",
    r"(?:\+?[01][ *\-.)]*)?(?:\(?\p{Nd}{3}[ *\-.)]*)?\p{Nd}{3}[ *\-.)]*\p{Nd}{4}",
    r"[<>]?[:;=8][\-o*']?[)\](\[dDpP/:}{@|\\]|[)\](\[dDpP/:}{@|\\][\-o*']?[:;=8][<>]?|</?3",
    rf"<[^>{S}]+>",
    r"-+>|<-+",
    rf"@{_T}+",
    rf"#+{_T}+[{_TS}'\-]*{_T}+",
    rf"[{_L}][{_L}'\-_]+[{_L}]",
    r"[+\-]?\p{Nd}+[,/.:\-]\p{Nd}+[+\-]?",
    rf"{_T}+",
    rf"\.[{S}.]*\.",
    rf"[^{S}]",
])


def tweet_list(e: str) -> str:
    """Tokens of text that is already squeezed; faces keep their case, the rest is lowercased."""
    plain = f"regexp_extract_all(replace({e}, '&amp;', '&'), {text(TWEET_RE)})"
    face = r"[:;=8][\-o*'']?[)\](\[dDpP/:}{@|\\]|[)\](\[dDpP/:}{@|\\][\-o*'']?[:;=8]|</?3"
    return (
        f"list_transform({plain}, lambda t: CASE WHEN regexp_matches(t, '{face}') THEN t "
        f"ELSE lower(t) END)"
    )


CLEANED = f"cleaned AS (SELECT doc_id, {clean('text')} AS text FROM noisy)"
CLEANED_LOW = f"cleaned AS (SELECT doc_id, {clean('lower(text)')} AS text FROM noisy)"
CLEAN_SQ = squeezed("clean_sq", "cleaned", 3)
BASE_TOKENS = f"base AS (SELECT doc_id, {tweet_list('text')} AS toks FROM clean_sq)"
PRE = [NOISY, CLEANED, CLEAN_SQ, BASE_TOKENS]
PRE_LOW = [NOISY, CLEANED_LOW, CLEAN_SQ, BASE_TOKENS]

RAW_SQ = squeezed("raw_sq", "noisy", 3)
RAW_TOKENS = f"raw AS (SELECT doc_id, {tweet_list('text')} AS toks FROM raw_sq)"
RAW = [NOISY, RAW_SQ, RAW_TOKENS]

BIGRAMS = (
    "grams AS (SELECT doc_id, toks, list_transform(range(1, len(toks)), "
    "lambda i: toks[i] || ' ' || toks[i + 1]) AS pairs FROM base)"
)


def hits(e: str, side: str) -> str:
    return f"len(list_filter({e}, lambda t: t IN {words(LEXICON[side])}))"


FULL = (
    "full_tokens AS (SELECT doc_id, list_concat(list_concat(toks, pairs), list_concat("
    f"list_transform(range({hits('list_concat(toks, pairs)', 'pos')}), lambda i: 'LEX_POS'), "
    f"list_transform(range({hits('list_concat(toks, pairs)', 'neg')}), lambda i: 'LEX_NEG'))) AS toks "
    "FROM grams)"
)
TERMS = (
    "terms AS (SELECT doc_id, term, count(*) AS tf FROM "
    "(SELECT doc_id, unnest(toks) AS term FROM full_tokens) GROUP BY ALL)"
)
TERM_CTES = [*PRE_LOW, BIGRAMS, FULL, TERMS]

CHARS = (
    "chars AS (SELECT doc_id, unnest(c) AS c, unnest(range(len(c))) AS pos FROM (SELECT doc_id, "
    f"string_split(regexp_replace(lower(text), '[{S}][{S}]+', ' ', 'g'), '') AS c FROM noisy))"
)
WINDOWS = (
    "leads AS (SELECT doc_id, c, lead(c, 1) OVER w AS c1, lead(c, 2) OVER w AS c2, "
    "lead(c, 3) OVER w AS c3, lead(c, 4) OVER w AS c4 FROM chars WINDOW w AS "
    "(PARTITION BY doc_id ORDER BY pos)),\n"
    "gram_rows AS (SELECT doc_id, c || c1 || c2 AS term FROM leads WHERE c2 IS NOT NULL UNION ALL "
    "SELECT doc_id, c || c1 || c2 || c3 FROM leads WHERE c3 IS NOT NULL UNION ALL "
    "SELECT doc_id, c || c1 || c2 || c3 || c4 FROM leads WHERE c4 IS NOT NULL),\n"
    "grams_tf AS (SELECT doc_id, term, count(*) AS tf FROM gram_rows GROUP BY ALL)"
)
CHAR_CTES = [NOISY, CHARS, WINDOWS]


def tfidf(name: str, counts: str) -> str:
    """CTE ``name(doc_id, term, df, weight)`` from term counts."""
    return (
        f"{name}_df AS (SELECT term, count(*) AS df FROM {counts} GROUP BY term),\n"
        f"{name}_raw AS (SELECT t.doc_id, t.term, d.df, t.tf * (ln((1 + n.n) / (1 + d.df)) + 1) AS w "
        f"FROM {counts} t JOIN {name}_df d ON d.term = t.term, "
        f"(SELECT count(*)::DOUBLE AS n FROM documents) n),\n"
        f"{name}_norm AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM {name}_raw GROUP BY doc_id),\n"
        f"{name} AS (SELECT r.doc_id, r.term, r.df, r.w / m.norm AS weight FROM {name}_raw r "
        f"JOIN {name}_norm m ON m.doc_id = r.doc_id)"
    )


_CORE = (r"regexp_replace(regexp_replace(w, '^[(\[{\"''“‘«]+', ''), '[)\]}\"''”’»,;:]+$', '')")
# Words in rows, abbreviations and sentence starters by their likelihood ratios, and the texts put together again.
SENTENCES = (
    "sentence_docs AS (SELECT doc_id, text || CASE doc_id % 5 " + " ".join(
        f"WHEN {i} THEN {text(s)}" for i, s in enumerate(SENTENCE_ENDINGS)) + " END AS text FROM documents)",
    f"s_runs AS (SELECT doc_id, regexp_extract_all(text, '[^{S}]+') AS ws FROM sentence_docs)",
    "s_rows AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM s_runs)",
    f"s_cores AS (SELECT *, {_CORE} AS core FROM s_rows)",
    r"s_words AS (SELECT *, regexp_matches(core, '[^.]\.$') AS stopped, "
    r"lower(regexp_replace(core, '([^.])\.$', '\1')) AS word FROM s_cores)",
    "s_counts AS (SELECT word, count(*) FILTER (WHERE stopped) AS c, count(*) FILTER (WHERE NOT stopped) AS p, "
    "count(*) AS b FROM s_words WHERE core <> '' GROUP BY word)",
    "s_total AS (SELECT sum(c)::DOUBLE AS stops, sum(b)::DOUBLE AS n FROM s_counts)",
    "s_ratio AS (SELECT word, length(replace(word, '.', '')) AS letters, length(word) - length(replace(word, '.', '')) "
    "+ 1 AS dots, p, 2 * (c * ln(0.99) + p * ln(0.01) - c * ln(stops / n) - p * ln(1 - stops / n)) AS ratio "
    r"FROM s_counts, s_total WHERE c > 0 AND regexp_matches(word, '\p{L}'))",
    "s_abbr AS (SELECT word, ratio * exp(-letters) * dots * pow(letters, -p) AS score FROM s_ratio "
    "WHERE ratio * exp(-letters) * dots * pow(letters, -p) >= 0.3)",
    "s_next AS (SELECT core, word, stopped, lead(core) OVER w AS next_core, lead(word) OVER w AS next_word "
    "FROM s_words WHERE core <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY pos))",
    r"s_first AS (SELECT next_word AS word, count(*)::DOUBLE AS k FROM s_next WHERE regexp_matches(next_core, '^\p{L}') "
    r"AND (regexp_matches(core, '[!?]$') OR stopped AND NOT regexp_matches(word, '^\p{L}$|^[\p{N}.,]+$') "
    "AND word NOT IN (SELECT word FROM s_abbr)) GROUP BY next_word)",
    "s_ends AS (SELECT sum(k) AS a FROM s_first)",
    "s_start AS (SELECT word, 2 * (k * ln(k / a) + CASE WHEN a > k THEN (a - k) * ln(1 - k / a) ELSE 0 END "
    "+ CASE WHEN b > k THEN (b - k) * ln((b - k) / (n - a)) ELSE 0 END "
    "+ (n - a - b + k) * ln(1 - (b - k) / (n - a)) - b * ln(b / n) - (n - b) * ln(1 - b / n)) AS score "
    "FROM s_first JOIN s_counts USING (word), s_total, s_ends WHERE k / a > b / n)",
    "s_starters AS (SELECT * FROM s_start WHERE score >= 30)",
    "s_follow AS (SELECT doc_id, pos, w, core, stopped, word, lead(core) OVER v AS next_core, lead(word) OVER v "
    "AS next_word FROM s_words WINDOW v AS (PARTITION BY doc_id ORDER BY pos))",
    r"s_split AS (SELECT doc_id, pos, CASE WHEN stopped AND (next_word IS NULL OR NOT (word IN (SELECT word FROM s_abbr) "
    r"OR regexp_matches(core, '^\p{L}\.$')) OR next_word IN (SELECT word FROM s_starters) "
    r"AND regexp_matches(next_core, '^\p{Lu}')) "
    r"THEN regexp_replace(w, '\.([)\]}\"''”’»,;:]*)$', ' .\1') ELSE w END AS w FROM s_follow)",
    "s_text AS (SELECT doc_id, string_agg(w, ' ' ORDER BY pos) AS text FROM s_split GROUP BY doc_id)",
)


def treebank(e: str, stops: bool = True) -> str:
    """Word tokens of the lowercased text, without look-around; runs are split by passing twice.

    Without ``stops`` the full stops of sentence ends are split off already.
    """
    e = f"lower({e})"
    steps = [
        (r"\.{2,}", r" \0 "),
        (r"([:,])([^0-9]|$)", r" \1 \2"), (r"([:,])([^0-9]|$)", r" \1 \2"),
        (r"[;@#$%&?!*\[\](){}<>\"«»“”‘’„`]", r" \0 "),
        (r"--+", r" \0 "),
        (rf"([^.{S}])\.([{S}]|$)", r"\1 . \2"),
        (rf"([^{S}'])'([{S}]|$)", r"\1 ' \2"),
        (rf"([^{S}'])('(?:s|m|d|ll|re|ve)|n't)([{S}]|$)", r"\1 \2\3"),
    ]
    for pattern, replacement in steps:
        if not stops and replacement == r"\1 . \2":
            continue
        e = f"regexp_replace({e}, {text(pattern)}, {text(replacement)}, 'g')"
    return f"regexp_extract_all({e}, '[^{S}]+')"


WORD_ROWS = (
    "word_rows AS (SELECT doc_id, unnest(w) AS tok, unnest(range(len(w))) AS pos FROM "
    f"(SELECT doc_id, {treebank('text')} AS w FROM noisy))"
)
NEGATION = (
    f"marked AS (SELECT *, tok IN {words(NEGATIONS)} AS neg, "
    "regexp_full_match(tok, '[a-zA-Z]+') AS alpha FROM word_rows),\n"
    "runs AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, neg ORDER BY pos) AS run "
    "FROM marked),\n"
    "heads AS (SELECT *, neg AND row_number() OVER (PARTITION BY doc_id, neg, run ORDER BY pos) % 2 = 1 "
    "AS head FROM runs),\n"
    "near AS (SELECT *, lead(tok) OVER w AS nxt, lead(alpha) OVER w AS nxt_alpha, "
    "coalesce(lag(head) OVER w, false) AS after_head FROM heads "
    "WINDOW w AS (PARTITION BY doc_id ORDER BY pos))"
)


def contrast(name: str, rows: str, prefix: str, end: str) -> str:
    """CTE ``name(doc_id, pos, tok)``: the last earlier event decides whether a token is in scope."""
    conn = words(CONNECTIVES)
    return (
        f"{name}_e AS (SELECT *, CASE WHEN tok IN {conn} THEN pos * 2 + 1 WHEN {end} THEN pos * 2 END "
        f"AS ev FROM {rows}),\n"
        f"{name}_s AS (SELECT *, max(ev) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED "
        f"PRECEDING AND 1 PRECEDING) AS last FROM {name}_e),\n"
        f"{name} AS (SELECT doc_id, pos, CASE WHEN last % 2 = 1 AND ev IS NULL THEN '{prefix}' || tok "
        f"ELSE tok END AS tok FROM {name}_s)"
    )


def placed(name: str, source: str) -> str:
    return (
        f"{name} AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS ord, "
        f"count(*) OVER () AS total FROM {source})"
    )


PREDICTIONS = (
    f"rule AS (SELECT p.doc_id AS id, p.ord // (p.total // {FOLDS} + 1) AS fold, p.label AS \"true\", "
    f"CASE WHEN {hits('b.toks', 'pos')} >= {hits('b.toks', 'neg')} THEN 'positive' ELSE 'negative' END "
    "AS pred, p.text FROM placed p JOIN base b ON b.doc_id = p.doc_id)"
)
RULE = [*PRE, LABELLED, placed("placed", "labelled"), PREDICTIONS]

PRF = (
    "names AS (SELECT DISTINCT fold, \"true\" AS label FROM rule UNION SELECT DISTINCT fold, pred FROM rule),\n"
    "per_label AS (SELECT n.fold, n.label, count(*) FILTER (r.\"true\" = n.label) AS support, "
    "count(*) FILTER (r.pred = n.label) AS predicted, "
    "count(*) FILTER (r.\"true\" = n.label AND r.pred = n.label) AS ok "
    "FROM names n JOIN rule r ON r.fold = n.fold GROUP BY ALL),\n"
    "pr AS (SELECT *, CASE WHEN predicted > 0 THEN ok / predicted ELSE 0 END AS p, "
    "CASE WHEN support > 0 THEN ok / support ELSE 0 END AS r FROM per_label),\n"
    "prf AS (SELECT fold, sum(p * support) / sum(support) AS precision, "
    "sum(r * support) / sum(support) AS recall, "
    "sum(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END * support) / sum(support) AS f1 "
    "FROM pr GROUP BY fold)"
)
