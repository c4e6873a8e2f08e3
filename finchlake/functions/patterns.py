"""Regular-expression pieces shared by the text functions.

``\\w``, ``\\d`` and ``\\s`` are ASCII-only in Java, so the Unicode classes are spelled out. Patterns
avoid alternation under an unbounded quantifier, which Java evaluates recursively and which would
overflow the stack on a very long run of characters; possessive groups are repeated in a loop instead.
"""

from __future__ import annotations

# White space as str.split() and the regex class \s see it.
SPACE_SET = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACE = f"[{SPACE_SET}]"
NOT_SPACE = f"[^{SPACE_SET}]"
# A whole run of other characters. The class above is tried range by range: ASCII is told apart by one range first.
NOT_SPACES = rf"(?:[!-~]++|(?![ -~]){NOT_SPACE})++"
# White space that is anything but one plain space: what squeezing has to change.
_ODD_SPACE = SPACE.replace(r"\x{1c}-\x{20}", r"\x{1c}-\x{1f}")
ODD_RUN = f"(?![!-~])(?: (?![!-~]){SPACE}+|(?! ){_ODD_SPACE}{SPACE}*)"   # most characters fail the first test

WORD_SET = r"\p{L}\p{N}_"
WORD = f"[{WORD_SET}]"
DIGIT = r"\p{Nd}"

# Token classes of the tweet tokenizer, in order of precedence.
_TW_JOINERS = r"\x{200c}\x{200d}"
_TW_WORD_SET = r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}" + _TW_JOINERS
_TW_W = f"[{_TW_WORD_SET}]"
_TW_LETTER_SET = (
    r"\p{L}\p{M}\p{Nl}\x{203f}\x{2040}\x{2054}\x{fe33}\x{fe34}\x{fe4d}-\x{fe4f}\x{ff3f}" + _TW_JOINERS
)
_TW_L = f"[{_TW_LETTER_SET}]"
_URL_CHAR = rf"[^{SPACE_SET}()<>{{}}\[\]]"
_URL_LAST = rf"[^{SPACE_SET}`!()\[\]{{}};:'\".,<>?«»“”‘’]"
_URL_PAREN = rf"\([^{SPACE_SET}()]*\)"
_URL_INNER = r"[`!;:'\".,?«»“”‘’]"  # may stand within a URL, but not end it
# A first unit, then turns that each end where a URL may end, without a limit on their number.
_URL_BODY = rf"(?:{_URL_CHAR}|{_URL_PAREN})(?:{_URL_INNER}*+(?:{_URL_PAREN}|{_URL_LAST}))++"
EMOTICON = (
    r"(?:[<>]?[:;=8][\-o*']?[)\](\[dDpP/:}{@|\\]"
    r"|[)\](\[dDpP/:}{@|\\][\-o*']?[:;=8][<>]?"
    r"|</?3)"
)
_TONE = r"[\x{1f3fb}-\x{1f3ff}]"
TWEET_TOKEN_CLASSES = {
    "url": rf"(?:https?:(?:/{{1,3}}|[a-z0-9%])|[a-z0-9.\-]+[.][a-z]{{2,13}}/){_URL_BODY}",
    "domain": rf"[a-z0-9](?:(?![.\-]{{2}})[a-z0-9.\-])*[.][a-z]{{2,13}}(?!{_TW_W})/?(?!@)",
    "phone": rf"(?:\+?[01][ *\-.)]*)?(?:\(?{DIGIT}{{3}}[ *\-.)]*)?{DIGIT}{{3}}[ *\-.)]*{DIGIT}{{4}}",
    "emoticon": EMOTICON,
    "tag": rf"<[^>{SPACE_SET}]+>",
    "arrow": r"-+>|<-+",
    "handle": f"@{_TW_W}+",
    "hashtag": rf"#+{_TW_W}+[{_TW_WORD_SET}'\-]*{_TW_W}+",
    "email": (
        rf"[{_TW_WORD_SET}.+\-]+@[{_TW_WORD_SET}\-]+\."
        rf"(?:[{_TW_WORD_SET}\-]{{2,}}|[{_TW_WORD_SET}\-]\.[{_TW_WORD_SET}\-]+)"
        rf"(?:\.[{_TW_WORD_SET}\-]++)*+"
    ),
    "emoji": rf".(?:{_TONE}?(?:\x{{200d}}.{_TONE}?)++|{_TONE})",
    "flag": r"[\x{1f1e6}-\x{1f1ff}]{2}",
    "word": rf"{_TW_L}[{_TW_LETTER_SET}'\-_]+{_TW_L}",
    "number": rf"[+\-]?{DIGIT}+[,/.:\-]{DIGIT}+[+\-]?",
    "plain": f"{_TW_W}+",
    "ellipsis": rf"\.[{SPACE_SET}.]*\.",
    "other": NOT_SPACE,
}
# Most tokens are plain words before a space or a sign that joins no word, and plain signs. No class can match
# them differently, so they are taken first, without trying the others.
_PLAIN_WORD = r"[a-zA-ZÀ-ÖØ-öø-ÿ]++(?=[ \t\n\r,!\"#$%&()?\[\]{}<>|~]|\.(?:[ \t\n\r]|$)|$)"
# Signs that start no longer token unless an emoji joiner or a skin tone follows, other signs before a space, and a
# full stop before a space and a word.
_JOINED = r"[\x{200d}\x{1f3fb}-\x{1f3ff}]"
_PLAIN_SIGN = (
    rf"[!\"$%&'*,?^`~](?!{_JOINED})|[#(-+\-/:-@\[-\]{{-}}](?=[ \t\n\r]|\z)|\.(?=[ \t\n\r][^.{SPACE_SET}])"
)
# A token starts at white space only where the same follows: other white space is passed over without trying the classes.
_TOKEN_START = rf"(?! (?!{_JOINED}))(?={NOT_SPACE}|.{_JOINED})"
TWEET_TOKEN = (
    "(?s)(?:" + _PLAIN_WORD + "|" + _PLAIN_SIGN + "|(?i:" + _TOKEN_START
    + "(?:" + "|".join(TWEET_TOKEN_CLASSES.values()) + ")))"
)


def alternation(words: list[str]) -> str:
    """Words as one alternation, longest first, metacharacters escaped for Java and RE2."""
    escaped = []
    for word in sorted(words, key=len, reverse=True):
        escaped.append("".join("\\" + ch if ch in r"\.^$|?*+()[]{}" else ch for ch in word))
    return "|".join(escaped)
