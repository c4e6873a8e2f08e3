import html
import re
import unicodedata

from finchlake.functions import text as tx
from finchlake.functions import unicode as un
from finchlake.plans.preprocess import clean_text, light_clean

EDGES = [None, "", "   ", "a", "ab", "...!?"]


def test_null_becomes_empty(apply):
    assert apply(tx.as_text, [None, "x"]) == ["", "x"]
    assert apply(lambda c: light_clean(c), EDGES)[:3] == ["", "", "   "]
    assert apply(lambda c: clean_text(c), EDGES) == ["", "", "", "a", "ab", "...!?"]


def test_urls_mentions_digits_punctuation(apply):
    assert apply(tx.remove_urls, ["see http://t.co/x?a=1 and www.x.org/y!", "wwwx http", "https"]) == [
        "see   and  ", "wwwx http", " "]
    assert apply(tx.remove_mentions, ["hi @bob_1 @Ünal", "a@b.c @ x"]) == ["hi    ", "a .c @ x"]
    assert apply(tx.remove_digits, ["a1٣b", "2nd"]) == ["ab", "nd"]
    assert apply(tx.remove_punctuation, ["it's, ok_1 é!", "a-b\tc."]) == ["its ok_1 é", "ab\tc"]


def test_hashtags(apply):
    texts = ["#HappyDay x", "##snake_caseOne #A", "# #", "no tag"]
    assert apply(tx.hashtags, texts) == [" happy day  x", "# snake case one   a ", "# #", "no tag"]
    assert apply(lambda c: tx.hashtags(c, "remove"), texts)[0] == "  x"
    assert apply(lambda c: tx.hashtags(c, "keep"), texts) == texts


def test_contractions_in_one_pass(apply):
    rows = {
        "i can't go": "i cannot go", "she's he's": "she is he is", "they're what's": "they are what is",
        "": "", "don't CAN'T": "do not CAN'T",
    }
    assert apply(tx.expand_contractions, list(rows)) == list(rows.values())


def test_slang_is_exact_on_words(apply):
    mapping = {"u": "you", "you": "ye", "gr8": "great"}
    rows = {"u r gr8": "you r great", "you \t u!": "ye u!", "  u\n\nu ": "you you", "": ""}
    assert apply(lambda c: tx.replace_slang(c, mapping), list(rows)) == list(rows.values())


def test_elongation(apply):
    rows = {"sooooo  greaaat!!!": "soo greaat!!", "aa\n\n\nbbb": "aa bb", " 😀😀😀😀 ": "😀😀", "aab": "aab"}
    assert apply(tx.squeeze_elongation, list(rows)) == list(rows.values())


def test_nfkc_equals_unicodedata(apply):
    points = [p for p in range(0x20, 0x30000, 7) if unicodedata.category(chr(p)) not in ("Cn", "Cs", "Co")]
    texts = ["".join(chr(p) for p in points[i:i + 50]) for i in range(0, len(points), 50)]
    texts += ["é", "ﬁ … Ｆ", "각", "ㄱㅏ", "plain", "Å", "ｶﾞ", "ſ̣"]
    assert apply(un.normalize_nfkc, texts) == [unicodedata.normalize("NFKC", t) for t in texts]
    assert apply(un.normalize_nfkc, [None, ""]) == [None, ""]


def test_stable_characters_skip_the_normaliser():
    ranges = re.findall(r"\\x\{(\w+)\}(?:-\\x\{(\w+)\})?", un.MAYBE_UNNORMALISED)
    for first, last in ranges:
        for p in range(int(first, 16), int(last or first, 16) + 1):
            assert unicodedata.normalize("NFKC", chr(p)) == chr(p)
            assert unicodedata.combining(chr(p)) == 0


def test_entities(apply):
    texts = ["a &amp; b &lt;x&gt; &#8364; &#x41; &notit; &copy", "&#0; &#1114112; &bogus; &amp;amp;", "none",
             "&#0000000000000000000065; &#x000000000000041 &#99999999999999999999; &#128; &#x81; &#55296; &#11;",
             "&CounterClockwiseContourIntegral; &NotEqualTilde;x &ampx &AMP&&; &#; &#x; &; &acE; &notin; &not-"]
    texts += ["&" + n for n in list(html.entities.html5)[::9]]
    assert apply(un.unescape_html, texts) == [html.unescape(t) for t in texts]
    assert apply(un.unescape_html, [None]) == [None]


def test_emoji(apply):
    texts = ["😀 at 10:30", "❤️x👍🏽", "no: emoji", "👩‍💻", "plain"]
    assert apply(un.emoji_to_text, texts) == [
        " grinning_face  at 10 30", " red_heart x thumbs_up_medium_skin_tone ", "no  emoji",
        " woman_technologist ", "plain",
    ]


def test_emoji_sequences(apply):
    cases = {
        "👨‍👩‍👧‍👦": " family_man_woman_girl_boy ", "👨‍👩‍👧‍🚀": " family_man_woman_girl \u200d rocket ",
        "🇩🇪🇧🇷": " Germany  Brazil ", "🇪🇺": " European_Union ",
        "🇩": " regional_indicator_symbol_letter_d ", "🇿🇿": " regional_indicator_symbol_letter_z " * 2,
        "*️⃣ 12": " keycap_*  12", "🏴󠁧󠁢󠁷󠁬󠁳󠁿": " Wales ", "👩🏽‍🔬": " woman_scientist_medium_skin_tone ",
        "👩🏻‍❤️‍👩🏻": " couple_with_heart_woman_woman_light_skin_tone ", "🏃": " person_running ",
        "👱🏿‍♂️": " man_dark_skin_tone_blond_hair ", "🧜🏻‍♀": " mermaid_light_skin_tone ", "🤼‍♂️x": " men_wrestling x",
        "🐻‍❄️🐻": " polar_bear  bear ", "": "", "12 # *": "12 # *",
    }
    assert apply(un.emoji_to_text, list(cases)) == list(cases.values())
    assert apply(lambda c: un.emoji_to_text(c, {"🐻": "grizzly", "👩\u200d🔥": "woman_on_fire"}), ["🐻👩‍🔥", None]) == [
        " grizzly  woman_on_fire ", None]
