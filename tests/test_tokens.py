import random
import re

from finchlake.constants import CONNECTIVES, STOPWORDS
from finchlake.functions import tokens as tk
from finchlake.functions.stem import porter_stem
from pyspark.sql import functions as F


def test_tweet_tokens(apply):
    texts = [
        "This is a cooool #dummysmiley: :-) :-P <3 and some arrows < > -> <--",
        "@remy: this is waaaaayyyy too much for you!!!!!!",
        "mail jane.doe@mail.example.com or see example.com/ab, call (377) 555-0271",
        "don't well-known x_y a1b .. . . &lt;3 &#x41; &nope; Été",
    ]
    assert apply(tk.tweet_tokens, texts) == [
        ["this", "is", "a", "coool", "#dummysmiley", ":", ":-)", ":-P", "<3", "and", "some", "arrows",
         "<", ">", "->", "<--"],
        ["@remy", ":", "this", "is", "waaayyy", "too", "much", "for", "you", "!", "!", "!"],
        ["mail", "jane.doe@mail.example.com", "or", "see", "example.com/ab", ",", "call", "(377) 555-0271"],
        ["don't", "well-known", "x_y", "a1b", ".. . .", "<3", "a", "été"],
    ]


def test_plain_word_shortcut_changes_nothing(apply):
    rng = random.Random(5)
    alphabet = "ab dD8:;=).,-o'é@/#\n"
    texts = ["".join(rng.choice(alphabet) for _ in range(40)) for _ in range(400)]
    slow = "(?s)(?:(?i:" + "|".join(tk.TWEET_TOKEN.split("|(?i:", 1)[1:])
    fast = apply(lambda c: F.regexp_extract_all(c, F.lit(tk.TWEET_TOKEN), F.lit(0)), texts)
    assert fast == apply(lambda c: F.regexp_extract_all(c, F.lit(slow), F.lit(0)), texts)


def test_long_runs_do_not_overflow(apply):
    texts = ["a" * 50000, "." * 50000, "a.b" * 20000, "'-" * 20000, "but " * 20000 + "x", "http://" + "!" * 5000]
    assert all(len(t) > 0 for t in apply(tk.tweet_tokens, texts))
    assert all(t is not None for t in apply(tk.mark_contrast_text, texts))
    assert all(t is not None for t in apply(tk.join_negations, texts))


def test_word_tokens(apply):
    texts = ["can't stop. it's ok, i'd 10:30 say... (didn’t) cannot end."]
    assert apply(tk.word_tokens, texts) == [
        ["ca", "n't", "stop", ".", "it", "'s", "ok", ",", "i", "'d", "10:30", "say", "...", "(", "didn", "’",
         "t", ")", "can", "not", "end", "."],
    ]


def test_negations(apply):
    rows = {
        "not good": "not_good", "never not good": "not_not good", "no, good": "no , good", "": "", "not": "not",
        "not x1 never bad film": "not x1 not_bad film", "barely good no no no": "not_good not_no no",
        "good not": "good not", "not not not good": "not_not not_good",
    }
    assert apply(tk.join_negations, list(rows)) == list(rows.values())
    merged = lambda c: tk.join_negations(c, merge_contractions=True)
    assert apply(merged, ["I didn't like it, don’t go", "a'b'c'd'e'f'g'h'i'j'k'l'm not good"]) == [
        "i not_like it , not_go", "a'b'c'd'e'f'g'h'i'j'k'l'm not_good"]


def last_event_before(tokens, i, ends):
    """The nearest connective or sentence end in front of position ``i``; scopes are defined by it."""
    before = [t for t in reversed(tokens[:i]) if t in CONNECTIVES or ends(t)]
    return before[0] if before else None


def in_contrast(tokens, prefix, ends):
    return [
        prefix + t if last_event_before(tokens, i, ends) in CONNECTIVES and t.strip() and t not in CONNECTIVES and not ends(t) else t
        for i, t in enumerate(tokens)
    ]


def test_contrast(apply):
    rows = [
        (["good", "but", "bad", "film", ".", "x"], ["good", "but", "BUT_bad", "BUT_film", ".", "x"]),
        (["yet", "however", "a", "", " "], ["yet", "however", "BUT_a", "", " "]), ([], []),
        (["but", "...", "x", "!", "y"], ["but", "BUT_...", "BUT_x", "!", "y"]),
    ]
    assert apply(tk.mark_contrast_tokens, [r[0] for r in rows], "array<string>") == [r[1] for r in rows]
    rng = random.Random(2)
    words = ["but", "however", "yet", "good", "film", ".", "!", "...", "x"]
    lists = [[rng.choice(words + ["", " "]) for _ in range(rng.randint(0, 14))] for _ in range(200)]
    got = apply(tk.mark_contrast_tokens, lists, "array<string>")
    assert got == [in_contrast(t, "BUT_", lambda x: x in (".", "!", "?")) for t in lists]
    assert apply(tk.mark_contrast_text, ["Nice but slow. Good!", "yet ... more", ""]) == [
        "nice but contrast_slow . good !", "yet ... more", ""]


def test_tokens_have_no_size_limits(apply):
    host = ".".join(f"a{i}" for i in range(200)) + ".com"
    url = "http://x.org/" + "a(b)" * 80
    mail = "me@h." + ".".join(f"dd{i}" for i in range(200))
    family = "\u200d".join(["👩"] * 30)
    assert apply(tk.tweet_tokens, [host, url, mail, family, "&#0000000000065;b &#x00000000000041; &#99999999999;c"]) == [
        [host], [url], [mail], [family], ["ab", "a", "c"]]
    assert apply(lambda c: tk.word_tokens(c, merge_contractions=True), ["a" + "'b" * 12]) == [["a" + "'b" * 12]]
    assert apply(tk.tweet_tokens, ["see a-b.com-x y..com z.info. http:/x http://() a.com@b"]) == [
        ["see", "a-b.com", "-", "x", "y", "..", "com", "z.info", ".", "http", ":/", "x", "http://()",
         "a", ".", "com", "@b"]]


def test_sentence_statistics(apply):
    got = apply(tk.sentence_stats, ["One two. Three! ", "...!?", "", None])
    assert [tuple(r) for r in got[:3]] == [(1, 2, 1.5), (0, 0, 0.0), (0, 0, 0.0)]
    long = "a b c d e f g h i j k. l"
    assert apply(lambda c: tk.length_tokens(tk.sentence_stats(c)), [long]) == [
        ["MIN_LEN<0>", "MAX_LEN<2>", "MEAN_LEN<1>"]
    ]


def test_ngrams(apply):
    lists = [[], ["a"], ["a", "b"], ["a", "b", "c"]]
    assert apply(lambda c: tk.token_ngrams(c, 2), lists, "array<string>") == [[], [], ["a b"], ["a b", "b c"]]
    assert apply(lambda c: tk.token_ngrams(c, 3), lists, "array<string>") == [[], [], [], ["a b c"]]
    texts = ["", "ab", "Ab  \n c😀d", "abc"]

    def grams(t):
        t = re.sub(r"\s\s+", " ", t.lower())
        return [t[i:i + n] for n in range(3, 6) for i in range(len(t) - n + 1)]

    assert apply(tk.char_ngrams, texts) == [grams(t) for t in texts]
    windows = apply(lambda c: F.flatten(F.transform(tk.char_windows(c), lambda w: tk.window_grams(w))), texts)
    assert [sorted(w) for w in windows] == [sorted(grams(t)) for t in texts]


def test_stopwords_and_tags(apply):
    lists = [["i", "am", "not", "never", "no", "happy", "the"]]
    assert len(STOPWORDS) == 179
    assert apply(tk.drop_stopwords, lists, "array<string>") == [["not", "never", "no", "happy"]]
    assert apply(lambda c: tk.drop_stopwords(c, False), lists, "array<string>") == [["never", "happy"]]
    assert apply(tk.wordnet_class, ["JJ", "VBD", "NNS", "RB", "IN", ""]) == ["a", "v", "n", "r", "n", "n"]


def test_porter(apply):
    pairs = {
        "caresses": "caress", "ponies": "poni", "cats": "cat", "feed": "feed", "agreed": "agre",
        "plastered": "plaster", "motoring": "motor", "sing": "sing", "hopping": "hop", "filing": "file",
        "falling": "fall", "hissing": "hiss", "happy": "happi", "sky": "sky", "relational": "relat",
        "conditional": "condit", "vietnamization": "vietnam", "operator": "oper", "hopefulness": "hope",
        "triplicate": "triplic", "electrical": "electr", "revival": "reviv", "adjustment": "adjust",
        "adoption": "adopt", "effective": "effect", "probate": "probat", "rate": "rate", "cease": "ceas",
        "controll": "control", "roll": "roll", "as": "as",
    }
    assert apply(porter_stem, list(pairs)) == list(pairs.values())
