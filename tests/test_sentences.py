"""Abbreviations and sentence starters learned from texts, and full stops at sentence ends."""

from pyspark.sql import functions as F

from finchlake.functions import tokens as tk
from finchlake.operators import sentences as se

TEXTS = (["Mr. Ray saw Dr. Poe at home. Then he went away. The end came. It was late."] * 30
         + ["He saw it then. Mr. Poe (e.g. the elder) came. The dog ran. We left!"] * 20 + ["", None] + ["they came home late, ran away then left"] * 20)


def corpus(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")


def test_learned_words(spark):
    learned = {(r["kind"], r["word"]) for r in se.learn(corpus(spark), "text").collect()}
    assert {("a", "mr"), ("a", "dr"), ("a", "e.g"), ("s", "the")} <= learned
    assert not {("a", "home"), ("a", "late"), ("a", "came"), ("s", "saw")} & learned


def test_no_texts_no_words(spark):
    for rows in ([], [(0, None), (1, "")], [(0, "no stop here")]):
        df = spark.createDataFrame(rows, "id int, text string")
        assert se.learn(df, "text").count() == 0
        got = se.split_stops(df, "id", "text", se.learn(df, "text")).orderBy("id").collect()
        assert [r["text"] for r in got] == [t for _, t in rows]


def test_split_by_hand(apply):
    known = {"a:mr": "1", "a:e.g": "1", "a:etc": "1", "s:the": "1"}
    assert apply(lambda c: tk.split_stops(c, known), [
        "Mr. Ray left. He (e.g. J. Poe) ran.", "cats etc. The dog", "cats etc. the dog", "No (really.) Yes.", "etc.",
        "wait... what? a.b", "  ", None,
    ]) == ["Mr. Ray left . He (e.g. J. Poe) ran .", "cats etc . The dog", "cats etc. the dog", "No (really .) Yes .",
           "etc .", "wait... what? a.b", "", None]
    assert apply(lambda c: tk.word_tokens(tk.split_stops(c, known), stops_split=True), ["Mr. Ray can't. Bye."], ) == [
        ["Mr.", "Ray", "ca", "n't", ".", "Bye", "."]]


def test_join_equals_lookup_inside_the_row(spark):
    df = corpus(spark)
    learned = se.learn(df, "text")
    rows = [r["text"] for r in se.split_stops(df, "id", "text", learned).orderBy("id").collect()]
    joined = [r["text"] for r in se.split_stops(df, "id", "text", learned, limit=0).orderBy("id").collect()]
    assert rows == joined and rows[0].startswith("Mr. Ray saw Dr. Poe at home . Then")
