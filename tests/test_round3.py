"""Whole texts by few passes, texts tokenized once, and vocabularies without one row a document and gram."""

import pytest
from pyspark.sql import functions as F

from finchlake.functions import text as tx
from finchlake.functions import tokens as tk
from finchlake.functions.patterns import TWEET_TOKEN, TWEET_TOKEN_CLASSES
from finchlake.functions.unicode import _bucket_count
from finchlake.operators import sentences
from finchlake.queries.registry import QUERIES


ODD = ["", "the&&& of%%%, d; p= do: (x) a|b | c", "a . .. b. c", "w/ 8) :-) <3 </3 *1 555-1234", "\x1c a\x85b c", "a 🏻 b ‍ c, !🏻",
       "x's 'y z' don't' cannot GONNA wanna. gotta:gimme", "http://a.b/c www.x.y e@x.org d,.. e:5 f::", None]


def test_plain_tokens_are_those_of_the_classes(apply):
    slow = "(?s)(?i:" + "|".join(TWEET_TOKEN_CLASSES.values()) + ")"
    found = lambda p: apply(lambda c: F.regexp_extract_all(c, F.lit(p), F.lit(0)), ODD)
    assert found(TWEET_TOKEN) == found(slow)


def test_plain_signs_skip_the_classes():
    """The pattern takes a sign before any class is tried."""
    assert TWEET_TOKEN.index("[!\\\"$%&'*,?^`~]") < TWEET_TOKEN.index("https?")


def test_cores_of_a_text_are_those_of_its_words(apply):
    texts = [t for t in ODD if t] + ['("a) b"], ("\'),: c, \'d\' "" (e', "(,) f; «g». h"]
    by_word = apply(lambda c: F.filter(F.transform(tx.space_words(c), tk.word_core), lambda w: w != ""), texts)
    assert apply(tk.word_cores, texts) == by_word


def test_large_tables_of_names_have_small_buckets():
    assert _bucket_count({str(i): "" for i in range(20_000)}) >= 40_000
    assert _bucket_count({}) == 256


def test_sentence_statistics_read_the_texts_once_each(spark, monkeypatch):
    """One pass for the words and one for the pairs, which are written."""
    names, real = [], sentences.written
    monkeypatch.setattr(sentences, "written", lambda df, name: (names.append(name), real(df, name))[1])
    sentences.learn(spark.createDataFrame([("Mr. Fox ran. Then he left! Then no.",)], "text string"), "text")
    assert names.count("sentence-pairs") == 1


@pytest.mark.parametrize("name", ["pre_process_lemmas", "tfidf_lemmas"])
def test_lemmas_start_from_written_tokens(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan


def test_feature_names_write_no_counts_by_document(spark, sf_dir, monkeypatch):
    from finchlake.queries import registry

    monkeypatch.setattr(registry, "_block_counts", lambda *a: pytest.fail("one row a document and gram"))
    QUERIES["feature_names"](spark, sf_dir)
