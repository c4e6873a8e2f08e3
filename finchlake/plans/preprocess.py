"""The two text preparation plans: full pre-processing and light cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finchlake.functions import text as tx
from finchlake.functions import tokens as tk
from finchlake.functions import unicode as un
from finchlake.operators.lexicon import with_hits
from finchlake.operators.lookup import keyed_lookup
from finchlake.operators.rows import collected, exploded, laid_out


def light_clean(col: Column) -> Column:
    """Minimal clean-up for text encoders: normal form, no URLs, emoji spelled out; case is kept."""
    return un.emoji_to_text(tx.remove_urls(un.normalize_nfkc(tx.as_text(col))))


def clean_text(col: Column, hashtag_mode: str = "split", remove_punctuation: bool = False) -> Column:
    """The string part of pre-processing, up to but without tokenizing."""
    col = tx.remove_urls(un.normalize_nfkc(tx.as_text(col)))
    col = un.emoji_to_text(tx.hashtags(col, hashtag_mode))
    col = tx.remove_digits(tx.lowercase(col))
    if remove_punctuation:
        col = tx.remove_punctuation(col)
    return tx.replace_slang(col)


def lemmatize(df: DataFrame, key: str, tokens: str, lemmas: DataFrame, tags: Column | None = None) -> DataFrame:
    """Replace tokens by their lemma from ``lemmas(word, wn_class, lemma)``; others stay.

    ``tags`` is an expression over the exploded column ``token`` giving its Penn tag, if known; the
    class is a noun otherwise.
    """
    wn = tk.wordnet_class(tags) if tags is not None else F.lit("n")
    long = exploded(df, key, tokens).withColumn("wn_class", wn)
    dim = lemmas.select(F.col("word").alias("token"), "wn_class", "lemma")
    mapped = keyed_lookup(long, dim, ["token", "wn_class"], F.col(key))
    mapped = mapped.withColumn("token", F.coalesce("lemma", "token"))
    arrays = collected(mapped, key, "token", "_lemmas")
    empty = F.array().cast("array<string>")
    return df.join(arrays, key, "left").withColumn(tokens, F.coalesce("_lemmas", empty)).drop("_lemmas")


def pre_process(
    df: DataFrame,
    key: str,
    text: str,
    lexicon: DataFrame | dict[str, list[str]],
    hashtag_mode: str = "split",
    remove_punctuation: bool = False,
    add_lexicon_tokens: bool = True,
    add_bigrams: bool = True,
    add_length_tokens: bool = False,
    lemmas: DataFrame | dict[str, str] | None = None,
    tags: Column | None = None,
    lowercase_first: bool = False,
    lay_out: bool = False,
    into: str = "tokens",
) -> DataFrame:
    """Add the token array of the full pre-processing.

    Order: clean, tokenize, lemmatize, bigrams, lexicon markers, sentence-length tokens of the uncleaned
    text. Lemmas come from a table, joined, or from the literals of
    :func:`finchlake.operators.vocabulary.lemma_literals`, looked up inside the row with classes by ending.
    ``lowercase_first`` lowers the text before anything else, as the word vectorizer does, so that hashtags
    in CamelCase stay one word. Without a joined table and with a small lexicon the plan is a single narrow
    projection.

    ``lay_out`` partitions the rows by ``key`` once they are clean, for callers that explode the tokens
    and group by document.
    """
    source = F.lower(tx.as_text(F.col(text))) if lowercase_first else F.col(text)
    out = df.withColumn("_clean", clean_text(source, hashtag_mode, remove_punctuation))
    if lay_out:
        out = laid_out(out, key)
    out = out.withColumn(into, tk.tweet_tokens(F.col("_clean"), folded=True)).drop("_clean")
    if add_length_tokens:
        out = out.withColumn("_stats", tk.sentence_stats(tx.as_text(source)))
    return finish(out, key, into, lexicon, add_lexicon_tokens, add_bigrams, add_length_tokens, lemmas, tags)


def with_markers(df: DataFrame, key: str, tokens: str, lexicon: DataFrame | dict[str, list[str]], into: str) -> DataFrame:
    """The lexicon markers that :func:`finish` puts behind ``tokens`` and their bigrams, in a column of their own.

    Bigrams hold a space, so they are made only for a lexicon that has words with one.
    """
    spaced = not isinstance(lexicon, dict) or any(" " in w for words in lexicon.values() for w in words)
    both = F.concat(tokens, tk.token_ngrams(F.col(tokens), 2)) if spaced else F.col(tokens)
    out = with_hits(df.withColumn(into, both), key, into, lexicon)
    return out.withColumn(into, tk.lexicon_markers(F.col("pos_hits"), F.col("neg_hits"))).drop("pos_hits", "neg_hits")


def finish(
    out: DataFrame,
    key: str,
    into: str,
    lexicon: DataFrame | dict[str, list[str]],
    add_lexicon_tokens: bool = True,
    add_bigrams: bool = True,
    add_length_tokens: bool = False,
    lemmas: DataFrame | dict[str, str] | None = None,
    tags: Column | None = None,
) -> DataFrame:
    """The steps of :func:`pre_process` after the tokenizer, for rows whose column ``into`` holds the tokens.

    ``add_length_tokens`` reads the sentence statistics in the column ``_stats`` and drops it.
    """
    if isinstance(lemmas, dict):
        out = out.withColumn(into, tk.lemmatized(F.col(into), lemmas))
    elif lemmas is not None:
        out = lemmatize(out, key, into, lemmas, tags)
    if add_bigrams:
        out = out.withColumn(into, F.concat(into, tk.token_ngrams(F.col(into), 2)))
    if add_lexicon_tokens:
        out = with_hits(out, key, into, lexicon)
        markers = tk.lexicon_markers(F.col("pos_hits"), F.col("neg_hits"))
        out = out.withColumn(into, F.concat(into, markers)).drop("pos_hits", "neg_hits")
    if add_length_tokens:
        out = out.withColumn(into, F.concat(into, tk.length_tokens(F.col("_stats")))).drop("_stats")
    return out
