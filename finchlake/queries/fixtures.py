"""Inputs of the registered queries, derived from the given tables by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finchlake.functions import tokens as tk
from finchlake.operators import ordinal
from finchlake.operators.lexicon import with_hits
from finchlake.operators.rows import laid_out, spread
from finchlake.plans.preprocess import pre_process

# Endings that bring URLs, hashtags, slang, emoji and so on into the texts, by doc_id modulo 8.
SUFFIXES = [
    " see http://t.co/x1?a=2 #HappyDay",
    " NOT good lol @bob_1",
    " sooooo greaaat!!! gr8 u",
    " i can't but it's ok. yes",
    " \U0001F600 at 10:30 thx #snake_case",
    " bad &amp; awful... never again",
    " Ｆｕｌｌ ﬁne … www.x.org/y",
    " didn’t like; however love wins",
]
# Emoji that are appended to the texts by doc_id modulo their number.
EMOJI_ENDINGS = [
    "👨‍👩‍👧‍👦", "👩‍👧", "🏳️‍🌈", "🏴‍☠️", "🇫🇷", "🇺🇸", "🇨🇮", "🏴󠁧󠁢󠁥󠁮󠁧󠁿", "1️⃣", "#⃣",
    "👩‍💻", "🧑🏽‍🚀", "👨🏿‍🦰", "🏃🏻‍♀️", "🤷‍♂️", "👮‍♀️", "👩‍❤️‍💋‍👨", "👩🏻‍🤝‍👩🏿", "❤️‍🔥", "😮‍💨",
    "🧔🏼", "👍🏾", "❤️", "😀😀", "😂", "🔥", "☀️", "©", "👩‍🔥", "🇦🇦",
]
# Characters with other normal forms, by doc_id modulo their number.
FORM_ENDINGS = [
    "\uff21\uff42\uff43\uff11\uff12\uff13", "\ufb00 \ufb01 \ufb02 \ufb03 \ufb04 \ufb06",
    "x\u00b2 y\u00b3 z\u00b9 \u2074 \u2082", "\u00bd \u00bc \u00be \u2153", "\u2116 \u2122 \u2120 \u2121",
    "\u2163 \u2178 \u216b", "\u2460 \u2473 \u24d0 \u24cf", "\u338f \u339e \u33d1 \u337f",
    "\uff71\uff72\uff73 \uff76\uff9e \uff8a\uff9f", "가 각", "e\u0301 o\u0302\u0301 n\u0303",
    "a\u0323\u0302 q\u0307\u0323", "\u212b \u2126 \u212a", "\u017f \u1e9b\u0323", "a\u00a0b\u2003c\u3000d\u202fe",
    "\u2026 \u2025 \u203c \u2047", "\U0001d400\U0001d41b \U0001d49e \U0001d507 \U0001d7d7", "\ufdfa \ufefb \ufe8f",
    "\uf900 \uf92d", "\u01c4 \u01c6 \u01c7 \u0149", "\u00b4 \u00a8 \u00af \u00b8", "\ufe77 \ufe7c",
    "か\u3099 ハ\u309a", "क\u093c \u0958 ড\u09bc", "\u00aa \u00ba \u00b5 \u02b0 \u02b7", "〜 \uff5e \uff9e ー",
    "하 \uac00ᆨ", "\u3220 \u3299 \u32c0 \u3358", "\uff03 \uff20 \uff5b\uff5d \uffe5", "plain \u00e9 ß ж 漢",
]
# Sentences with abbreviations and initials, by doc_id modulo their number.
SENTENCE_ENDINGS = [
    " Mr. Brown met Dr. Lee at 5 p.m. on Monday. Then he left. The end.",
    " She has many (e.g. cats, dogs, etc.) here. They like her. Mr. Fox, from the U.S. Army, too.",
    " We saw J. Smith vs. Mr. Hall. Then we went home! The dr. was in.",
    " Is it ok? The vs. sign is fine etc. Then Dr. No came. He didn't go.",
    " Then, \"Mr. Hill said no.\" He did too... The end",
]
LEXICON = {
    "pos": ["good", "great", "love", "happy", "wins", "ok"],
    "neg": ["bad", "awful", "never", "sad"],
}
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_suffix(docs: DataFrame) -> DataFrame:
    endings = F.array(*[F.lit(s) for s in SUFFIXES])
    ending = F.get(endings, (F.col("doc_id") % len(SUFFIXES)).cast("int"))
    return docs.select("doc_id", F.concat("text", ending).alias("text"))


def with_emoji(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text: every whole document with an emoji or a sequence of them at its end."""
    endings = F.array(*[F.lit(e) for e in EMOJI_ENDINGS])
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    ending = F.get(endings, (F.col("doc_id") % len(EMOJI_ENDINGS)).cast("int"))
    return docs.select("doc_id", F.concat("text", F.lit(" so: "), ending).alias("text"))


def with_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text: every whole document with characters of other normal forms at its end."""
    endings = F.array(*[F.lit(e) for e in FORM_ENDINGS])
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    ending = F.get(endings, (F.col("doc_id") % len(FORM_ENDINGS)).cast("int"))
    return docs.select("doc_id", F.concat("text", F.lit(" so: "), ending).alias("text"))


def with_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text: every whole document with sentences at its end."""
    endings = F.array(*[F.lit(e) for e in SENTENCE_ENDINGS])
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    ending = F.get(endings, (F.col("doc_id") % len(SENTENCE_ENDINGS)).cast("int"))
    return docs.select("doc_id", F.concat("text", ending).alias("text"))


def noisy_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text: every whole document with its suffix."""
    return _with_suffix(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


def noisy_tweets_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same laid out by doc_id, for queries that explode and regroup."""
    return _with_suffix(laid_out(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id"))


def noisy_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, label, text of the labelled documents."""
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "positive").otherwise("negative").alias("label")
    )
    return labels.join(noisy_tweets(spark, sf_dir), "doc_id").select("doc_id", "label", "text")


suffix_tag = tk.tag_by_ending


def processed(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return pre_process(noisy_tweets(spark, sf_dir), "doc_id", "text", LEXICON, **options)


def processed_by_id(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """The same, laid out by doc_id before tokenizing, for queries that explode and regroup."""
    return processed(spark, sf_dir, lay_out=True, **options)


def tokenized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, tokens: pre-processed tokens only, without bigrams and markers; laid out by doc_id."""
    return processed_by_id(spark, sf_dir, add_bigrams=False, add_lexicon_tokens=False).select(
        "doc_id", "tokens"
    )


def rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, fold, true, pred, text: the sign of the lexicon hits as a prediction."""
    placed, total = ordinal.ordinal(noisy_labelled(spark, sf_dir), "doc_id")
    tokens = pre_process(placed, "doc_id", "text", LEXICON, add_bigrams=False, add_lexicon_tokens=False)
    hits = with_hits(tokens, "doc_id", "tokens", LEXICON)
    return hits.select(
        F.col("doc_id").alias("id"), ordinal.fold_id(total, FOLDS).alias("fold"),
        F.col("label").alias("true"),
        F.when(F.col("pos_hits") >= F.col("neg_hits"), "positive").otherwise("negative").alias("pred"),
        "text",
    )


def joined_tokens(tokens: Column | str) -> Column:
    return F.array_join(tokens, " ").alias("tokens")


def tweet_token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noisy_tweets(spark, sf_dir).select("doc_id", tk.tweet_tokens(F.col("text")).alias("tokens"))
