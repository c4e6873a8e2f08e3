"""Abbreviations and sentence starters learned from a corpus, and full stops split off at sentence ends.

The statistics are those of Kiss and Strunk, Unsupervised Multilingual Sentence Boundary Detection (2006):
likelihood ratios over counts of words with and without a final full stop. Words are the runs between white
space without brackets, quotes and commas around them, lowercased.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finchlake.functions import tokens as tk
from finchlake.operators.lookup import keyed_lookup
from finchlake.operators.rows import collected, element_rows
from finchlake.session import written

ABBREVIATION_SCORE = 0.3
STARTER_SCORE = 30.0
IN_ROW_WORDS = 20_000


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """word, stopped, plain: how often each word stands with and without a final full stop."""
    rows = element_rows(df, [], tk.word_cores(F.col(text)), "core")
    # Counted as they are written first, so that the patterns run once a spelling and not once a word.
    spelled = rows.groupBy("core").agg(F.count(F.lit(1)).alias("n"))
    stopped = F.when(tk.is_stopped(F.col("core")), F.col("n")).otherwise(F.lit(0))
    return spelled.groupBy(tk.stopless(F.col("core")).alias("word")).agg(
        F.sum(stopped).alias("stopped"), F.sum(F.col("n") - stopped).alias("plain"))


def abbreviations(counts: DataFrame, threshold: float = ABBREVIATION_SCORE) -> DataFrame:
    """word, score of the words in ``counts`` that are abbreviations.

    The score is the likelihood ratio of "nearly always with a full stop" against "as often as any word",
    lowered for long words and for occurrences without a stop, raised for inner stops. Words without a
    letter are none. ``counts`` is read twice, so it should be a written table.
    """
    total = counts.agg(F.sum("stopped").alias("stopped"), F.sum(F.col("stopped") + F.col("plain")).alias("n")).first()
    if not total["stopped"]:
        return counts.select("word", F.lit(0.0).alias("score")).limit(0)
    share = total["stopped"] / total["n"]
    letters = F.length(F.replace("word", F.lit("."))).cast("double")
    stops = F.length("word") - letters + 1
    rare = F.when(F.col("plain") > 0, F.col("plain") * F.log(F.lit(max(1 - share, 1e-300)))).otherwise(0.0)
    ratio = 2 * (F.col("stopped") * F.log(F.lit(0.99)) + F.col("plain") * F.log(F.lit(0.01))
                 - F.col("stopped") * F.log(F.lit(share)) - rare)
    score = ratio * F.exp(-letters) * stops * F.pow(letters, -F.col("plain"))
    scored = counts.where((F.col("stopped") > 0) & F.col("word").rlike(r"\p{L}")).select("word", score.alias("score"))
    return scored.where(F.col("score") >= threshold)


def starters(df: DataFrame, text: str, counts: DataFrame, abbreviated: DataFrame, threshold: float = STARTER_SCORE) -> DataFrame:
    """word, score of the words that stand after a sure sentence end far more often than elsewhere.

    Sure ends are question and exclamation marks and full stops of words that are neither abbreviations nor
    initials nor numbers. Pairs are counted by (word before, word), partially before the exchange.
    """
    # Only pairs whose first word ends like a sentence leave the row; the last word has no next one. They are counted
    # as they are written, once for both kinds of ends, so that the patterns run once a pair of spellings.
    words = df.select(tk.word_cores(F.col(text)).alias("_w"))
    found = element_rows(words, [], F.filter(
        F.zip_with("_w", F.slice("_w", 2, F.greatest(F.size("_w"), F.lit(1))), lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
        lambda p: F.right(p["a"], F.lit(1)).isin(".", "!", "?")), "pair").select("pair.*")
    spelled = written(found.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")), "sentence-pairs")
    pairs = spelled.where(F.col("b").rlike(r"^\p{L}")).select("a", tk.stopless(F.col("b")).alias("word"), "n")
    marked = pairs.where(F.col("a").rlike(r"[!?]$")).groupBy("word").agg(F.sum("n").alias("n"))
    before = tk.stopless(F.col("a"))
    after_stop = pairs.where(tk.is_stopped(F.col("a")) & ~before.rlike(r"^\p{L}$|^[\p{N}.,]+$")).groupBy(
        before.alias("before"), "word").agg(F.sum("n").alias("n"))
    sure = after_stop.join(abbreviated.select(F.col("word").alias("before")), "before", "left_anti")
    at_start = written(marked.unionByName(sure.select("word", "n")).groupBy("word").agg(F.sum("n").alias("n")), "starts")
    ends = at_start.agg(F.sum("n")).first()[0]
    if not ends:
        return at_start.select("word", F.lit(0.0).alias("score")).limit(0)
    total = counts.agg(F.sum(F.col("stopped") + F.col("plain"))).first()[0]
    both = at_start.join(counts.select("word", (F.col("stopped") + F.col("plain")).alias("b")), "word")
    hits, seen = F.col("n").cast("double"), F.col("b").cast("double")

    def likelihood(found: Column, tries: Column, p: Column) -> Column:
        """Log-likelihood of ``found`` in ``tries``, where 0 log 0 counts as 0."""
        missed = tries - found
        return (F.when(found > 0, found * F.log(p)).otherwise(0.0)
                + F.when(missed > 0, missed * F.log(1 - p)).otherwise(0.0))

    n_ends, others = F.lit(float(ends)), F.lit(float(total - ends))
    ratio = 2 * (likelihood(hits, n_ends, hits / n_ends) + likelihood(seen - hits, others, (seen - hits) / others)
                 - likelihood(hits, n_ends, seen / total) - likelihood(seen - hits, others, seen / total))
    return both.where(hits / n_ends > seen / total).select("word", ratio.alias("score")).where(F.col("score") >= threshold)


def learn(df: DataFrame, text: str) -> DataFrame:
    """kind (``a`` abbreviation, ``s`` sentence starter), word, score over all rows of ``df``, written.

    Null and empty texts count for nothing; an empty table gives no rows.
    """
    counts = written(word_counts(df, text), "stop-counts")
    short = written(abbreviations(counts), "abbreviations")
    start = starters(df, text, counts, short)
    return written(short.select(F.lit("a").alias("kind"), "word", "score").unionByName(
        start.select(F.lit("s").alias("kind"), "word", "score")), "sentence-words")


def literals(learned: DataFrame, limit: int = IN_ROW_WORDS) -> dict[str, str] | None:
    """The learned words for :func:`finchlake.functions.tokens.split_stops`; None beyond ``limit`` words."""
    rows = learned.select("kind", "word").limit(limit + 1).collect()
    return None if len(rows) > limit else {f"{r['kind']}:{r['word']}": "1" for r in rows}


def split_stops(df: DataFrame, key: str, text: str, learned: DataFrame, limit: int = IN_ROW_WORDS) -> DataFrame:
    """``text`` with a space before the full stops that end a sentence; runs of white space become one space.

    Up to ``limit`` learned words are looked up inside the row; more are joined by word, with the same result.
    ``key`` must be unique for that; other columns stay.
    """
    known = literals(learned, limit)
    if known is not None:
        return df.withColumn(text, tk.split_stops(F.col(text), known))
    long = df.select(key, F.posexplode_outer(tk.word_pairs(F.col(text))).alias("pos", "pair")).where("pair IS NOT NULL")
    long = long.select(key, "pos", "pair", tk.stopless(tk.word_core(F.col("pair.w"))).alias("word"),
                       tk.stopless(tk.word_core(F.col("pair.n"))).alias("after"))
    for kind, column in [("a", "word"), ("s", "after")]:
        dim = learned.where(F.col("kind") == kind).select(F.col("word").alias(column), F.lit(True).alias(f"_{kind}"))
        long = keyed_lookup(long, dim, [column], F.col(key))
    closed = tk.closed_word(F.col("pair"), F.coalesce("_a", F.lit(False)), F.coalesce("_s", F.lit(False)))
    arrays = collected(long.withColumn("token", closed), key, "token", "_split")
    joined = F.when(F.col(text).isNotNull(), F.coalesce(F.array_join("_split", " "), F.lit("")))
    return df.join(arrays, key, "left").withColumn(text, joined).drop("_split")
