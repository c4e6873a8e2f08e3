"""Opinion-word hits for lexicons of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finchlake.functions.tokens import count_hits
from finchlake.operators.lookup import keyed_lookup
from finchlake.operators.rows import exploded

IN_ROW_WORDS = 20_000


def small_lexicon(lexicon: DataFrame, limit: int = IN_ROW_WORDS) -> dict[str, list[str]] | None:
    """pos and neg word lists if the lexicon has at most ``limit`` rows, else None.

    At most ``limit`` + 1 rows ever reach the driver.
    """
    rows = lexicon.select("word", "polarity").limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    return {p: [r["word"] for r in rows if r["polarity"] == p] for p in ("pos", "neg")}


def with_hits(df: DataFrame, key: str, tokens: str, lexicon: DataFrame | dict[str, list[str]]) -> DataFrame:
    """Add pos_hits and neg_hits: how many tokens are in either list.

    A small lexicon is tested inside each row, with no exchange. A larger one is joined to the tokens,
    which are laid out by ``key`` first.
    """
    words = lexicon if isinstance(lexicon, dict) else small_lexicon(lexicon)
    if words is not None:
        return df.withColumn("pos_hits", count_hits(F.col(tokens), words["pos"])) \
            .withColumn("neg_hits", count_hits(F.col(tokens), words["neg"]))
    return join_hits(df, key, tokens, lexicon)


def join_hits(df: DataFrame, key: str, tokens: str, lexicon: DataFrame) -> DataFrame:
    """The same for a lexicon of any size, as a join."""
    flags = lexicon.groupBy(F.col("word").alias("token")).agg(
        F.max((F.col("polarity") == "pos").cast("int")).alias("is_pos"),
        F.max((F.col("polarity") == "neg").cast("int")).alias("is_neg"),
    )
    hits = (
        keyed_lookup(exploded(df, key, tokens), flags, ["token"], F.col(key), "inner")
        .groupBy(key).agg(F.sum("is_pos").cast("int").alias("pos_hits"),
                          F.sum("is_neg").cast("int").alias("neg_hits"))
    )
    return df.join(hits, key, "left").fillna(0, ["pos_hits", "neg_hits"])
