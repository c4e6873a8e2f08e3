"""Replacing matches inside the row: right cuts, and patterns that are compiled once."""

import pytest
from pyspark.sql import functions as F

from finchlake.functions import unicode as un
from finchlake.functions.text import rewrite_matches


def test_matches_anywhere(apply):
    mark = lambda c: rewrite_matches(c, "ab+", lambda m: F.concat(F.lit("<"), m, F.lit(">")), marks="b")
    texts = ["", "b", "ab", "abab", "xab", "abx", "x\nabb\ny", "a\x01ab\x02", "ababx\U0001F600ab", None]
    want = ["", "b", "<ab>", "<ab><ab>", "x<ab>", "<ab>x", "x\n<abb>\ny", "a\x01<ab>\x02", "<ab><ab>x\U0001F600<ab>", None]
    assert apply(mark, texts) == want


def test_a_pattern_that_captures_is_refused():
    with pytest.raises(ValueError):
        rewrite_matches(F.lit("x"), "(x)", lambda m: m)


def test_emoji_pattern_is_not_compiled_by_row(spark):
    """``split`` compiles its pattern for every row: the large one of emoji must not be given to it."""
    rows = spark.range(1).select(F.concat(F.col("id").cast("string"), F.lit(" 😀")).alias("x"))
    plan = rows.select(un.emoji_to_text(F.col("x")))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" in plan and "split(lambda" not in plan and "split(namedlambda" not in plan
