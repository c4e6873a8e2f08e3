"""Tokens replaced by pieces against the join that took one row a token."""

from pyspark.sql import functions as F

from finchlake.operators.lookup import substitute_tokens
from finchlake.operators.rows import collected, exploded
from finchlake.queries.registry import QUERIES

ROWS = [(1, ["a", "b", "a"]), (2, ["c"]), (2, ["z", "a"]), (2, ["c"]), (None, ["a"]), (None, ["b"]), (3, []), (4, None),
        (5, ["b", None, "", "\u00e9"]), (6, ["a b"])]
MAPPING = [("a", "X"), ("c", "a"), ("", "E"), ("unseen", "Y")]


def _joined(df, mapping, into):
    long = exploded(df, "id", "t").join(F.broadcast(mapping), "token", "left").withColumn("token", F.coalesce("replacement", "token"))
    return df.join(collected(long, "id", "token", "_sub"), "id", "left").withColumn(
        into, F.coalesce("_sub", F.array().cast("array<string>"))).drop("_sub")


def test_replaced_tokens_are_those_of_the_join(spark):
    mapping = spark.createDataFrame(MAPPING, "token string, replacement string")
    df = spark.createDataFrame(ROWS, "id int, t array<string>")
    rows = lambda x: sorted(map(repr, x.collect()))
    assert rows(substitute_tokens(df, "id", "t", mapping)) == rows(_joined(df, mapping, "t"))
    wide = df.withColumn("n", F.size("t"))
    assert rows(substitute_tokens(wide, "id", "t", mapping, "u").select("id", "n", "t", "u")) == rows(
        _joined(wide, mapping, "u").select("id", "n", "t", "u"))


def test_stems_exchange_no_row_a_token(spark, sf_dir):
    plan = QUERIES["stems"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "collect_list" not in plan


def test_lemmas_are_not_laid_out_before_they_are_dealt(spark, sf_dir):
    plan = QUERIES["tfidf_lemmas"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [doc_id" not in plan
