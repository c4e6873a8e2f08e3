"""Every registered query against its SQL on the smallest tables."""

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from finchlake.queries.registry import ORACLES, QUERIES
from check import canonical, connect

HEAVY = {"svm_base", "svm_hybrid", "score_texts", "holdout_eval", "kfold_eval"}  # covered in test_jobs


def test_entry(spark):
    assert entry(spark).columns == ["doc_id", "term", "weight"]


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) - set(ORACLES) == HEAVY


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    got = queries()[name](spark, sf_dir).toPandas()
    want = connect(sf_dir).execute(oracle_sql()[name]).df()
    assert canonical(got) == canonical(want)


@pytest.mark.parametrize("name", ["nfkc", "html_entities", "clean_text", "light_clean", "pre_process", "tweet_tokens", "term_counts"])
def test_text_work_runs_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("EvalPython|InPandas|InArrow", plan)
