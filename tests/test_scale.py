"""What keeps large runs in bounds: texts tokenized once, batches and files of bounded size."""

import pytest
from pyspark.ml.linalg import Vectors

from finchlake.plans import svm
from finchlake.queries import registry
from finchlake.queries.registry import QUERIES


@pytest.mark.parametrize("name", ["lexicon_join_hits", "lemmas", "stems", "spell_corrected"])
def test_tokens_are_written_once(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan


def test_frequencies_read_small_batches(spark, monkeypatch):
    rows = spark.createDataFrame(
        [(0, 1.0, Vectors.sparse(8, [i % 8], [1.0])) for i in range(20)], ["fold", "y", "words"])
    settings = (svm.SENT, svm.READ)
    before, seen, real = [spark.conf.get(s) for s in settings], [], svm.summed
    monkeypatch.setattr(svm, "summed", lambda *a: (seen.extend(int(spark.conf.get(s)) for s in settings), real(*a))[1])
    found = svm.fold_frequencies(rows, [svm.Block("words", 8)], [0])
    assert found[0][0].tolist() == [3, 3, 3, 3, 2, 2, 2, 2]
    assert max(seen) <= svm.FIRST_ROWS and [spark.conf.get(s) for s in settings] == before


def test_labelled_file_is_written_by_many_tasks(spark, sf_dir, monkeypatch):
    plans, real = [], registry.src.write_labelled
    monkeypatch.setattr(registry.src, "write_labelled", lambda df, path: (
        plans.append(df._jdf.queryExecution().optimizedPlan().toString()), real(df, path))[1])
    QUERIES["tsv_pieces"](spark, sf_dir)
    assert "Repartition 1, false" not in plans[0]
