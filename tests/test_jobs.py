import math
import os

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from finchlake import session
from finchlake.operators import lexicon, lookup, metrics, ordinal, terms, vocabulary
from finchlake.operators.rows import laid_out
from finchlake.plans import evaluate, model
from finchlake.plans.features import hashed_projection
from finchlake.queries import fixtures as fx
from finchlake.queries.registry import QUERIES
from finchlake.sources import labelled as src
from finchlake.streaming.score import read_text_stream, score_stream


def test_ordinal_and_folds(spark):
    ids = spark.range(0, 3000, 3).union(spark.range(10_000_000, 10_000_200))
    rows, total = ordinal.ordinal(ids.repartition(5), "id", buckets=7)
    got = [r["ord"] for r in rows.orderBy("id").collect()]
    assert total == 1200 and got == list(range(1200))
    for n, k, folds, last in [(20, 10, 7, 2), (100, 10, 10, 1)]:
        rows, total = ordinal.ordinal(spark.range(n), "id")
        sizes = rows.groupBy(ordinal.fold_id(total, k).alias("f")).count().orderBy("f").collect()
        assert len(sizes) == folds and sizes[-1]["count"] == last
    legacy = rows.select(ordinal.fold_id(total, 10, legacy_tail=True).alias("f")).where("f is not null")
    assert legacy.count() == 99 and legacy.distinct().count() == 9


def test_lookup_paths_agree(spark, monkeypatch):
    facts = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("k"), F.col("id") % 40)).alias("token"))
    dim = spark.createDataFrame([("hot", "H"), ("k1", "one"), ("k2", "two")], "token string, replacement string")
    small = lookup.keyed_lookup(facts, dim, ["token"], F.col("id")).orderBy("id").collect()
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 1)
    large = lookup.keyed_lookup(facts, dim, ["token"], F.col("id"))
    assert large.orderBy("id").select("token", "id", "replacement").collect() == \
        [r for r in spark.createDataFrame(small, large.schema).orderBy("id").select("token", "id", "replacement").collect()]
    stats = facts.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    joined = lookup.weighted_lookup(facts, stats, "token", "n", F.col("id"))
    assert joined.count() == 4000 and joined.where("token = 'hot'").select("n").distinct().collect()[0]["n"] == 1334


def test_a_key_of_every_row_is_split(spark):
    facts = spark.range(5000).select("id", F.lit("the").alias("token"))
    stats = facts.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    salts = lookup.hot_keys(stats, ["token"], "n", 100).collect()
    assert [(r["token"], r["_salts"]) for r in salts] == [("the", 50)]
    joined = lookup.weighted_lookup(facts, stats, "token", "n", F.col("id"), rows_per_task=100)
    assert joined.select("id").distinct().count() == joined.count() == 5000


def test_written_tables_can_be_dropped(spark):
    table = session.written(spark.range(7).withColumn("k", F.col("id") % 2), "dropped", partition_by="k")
    assert table.where("k = 1").count() == 3 and table.columns == ["id", "k"]
    paths = table.inputFiles()
    kept, session._written[:] = session._written[:-1], session._written[-1:]
    assert session.drop_written(spark) == 1 and not any(os.path.exists(p.removeprefix("file://")) for p in paths)
    session._written[:] = kept


def test_lexicon_paths_agree(spark, sf_dir):
    rows = fx.tokenized(spark, sf_dir)
    table = spark.createDataFrame(
        [(w, p) for p, ws in fx.LEXICON.items() for w in ws], "word string, polarity string")
    cols = ["doc_id", "pos_hits", "neg_hits"]
    a = lexicon.with_hits(rows, "doc_id", "tokens", table).select(cols).orderBy("doc_id").collect()
    b = lexicon.join_hits(rows, "doc_id", "tokens", table).select(cols).orderBy("doc_id").collect()
    assert a == b and sum(r["pos_hits"] for r in a) > 0


def edits1(word):
    letters = "abcdefghijklmnopqrstuvwxyz"
    splits = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    return set([a + b[1:] for a, b in splits if b] + [a + b[1] + b[0] + b[2:] for a, b in splits if len(b) > 1]
               + [a + c + b[1:] for a, b in splits if b for c in letters]
               + [a + c + b for a, b in splits for c in letters])


def test_spelling(spark):
    known = {"the": 50, "then": 30, "a": 9, "spelling": 20, "cat": 8, "act": 7, "of": 3}
    unknown = ["teh", "spellnig", "speling", "xyzzyq", "cta", "thenn", "o", "spelxxng", "i"]
    words = spark.createDataFrame([(w, 1) for w in unknown] + list(known.items()), "word string, n long")
    dictionary = spark.createDataFrame(list(known.items()), "word string, n long")
    got = {r["token"]: r["replacement"] for r in vocabulary.spelling_map(words, dictionary).collect()}
    for w in unknown:
        near = [k for k in edits1(w) & set(known)]
        if near:
            assert got[w] == max(near, key=lambda k: (known[k], k)), w
    assert got["spelxxng"] == "spelling" and "xyzzyq" not in got


def test_tfidf_matches_definition(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["a", "c"]), (3, [])], "id long, t array<string>")
    counts = terms.term_counts(laid_out(docs, "id"), "id", "t")
    got = {(r["id"], r["term"]): r["weight"] for r in terms.tfidf(counts, "id", 3).collect()}
    ia, ib = math.log(4 / 3) + 1, math.log(4 / 2) + 1
    norm = math.hypot(2 * ia, ib)
    assert got[(1, "a")] == pytest.approx(2 * ia / norm) and got[(1, "b")] == pytest.approx(ib / norm)
    assert len(got) == 4


def test_metrics_equal_mllib(spark):
    rows = [(i, 0, "positive" if i % 3 else "negative", "positive" if i % 4 else "negative") for i in range(50)]
    pred = spark.createDataFrame(rows + [(99, 0, "other", "positive")], "id long, fold int, true string, pred string")
    ours = metrics.weighted_prf(pred).first()
    index = {"positive": 0.0, "negative": 1.0, "other": 2.0}
    ml = spark.createDataFrame([(index[t], index[p]) for _, _, t, p in rows + [(99, 0, "other", "positive")]],
                               "label double, prediction double")
    for name, metric in [("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1", "f1")]:
        assert ours[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=metric).evaluate(ml), abs=1e-9)
    assert metrics.with_outcome(pred).count() == 50
    cells = metrics.confusion(pred, ["positive", "negative", "other"]).collect()
    assert len(cells) == 9 and sum(c["n"] for c in cells) == 51
    assert math.isnan(metrics.fold_mean(metrics.weighted_prf(pred)).first()["support"])


def test_tsv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, "positive", 'a "q" b\tc'), (2, "negative", "line\nbreak"), (3, "positive", " pad ")],
        "id long, label string, text string")
    src.write_labelled(rows, str(tmp_path / "t"))
    back = src.read_labelled_with_id(spark, str(tmp_path / "t")).orderBy("id").collect()
    assert back == rows.orderBy("id").collect()


def test_unknown_architecture():
    with pytest.raises(ValueError):
        model.classifier("other")


def test_hybrid_and_stream_scoring(spark, sf_dir, tmp_path):
    rows = fx.noisy_labelled(spark, sf_dir)
    hybrid = model.train(rows, "BERTweet", encoder=hashed_projection(16), hash_size=1 << 10, max_iter=3)
    scored = model.score(hybrid, rows)
    assert scored.count() == rows.count()
    assert {r["pred"] for r in scored.select("pred").distinct().collect()} <= {"positive", "negative"}

    base = model.train(rows, lexicon=fx.LEXICON, hash_size=1 << 10, max_iter=3)
    folder = str(tmp_path / "in")
    rows.select("doc_id", "text").repartition(3).write.parquet(folder)
    stream = read_text_stream(spark, folder, rows.select("doc_id", "text").schema)
    query = score_stream(base, stream, str(tmp_path / "out"), str(tmp_path / "ck"))
    query.awaitTermination(120)
    batch = model.score(base, rows.select("doc_id", "text")).select("doc_id", "pred").orderBy("doc_id").collect()
    assert spark.read.parquet(str(tmp_path / "out")).select("doc_id", "pred").orderBy("doc_id").collect() == batch

    saved = str(tmp_path / "model")
    base.save(saved)
    from pyspark.ml import PipelineModel
    again = model.score(PipelineModel.load(saved), rows.select("doc_id", "text"))
    assert again.select("doc_id", "pred").orderBy("doc_id").collect() == batch


def test_cross_validation(spark, sf_dir, tmp_path):
    rows = fx.noisy_labelled(spark, sf_dir)
    log = str(tmp_path / "log")
    pred = evaluate.cross_validate(rows, "doc_id", 3, lexicon=fx.LEXICON, hash_size=1 << 10, max_iter=3, log_path=log)
    assert pred.count() == rows.count() == pred.select("id").distinct().count()
    assert src.read_error_log(spark, log).count() == rows.count()
    assert os.path.isdir(log + "/scores")
    scores = evaluate.cv_scores(pred).first()
    assert 0 < scores["f1"] <= 1
