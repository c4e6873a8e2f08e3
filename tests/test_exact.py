"""Exact vocabularies, positions in any order, and models with named features."""

import pytest
from pyspark.sql import functions as F

from finchlake.operators import ordinal, terms
from finchlake.plans import exact
from finchlake.queries import fixtures as fx

TEXTS = [
    (1, "positive", "good good day"), (2, "negative", "bad day"), (3, "positive", "a good one"), (4, "negative", ""),
    (5, "negative", None), (6, "positive", "good: it's fine"), (7, "negative", "awful: bad one"),
]


def test_positions_in_any_order(spark):
    rows = [(k, t) for k in (3, None, 1) for t in ("b", "a", "é", "", None)]
    df = spark.createDataFrame(rows, "k int, t string")
    for by in (["k", "t"], [F.desc("k"), F.asc_nulls_last("t")], ["t", F.desc_nulls_first("k")]):
        placed, total = ordinal.positions(df, by)
        want = [tuple(r) for r in df.orderBy(*by).collect()]
        got = {r["ord"]: (r["k"], r["t"]) for r in placed.collect()}
        assert total == len(rows) and [got[i] for i in range(total)] == want
    ties, total = ordinal.positions(spark.range(50).select((F.col("id") % 2).alias("id")), ["id"], "n")
    assert sorted(r["n"] for r in ties.collect()) == list(range(50)) and total == 50
    assert {r["id"] for r in ties.where("n < 25").collect()} == {0}
    none, total = ordinal.positions(df.limit(0), ["k"])
    assert none.count() == 0 == total


def test_dictionary_and_vectors(spark):
    df = spark.createDataFrame(TEXTS, "id int, label string, text string")
    counts = exact.block_counts(df, "id", "text", fx.LEXICON)
    names, sizes = exact.dictionary(counts)
    rows = names.orderBy("block", "index").collect()
    for block in exact.BLOCKS:
        mine = [r for r in rows if r["block"] == block]
        assert [r["index"] for r in mine] == list(range(sizes[block])) and [r["term"] for r in mine] == sorted(r["term"] for r in mine)
    weights = exact.tfidf_entries(counts, names, "id", len(TEXTS))
    vectors = exact.sparse_vectors(weights.withColumnRenamed("weight", "value"), df.select("id", "label"), "id", sizes)
    got = {(r["id"], b): r[b] for r in vectors.collect() for b in exact.BLOCKS}
    assert len(got) == 2 * len(TEXTS) and got[5, "word"].numNonzeros() == 0 and got[5, "word"].size == sizes["word"]
    for r in weights.collect():
        assert got[r["id"], r["block"]][int(r["index"])] == pytest.approx(r["weight"])
    back = exact.vector_entries(vectors, "id", list(exact.BLOCKS))
    assert sorted(map(tuple, back.collect())) == sorted(
        (r["block"], r["id"], r["index"], r["weight"]) for r in weights.collect())


def margins(model, df, total):
    """Margins from the weighted entries of every row and the listed weights."""
    counts = exact.block_counts(df, "id", "text", fx.LEXICON)
    entries = exact.tfidf_entries(counts, model.features, "id", total).drop("index")
    sums = entries.join(model.features.select("block", "term", F.col("weight").alias("w")), ["block", "term"]).groupBy(
        "id").agg(F.sum(F.col("weight") * F.col("w")).alias("m"))
    found = {r["id"]: r["m"] for r in sums.collect()}
    return {r["id"]: found.get(r["id"], 0.0) + model.intercept for r in df.collect()}


@pytest.mark.parametrize("best", [None, 6])
def test_models_list_their_features(spark, best):
    df = spark.createDataFrame(TEXTS, "id int, label string, text string")
    model = exact.train_exact(df, "id", fx.LEXICON, best=best)
    assert model.features.columns == ["block", "index", "term", "df", "idf", "weight"] and model.labels == ["negative", "positive"]
    listed = model.features.collect()
    scored = {r["id"]: r for r in model.score(df, "id").collect()}
    assert scored.keys() == {t[0] for t in TEXTS} and all(scored[t[0]]["pred"] == t[1] for t in TEXTS if t[2])
    for key, margin in margins(model, df, len(TEXTS)).items():
        assert scored[key]["margin"] == pytest.approx(margin, abs=1e-9)
    unseen = model.score(spark.createDataFrame([(1, "zzz qqq")], "id int, text string"), "id").first()
    assert unseen["margin"] == pytest.approx(model.intercept)
    if best is not None:
        counts = exact.block_counts(df, "id", "text", fx.LEXICON)
        weights = exact.tfidf_entries(counts, model.features, "id", len(TEXTS))
        both = weights.select("id", F.concat_ws(":", "block", "term").alias("term"), "weight")
        top = terms.chi2_top(both, df.select("id", "label"), "id", best).collect()
        assert {f"{r['block']}:{r['term']}" for r in listed if r["weight"]} <= {r["term"] for r in top}
        assert sum(r["weight"] != 0 for r in listed) > best // 2
        words = weights.where("block = 'word'")
        assert {r["term"] for r in exact.best_terms(words, df.select("id", "label"), "id", 4).collect()} == {
            r["term"] for r in terms.chi2_top(words.select("id", "term", "weight"), df.select("id", "label"), "id", 4).collect()}
