"""Lemmas: irregular forms, lookup inside the row or by a join, and in fitted stages."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from finchlake.constants import IRREGULAR_LEMMAS
from finchlake.functions import tokens as tk
from finchlake.operators import vocabulary
from finchlake.plans.features import WordTerms
from finchlake.plans.preprocess import pre_process

WORDS = ["cats", "cat", "walked", "walk", "went", "children", "better", "walking", "was", "zzz", "nicer", "nice"]


def table(spark):
    words = spark.createDataFrame([(w,) for w in WORDS], "word string")
    tagged = words.select("word", tk.wordnet_class(tk.tag_by_ending(F.col("word"))).alias("wn_class"))
    return vocabulary.lemma_map(tagged.unionByName(spark.createDataFrame([("went", "v"), ("was", "v")], tagged.schema)),
                                words, IRREGULAR_LEMMAS)


def test_irregular_forms_go_before_the_rules(spark):
    got = {(r["word"], r["wn_class"]): r["lemma"] for r in table(spark).collect()}
    assert got["went", "v"] == "go" and got["was", "v"] == "be" and got["children", "n"] == "child"
    assert got["better", "a"] == "good" and got["cats", "n"] == "cat" and got["walked", "v"] == "walk" == got["walking", "v"]
    assert got["nicer", "a"] == "nice" and got["zzz", "n"] == "zzz"


def test_lookup_inside_the_row_equals_the_join(spark):
    lemmas = table(spark)
    literals = vocabulary.lemma_literals(lemmas)
    assert literals["n:cats"] == "cat" and "n:cat" not in literals and vocabulary.lemma_literals(lemmas, limit=2) is None
    texts = [(1, "cats walked, children walking nicer"), (2, ""), (3, None), (4, "better zzz went n:cats cats")]
    df = spark.createDataFrame(texts, "id int, text string")
    inside = pre_process(df, "id", "text", {"pos": [], "neg": []}, lemmas=literals)
    joined = pre_process(df, "id", "text", {"pos": [], "neg": []}, lemmas=lemmas, tags=tk.tag_by_ending(F.col("token")))
    want = {r["id"]: r["tokens"] for r in joined.collect()}
    got = {r["id"]: r["tokens"] for r in inside.collect()}
    assert got == want and got[1][:5] == ["cat", "walk", ",", "child", "walk"] and "cat walk" in got[1]


def test_stages_keep_their_lemmas(spark, tmp_path):
    literals = vocabulary.lemma_literals(table(spark))
    stage = WordTerms(inputCol="text", outputCol="words", positive=["cat"], lemmas=[f"{k}={v}" for k, v in literals.items()])
    df = spark.createDataFrame([("Cats walked",)], "text string")
    fitted = Pipeline(stages=[stage]).fit(df)
    fitted.write().overwrite().save(str(tmp_path / "m"))
    for model in (fitted, PipelineModel.load(str(tmp_path / "m"))):
        assert model.transform(df).first()["words"] == ["cat", "walk", "cat walk", "LEX_POS"]
