"""The solver of linear SVMs against its definition, and the registered model queries run to the end."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from finchlake.plans import model, svm
from finchlake.queries import fixtures as fx
from finchlake.queries.registry import QUERIES


def sample(n=120, size=30, seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        slots = np.sort(rng.choice(size, rng.integers(0, 8), replace=False))
        counts = rng.integers(1, 4, len(slots)).astype(float)
        label = "good" if (slots < 12).sum() + rng.normal(0, 1) > (slots >= 12).sum() else "poor"
        rows.append((i % 4, label, Vectors.sparse(size, slots.tolist(), counts.tolist()), Vectors.dense(rng.normal(0, 1, 3))))
    return rows


def matrix(rows, fitted_on):
    """The weighted, scaled features of all rows with frequencies of some, by definition; a last column of ones."""
    raw = np.array([r[2].toArray() for r in rows])
    seen = (raw[fitted_on] > 0).sum(axis=0)
    idf = np.where(seen > 0, np.log((1 + len(fitted_on)) / (1 + seen)) + 1, 0)
    x = raw * idf
    length = np.sqrt((x * x).sum(axis=1, keepdims=True))
    x = np.divide(x, length, out=np.zeros_like(x), where=length > 0)
    return np.hstack([x, np.array([r[3].toArray() for r in rows]), np.ones((len(rows), 1))])


def gradient(x, y, c, w, cost):
    gap = np.maximum(0, 1 - y * (x @ w))
    return w - 2 * cost * x.T @ (c * y * gap)


@pytest.mark.parametrize("balanced", [False, True])
def test_models_without_a_fold_equal_models_fitted_on_the_rest(spark, monkeypatch, balanced):
    rows = sample()
    df = spark.createDataFrame([(f, y, a, b) for f, y, a, b in rows], ["fold", "label", "a", "b"]).withColumn(
        "fold", F.col("fold").cast("int"))
    y = np.array([1.0 if r[1] == "poor" else -1.0 for r in rows])
    # One task, which solves the problem itself, or several whose solutions are averaged and then improved.
    for entries, tolerance, off in ((10**9, 1e-7, 1e-4), (150, 1e-4, 1e-2)):
        monkeypatch.setattr(svm, "ENTRIES_PER_TASK", entries)
        read, blocks, problems, names = model.fit_problems(
            df.repartition(3), ["a", "b"], [None, 0, 3], cost=0.7, max_iter=500, balanced=balanced, tolerance=tolerance)
        assert names == ["good", "poor"] and [b.weighted for b in blocks] == [True, False]
        for p in problems:
            inside = [i for i, r in enumerate(rows) if r[0] != p.held]
            x, labels = matrix(rows, inside)[inside], y[inside]
            n_class = {v: (labels == v).sum() for v in (-1.0, 1.0)}
            c = np.array([len(inside) / (2 * n_class[v]) if balanced else 1.0 for v in labels])
            assert np.abs(gradient(x, labels, c, p.weights, 0.7)).max() < off
        scored = svm.predicted(read, blocks, problems[1:], ["fold", "label"]).collect()
        assert len(scored) == sum(r[0] in (0, 3) for r in rows)
        for p in problems[1:]:
            mine = [i for i, r in enumerate(rows) if r[0] == p.held]
            want = matrix(rows, [i for i, r in enumerate(rows) if r[0] != p.held])[mine] @ p.weights
            assert sorted(r["margin"] for r in scored if r["fold"] == p.held) == pytest.approx(sorted(want))


def test_vectors_are_added_in_groups(spark, monkeypatch):
    monkeypatch.setattr(svm, "GROUP_BYTES", 1)

    def part(batches):
        n = sum(b.num_rows for b in batches)
        yield svm._sent([(svm._task(), k, float(n), np.full(3, n * (k + 1.0))) for k in range(2)])

    found = svm.summed(spark.range(100).repartition(7), part, 2, 3)
    assert {k: (loss, v.tolist()) for k, (loss, v) in found.items()} == {0: (100.0, [100.0] * 3), 1: (100.0, [200.0] * 3)}


@pytest.mark.parametrize("long", [0, 10**9])
def test_packed_rows_are_opened_as_they_were_and_models_share_a_pass(monkeypatch, long):
    monkeypatch.setattr(svm, "PACKED_ENTRIES", 7)
    monkeypatch.setattr(svm, "LONG_ROWS", long)
    rng = np.random.default_rng(3)
    lengths, n = rng.integers(0, 6, 20), 20
    slots = np.concatenate([np.sort(rng.choice(30, k, replace=False)) for k in lengths])
    sparse, dense = rng.integers(1, 4, len(slots)).astype(float), rng.normal(0, 1, 3 * n)
    blocks = [svm.Block("a", 30), svm.Block("b", 3, weighted=False, dense=True)]
    y, fold, factors = np.where(rng.random(n) > 0.4, 1.0, -1.0), rng.integers(-1, 3, n), rng.random((n, 2, 2))
    held = svm.Rows(fold, y, [(slots, sparse, lengths), (np.tile(np.arange(3), n), dense, np.full(n, 3))])
    packs = list(held.packs(factors))
    again = svm.Rows.opened(packs, blocks)
    assert len(packs) > 5 and again.n == n and (again.fold == fold).all() and (again.y == y).all() and (again.known == factors).all()
    assert all((p == q).all() for x, z in zip(held.blocks, again.blocks) for p, q in zip(x, z))
    points = [(0, None, (1.0, 2.0), rng.normal(0, 1, 34)), (1, 2, (1.0, 1.0), rng.normal(0, 1, 34))]
    sums = np.zeros((34, 2))
    loss = again.passed(blocks, points, 0.7, sums)
    x = np.zeros((n, 33))
    x[np.repeat(np.arange(n), lengths), slots] = sparse
    x[:, 30:] = dense.reshape(n, 3)
    for k, out, (low, high), w in points:
        scaled = np.hstack([x[:, :30] * factors[:, k, :1], x[:, 30:] * factors[:, k, 1:], np.ones((n, 1))])
        c = np.where(y > 0, high, low) * (1.0 if out is None else fold != out)
        gap = np.maximum(0, 1 - y * (scaled @ w))
        plain = scaled.T @ (-2 * 0.7 * c * y * gap)
        assert loss[k] == pytest.approx(0.7 * (c * gap * gap).sum()) and sums[:, k] == pytest.approx(plain)


def test_tasks_of_a_pass_do_not_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(svm, "ENTRIES_PER_TASK", 1)
    seen, real = [], svm.summed
    monkeypatch.setattr(svm, "summed", lambda rows, *a: (seen.append((rows.rdd.getNumPartitions(), rows.columns)), real(rows, *a))[1])
    df = spark.createDataFrame([(f, y, a) for f, y, a, _ in sample()], ["fold", "label", "a"]).repartition(60)
    model.fit_problems(df, ["a"], [0, 1], cost=1.0, max_iter=2, balanced=False)
    assert max(n for n, _ in seen) <= 2 * spark.sparkContext.defaultParallelism
    assert seen[-1][1] == ["entries", "pack"]


def test_scoring_by_blocks_equals_the_passes(spark, sf_dir):
    rows = fx.noisy_labelled(spark, sf_dir)
    fitted = model.train(rows, lexicon=fx.LEXICON, hash_size=1 << 12)
    made = fitted.transform(rows).select("doc_id", "label", "margin", "word_tf", "char_tf", F.lit(0).alias("fold"))
    read, blocks, (p,), _ = model.fit_problems(made, ["word_tf", "char_tf"], [None], 1.0, model.MAX_ITER, False)
    p.held = 0
    again = {r["doc_id"]: r["margin"] for r in svm.predicted(read, blocks, [p], ["doc_id"]).collect()}
    for r in made.select("doc_id", "margin").collect():
        assert r["margin"] == pytest.approx(again[r["doc_id"]], abs=2e-3)


def test_two_classes_are_needed(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "y")], "label string, text string")
    with pytest.raises(ValueError, match="two classes"):
        model.train(rows, hash_size=1 << 10)


@pytest.mark.parametrize("name, columns", [
    ("svm_base", ["doc_id", "label", "pred"]), ("svm_hybrid", ["doc_id", "label", "pred"]),
    ("score_texts", ["conv_id", "turn", "pred"]), ("holdout_eval", ["precision", "recall", "f1"]),
    ("kfold_eval", ["precision", "recall", "f1"]),
])
def test_model_queries_end(spark, sf_dir, name, columns):
    got = QUERIES[name](spark, sf_dir).toPandas()
    assert list(got.columns) == columns and not got.isna().any().any()
    if "pred" in columns:
        assert set(got["pred"]) <= {"positive", "negative"}
        table = {"score_texts": "conversations"}.get(name, "labels")
        assert len(got) == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
    if "label" in columns:
        assert (got["label"] == got["pred"]).mean() > 0.95
    if "f1" in columns:
        assert 0 < got["f1"][0] <= 1
