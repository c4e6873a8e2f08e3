"""Operators 11, 12 and 13."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from finchlake.llm import product_codes as pc
from finchlake.llm import quality_gam as qg
from finchlake.llm import resampling as rs
from finchlake.llm.queries import QUERIES


def clean(value):
    return (value or "").translate(str.maketrans(rs.UPPER, rs.LOWER))


# ---------------------------------------------------------------- 11

def test_planes_give_the_sum_of_gains():
    rng = np.random.default_rng(3)
    gain = rng.integers(-9000, 9000, 1000)
    gain[:5] = [0, 1, -1, 2**20, -2**20]
    documents = [rng.integers(0, 1000, n) for n in (0, 1, 7, 300, 5000)] + [np.full(4099, 4), np.zeros(0, dtype=int)]
    assert rs.Weigher(gain).weights(documents).tolist() == [int(gain[d].sum()) for d in documents]
    assert rs.Weigher(np.zeros(10, dtype=int)).weights([np.array([1, 2])]).tolist() == [0]
    assert rs.Weigher(-np.ones(70, dtype=int)).weights([np.array([69, 69, 3])]).tolist() == [-3]


def plain_resample(rows, target, buckets, seed, least, percent):
    """(n_features, weight, score) of every (id, text) and the drawn ids in order, by definition."""
    found = [[zlib.crc32(w.encode()) % buckets for w in re.findall(rs.WORD.removesuffix("+"), clean(t))] for _, t in rows]
    aims = [zlib.crc32(w.encode()) % buckets for t in target for w in re.findall(rs.WORD.removesuffix("+"), clean(t))]
    s = np.bincount([b for f in found for b in f], minlength=buckets)
    t = np.bincount(aims, minlength=buckets)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + buckets) / ((s[b] + 1) * (t.sum() + buckets)))) for b in range(buckets)]
    out = []
    for (key, _), f in zip(rows, found):
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append((key, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    fit = sorted((o for o in out if o[1] >= least), key=lambda o: (-o[3], o[0] is None, o[0] or 0))
    return out, [o[0] for o in fit[:percent * len(fit) // 100]]


def test_resampling_of_awkward_rows(spark, edge, empty):
    target = spark.createDataFrame([("words of a long tale",), (None,), ("",)], "t string")
    got = rs.importance_resample(edge, "doc_id", "text", target, "t", buckets=50, least_words=1, percent=40)
    assert got.columns.count("score") == 1 and "text" not in got.columns and {"row", "part", "key"} <= set(got.columns)
    rows = got.collect()
    source = [(r["doc_id"], r["text"]) for r in edge.collect()]
    want, drawn = plain_resample(source, ["words of a long tale"], 50, 2024, 1, 40)
    assert sorted(map(repr, ((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in rows))) == sorted(map(repr, want))
    ranked = sorted((r["rank"], r["doc_id"]) for r in rows if r["rank"] is not None)
    assert [r[0] for r in ranked] == list(range(1, len(drawn) + 1)) and [r[1] for r in ranked] == drawn
    assert rs.importance_resample(empty, "doc_id", "text", target, "t").count() == 0
    assert rs.importance_resample(edge, "doc_id", "text", target.limit(0), "t", keep=["doc_id"]).count() == edge.count()


def test_runs_of_words_are_features(spark):
    found = spark.sql("SELECT array('a', 'b', 'c') AS w UNION ALL SELECT array('a') UNION ALL SELECT array()").select(
        rs.feature_buckets(F.col("w").cast("array<string>"), 2, 1000).alias("b"))
    want = [[zlib.crc32(x) % 1000 for x in xs] for xs in ([b"a", b"b", b"c", b"a b", b"b c"], [b"a"], [])]
    assert sorted(r["b"] for r in found.collect()) == sorted(want)


# ---------------------------------------------------------------- 12

def brute(table, parts):
    apart = ((parts[:, None, :] - table[None, :, :]) ** 2).sum(axis=2)
    return apart.argmin(axis=1), apart.min(axis=1)


@pytest.mark.parametrize("spread", [3, 40, 4000])
def test_search_finds_the_nearest_entry_and_the_first_of_ties(spread):
    rng = np.random.default_rng(spread)
    for entries, width in ((1, 4), (2, 1), (64, 4), (64, 2), (33, 0)):
        table = rng.integers(-spread, spread, (entries, width))
        table[entries // 2:] = table[:entries - entries // 2]   # every entry twice
        parts = np.concatenate([rng.integers(-spread, spread, (500, width)), table])
        held, distance = pc.Codebooks([table]).nearest(0, parts)
        want = brute(table, parts)
        assert (held == want[0]).all() and (distance == want[1]).all()


def plain_codes(rows, parts, entries, rounds):
    """(id, code, error, label) of the usable (id, vector, label) rows and the codebooks, by definition."""
    kept = [(k, [math.floor(256 * x) for x in v], g) for k, v, g in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1])
    cuts = [i * width // parts for i in range(parts + 1)]
    books = [[v[a:b] for _, v, _ in kept[:entries]] for a, b in zip(cuts, cuts[1:])]
    for step in range(rounds + 1):
        coded = []
        for k, v, g in kept:
            best = [min((sum((x - y) ** 2 for x, y in zip(v[a:b], e)), i) for i, e in enumerate(book))
                    for a, b, book in zip(cuts, cuts[1:], books)]
            coded.append((k, "".join(f"{i:02x}" for _, i in best), sum(d for d, _ in best), g, v, [i for _, i in best]))
        if step < rounds:
            for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                for e in range(len(books[p])):
                    mine = [c[4][a:b] for c in coded if c[5][p] == e]
                    if mine:
                        books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    return [c[:4] for c in coded], books


def test_codes_of_awkward_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(int(k), [float(x) for x in rng.normal(0, 1, 7)], int(k) % 3) for k in rng.permutation(60)]
    rows += [rows[0], rows[0], (None, [0.5] * 7, None), (7, [-0.25] * 7, None), (100, None, 1), (101, [], 1),
             (102, [None] + [1.0] * 6, 1), (103, [float("nan")] + [1.0] * 6, 1), (104, [float("inf")] * 7, 2)]
    schema = "vec_id long, embedding array<float>, label int, code int, row int, key int, error string"
    df = spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], schema)
    source = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    for parts, entries in ((4, 8), (16, 64), (1, 200)):
        out = pc.product_codes(df, "vec_id", "embedding", "label", parts, entries)
        assert out.columns == ["vec_id", "label", "row", "key", *pc.OUTPUTS]
        want, books = plain_codes(source, parts, entries, 2)
        got = out.collect()
        assert sorted(map(repr, ((r["vec_id"], r["code"], r["error"], r["label"]) for r in got))) == sorted(map(repr, want))
        by_label = {g: sum(w[2] for w in want if w[3] == g) for g in {w[3] for w in want}}
        assert all(r["label_error"] == by_label[r["label"]] for r in got)
        listed = ",".join(str(x) for book in books for e in book for x in e)
        assert {r["codebooks_sha256"] for r in got} == {hashlib.sha256(listed.encode()).hexdigest()}
    assert pc.product_codes(df.limit(0), "vec_id", "embedding", "label").count() == 0
    assert pc.product_codes(df.where("vec_id > 99"), "vec_id", "embedding", "label").count() == 0


# ---------------------------------------------------------------- 13

def test_tables_learn_curves_and_interactions():
    rng = np.random.default_rng(1)
    rows = rng.uniform(-1, 1, (4000, 4))
    curved = (np.abs(rows[:, 0]) < 0.5).astype(float)
    crossed = (rows[:, 1] * rows[:, 2] > 0).astype(float)
    for good in (curved, crossed):
        model = qg.fit(rows[:3000], good[:3000], pairs=2)
        right = (model.scores(rows[3000:]) >= 0.5) == (good[3000:] == 1)
        assert right.mean() > 0.93
    assert (1, 2) in model.pairs
    bins = model.bins(rows[:50])
    for i in range(50):
        total = model.base + sum(t[bins[i, j]] for j, t in enumerate(model.tables))
        total += sum(t[bins[i, a], bins[i, b]] for (a, b), t in zip(model.pairs, model.pair_tables))
        assert abs(model.scores(rows[i:i + 1])[0] - 1 / (1 + math.exp(-total))) < 1e-12
    assert qg.fit(rows[:5], np.ones(5)).scores(rows[:2]).tolist() == pytest.approx([6 / 7] * 2)
    assert qg.fit(np.zeros((0, 4)), np.zeros(0)).scores(rows[:1]).tolist() == [0.5]


def test_numbers_of_texts_are_finite():
    texts = [None, "", " ", "\n\n", "a", "ÀÉ ß 日本 🙂", "x" * 100_000, "word " * 20_000, "\x00\ud800!"]
    rows = np.array([qg.features(t) for t in texts])
    assert rows.shape == (len(texts), len(qg.FEATURES)) and np.isfinite(rows).all()
    assert (rows[0] == rows[1]).all()


def test_quality_of_awkward_rows(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1), (4, 0), (6, 1), (6, 0), (99, 1), (None, 1), (7, None), (5, 3)], "doc_id long, quality int")
    model = qg.fit_quality(edge, "doc_id", "text", labels, "quality", F.lit(True))
    out = qg.with_quality(edge, "text", model)
    rows = out.collect()
    assert len(rows) == edge.count() and out.columns.count("score") == 1 and all(0 <= r["score"] <= 1 for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r["text"] or "", r["score"]) == r["score"]
        assert r["predicted"] == int(r["score"] >= 0.7)
    assert qg.with_quality(empty, "text", model).count() == 0
    none = qg.fit_quality(empty, "doc_id", "text", labels, "quality", F.lit(True))
    assert none.scores(np.zeros((1, len(qg.FEATURES)))).tolist() == [0.5]


def test_quality_query_tells_held_out_texts_apart(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in QUERIES["op13_additive_quality"](spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    held = [r for r in labels if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count() and len(held) > 50
    assert all(rows[r["doc_id"]]["held_out"] for r in held)
    assert sum(rows[r["doc_id"]]["predicted"] == r["quality"] for r in held) >= 0.97 * len(held)
