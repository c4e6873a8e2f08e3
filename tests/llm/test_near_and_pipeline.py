"""Operator 5 and the pipeline."""

import collections
import random

import corpus_pipeline
import duckdb
import numpy as np
import pytest

from finchlake.llm import components, mixture, probminhash
from finchlake.llm.queries import ORACLES, QUERIES
from finchlake.session import written


def plain_shingles(text):
    import re

    words = re.findall(r"[0-9a-z_\x80-\U0010ffff]+", text.lower())
    if not words:
        return {}
    return dict(collections.Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))))


def plain_similarity(x, y):
    if not x or not y:
        return 0.0
    return sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in {*x, *y}) for d in x if d in y)


def classes_by_brute_force(rows, least=0.8):
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    bags = [plain_shingles(t or "") for _, t in rows]
    where = collections.defaultdict(list)
    for i, bag in enumerate(bags):
        for s in bag:
            where[s].append(i)
    common = collections.Counter((a, b) for v in where.values() for n, a in enumerate(v) for b in v[n + 1:])
    pairs = [p for p, n in common.items() if n >= 0.5 * min(len(bags[p[0]]), len(bags[p[1]]))
             and plain_similarity(bags[p[0]], bags[p[1]]) >= least]
    same = collections.defaultdict(list)
    for i, (_, t) in enumerate(rows):
        same[t or ""].append(i)
    pairs += [(v[0], i) for v in same.values() for i in v[1:]]
    for a, b in pairs:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    groups = collections.defaultdict(list)
    for i, (k, _) in enumerate(rows):
        groups[root(i)].append(k)
    return sorted((sorted(g, key=repr) for g in groups.values()), key=repr)


def classes_of(found, key="doc_id"):
    groups = collections.defaultdict(list)
    for r in found:
        groups[r["class_id"]].append(r[key])
    return sorted((sorted(g, key=repr) for g in groups.values()), key=repr)


def test_shingles_and_weights():
    texts = ["a b c d e a b c d e a b c d e", "Ünï, (x) y", "", "..., -", "One two three four five six", "one TWO three four five six!"]
    doc, shingle, weight = probminhash.weighted_shingles(texts)
    for i, t in enumerate(texts):
        assert sorted(weight[doc == i].tolist()) == sorted(plain_shingles(t).values())
    assert shingle[doc == 4].tolist() == shingle[doc == 5].tolist()


def bag(n, rng):
    keys = np.sort(np.array(rng.sample(range(1, 60), n), np.uint64))
    return keys, np.array([rng.randrange(1, 6) for _ in range(n)])


def test_registers_agree_with_the_probability_jaccard_similarity():
    rng = random.Random(3)
    for _ in range(20):
        (a, wa), (b, wb) = bag(rng.randrange(1, 40), rng), bag(rng.randrange(1, 40), rng)
        want = plain_similarity(dict(zip(a.tolist(), wa.tolist())), dict(zip(b.tolist(), wb.tolist())))
        assert probminhash.probability_jaccard(a, wa, b, wb) == pytest.approx(want)
        doc = np.array([0] * len(a) + [1] * len(b))
        both = np.concatenate((a, b)), np.concatenate((wa, wb))
        r = probminhash.prob_minhash(doc, probminhash.mixed(both[0]), both[1], 2, 20_000)
        assert abs((r[0] == r[1]).mean() - want) < 0.02 and (r != 0).all()


def test_query_against_brute_force(spark, sf_dir, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    found = QUERIES["op5_prob_minhash"](spark, sf_dir).collect()
    assert len(found) == len(rows) and classes_of(found) == classes_by_brute_force(rows)
    assert all(r["class_id"] <= r["doc_id"] for r in found)


def test_a_chain_and_a_star_of_copies(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(120)]
    chain, rows = list(base), []
    for i in range(30):  # neighbours are similar, ends are not
        rows.append((i, " ".join(chain)))
        chain[(4 * i) % 120] = word()
    for i in range(100, 160):  # copies with edits of their own around one text
        copy = [word() if rng.random() < 0.015 else w for w in reversed(base)]
        rows.append((i, " ".join(copy)))
    rows += [(i, "the very same text of more than five words") for i in range(200, 260)]
    rows += [(i, " ".join(word() for _ in range(50)) + " " + " ".join(base[:25])) for i in range(300, 340)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = probminhash.near_duplicate_classes(df, "doc_id", "text").collect()
    assert classes_of(found) == classes_by_brute_force(rows)
    kept = probminhash.one_of_each_class(df, "doc_id", "text").collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({r["class_id"] for r in found})


def test_near_copies_of_awkward_rows(edge, empty):
    found = probminhash.near_duplicate_classes(edge, "doc_id", "text").collect()
    ids = collections.defaultdict(set)
    for r in found:
        ids[r["class_id"]].add(r["doc_id"])
    assert len(found) == edge.count() and ids[1] == {1, 5} and ids[2] == {2, 3, None} and ids[None] == {None} and ids[6] == {6}
    kept = probminhash.one_of_each_class(edge, "doc_id", "text")
    assert kept.columns == edge.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, 2, 4, 6, 7, 8, None]
    assert probminhash.near_duplicate_classes(empty, "doc_id", "text").count() == 0
    assert probminhash.one_of_each_class(empty, "doc_id", "text").count() == 0


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (6, 5), (5, 4), (20, 21)] + [(100, i) for i in range(101, 150)]
    out = {r["node"]: r["label"] for r in components.component_labels(spark.createDataFrame(links, "x long, y long")).collect()}
    assert out == {**dict.fromkeys((1, 2, 3), 1), **dict.fromkeys(range(4, 10), 4), 20: 20, 21: 20, **dict.fromkeys(range(100, 150), 100)}
    assert components.component_labels(spark.createDataFrame([], "x long, y long")).count() == 0


def test_pipeline_stage_by_stage(spark, sf_dir, documents):
    stages = dict(corpus_pipeline.STAGES)
    docs, before = documents, {r["doc_id"]: r["text"] for r in documents.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = written(stage(spark, docs, sf_dir), "stage")
        assert after.columns == corpus_pipeline.COLUMNS
        rows = after.collect()
        if name == "toxicity":
            assert all(before[r["doc_id"]] == r["text"] for r in rows) and len(rows) >= 0.7 * len(before)
        if name == "line dedup":
            con = duckdb.connect()
            con.register("documents", docs.toPandas())
            want = {r[0]: (r[1], r[3]) for r in con.execute(ORACLES["op7_line_runs"]).fetchall()}
            import hashlib
            assert {r["doc_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in rows} == {k: v[1] for k, v in want.items()}
        if name == "MinHash near-dedup":
            groups = classes_by_brute_force([(r["doc_id"], r["text"]) for r in docs.collect()])
            assert sorted(r["doc_id"] for r in rows) == sorted(min(g) for g in groups)
        if name.startswith("mixing"):
            from pyspark.sql import functions as F
            usage = {r["doc_id"]: r["taken"] for r in mixture.Mixture(docs, "doc_id", "source", mixture.words(F.col("text"))).usage().collect()}
            taken = collections.Counter()
            for r in rows:
                taken[r["doc_id"]] += len(r["text"].split())
            assert {k: v for k, v in usage.items() if v} == dict(taken)
        docs = after
    packed = stages["best-fit packing"](spark, docs, sf_dir).collect()
    assert sorted({r["doc_id"] for r in packed}) == sorted({r["doc_id"] for r in docs.collect()})
    assert len({(r["sequence_id"], r["offset"]) for r in packed}) == len(packed)
    total = collections.Counter()
    for r in packed:
        total[r["sequence_id"]] += r["length"]
    assert max(total.values()) <= corpus_pipeline.CAPACITY and len(total) <= 1.05 * sum(total.values()) / corpus_pipeline.CAPACITY + 1


def test_pipeline_of_awkward_rows(spark, tmp_path, edge, empty):
    for number, table in enumerate((edge, empty)):
        folder = str(tmp_path / str(number))
        table.select("doc_id", "text", "lang", "source").selectExpr("*", "cast(length(text) as long) n_chars").write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, 0, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        out = corpus_pipeline.run(spark, folder)
        assert out.count() >= (0 if number else 3)

