"""Operators 1, 4, 6 and 10."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from check import canonical, connect
from finchlake.llm import layout_text, order_minhash, topk_search, toxicity
from finchlake.llm.queries import ORACLES, QUERIES

# ------------------------------------------------------------------ 1


def model_of(text):
    symbol = toxicity.tables()[1]
    s = symbol[toxicity.code_points(f"\n{text}\n")]
    counts = np.zeros((28, 28, 28))
    np.add.at(counts, (s[:-2], s[1:-1], s[2:]), 1)
    return toxicity.language_model(counts)


WORDS = "you are an idiot and a loser some trash talk of stupid people who like the pathetic clown in town " * 30


@pytest.mark.parametrize("noisy, clear", [
    ("1d10t", "idiot"), ("l0s3r", "loser"), ("s.t.u.p.i.d", "stupid"), ("c l o w n", "clown"), ("tr@$h", "trash"),
    ("stuuuupid", "stupid"), ("p4th3t1c", "pathetic"), ("сlоwn", "clown"), ("cl​own", "clown"), ("5tup1d.", "stupid"),
])
def test_disguises_are_read(noisy, clear):
    model = model_of(WORDS).tolist()
    assert clear in toxicity.restored_text(f"the {noisy} people", model, {}).split()


@pytest.mark.parametrize("noisy, clear", [
    ("c=l=o=w=n", "clown"), ("tr@sh.you", "trash"), ("idi0t=you", "idiot"), ("l - o - s - e - r", "loser"), ("c  l  o  w  n", "clown"),
    ("s . t . u . p . i . d", "stupid"), ("you=l0ser", "loser"), ("s.t-u p i_d", "stupid"),
])
def test_wider_spacing_and_signs_like_those_of_addresses_are_read(noisy, clear):
    model = model_of(WORDS).tolist()
    assert clear in toxicity.restored_text(f"the {noisy} people", model, {}).split()


def test_addresses_and_short_lists_stay():
    model = model_of(WORDS).tolist()
    for text in ("see http://t.co/x1?a=b2", "me@site4.org.", "(x1@mail.co.uk)", "www.l0ser.com", "a, b and c", "x - y", "i am = a"):
        want = "".join(chr(c) for c in toxicity.tables()[0][toxicity.code_points(text)])
        assert toxicity.restored_text(text, model, {}).split() == want.split()


def test_spelled_out_by_its_definition():
    rng = random.Random(8)
    for _ in range(400):
        text = "".join(rng.choice("ab  .-") for _ in range(rng.randrange(0, 30)))
        part = [c in "ab" for c in text]
        want = [False] * len(text)
        at = [i for i, p in enumerate(part) if p]
        alone = {i for i in at if not (i and part[i - 1]) and not (i + 1 < len(text) and part[i + 1])}
        for x, y, z in zip(at, at[1:], at[2:]):
            one, two = text[x + 1:y], text[y + 1:z]
            if {x, y, z} <= alone and len(one) == len(two) and (len(one) == 1 or len(one) <= 3 and one == two):
                want[x:z + 1] = [True] * (z + 1 - x)
        got = toxicity.spelled_out(toxicity.code_points(text), np.array(part, dtype=bool))
        assert got.tolist() == want


def test_clean_texts_stay():
    model = model_of(WORDS).tolist()
    for text in ("Éin schöner Tag, ñu", "call +1 (555) 010-2345 now", "mail x.y@mail6.example.com", "", " \n", "日本語"):
        want = "".join(chr(c) for c in toxicity.tables()[0][toxicity.code_points(text)])
        assert toxicity.restored_text(text, model, {}).split() == want.split()


def test_viterbi_finds_the_best_path():
    model = model_of(WORDS)
    rng = random.Random(3)

    def score(reading):
        s = [0, 0] + [0 if c == " " else ord(c) - 96 for c in reading] + [0]
        return sum(model[a][b][c] for a, b, c in zip(s, s[1:], s[2:]))

    for _ in range(50):
        span = "".join(rng.choice("1d60tals") for _ in range(6))
        span = span if not any(a == b for a, b in zip(span, span[1:])) else "1d10t"
        readings = [("", 0.0)]
        for c in span:
            own = [(r, toxicity.READ - np.log(len(toxicity.READINGS[c]))) for r in toxicity.READINGS.get(c, "")] or [(c, 0.0)]
            readings = [(a + b, x + y) for a, x in readings for b, y in own]
        best = max(readings, key=lambda r: r[1] + score(r[0]))
        got = toxicity.restore(span, model.tolist())
        if got.isalpha():
            assert got == best[0]


def toxic_table(spark):
    rng = random.Random(1)
    plain = ["walk", "river", "stone", "green", "house", "table", "morning", "paper", "garden", "window"]
    bad = ["idiot", "loser", "trash", "stupid", "clown"]
    disguised = ["1d10t", "l0s3r", "tr@sh", "s.t.u.p.i.d", "cl0wn", "stuuupid"]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 4 == 0
        words = [rng.choice(plain) + rng.choice(["", "s", "ed", "ing"]) for _ in range(30)]
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(30), rng.choice(disguised if i % 8 == 4 and i > 600 else bad))
        rows.append((i, " ".join(words)))
        if i < 600:
            labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_and_disguised_texts(spark):
    docs, labels = toxic_table(spark)
    detector = toxicity.fit_detector(docs, "doc_id", "text", labels, "toxic", F.lit(True))
    rows = toxicity.with_toxicity(docs, "text", detector).collect()
    wrong = [r["doc_id"] for r in rows if r["predicted"] != int(r["doc_id"] % 4 == 0)]
    assert len(wrong) <= 9 and all(0 <= r["score"] <= 1 for r in rows)


def test_detector_against_a_plain_version(spark):
    docs, labels = toxic_table(spark)
    detector = toxicity.fit_detector(docs, "doc_id", "text", labels, "toxic", F.lit(True))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    symbol, counts = toxicity.tables()[1], np.zeros((28, 28, 28))
    stream = [0, 0] + [int(x) for t in texts.values() for x in [*(symbol[ord(c)] for c in t), 0, 0]]
    for gram in zip(stream, stream[1:], stream[2:]):
        counts[gram] += 1
    for parts in (1, 7):
        assert np.array_equal(toxicity.trigram_counts(docs.repartition(parts), "text"), counts)

    lists = toxicity.language_model(counts).tolist()
    clear = {k: toxicity.restored_text(t, lists, {}) for k, t in texts.items()}
    fits = {r["doc_id"]: r["fits"] for r in labels.select("doc_id", (F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(3)) == 0).alias("fits")).collect()}
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows, found, bits = {0: 0, 1: 0}, {0: {}, 1: {}}, {}
    for k in toxic:
        if fits[k]:
            continue
        rows[toxic[k]] += 1
        words = clear[k].split()
        for i, word in enumerate(words):
            before = toxicity._word_hash(words[i - 1]) if i else 0
            after = toxicity._word_hash(words[i + 1]) if i + 1 < len(words) else 0
            bit = ((before * 31 + after) * 0x9E3779B97F4A7C15 >> 40) & 63
            for mark in [f" {word} "] + [f" {word[:n]}" for n in (3, 4, 5, 6, 7) if n < len(word)]:
                found[toxic[k]].setdefault(mark, set()).add(k)
                if toxic[k]:
                    bits.setdefault(mark, set()).add(bit)
    want = {}
    for mark, holders in found[1].items():
        if len(holders) >= 3 and len(bits[mark]) >= 3:
            pos = min(len(holders), 64 * np.log(64 / max(64 - len(bits[mark]), 0.5)))
            neg = len(found[0].get(mark, ()))
            weight = np.log((pos + 0.5) / (rows[1] + 1)) - np.log((neg + 0.5) / (rows[0] + 1)) - (1 / (pos + 0.5) + 1 / (neg + 0.5)) ** 0.5
            if weight > 1:
                want[mark] = weight
    assert want and detector.marks == pytest.approx(want)

    def features(text):
        text = f" {text} "
        best = {i: max((w for m, w in want.items() if text.startswith(m, i)), default=0) for i in range(len(text))}
        held = sorted((w for w in best.values() if w), reverse=True)
        top, total, words = (held + [0, 0])[:2], sum(held), len(text.split())
        return [1, *top, np.log1p(total), np.log1p(words), 10 * total / (words + 20)]

    x = np.array([features(clear[k]) for k in toxic if fits[k]])
    weights = toxicity.logistic_weights(x, np.array([toxic[k] for k in toxic if fits[k]], dtype=float))
    scores = {k: 1 / (1 + np.exp(-np.array(features(t)) @ weights)) for k, t in clear.items()}
    got = {r["doc_id"]: r["score"] for r in toxicity.with_toxicity(docs, "text", detector).collect()}
    assert got == pytest.approx(scores, abs=1e-6)


def test_rare_marks_beside_many_common_words(spark):
    rng = random.Random(3)
    common = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(12_000)]
    rows, labels = [], []
    for i in range(60):
        words = rng.sample(common, len(common))
        if i % 4 == 0:
            words.insert(rng.randrange(len(words)), "zzyqwort")
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 2 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    marks = toxicity.fit_detector(docs, "doc_id", "text", labels, "toxic", F.lit(True)).marks
    assert " zzyqwort " in marks and not any(f" {w} " in marks for w in common)


def test_toxicity_of_awkward_rows(spark, edge, empty):
    docs, labels = toxic_table(spark)
    detector = toxicity.fit_detector(docs, "doc_id", "text", labels, "toxic", F.lit(True))
    out = toxicity.with_toxicity(edge, "text", detector)
    rows = out.collect()
    assert len(rows) == edge.count() and out.columns.count("score") == 1 and {r["predicted"] for r in rows} == {0}
    by = {}
    for r in rows:
        assert by.setdefault(r["text"] or "", r["score"]) == r["score"]
    assert toxicity.with_toxicity(empty, "text", detector).count() == 0
    none = toxicity.fit_detector(empty, "doc_id", "text", labels, "toxic", F.lit(True))
    assert none.score("idiot") < 0.01
    one_kind = toxicity.fit_detector(docs, "doc_id", "text", labels.where("toxic = 0"), "toxic", F.lit(True))
    assert one_kind.score("idiot") < 0.01


def test_toxicity_query(spark, sf_dir):
    import zlib

    rows = QUERIES["op1_deobfuscated_toxicity"](spark, sf_dir).collect()
    assert len(rows) == 200
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)


# ------------------------------------------------------------------ 4

@pytest.mark.parametrize("html, text", [
    ("", ""), ("plain  text\n here", "plain text here"),
    ("<p>One<p>Two<br>lines", "One\n\nTwo\nlines"),
    ("<div>a</div><div>b <b> c</b></div>", "a\nb c"),
    ("<head><title>no</title></head><body>yes<script>x()</script><style>y{}</style></body>", "yes"),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>end", "- a\n- b\n  - c\n\nend"),
    ("<ol start=3><li>x<li value=9>y<li>z</ol>", "3. x\n9. y\n10. z"),
    ("<ol reversed><li>x<li>y</ol>", "2. x\n1. y"),
    ("<table><tr><th>Name<th>N<tr><td>ab<td>1<tr><td>longer<td>22</table>", "Name    N\nab      1\nlonger  22"),
    ("<table><caption>C</caption><tr><td colspan=2>wide<td>z<tr><td>a<td>b<td>c</table>", "C\nwide  z\na  b  c"),
    ("<table><tr><td rowspan=2>r<td>1<tr><td>2</table>", "r  1\n   2"),
    ("<p hidden>no</p><p style='display: none'>no</p><p style='visibility:hidden'>no<b style='visibility:visible'>yes</b></p>", "yes"),
    ("<pre>\n a\n  b</pre>", "a\n  b"), ("a&nbsp;&amp;&lt;b", "a\xa0&<b"),
    ("<blockquote>q</blockquote>after", "  q\n\nafter".strip("\n")),
    ("<details><summary>s</summary>hid</details><details open><summary>t</summary>shown</details>", "s\nt\nshown"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    ("<select><option>a<option selected>b</select><input type=hidden value=h><input value=v><textarea>k</textarea>", "bvk"),
    ("<b>x<p>y</b>z</p></div></span>w", "x\n\nyz\n\nw"), ("<table>lost<tr><td>c</table>", "lost\n\nc"), ("<!-- c --><![foo]>t<!doctype html>", "t"),
])
def test_layout(html, text):
    assert layout_text.rendered(html).lstrip() == text.lstrip()


@pytest.mark.parametrize("html, text", [
    ("<svg><title>no</title><defs><text>no</text></defs><g><text>Q1 <tspan>sales</tspan></text><text>Q2</text></g></svg>", "Q1 sales\nQ2"),
    ("<svg/>rest", "rest"), ("a <math/> rest", "a rest"), ("<p>a<svg><path d='x'/><circle/></svg> b</p><p>c", "a b\n\nc"),
    ("<p>let <math> <mi>x</mi> <mo>=</mo> <mn>1</mn> <annotation>no</annotation></math> be", "let x=1 be"),
    ("<math><mfrac><mn>1</mn><mn>2</mn></mfrac></math>", "1 2"),
    ("<svg><g><div>one</div>two<p>three", "one\ntwo\n\nthree"), ("<math><mi>x<p>y</p>z", "x\n\ny\n\nz"),
    ("<div><svg><g></div>after", "after"), ("<p>a<svg><foreignObject><p>in</p></foreignObject></svg>b", "a\nin\n\nb"),
    ("<svg><foreignObject><div>in</svg>out", "in\nout"), ("<svg><text><![CDATA[a > b]]></text></svg>", "a > b"),
    ("<svg display=none><text>no</text></svg><svg><text visibility=hidden>no</text></svg>yes", "yes"),
])
def test_foreign_content(html, text):
    got = [line for line in layout_text.rendered(html).split("\n") if line]
    assert got == [line for line in text.split("\n") if line]


def test_deep_and_broken_markup():
    deep = "<div>" * 5000 + "x" + "<table><tr><td>" * 300 + "y"
    assert layout_text.rendered(deep).split() == ["x", "y"]
    rng = random.Random(5)
    pieces = ["<p>", "</p>", "<table>", "<tr>", "<td>", "</td>", "</table>", "<li>", "<ul>", "</ul>", "<b>", "</i>", "<![", "<!--", "-->", "&", "<", "w"]
    for _ in range(300):
        words = [f"w{i}" for i in range(8)]
        html = " ".join(rng.choice(pieces[:12]) + w for w in words) + " " + rng.choice(pieces)
        assert sorted(x for x in layout_text.rendered(html).split() if x in words) == words


def test_layout_of_awkward_rows(spark, edge, empty, sf_dir):
    out = layout_text.with_layout_text(edge, "text", "text")
    assert out.count() == edge.count() and out.columns.count("text") == 1
    assert layout_text.with_layout_text(empty, "text").count() == 0
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    rows = {r["page_id"]: r["text"] for r in QUERIES["op4_layout_text"](spark, sf_dir).collect()}
    assert len(rows) == len(pages) and all(rows[p["page_id"]] == layout_text.rendered(p["html"]) for p in pages)
    assert all("<p>" not in t and "track(" not in t for t in rows.values())


# ------------------------------------------------------------------ 6

def test_top_k_query_equals_sql(spark, sf_dir):
    got = QUERIES["op6_exact_top_k"](spark, sf_dir).toPandas()
    assert canonical(got) == canonical(connect(sf_dir).execute(ORACLES["op6_exact_top_k"]).df())


@pytest.mark.parametrize("at_a_time, block", [(1000, 1000), (3, 7)])
def test_top_k_against_brute_force(spark, monkeypatch, at_a_time, block):
    monkeypatch.setattr(topk_search, "QUERIES_AT_A_TIME", at_a_time)
    monkeypatch.setattr(topk_search, "BLOCK", block)
    rng = random.Random(2)
    vectors = {i: [rng.choice([0, 0, 0, -2, 1, 3]) for _ in range(rng.choice([0, 3, 6]))] for i in range(80)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, v array<long>")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in
           topk_search.top_k(df, "vec_id", "v", F.col("vec_id") % 8 == 0, 5).collect()}
    for q in range(0, 80, 8):
        scored = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)[:5]
        for rank, (score, i) in enumerate(scored, 1):
            assert got.pop((q, rank)) == (i, -score)
    assert not got


def test_top_k_of_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -0.001]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (5, [0.5, 0.5]), (5, [0.5, 0.5]),
            (6, []), (None, [1.0, 1.0]), (7, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", topk_search.quantized(F.col("embedding")))
    got = topk_search.top_k(df, "vec_id", "v", F.col("vec_id") == 0, 5).orderBy("rank").collect()
    score = 256 * 128 - 1 * 128
    assert [(r["vec_id"], r["score"]) for r in got] == [(5, score), (5, score), (7, score), (6, 0)]
    assert topk_search.top_k(df.where("false"), "vec_id", "v", F.col("vec_id") == 0, 5).count() == 0


# ------------------------------------------------------------------ 10

def test_kmers_and_occurrences():
    for k in (1, 2, 3, 5, 8):
        text = "abcabcabcabcabdé🙂x"
        h = order_minhash.kmer_hashes(text, k)
        grams = [text[i:i + k] for i in range(len(text) - k + 1)]
        assert len(h) == len(grams) and len(set(h.tolist())) == len(set(grams))
        assert len({(g, x) for g, x in zip(grams, h.tolist())}) == len(set(grams))
    numbered = order_minhash.occurrence_hashes(order_minhash.kmer_hashes("abababab", 2))
    assert len(set(numbered.tolist())) == 7


def test_signature_by_its_definition():
    rng = random.Random(9)
    for n in (1, 5, 9, 40, 300, 9000):
        text = "".join(rng.choice("abcd e") for _ in range(n))
        kmers = order_minhash.kmer_hashes(text)
        numbered = order_minhash.occurrence_hashes(kmers)
        ring = sorted((int(v), i) for i, v in enumerate(numbered.tolist()))
        got = order_minhash.signature(text)
        for cell in range(order_minhash.CELLS):
            start = cell << (64 - order_minhash.CELLS_LOG2)
            later = [i for v, i in ring if v >= start] + [i for v, i in ring if v < start]
            entry = np.zeros(1, np.uint64)
            with np.errstate(over="ignore"):
                for i in sorted(later[:order_minhash.TUPLE]):
                    entry = order_minhash.mixed(entry * order_minhash.BASE + kmers[i:i + 1])
            assert got[cell] == int(entry[0]) >> 48


def test_order_counts():
    rng = random.Random(4)
    parts = ["".join(rng.choice("abcdefghij ") for _ in range(400)) for _ in range(6)]
    a, b = "".join(parts), "".join(reversed(parts))
    near = a[:1200] + "x" + a[1200:]
    s = order_minhash.signature
    assert order_minhash.likeness(s(a), s(near)) > 0.9
    assert order_minhash.likeness(s(a), s(b)) < 0.75
    assert order_minhash.likeness(s(a), s("".join(rng.choice("klmnop ") for _ in range(2400)))) == 0


def neighbours(rows):
    ordered = sorted(rows, key=lambda r: r[1] or "")
    return sorted(ordered, key=lambda r: (r[0] is None, -(r[0] or 0)))


def check_order(df, rows):
    ordered = neighbours([(r["doc_id"], r["text"]) for r in df.collect()])
    want = []
    for i, (k, t) in enumerate(ordered):
        text, after = t or "", ordered[(i + 1) % len(ordered)][1] or ""
        edited = order_minhash.edited_text(text, after)
        own, changed = order_minhash.signature(text), order_minhash.signature(edited)
        want.append((k, len(text), hashlib.sha256(edited.encode()).hexdigest(), own.tobytes().hex(), changed.tobytes().hex(),
                     order_minhash.likeness(own, changed), order_minhash.likeness(own, order_minhash.signature(after))))
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))


def test_order_query_against_a_plain_version(spark, sf_dir, documents):
    check_order(documents, QUERIES["op10_order_minhash"](spark, sf_dir).collect())


def test_order_of_awkward_rows(edge, empty, spark):
    check_order(edge, order_minhash.order_minhash(edge, "doc_id", "text").collect())
    one = spark.createDataFrame([(4, "abc")], "doc_id long, text string")
    check_order(one, order_minhash.order_minhash(one, "doc_id", "text").collect())
    assert order_minhash.order_minhash(empty, "doc_id", "text").count() == 0
