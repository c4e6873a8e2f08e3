"""Operators 3, 8 and 9."""

import collections
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from finchlake.llm import hypershuffle, mixture, packing
from finchlake.llm.queries import QUERIES


def test_matrix_has_exact_margins_and_the_right_distribution():
    rng = random.Random(4)
    for seed in range(20):
        blocks = [rng.randrange(0, 50) for _ in range(9)]
        shards = hypershuffle.even_sizes(sum(blocks), 5)
        matrix = hypershuffle.communication_matrix(blocks, shards, seed)
        assert [sum(r) for r in matrix] == blocks
        assert [sum(c) for c in zip(*matrix)] == shards
    draws = np.random.default_rng(1)
    ours = [hypershuffle.draw_hypergeometric(draws, 7, 13, 6) for _ in range(20_000)]
    theirs = np.random.default_rng(2).hypergeometric(7, 13, 6, 20_000)
    for k in range(7):
        assert abs(ours.count(k) - int((theirs == k).sum())) < 500
    big = [hypershuffle.draw_hypergeometric(draws, 10**11, 10**11, 10**6) for _ in range(50)]
    assert abs(np.mean(big) - 5e5) < 500


def slots_are_gapless(rows):
    by = collections.defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    return all(sorted(v) == list(range(len(v))) for v in by.values())


def test_shuffle_of_awkward_rows(edge, empty):
    out = hypershuffle.hypergeometric_shuffle(edge, ["doc_id"], 4)
    rows = out.collect()
    assert len(rows) == edge.count() and out.columns.count("shard") == 1
    assert sorted(collections.Counter(r["shard"] for r in rows).values()) == [2, 3, 3, 3]
    assert slots_are_gapless(rows)
    assert sorted(map(repr, (r["text"] for r in rows))) == sorted(map(repr, (r["text"] for r in edge.collect())))
    assert hypershuffle.hypergeometric_shuffle(empty, ["doc_id"], 4).count() == 0


def test_shuffle_query_is_exact_and_repeats(spark, sf_dir, documents):
    first, again = (sorted(map(tuple, QUERIES["op3_hypergeometric_shuffle"](spark, sf_dir).collect())) for _ in range(2))
    assert first == again
    rows = QUERIES["op3_hypergeometric_shuffle"](spark, sf_dir).collect()
    sizes = collections.Counter(r["shard"] for r in rows)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1 and slots_are_gapless(rows)
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in documents.collect()}
    assert all(r["size"] == len(texts[r["doc_id"]]) + 8 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]]) for r in rows)
    # Neighbours of the input are not neighbours of the output.
    near = sum(1 for a in rows for b in rows if a["shard"] == b["shard"] and b["slot"] == a["slot"] + 1 and abs(a["doc_id"] - b["doc_id"]) == 1)
    assert near < 12


def test_shuffle_query_against_a_plain_version(spark, sf_dir, documents):
    got = {r["doc_id"]: (r["shard"], r["slot"]) for r in QUERIES["op3_hypergeometric_shuffle"](spark, sf_dir).collect()}
    seed = 20_011
    rows = documents.select("doc_id", *[F.xxhash64(F.lit(seed + i), "doc_id").alias(f"h{i}") for i in range(3)]).collect()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = [sorted((r["h1"], r["h2"], r["doc_id"]) for r in rows if r["h0"] % n == b) for b in range(n)]
    matrix = hypershuffle.communication_matrix([len(b) for b in blocks], hypershuffle.even_sizes(len(rows), 24), seed)
    shards = collections.defaultdict(list)
    for block, dealt in zip(blocks, matrix):
        at = 0
        for shard, count in enumerate(dealt):
            shards[shard] += [(second % n, second, first, key) for first, second, key in block[at:at + count]]
            at += count
    assert got == {key: (s, slot) for s, held in shards.items() for slot, (*_, key) in enumerate(sorted(held))}


def test_targets_by_hand():
    shares = mixture.share_targets({"b": 100, "a": 10, None: 50}, (5.0, 2.0, 1.0), 240.0, 2)
    assert [(s.source, s.target) for s in shares] == [("a", 20.0), ("b", pytest.approx(440 / 3)), (None, pytest.approx(220 / 3))]
    assert mixture.share_targets({}, (1.0,), 0.0, 2) == []
    assert [s.target for s in mixture.share_targets({"a": 0, "b": 4}, (5.0, 2.0), 6.0, 2)] == [0.0, 6.0]


def test_mixture_against_a_plain_version(spark, sf_dir):
    rows = QUERIES["op8_mixture"](spark, sf_dir).collect()
    again = QUERIES["op8_mixture"](spark, sf_dir).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    texts = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in rows:
        doc = texts[r["doc_id"]]
        assert r["size"] == len([w for w in (doc["text"] or "").replace("\xa0", "x").split()])
        assert 0 <= r["taken"] <= 2 * r["size"]
        sizes[doc["source"]] += r["size"]
        taken[doc["source"]] += r["taken"]
        target[doc["source"]] = r["target"]
    assert len(rows) == len(texts) and all(r["source_size"] == sizes[texts[r["doc_id"]]["source"]] for r in rows)
    plain = mixture.share_targets(dict(sizes), mixture.WEIGHTS, 1.5 * sum(sizes.values()), 2)
    assert {s.source: s.target for s in plain} == target
    assert all(abs(taken[s] - target[s]) <= max(20, 0.01 * target[s]) for s in target)


def test_mixture_query_against_a_plain_schedule(spark, sf_dir):
    got = {r["doc_id"]: (r["size"], r["taken"]) for r in QUERIES["op8_mixture"](spark, sf_dir).collect()}
    cells = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", "source", "text", F.pmod(F.xxhash64(F.lit(8_191), "doc_id"), F.lit(cells)).alias("cell"),
        F.xxhash64(F.lit(8_192), "doc_id").alias("shuffled")).collect()
    size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in docs}
    words = collections.defaultdict(list)   # of every source, each named by its document, in shuffled order
    for r in sorted(docs, key=lambda r: (r["cell"], r["shuffled"])):
        words[r["source"]] += [r["doc_id"]] * size[r["doc_id"]]
    total = 1.5 * sum(size.values())
    shares = mixture.share_targets({s: len(w) for s, w in words.items()}, (5.0, 2.0, 1.0), total, 2)
    most = max(1, min(512, int(total // 200_000)))
    blocks = []
    for share in shares:
        stream, count = words[share.source], -(-share.size // max(1, min(most, int(share.target // 64))))
        each, longer = divmod(len(stream), count)
        starts = [i * each + min(i, longer) for i in range(count + 1)]
        blocks.append([stream[a:b] for a, b in zip(starts, starts[1:])])
    counts = [round(s.target * len(b) / s.size) for s, b in zip(shares, blocks)]
    points = sorted((slot * 1327217885 % 2**31, slot) for slot in range(sum(counts)))
    taken, first = collections.Counter(), 0
    for own, count in zip(blocks, counts):
        slots = sorted(slot for _, slot in points[first:first + count])
        first += count
        for rank, _ in enumerate(slots):
            taken.update(own[rank % len(own)])
    assert got == {k: (n, taken[k]) for k, n in size.items()}


def test_points_are_counted_exactly():
    for counts in ([3], [1, 0, 5, 2, 900], [0, 0], [7] * 40, [1, 100_000, 1]):
        ends = mixture.slot_ends(counts)
        points = [s * mixture.STEP % mixture.CYCLE for s in range(sum(counts))]
        got = collections.Counter(sum(e <= p for e in ends) for p in points)
        assert [got[i] for i in range(len(counts))] == counts


@pytest.mark.parametrize("block", [512, 7, 1])
def test_small_sources_beside_a_huge_one_come_near_their_targets(spark, block):
    sizes = {f"s{i:02}": n for i, n in enumerate((1, 5, 100, 200, 511, 512, 513, 600, 1025, 1_500_000))}
    rows = [(i, s, n) for i, (s, n) in enumerate(sizes.items()) if n < 2_000]
    rows += [(100 + i, "s09", 1_500) for i in range(1_000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n long")
    mix = mixture.Mixture(df, "doc_id", "source", F.col("n"), block=block)
    taken, target, size = collections.Counter(), {}, {}
    for r in mix.usage().collect():
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]], size[r["source"]] = r["target"], r["source_size"]
    assert size == sizes
    assert all(abs(taken[s] - target[s]) <= max(1, target[s] / 64) for s in target)


def test_mixture_of_awkward_rows(edge, empty):
    mix = mixture.Mixture(edge, "doc_id", "source", mixture.words(F.col("text")), block=2)
    rows = mix.usage().collect()
    assert len(rows) == edge.count() and mix.usage().columns.count("size") == 1
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    assert {r["taken"] for r in rows if not r["text"]} == {0}
    docs = mix.documents("text").collect()
    words = {(r["doc_id"], r["source"]): len(r["text"].split()) for r in docs}
    assert words and all(n > 0 for n in words.values())
    total = sum(len(r["text"].replace("\xa0", "x").split()) for r in docs)
    assert total == sum(r["taken"] for r in rows)
    none = mixture.Mixture(empty, "doc_id", "source", mixture.words(F.col("text")))
    assert none.usage().count() == 0 and none.documents("text").count() == 0


def placed_pieces(plan, capacity):
    used = collections.defaultdict(list)
    ranks = collections.defaultdict(list)
    for length, rank, n, first, offset in plan:
        for i in range(n):
            used[first + i].append((offset, length))
            ranks[length].append(rank + i)
    for pieces in used.values():
        pieces.sort()
        assert pieces[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(pieces, pieces[1:]))
        assert pieces[-1][0] + pieces[-1][1] <= capacity
    return used, ranks


def test_plan_places_every_piece_once_and_tightly():
    rng = random.Random(7)
    for capacity in (1, 7, 64, 500):
        for _ in range(10):
            counts = {n: rng.randrange(1, 400) for n in rng.sample(range(1, capacity + 1), rng.randrange(1, min(capacity, 40) + 1))}
            used, ranks = placed_pieces(packing.plan_best_fit(counts, capacity), capacity)
            assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
            # Best fit decreasing, piece by piece, as the plain version.
            rooms = []
            for n in sorted(counts, reverse=True):
                for _ in range(counts[n]):
                    fit = min((r for r in rooms if r >= n), default=None)
                    if fit is not None:
                        rooms.remove(fit)
                    rooms.append((capacity if fit is None else fit) - n)
            assert len(used) == len(rooms)
    assert packing.plan_best_fit({}, 10) == []
    with pytest.raises(ValueError):
        packing.plan_best_fit({11: 1}, 10)
    assert len(packing.plan_best_fit({3: 10**12, 2048: 10**12}, 2048)) < 2 * 2048


def test_packing_query_against_the_tokenizer(spark, sf_dir, documents):
    rows = {(r["doc_id"], r["piece"]): r for r in QUERIES["op9_histogram_packing"](spark, sf_dir).collect()}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    seen = 0
    for doc in documents.collect():
        ids = tokenizer.encode(doc["text"] or "", add_special_tokens=False).ids + [0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part, r = np.array(ids[at:at + 2048], dtype="<u4"), rows[doc["doc_id"], piece]
            assert (r["start"], r["length"], r["ids_crc32"]) == (at, len(part), zlib.crc32(part.tobytes()))
            seen += 1
    assert seen == len(rows)
    used = collections.defaultdict(list)
    for r in rows.values():
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in used.values():
        pieces.sort()
        assert pieces[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(pieces, pieces[1:])) and sum(n for _, n in pieces) <= 2048


def test_packing_of_awkward_rows(edge, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.token_pieces(edge, "doc_id", "text", path, 0, 100)
    out = packing.place(pieces.drop("ids"), "length", 100, ["key", "piece", "ids_crc32"]).collect()
    assert len(out) == pieces.count() and sum(r["length"] == 1 for r in out) >= 4
    places = [(r["sequence_id"], r["offset"]) for r in out]
    assert len(set(places)) == len(places)
    none = packing.token_pieces(empty, "doc_id", "text", path, 0, 100).drop("ids")
    assert packing.place(none, "length", 100, ["key", "piece"]).count() == 0


def test_sequences_hold_the_tokens(edge, empty, spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    pieces = packing.token_pieces(edge, "doc_id", "text", path, 0, 100)
    packed = packing.sequences(packing.place(pieces, "length", 100, ["key", "piece", "ids_crc32"]), ["key", "piece"])
    texts, rows = collections.Counter(), packed.collect()
    for r in rows:
        assert 0 < len(r["ids"]) <= 400 and sum(4 * p["length"] for p in r["pieces"]) == len(r["ids"])
    for r in packing.pieces_of(packed).collect():
        texts[r["key"], r["piece"], bytes(r["ids"])] += 1
    want = collections.Counter()
    for r in edge.collect():
        ids = np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0], dtype="<u4")
        for piece, at in enumerate(range(0, len(ids), 100)):
            want[r["doc_id"], piece, ids[at:at + 100].tobytes()] += 1
    assert texts == want
    none = packing.token_pieces(empty, "doc_id", "text", path, 0, 100)
    assert packing.sequences(packing.place(none, "length", 100, ["key", "piece"]), ["key"]).count() == 0


def test_narrow_ids(spark):
    ids = np.array([0, 7, 65_535], dtype="<u4").tobytes()
    assert packing.narrowed(ids, 4) == ids and np.frombuffer(packing.narrowed(ids, 2), "<u2").tolist() == [0, 7, 65_535]
    with pytest.raises(ValueError):
        packing.narrowed(np.array([65_536], dtype="<u4").tobytes(), 2)
    df = spark.createDataFrame([(bytearray(packing.narrowed(ids, 2)),), (bytearray(),)], "ids binary")
    assert [r[0] for r in df.select(packing.crc32_of(F.col("ids"), 2)).collect()] == [zlib.crc32(ids), 0]


def test_pipeline_keeps_the_tokens(spark, edge):
    docs = edge.select("doc_id", "text")
    rows = corpus_pipeline.packing(spark, docs, "").collect()
    assert rows and all(len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"] for r in rows)
