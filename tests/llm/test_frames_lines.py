"""Operators 2 and 7."""

import io
import random

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from check import canonical, connect
from finchlake.llm import frames, line_runs, tokenizing
from finchlake.llm.queries import ORACLES, QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def written_file(docs, frame_bytes):
    out = io.BytesIO()
    writer = frames.FrameWriter(out, frame_bytes)
    for key, ids in docs:
        writer.add(key, np.array(ids, "<u4").tobytes())
    writer.close()
    return out.getvalue()


def test_file_format():
    docs = [(i, list(range(i, i + 40))) for i in range(100)] + [(200, list(range(5000)))]
    data = written_file(docs, 1600)
    stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert np.frombuffer(stream, "<u4").tolist() == [x for _, ids in docs for x in ids]
    reader = frames.FrameReader(io.BytesIO(data))
    assert [(k, np.frombuffer(b, "<u4").tolist()) for k, _, b in reader.read()] == docs
    some = frames.FrameReader(io.BytesIO(data))
    found = list(some.read({3, 4, 99}))
    assert [k for k, _, _ in found] == [3, 4, 99] and found[2][1] == 99 * 40 and some.frames_read == 2
    hurt = bytearray(data)
    hurt[-12] ^= 1
    with pytest.raises(ValueError):
        list(frames.FrameReader(io.BytesIO(bytes(hurt))).read())
    assert list(frames.FrameReader(io.BytesIO(written_file([], 10))).read()) == []


@pytest.mark.parametrize("name, drops", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_pieces_give_the_ids_of_whole_texts(name, drops, documents, monkeypatch):
    monkeypatch.setattr(tokenizing, "PIECES_KEPT", 500)
    encode = tokenizing.PieceEncoder(public_tokenizers.path(name), drops)
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    texts = [r["text"] or "" for r in documents.collect()] + [
        "", " ", "  \n\n a  b\t.", "a.b, c.", "é. à,, .,", "don't. they've,", "q́, <|endoftext|>. ", "x\x1cy\xa0 z　.", "日本語。テスト.", "ﬁ①. Ⅷ,"]
    rng = random.Random(6)
    texts += ["".join(rng.choice("aB é.,1' \n\n  \t\xa0\r\0") for _ in range(rng.randrange(12))) for _ in range(3000)]
    scripts = [(0x20, 0x250), (0x370, 0x530), (0x590, 0x700), (0x900, 0xE00), (0x1E00, 0x2100), (0x3040, 0x3100),
               (0xAC00, 0xAD00), (0xFB00, 0xFB50), (0x1F600, 0x1F650)]
    signs = [chr(c) for a, b in scripts for c in range(a, b)]
    parts = [" ", " ", "\n", ".", ",", "the", "The ", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "\u0301", "İ."]
    texts += ["".join(rng.choice(parts if rng.random() < 0.4 else signs) for _ in range(rng.randrange(16))) for _ in range(20_000)]
    texts += [c + sign + c for sign in ".," for c in map(chr, range(0x110000)) if c.isalpha() and not "\u4e00" < c < "\u9fff"
              and not "\U00017000" < c]
    wanted = tokenizer.encode_batch(texts, add_special_tokens=False)
    for text, want in zip(texts, wanted):
        assert encode.ids(text) == np.array(want.ids, "<u4").tobytes(), repr(text)


def test_frames_query_against_the_tokenizer(spark, sf_dir, documents):
    import zlib

    rows = {r["doc_id"]: r for r in QUERIES["op2_token_frames"](spark, sf_dir).collect()}
    tokenizer, start = Tokenizer.from_file(PATH), 0
    for doc in sorted(documents.collect(), key=lambda r: r["doc_id"]):
        ids = tokenizer.encode(doc["text"] or "", add_special_tokens=False).ids + [2]
        r = rows.pop(doc["doc_id"])
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not rows


def test_frames_of_awkward_rows(spark, edge, empty):
    manifest = frames.write_token_frames(edge, "doc_id", "text", PATH, 2, parts=3, frame_bytes=64)
    rows = frames.read_token_frames(manifest, "doc_id").orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, None, 1, 2, 3, 4, 5, 6, 6, 7, 8]
    assert [len(r["ids"]) for r in rows if r["doc_id"] in (2, 3)] == [4, 4]
    path = max(manifest.collect(), key=lambda r: r["n_docs"])["path"]
    keys = {r["doc_id"] for r in rows if r["doc_id"] is not None}
    found, read = frames.read_documents(path, list(keys)[:1])
    assert len(found) <= 1 and read <= 1
    assert frames.read_token_frames(frames.write_token_frames(empty, "doc_id", "text", PATH, 2)).count() == 0


def test_lines_query_equals_sql(spark, sf_dir):
    got = QUERIES["op7_line_runs"](spark, sf_dir).toPandas()
    assert canonical(got) == canonical(connect(sf_dir).execute(ORACLES["op7_line_runs"]).df())


def plain_lines(rows, limit):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate({65 + i: 97 + i for i in range(26)})

    split = [(r["text"] or "").split("\n") for r in rows]
    count = {}
    for lines in split:
        for k in {key(x) for x in lines}:
            count[k] = count.get(k, 0) + 1
    return [("\n".join(x for x in lines if not key(x) or count[key(x)] < limit), len(lines),
             sum(bool(key(x)) and count[key(x)] >= limit for x in lines)) for lines in split]


@pytest.mark.parametrize("batches, fan", [(1, 2), (5, 2), (7, 3)])
def test_runs_in_many_batches(spark, batches, fan):
    rows = [(i, "\n".join(f"Line {i % m}" for m in (2, 3, 50) for _ in range(2)) + "\n \n" + f"own {i}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_runs.drop_repeated_lines(df, "text", limit=10, batches=batches, fan=fan).orderBy("doc_id").collect()
    assert [(r["text"], r["n_lines"], r["n_dropped"]) for r in got] == plain_lines(df.orderBy("doc_id").collect(), 10)


def test_lines_of_awkward_rows(edge, empty):
    got = line_runs.drop_repeated_lines(edge, "text", limit=2)
    assert got.columns.count("text") == 1
    want = sorted(plain_lines(edge.collect(), 2), key=repr)
    assert sorted(((r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()), key=repr) == want
    assert line_runs.drop_repeated_lines(empty, "text").count() == 0


def test_unsettled_lines_only(spark):
    runs = line_runs.LineRuns(spark, limit=3, fan=2)
    batch = spark.createDataFrame([(b"a", 2), (b"b", 1)], "h binary, n long")
    runs.add(batch)
    runs.add(batch)
    assert [bytes(r["h"]) for r in runs.unsettled(batch).collect()] == [b"b"]
    runs.add(batch)
    runs.add(batch)
    assert sorted(bytes(r["h"]) for r in runs.frequent().collect()) == [b"a", b"b"]
