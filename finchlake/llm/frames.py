"""Operator 2: token ids in zstandard files that can be read document by document.

A file holds independent frames of whole documents, ids as little-endian unsigned 32-bit integers, so any
zstandard reader gets the plain stream of ids. Two skippable frames follow. The first lists the documents
of each frame; the last is the seek table of the public seekable format: compressed size, content size
and checksum (low 32 bits of XXH64 of the content) of every frame, and a footer at the very end.
"""

from __future__ import annotations

import posixpath
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finchlake.llm.common import column, key_ranges, range_count, shuffle_partitions, small_batches, text_or_empty
from finchlake.llm.tokenizing import encoder
from finchlake.session import fresh_path, written

# Fixed values of the public seekable zstandard format.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
HAS_CHECKSUMS = 0x80
DOCUMENTS = 0x184D2A50  # another skippable frame: the documents of each frame
FRAME_BYTES = 1 << 18
MANIFEST = "part int, path string, n_docs long, n_ids long"
NO_KEY = -(1 << 63)


class FrameWriter:
    """Write documents to an open binary stream; a frame ends once it holds ``frame_bytes``."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.out, self.frame_bytes = out, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.ids: list[bytes] = []
        self.held = 0
        self.listed: list[tuple[int, int]] = []
        self.seek: list[bytes] = []
        self.documents: list[bytes] = []
        self.n_docs = self.n_ids = 0

    def add(self, key: int, ids: bytes) -> None:
        self.ids.append(ids)
        self.listed.append((key, len(ids) // 4))
        self.held += len(ids)
        self.n_docs += 1
        self.n_ids += len(ids) // 4
        if self.held >= self.frame_bytes:
            self._end_frame()

    def _end_frame(self) -> None:
        if not self.listed:
            return
        content = b"".join(self.ids)
        packed = self.compressor.compress(content)
        self.out.write(packed)
        self.seek.append(struct.pack("<III", len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        entries = b"".join(struct.pack("<qI", k, n) for k, n in self.listed)
        self.documents.append(struct.pack("<I", len(self.listed)) + entries)
        self.ids, self.listed, self.held = [], [], 0

    def close(self) -> None:
        self._end_frame()
        listed = b"".join(self.documents)
        self.out.write(struct.pack("<II", DOCUMENTS, len(listed)) + listed)
        footer = struct.pack("<IBI", len(self.seek), HAS_CHECKSUMS, SEEKABLE)
        table = b"".join(self.seek) + footer
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)


class FrameReader:
    """Read documents from a file that can be sought; ``frames_read`` counts the frames decompressed."""

    def __init__(self, source):
        self.source, self.frames_read = source, 0
        self.decompressor = zstandard.ZstdDecompressor()
        end = source.seek(0, 2)
        n, flags, magic = struct.unpack("<IBI", self._read(end - 9, 9))
        if magic != SEEKABLE or not flags & HAS_CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        table = self._read(end - 9 - 12 * n, 12 * n)
        sizes = np.frombuffer(table, dtype="<u4").reshape(n, 3)
        self.packed, self.content, self.sums = (sizes[:, i].astype(np.int64) for i in range(3))
        self.starts = np.concatenate(([0], np.cumsum(self.packed)))
        at = int(self.starts[-1])
        magic, size = struct.unpack("<II", self._read(at, 8))
        if magic != DOCUMENTS:
            raise ValueError("the list of documents is missing")
        listed = self._read(at + 8, size)
        self.documents, at = [], 0
        for _ in range(n):
            count = struct.unpack_from("<I", listed, at)[0]
            self.documents.append(np.frombuffer(listed, dtype=[("key", "<i8"), ("n", "<u4")], count=count, offset=at + 4))
            at += 4 + 12 * count

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def frame(self, i: int) -> bytes:
        content = self.decompressor.decompress(self._read(int(self.starts[i]), int(self.packed[i])))
        if len(content) != self.content[i] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.sums[i]:
            raise ValueError(f"frame {i} does not match its checksum")
        self.frames_read += 1
        return content

    def read(self, wanted: set[int] | None = None) -> Iterator[tuple[int, int, bytes]]:
        """(key, ids before it in the file, ids) of all documents, or of the wanted keys only."""
        before = 0
        for i, docs in enumerate(self.documents):
            total = int(docs["n"].sum())
            if wanted is None or not wanted.isdisjoint(docs["key"].tolist()):
                content, at = self.frame(i), 0
                for key, n in zip(docs["key"].tolist(), docs["n"].tolist()):
                    if wanted is None or key in wanted:
                        yield key, before + at, content[4 * at:4 * (at + n)]
                    at += n
            before += total


def write_token_frames(
    df: DataFrame, key: str, text: str, tokenizer: str, end_id: int, parts: int | None = None,
    folder: str | None = None, drops_space: bool = False, frame_bytes: int = FRAME_BYTES,
) -> DataFrame:
    """Encode all documents into files in ascending order of the integer ``key``; returns the manifest.

    One file per key range, in ``folder`` (by default a new one in the shared folder). A task writes under
    a name of its own and then renames, so a repeated task leaves one whole file. A null text is empty and
    has the end id alone; null keys come first; rows with equal keys follow one another in text order. An
    empty table gives an empty manifest.
    """
    small_batches(df)
    folder = folder or fresh_path(df.sparkSession, "token-frames")
    parts = parts or range_count(df, 2 * shuffle_partitions(df))
    end = np.array([end_id], dtype="<u4").tobytes()

    def write(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer, drops_space).ids
        attempt = TaskContext.get().taskAttemptId()
        store, root = pafs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        part, out, writer, names = None, None, None, ("", "")

        def finished() -> pd.DataFrame:
            writer.close()
            out.close()
            store.move(names[0], names[1])
            row = (part, f"{folder}/{posixpath.basename(names[1])}", writer.n_docs, writer.n_ids)
            return pd.DataFrame([row], columns=["part", "path", "n_docs", "n_ids"])

        for batch in batches:
            for p, k, t in zip(batch["part"].tolist(), batch["key"].tolist(), batch["text"]):
                if p != part:
                    if writer:
                        yield finished()
                    part = p
                    names = (f"{root}/.part-{p:06d}-{attempt}", f"{root}/part-{p:06d}.zst")
                    out = store.open_output_stream(names[0])
                    writer = FrameWriter(out, frame_bytes)
                writer.add(k, encode(t) + end)
        if writer:
            yield finished()

    docs = df.select(F.coalesce(column(key).cast("long"), F.lit(NO_KEY)).alias("key"), text_or_empty(text).alias("text"))
    tasks = max(shuffle_partitions(df), parts // 2)
    ordered = key_ranges(docs, "key", parts)(docs).repartition(tasks, "part").sortWithinPartitions("part", "key", "text")
    return written(ordered.mapInPandas(write, MANIFEST), "frame-manifest")


def read_token_frames(manifest: DataFrame, key: str = "key") -> DataFrame:
    """``key``, ``start`` (ids of all documents before it in all files), ``ids`` from the files of a manifest."""

    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, base in zip(batch["path"], batch["base"].tolist()):
                store, name = pafs.FileSystem.from_uri(path)
                with store.open_input_file(name) as source:
                    rows = []
                    for k, at, ids in FrameReader(source).read():
                        rows.append((None if k == NO_KEY else k, base + at, ids))
                        if len(rows) == 512:
                            yield _frame(rows)
                            rows = []
                    yield _frame(rows)

    def _frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["key", "start", "ids"])
        return out.astype({"key": "Int64", "start": "int64"})

    # One small row per file: the running sum over them is short whatever the corpus.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))
    dealt = based.repartition(shuffle_partitions(manifest), "part")
    return dealt.mapInPandas(read, "key long, start long, ids binary").withColumnRenamed("key", key)


def read_documents(path: str, keys: Iterable[int]) -> tuple[dict[int, bytes], int]:
    """The ids of the requested documents of one file, and how many frames had to be decompressed."""
    store, name = pafs.FileSystem.from_uri(path)
    with store.open_input_file(name) as source:
        reader = FrameReader(source)
        found = {k: ids for k, _, ids in reader.read(set(keys))}
        return found, reader.frames_read
