"""Operator 9: best-fit packing planned on the histogram of lengths.

Documents are tokenized once and cut into pieces of at most one sequence. The plan works on how many
pieces there are of each length, at most as many numbers as a sequence has tokens, whatever the corpus:
best fit decreasing places all pieces of a length at a time, into ranges of sequences with equal room.
A plan entry says which ranks of a length take which sequences at which offset; pieces find theirs by
their rank among the pieces of their length.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finchlake.llm.common import column, packed, shuffle_partitions, small_batches, text_or_empty
from finchlake.llm.tokenizing import chunks, encoder
from finchlake.operators.lookup import keyed_lookup

ROWS_PER_CELL = 100_000
PIECES = "key string, piece int, start long, length int, ids binary, ids_crc32 long, task int, nth long"


def plan_best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, number, first sequence, offset): that many pieces, one per sequence on from the first.

    Lengths go from long to short. Each goes where it leaves least room; sequences with equal room are
    handled as one range, of which a length takes what it needs, sequence by sequence. The entries grow
    with the capacity, not with the pieces.
    """
    rooms: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []
    plan: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in rooms:
                rooms[room] = []
                bisect.insort(order, room)
            rooms[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit")
        while left:
            at = bisect.bisect_left(order, length)
            if at == len(order):
                opened = -(-left // (capacity // length))
                put(capacity, sequences, opened)
                sequences += opened
                continue
            room = order[at]
            first, n = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
                order.pop(at)
            each = room // length
            full = min(n, left // each)
            used = capacity - room
            if full:
                for j in range(each):
                    plan.append((length, rank, full, first, used + j * length))
                    rank += full
                left -= full * each
                put(room - each * length, first, full)
                put(room, first + full, n - full)
            else:
                for j in range(left):
                    plan.append((length, rank, 1, first, used + j * length))
                    rank += 1
                put(room - left * length, first, 1)
                put(room, first + 1, n - 1)
                left = 0
    return plan


def narrowed(ids: bytes, id_bytes: int) -> bytes:
    """Ids of 4 bytes as ids of ``id_bytes``."""
    if id_bytes == 4:
        return ids
    wide = np.frombuffer(ids, dtype="<u4")
    if wide.max(initial=0) >> (8 * id_bytes):
        raise ValueError(f"an id does not fit {id_bytes} bytes")
    return wide.astype(f"<u{id_bytes}").tobytes()


def crc32_of(ids: Column, id_bytes: int) -> Column:
    """The unsigned crc32 of ids of ``id_bytes`` bytes, taken as 4 bytes each."""
    @F.pandas_udf("long")
    def crc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([zlib.crc32(np.frombuffer(b, f"<u{id_bytes}").astype("<u4").tobytes()) for b in batch], dtype="int64")

    return crc(ids)


def token_pieces(
    df: DataFrame, key: str, text: str, tokenizer: str, end_id: int, capacity: int, drops_space: bool = True,
    id_bytes: int = 4, kept: int | None = None,
) -> DataFrame:
    """key, piece, start, length, ids, ids_crc32, task, nth: every document's ids with ``end_id``, cut at ``capacity``.

    ``key`` is the column of that name; a null text is an empty one, of which only the end id stays. ``nth``
    numbers the pieces of a length within the task that made them: write the table before it is read twice.
    ``ids`` are little-endian integers of ``id_bytes`` bytes, 2 being enough for a vocabulary of up to 65,536;
    ``ids_crc32`` is always that of 4 bytes an id. ``kept`` bounds the pieces of text that a worker remembers.
    """
    small_batches(df)
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, task = encoder(tokenizer, drops_space, kept).ids, TaskContext.get().partitionId()
        seen = Counter()
        for batch in chunks(batches):
            rows = []
            for k, t in zip(batch["key"], batch["text"]):
                ids = encode(t) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append((k, piece, at // 4, len(part) // 4, narrowed(part, id_bytes), zlib.crc32(part), task, seen[len(part)]))
                    seen[len(part)] += 1
            yield pd.DataFrame(rows, columns=["key", "piece", "start", "length", "ids", "ids_crc32", "task", "nth"])

    source = df.select(column(key).cast("string").alias("key"), text_or_empty(text).alias("text"))
    kind = df.schema[key].dataType
    return source.mapInPandas(cut, PIECES).withColumn("key", F.col("key").cast(kind))


def place(pieces: DataFrame, length: str, capacity: int, by: list[str]) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; read twice, so better a written table.

    Ranks within a length are gapless without a task that sees all pieces of a length: pieces are numbered
    within (cell, length) and shifted by the counts of earlier cells. With the columns ``task`` and ``nth`` of
    :func:`token_pieces` these are the cells and numbers, and wide rows stay where they are: the shifts, a
    number for each task and length, come to them. Otherwise cells are hashes of ``by``, which gives the order
    among pieces of a length; pieces equal in it are interchangeable. Every length must be from 1 to
    ``capacity``. An empty table gives no rows.
    """
    counts = {r["n_tokens"]: r["n"] for r in
              pieces.groupBy(column(length).cast("int").alias("n_tokens")).agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = plan_best_fit(counts, capacity)
    n_tokens = column(length).cast("int").alias("n_tokens")
    if {"task", "nth"} <= set(pieces.columns):
        cell = column("task").alias("cell")
        kept = [c for c in pieces.columns if c not in ("task", "nth")]
        rows = pieces.select(F.struct(*[column(c) for c in kept]).alias("row"), n_tokens, cell, column("nth").alias("nth"))
        sizes = pieces.select(cell, n_tokens)
    else:
        cells = max(shuffle_partitions(pieces), -(-sum(counts.values()) // ROWS_PER_CELL))
        order = [column(b) for b in by]
        cell = F.pmod(F.xxhash64(*order), F.lit(cells)).cast("int")
        rows = packed(pieces, n_tokens=column(length).cast("int"), cell=cell, by=F.struct(*order))
        rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("cell", "n_tokens").orderBy("by")) - 1)
        sizes = pieces.select(cell.alias("cell"), n_tokens)
    earlier = Window.partitionBy("n_tokens").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.groupBy("cell", "n_tokens").agg(F.count(F.lit(1)).alias("n")).select(
        "cell", "n_tokens", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = keyed_lookup(rows, base, ["cell", "n_tokens"], F.col("nth"), "inner").withColumn(
        "rank", F.col("base") + F.col("nth"))
    entries = pieces.sparkSession.createDataFrame(
        plan, "p_length int, p_rank long, p_n long, p_sequence long, p_offset int")
    inside = (F.col("n_tokens") == F.col("p_length")) & (F.col("rank") >= F.col("p_rank")) & (
        F.col("rank") < F.col("p_rank") + F.col("p_n"))
    placed = ranked.join(F.broadcast(entries), inside)
    kept = [c for c in rows.schema["row"].dataType.fieldNames() if c not in ("sequence_id", "offset")]
    return placed.select(
        *[F.col("row").getField(c).alias(c) for c in kept],
        (F.col("p_sequence") + F.col("rank") - F.col("p_rank")).alias("sequence_id"),
        F.col("p_offset").cast("long").alias("offset"),
    )


def sequences(placed: DataFrame, names: list[str]) -> DataFrame:
    """sequence_id, ids, pieces: the tokens of every sequence, and whose they are.

    ``placed`` is what :func:`place` gives for pieces with ``ids``. ``pieces`` holds offset, length and the
    columns ``names`` of each piece in order; a sequence has at most as many as it has tokens.
    """
    piece = F.struct("offset", F.col("length").cast("int").alias("length"), *[column(n) for n in names], "ids")
    gathered = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(piece)).alias("parts"))
    kept = [*dict.fromkeys(["offset", "length", *names])]
    ids = F.aggregate("parts", F.lit(b""), lambda all_ids, p: F.concat(all_ids, p.getField("ids")))
    return gathered.select(
        "sequence_id", ids.alias("ids"),
        F.transform("parts", lambda p: F.struct(*[p.getField(n).alias(n) for n in kept])).alias("pieces"))


def pieces_of(packed_sequences: DataFrame, id_bytes: int = 4) -> DataFrame:
    """The pieces again, one a row, with ``sequence_id`` and the ``ids`` that their sequence holds for them."""
    cut = lambda p: F.col("ids").substr(
        (id_bytes * p.getField("offset") + 1).cast("int"), id_bytes * p.getField("length"))
    parts = F.transform("pieces", lambda p: F.struct(p.alias("piece_of"), cut(p).alias("ids")))
    return packed_sequences.select("sequence_id", F.explode(parts).alias("part")).select(
        "part.piece_of.*", "sequence_id", F.col("part.ids").alias("ids"))
