"""Operator 12: product quantisation of integer vectors, nearest entries found by Orchard's search.

Vectors are cut into parts, and every part position has a codebook of a few entries. For each entry the
other entries are kept in a list sorted by distance. A search holds the nearest entry so far and walks its
list: an entry seen before is passed over, a nearer one becomes the entry whose list is walked from its
start, and the walk ends at the first entry more than twice as far from the held one as the vector is, since
no entry from there on can be nearer (or as near). All arithmetic is on integers, so results are exact.

Codebooks improve in rounds. Tasks add up the parts of every entry by themselves; what meets in the shuffle
and on the driver is one sum per part position and entry, however many vectors there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finchlake.llm.common import column, small_batches, unpacked
from finchlake.operators.lookup import keyed_lookup
from finchlake.session import written

PARTS, ENTRIES, ROUNDS = 16, 64, 2
LARGEST = 1 << 24   # components up to this magnitude keep four times a squared distance within 64 bits
SUMS = "position int, entry int, n long, sums array<long>"
OUTPUTS = ["code", "error", "label_error", "codebooks_sha256"]


def usable(name: str):
    """True for vectors that have components, all of them finite."""
    vector = column(name)
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & whole, F.lit(False))


def integers(lists: pa.Array, width: int | None = None) -> np.ndarray:
    """floor(256 x) of every component, one row a vector."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(flat * 256.0)
    if np.abs(scaled).max(initial=0) > LARGEST:
        raise ValueError(f"components must not exceed {LARGEST / 256} in magnitude")
    if width is None:
        width = len(flat) // max(1, len(lists))
    if len(flat) != width * len(lists) or (np.diff(lists.offsets.to_numpy()) != width).any():
        raise ValueError(f"all vectors must have {width} components")
    return scaled.astype(np.int64).reshape(len(lists), width)


class Codebooks:
    """The entries of every part position with their neighbour lists. ``tables[p]`` has one entry a row."""

    def __init__(self, tables: list[np.ndarray]):
        self.tables = tables
        self.lists, self.distances, self.starts = [], [], []
        for table in tables:
            apart = ((table[:, None, :] - table[None, :, :]) ** 2).sum(axis=2)
            # The entry itself is the first of its list: its distance to itself is 0, and equal entries follow by number.
            np.fill_diagonal(apart, -1)
            order = np.argsort(apart, axis=1, kind="stable")
            np.fill_diagonal(apart, 0)
            self.lists.append(order)
            self.distances.append(np.take_along_axis(apart, order, axis=1))
            self.starts.append(int(apart.sum(axis=1).argmin()))

    @property
    def bounds(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum([t.shape[1] for t in self.tables])))

    def nearest(self, position: int, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of every row of ``parts``, ties to the smaller number, and its squared distance.

        The searches of all rows advance together; a row leaves once its own search is over.
        """
        table, lists, apart = self.tables[position], self.lists[position], self.distances[position]
        n, entries = len(parts), len(table)
        held = np.full(n, self.starts[position])
        best = ((parts - table[held]) ** 2).sum(axis=1)
        seen = np.zeros((n, entries), dtype=bool)
        seen[np.arange(n), held] = True
        at = np.ones(n, dtype=np.int64)   # place in the held entry's list; place 0 is the entry itself
        active = np.arange(n)
        while True:
            active = active[at[active] < entries]
            # Twice the distance, squared. An entry exactly as far may tie, so only farther ones end a search.
            active = active[apart[held[active], at[active]] <= 4 * best[active]]
            if not len(active):
                return held, best
            found = lists[held[active], at[active]]
            at[active] += 1
            new = ~seen[active, found]
            rows, found = active[new], found[new]
            seen[rows, found] = True
            distance = ((parts[rows] - table[found]) ** 2).sum(axis=1)
            better = (distance < best[rows]) | ((distance == best[rows]) & (found < held[rows]))
            rows = rows[better]
            held[rows], best[rows], at[rows] = found[better], distance[better], 1

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (one column a position) and the squared distances added over the positions."""
        bounds = self.bounds
        codes = np.zeros((len(vectors), len(self.tables)), dtype=np.int64)
        error = np.zeros(len(vectors), dtype=np.int64)
        for p in range(len(self.tables)):
            codes[:, p], distance = self.nearest(p, vectors[:, bounds[p]:bounds[p + 1]])
            error += distance
        return codes, error

    def improved(self, sums: Iterable) -> Codebooks:
        """Entries replaced by the floors of their parts' means, given (position, entry, n, sums) rows."""
        tables = [t.copy() for t in self.tables]
        for r in sums:
            tables[r["position"]][r["entry"]] = [s // r["n"] for s in r["sums"]]
        return Codebooks(tables)

    def sha256(self) -> str:
        listed = ",".join(str(x) for table in self.tables for x in table.ravel().tolist())
        return hashlib.sha256(listed.encode()).hexdigest()


def first_codebooks(vectors: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """The parts of the vectors with the smallest keys; None without a vector."""
    first = vectors.select("key", "vector").orderBy(F.asc_nulls_last("key"), "vector").limit(entries).toArrow()
    if not first.num_rows:
        return None
    table = integers(first.column("vector").combine_chunks())
    cuts = [i * table.shape[1] // parts for i in range(parts + 1)]
    return Codebooks([table[:, a:b] for a, b in zip(cuts, cuts[1:])])


def entry_sums(vectors: DataFrame, codebooks: Codebooks) -> list:
    """(position, entry, n, sums): the parts of every entry, added up. At most one row per position and entry."""
    shared = vectors.sparkSession.sparkContext.broadcast(codebooks)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, totals = shared.value, None
        bounds, width = books.bounds, int(books.bounds[-1])
        for batch in batches:
            rows = integers(batch.column("vector"), width)
            codes = books.encode(rows)[0]
            if totals is None:
                totals = [(np.zeros(len(t), dtype=np.int64), np.zeros(t.shape, dtype=np.int64)) for t in books.tables]
            for p, (counts, sums) in enumerate(totals):
                counts += np.bincount(codes[:, p], minlength=len(counts))
                np.add.at(sums, codes[:, p], rows[:, bounds[p]:bounds[p + 1]])
        listed = [(p, e, int(counts[e]), sums[e].tolist())
                  for p, (counts, sums) in enumerate(totals or []) for e in np.flatnonzero(counts).tolist()]
        columns = list(zip(*listed)) or [()] * 4
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, type=k) for c, k in zip(columns, kinds)], names=["position", "entry", "n", "sums"])

    each = vectors.select("vector").mapInArrow(add, SUMS)
    long = each.select("position", "entry", "n", F.posexplode("sums").alias("i", "s"))
    added = long.groupBy("position", "entry", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    whole = added.groupBy("position", "entry").agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("i", "s"))).alias("sums"))
    return whole.select("position", "entry", "n", F.col("sums.s").alias("sums")).collect()


def product_codes(
    df: DataFrame, key: str, vector: str, label: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """Rows with a usable vector: their columns but the vector, ``code``, ``error``, ``label_error``, ``codebooks_sha256``.

    A component x counts as floor(256 x). Vectors that are null, empty, or hold null or non-finite components
    are dropped. All others must have one length, cut into ``parts`` parts, as equal as it allows. The first
    entries are the vectors with the smallest keys (null keys last, equal keys by vector); with fewer vectors
    there are fewer entries. ``code`` has two hex digits a part, ``error`` is the sum of squared distances,
    ``label_error`` that of all rows with the same label, null labels together. Rows that repeat count each.
    A component above LARGEST / 256 in magnitude is an error. An empty table gives no rows. ``df`` is read
    2 + ``rounds`` times.
    """
    if entries > 256:
        raise ValueError("a code has two hex digits: at most 256 entries")
    small_batches(df)
    keep = [c for c in df.columns if c != vector]
    kept = F.struct(F.lit(0).alias("any"), *[column(c).alias(c) for c in keep])
    vectors = df.where(usable(vector)).select(
        kept.alias("row"), column(key).alias("key"), column(vector).cast("array<double>").alias("vector"),
        F.coalesce(column(label).cast("string"), F.lit("")).alias("group"), column(label).isNull().alias("no_group"))
    codebooks = first_codebooks(vectors, parts, entries)
    if codebooks is None:
        empty = vectors.select("row", *[F.lit(None).cast(t).alias(c) for c, t in zip(OUTPUTS, ("string", "long", "long", "string"))])
        return unpacked(empty, OUTPUTS, keep)
    for _ in range(rounds):
        codebooks = codebooks.improved(entry_sums(vectors, codebooks))
    shared = df.sparkSession.sparkContext.broadcast(codebooks)

    @F.pandas_udf("code string, error long")
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        width = int(shared.value.bounds[-1])
        for batch in batches:
            codes, error = shared.value.encode(integers(pa.array(batch, type=pa.list_(pa.float64())), width))
            yield pd.DataFrame({"code": [bytes(c).hex() for c in codes.astype(np.uint8)], "error": error})

    found = written(vectors.select("row", "key", "group", "no_group", coded("vector").alias("c")).select(
        "row", "key", "group", "no_group", "c.code", "c.error"), "codes")
    by_label = found.groupBy("group", "no_group").agg(F.sum("error").alias("label_error"))
    joined = keyed_lookup(found, by_label, ["group", "no_group"], F.struct("key", "code"))
    return unpacked(joined.withColumn("codebooks_sha256", F.lit(codebooks.sha256())), OUTPUTS, keep)
