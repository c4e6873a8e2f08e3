"""Operator 8: mix sources to target weights by a low-discrepancy schedule of equal-token blocks.

Every source is shuffled and cut into blocks whose words differ by one at most; a source of a small target
has smaller blocks. The slots of the mixture are numbered; a source gets as many as its target has blocks,
and the golden-ratio point of a slot, among the points of all slots, names its source, so every stretch of
the mixture follows the weights closely. Slots are ranked within their source, and the slot of rank r takes
block r of the shuffled source, starting over after its last one. A document is used as often as the blocks
that hold its words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finchlake.llm.common import column, identity, packed, shuffle_partitions, unpacked

# The points are multiples of a step close to 2**31 divided by the golden ratio.
CYCLE = 1 << 31
STEP = 1327217885
WEIGHTS = (5.0, 2.0, 1.0)
MAX_BLOCK = 512
LEAST_SLOTS = 200_000
LEAST_BLOCKS = 64                  # of a target of as many words: half a block is the most that it is missed by
ROWS_PER_CELL = 50_000
SLOTS_PER_CHUNK = 4096
MAX_SOURCES = 100_000


@dataclass
class Share:
    source: str | None
    size: int
    target: float

    def blocks(self, most_words: int) -> int:
        """How many blocks the source is cut into, of at most that many words and at most 1/64 of the target."""
        return -(-self.size // max(1, min(most_words, int(self.target // LEAST_BLOCKS))))

    def slots(self, most_words: int) -> int:
        return round(self.target * self.blocks(most_words) / self.size) if self.size else 0


def points_below(end: int, slots: int) -> int:
    """How many of the first ``slots`` golden-ratio points are less than ``end``, in logarithmic time."""
    return slots + floor_sum(slots, CYCLE, STEP, 0) - floor_sum(slots, CYCLE, STEP, CYCLE - end)


def floor_sum(n: int, m: int, a: int, b: int) -> int:
    """The sum of (a * i + b) // m for i from 0 to n - 1."""
    total = 0
    while n > 0:
        total += n * (n - 1) // 2 * (a // m) + n * (b // m)
        a, b = a % m, b % m
        n, b = divmod(a * n + b, m)
        m, a = a, m
        if not a or not m:
            break
    return total


def slot_ends(counts: list[int]) -> list[int]:
    """Rising ends in 0 to CYCLE: exactly counts[i] points of all sum(counts) slots lie below the i-th end and
    not below the one before."""
    slots, run, ends = sum(counts), 0, []
    if slots > CYCLE:
        raise ValueError("more slots than points: take a larger block")
    for n in counts:
        run += n
        low, high = (ends[-1] if ends else 0), CYCLE
        if n == 0:
            high = low
        while low < high:
            middle = (low + high) // 2
            if points_below(middle, slots) < run:
                low = middle + 1
            else:
                high = middle
        ends.append(low)
    return ends


def share_targets(
    sizes: dict[str | None, int], weights: tuple[float, ...], total: float, most: float
) -> list[Share]:
    """Targets by weight, sources in code point order with null last; none above ``most`` times its size.

    What a source cannot take is shared among the others by weight, again until none is above.
    """
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    shares = [Share(s, sizes[s], 0.0) for s in names]
    weight = {i: weights[i % len(weights)] for i in range(len(shares))}
    open_ones, left = set(weight), float(total)
    while open_ones:
        unit = left / sum(weight[i] for i in sorted(open_ones))
        full = [i for i in sorted(open_ones) if unit * weight[i] > most * shares[i].size]
        if not full:
            for i in open_ones:
                shares[i].target = unit * weight[i]
            break
        for i in full:
            shares[i].target = float(most * shares[i].size)
            left -= shares[i].target
        open_ones -= set(full)
    return shares


def words(text: Column) -> Column:
    """The number of runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


class Mixture:
    """The plan of a mixture over ``df``; ``size`` is the words of a row, ``source`` its group.

    Null sources form a group of their own. Rows of size 0 are part of no block and are taken 0 times.
    Rows are told apart by their whole content; equal rows follow one another in the shuffle. All sums of
    an empty table are 0 and it gives no rows.

    The number of sources must stay under MAX_SOURCES: one small row for each of them goes to the driver.
    """

    def __init__(
        self, df: DataFrame, key: str, source: str, size: Column, weights: tuple[float, ...] = WEIGHTS,
        share: float = 1.5, most: int = 2, block: int | None = None, seed: int = 8_191,
    ):
        self.spark, self.fields, self.most = df.sparkSession, df.columns, most
        group = column(source).cast("string")
        sums = df.select(group.alias("source"), size.alias("size")).groupBy("source").agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")
        ).limit(MAX_SOURCES + 1).collect()
        if len(sums) > MAX_SOURCES:
            raise ValueError(f"more than {MAX_SOURCES} sources")
        sizes = {r["source"]: int(r["size"]) for r in sums}
        rows = sum(r["n"] for r in sums)
        self.total = share * sum(sizes.values())
        self.shares = share_targets(sizes, weights, self.total, most)
        self.block = block or max(1, min(MAX_BLOCK, int(self.total // LEAST_SLOTS)), int(self.total // (CYCLE >> 1)))
        self.cells = max(8 * shuffle_partitions(df), -(-rows // ROWS_PER_CELL))
        ids = identity(*[column(c) for c in df.columns])
        packed_rows = packed(
            df, source=group, size=size, cell=F.pmod(F.xxhash64(F.lit(seed), column(key)), F.lit(self.cells)).cast("int"),
            shuffled=F.xxhash64(F.lit(seed + 1), column(key)), a=ids[0], b=ids[1],
        )
        self.rows = packed_rows.join(F.broadcast(self._groups()), F.col("source").eqNullSafe(F.col("g_source")))
        # The cells of a source follow one another; what lies before each is a sum over few rows.
        earlier = Window.partitionBy("g").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        starts = self.rows.groupBy("g", "cell").agg(F.sum("size").alias("n")).select(
            "g", "cell", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("c_start"))
        order = ["shuffled", "a", "b"]
        within = Window.partitionBy("g", "cell").orderBy(*order)
        before = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1))
        ranked = self.rows.withColumn("nth", F.row_number().over(within)).withColumn(
            "before", F.coalesce(before, F.lit(0)))
        self.streams = ranked.join(starts, ["g", "cell"]).withColumn(
            "start", F.col("c_start") + F.col("before")
        ).select(
            "row", "g", "source_size", "target", "cell", "nth", "size", "start", "blocks", "slots"
        )

    def _groups(self) -> DataFrame:
        rows = [(i, s.source, s.size, s.target, s.blocks(self.block), s.slots(self.block)) for i, s in enumerate(self.shares)]
        return self.spark.createDataFrame(
            rows, "g int, g_source string, source_size long, target double, blocks long, slots long")

    def schedule(self) -> DataFrame:
        """slot, g (number of the source), block, epoch: which block every slot of the mixture takes."""
        counts = [s.slots(self.block) for s in self.shares]
        slots, ends = sum(counts), slot_ends(counts)
        cuts = (F.split(F.lit(",".join(map(str, ends))), ",") if ends else F.array()).cast("array<long>")
        point = (F.col("slot") % CYCLE) * STEP % CYCLE
        ids = self.spark.range(slots).withColumnRenamed("id", "slot")
        drawn = ids.withColumn("point", point).select(
            "slot", F.size(F.filter(cuts, lambda c: c <= F.col("point"))).alias("g"),
            F.floor(F.col("slot") / SLOTS_PER_CHUNK).cast("long").alias("chunk"),
        )
        earlier = Window.partitionBy("g").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
        counts = drawn.groupBy("chunk", "g").agg(F.count(F.lit(1)).alias("n"))
        base = counts.select("chunk", "g", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
        nth = F.row_number().over(Window.partitionBy("chunk", "g").orderBy("slot")) - 1
        ranked = drawn.withColumn("nth", nth).join(base, ["chunk", "g"])
        placed = ranked.withColumn("rank", F.col("base") + F.col("nth")).join(
            F.broadcast(self._groups().where(F.col("blocks") > 0).select("g", "blocks")), "g")
        return placed.select(
            "slot", "g", (F.col("rank") % F.col("blocks")).alias("block"),
            F.floor(F.col("rank") / F.col("blocks")).cast("int").alias("epoch"),
        )

    def segments(self) -> DataFrame:
        """g, cell, nth (which name a row), block, from_word, n_words: the words of a row in each block.

        The first blocks of a source have a word more than the others if its words cannot be dealt evenly.
        Blocks that no slot takes are left out.
        """
        each = F.expr("source_size div blocks")
        longer = F.col("source_size") % F.col("blocks")
        edge = longer * (each + 1)
        first = lambda block: block * each + F.least(block, longer)
        holds = lambda word: F.when(
            word < edge, F.floor(word / (each + 1))).otherwise(longer + F.floor((word - edge) / each)).cast("long")
        stop = F.col("start") + F.col("size")
        spans = self.streams.where(F.col("size") > 0).select(
            "g", "cell", "nth", "start", stop.alias("stop"), "source_size", "blocks",
            holds(F.col("start")).alias("low"), F.least(holds(stop - 1), F.col("slots") - 1).alias("high"),
        ).where(F.col("low") <= F.col("high")).select("*", F.explode(F.sequence("low", "high")).alias("block"))
        low = F.greatest("start", first(F.col("block")))
        high = F.least("stop", first(F.col("block") + 1))
        return spans.select(
            "g", "cell", "nth", "block", (low - F.col("start")).alias("from_word"), (high - low).alias("n_words")
        )

    def placements(self) -> DataFrame:
        """slot, epoch, g, cell, nth, from_word, n_words: the mixture itself, in pieces of rows."""
        return self.schedule().join(self.segments(), ["g", "block"]).select(
            "slot", "epoch", "g", "cell", "nth", "from_word", "n_words"
        )

    def taken(self, *by: str) -> DataFrame:
        return self.placements().groupBy("g", "cell", "nth", *by).agg(F.sum("n_words").alias("taken"))

    def usage(self) -> DataFrame:
        """The rows of ``df`` with ``size``, ``source_size``, ``target`` and ``taken`` (words, with repeats)."""
        joined = self.streams.join(self.taken(), ["g", "cell", "nth"], "left").withColumn(
            "taken", F.coalesce("taken", F.lit(0)).cast("long"))
        return unpacked(joined, ["size", "source_size", "target", "taken"], self.fields)

    def documents(self, text: str) -> DataFrame:
        """The rows of ``df`` as the mixture uses them: once per epoch, with the words that it takes.

        A row whose words are all taken keeps its text; a row at the edge of the last blocks is cut to its
        first words, joined by single spaces. Rows that no slot takes are left out.
        """
        joined = self.streams.join(self.taken("epoch"), ["g", "cell", "nth"])
        runs = F.regexp_extract_all(column("text_of_row"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
        cut = F.array_join(F.slice(runs, 1, F.col("taken").cast("int")), " ")
        whole = F.col("row").getField(text)
        out = joined.withColumn("text_of_row", whole).withColumn(
            text, F.when(F.col("taken") >= F.col("size"), F.col("text_of_row")).otherwise(cut))
        return unpacked(out, [text], self.fields)
