"""Linear SVMs with squared hinge loss over blocks of term counts, several of them in the same passes.

A first pass solves the problem on chunks of rows by dual coordinate descent and averages the solutions: the
exact one if all rows are one chunk, else a good start. Each later pass gives the loss and gradient of every
model at its own trial point, until the gradient over all rows is small. Tasks add up their rows and send one
vector a model, which are added in groups before the driver sees them. The driver holds the weights, whose
number is that of the features, and steps by L-BFGS. Models that leave out one fold each so cost one scan of
the features an iteration, not one each.

TF-IDF weights are not stored: document frequencies are counted once by fold, a model subtracts those of the
fold it leaves out, and a row is weighted while it is read, with factors that scale it to length one. What the
passes read is written once, some rows packed together: Spark hands bytes to Python, not one number an entry. Passes
have as many tasks as cores however many rows there are, so the vectors that tasks send do not grow with them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finchlake.operators.packed import packed, unpacked
from finchlake.session import written

ENTRIES_PER_TASK = 2_500_000   # feature entries that a task of a pass reads, at least
EPOCHS, GAP = 60, 1e-3          # of the descent on all rows: turns over them, and when to stop earlier
CHUNK_EPOCHS = 6                 # of the descent on a chunk of the rows, which is a start only
PACKED_ENTRIES = 250_000         # feature entries that are packed together
PACKS_READ = 4                   # packs that Spark reads and sends at a time
LONG_ROWS = 300                  # entries of a row from which several models take it by itself
BATCH_ENTRIES = 2_500_000       # and holds in memory at a time
GROUP_BYTES = 1 << 28            # vectors that the driver gets at once, added up in tasks beyond that
FIRST_ROWS = 256                 # rows in a batch before the number of entries is known
SENT, READ = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize"
HISTORY = 5
PARTIAL = "part int, model int, loss double, vector binary"


@dataclass
class Block:
    """A vector column. ``weighted``: sparse counts that become TF-IDF weights of length one; else as they are."""

    name: str
    size: int
    weighted: bool = True
    dense: bool = False


@dataclass
class Problem:
    """What one model is fitted on: rows of other folds than ``held``, their idf by block, weights by class."""

    idf: list[np.ndarray | None]
    held: int | None = None
    row_weights: tuple[float, float] = (1.0, 1.0)   # of the classes -1 and 1
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    loss: float = float("inf")
    passes: int = 0


class Rows:
    """Entries of some rows: by block their slots, values and row numbers; the folds and the classes; factors, if known."""

    def __init__(self, fold: np.ndarray, y: np.ndarray, blocks: list[tuple], known: np.ndarray | None = None):
        self.n, self.fold, self.y, self.known = len(y), fold, y, known
        self.lengths = [lengths for _, _, lengths in blocks]
        self.blocks = [(slots, numbers, np.repeat(np.arange(self.n), lengths)) for slots, numbers, lengths in blocks]

    @staticmethod
    def of(batch: pa.RecordBatch, blocks: list[Block]) -> Rows:
        read = []
        for block in blocks:
            vectors = batch.column(block.name)
            values = vectors.field("values")
            lengths = np.diff(values.offsets.to_numpy())
            numbers = values.flatten().to_numpy().astype(np.float64)
            slots = vectors.field("indices").flatten().to_numpy().astype(np.int64) if not block.dense else np.tile(
                np.arange(block.size), batch.num_rows)
            read.append((slots, numbers, lengths))
        return Rows(batch.column("fold").to_numpy(zero_copy_only=False),
                    batch.column("y").to_numpy(zero_copy_only=False).astype(np.float64), read)

    def packs(self, factors: np.ndarray) -> Iterator[bytes]:
        """Bytes of about PACKED_ENTRIES entries each, or a row, for :meth:`opened`; ``factors`` by row, problem and block."""
        ends = [np.append(0, np.cumsum(x)) for x in self.lengths]
        all_ends = np.sum(ends, axis=0)
        a = 0
        while a < self.n:
            b = max(a + 1, int(np.searchsorted(all_ends, all_ends[a] + PACKED_ENTRIES, "right")) - 1)
            parts = []
            for (slots, numbers, _), lengths, end in zip(self.blocks, self.lengths, ends):
                part, kept = slice(end[a], end[b]), numbers[end[a]:end[b]]
                whole = len(kept) > 0 and bool((kept >= 0).all()) and bool((kept == np.floor(kept)).all()) and kept.max() < 2**32
                parts += [lengths[a:b], slots[part], kept.astype(np.int64) if whole else kept]
            yield packed((self.fold[a:b] + 1).astype(np.int64), (self.y[a:b] > 0).astype(np.int64), factors[a:b].ravel(), *parts, level=1)
            a = b

    @staticmethod
    def opened(packs: list[bytes], blocks: list[Block]) -> Rows:
        arrays = [unpacked(p) for p in packs]
        joined = lambda i: np.concatenate([x[i] for x in arrays])
        y = np.where(joined(1) > 0, 1.0, -1.0)
        read = [(joined(3 * i + 4), joined(3 * i + 5).astype(np.float64), joined(3 * i + 3).astype(np.int64)) for i in range(len(blocks))]
        return Rows(joined(0).astype(np.int64) - 1, y, read, joined(2).reshape(len(y), -1, len(blocks)))

    def factors(self, blocks: list[Block], idf: list[np.ndarray | None]) -> list[np.ndarray]:
        """By block, what scales each row's TF-IDF weights to length one."""
        out = []
        for (slots, numbers, row), block, scale in zip(self.blocks, blocks, idf):
            factor = np.ones(self.n)
            if block.weighted:
                weighted = numbers * scale[slots]
                length = np.sqrt(np.bincount(row, weights=weighted * weighted, minlength=self.n))
                factor = np.divide(1.0, length, out=np.zeros(self.n), where=length > 0)
            out.append(factor)
        return out

    def margins(self, factors: list[np.ndarray], blocks: list[Block], scaled: np.ndarray) -> np.ndarray:
        """``scaled`` holds the weights times the idf of their slots, and the intercept."""
        total, start = np.full(self.n, scaled[-1]), 0
        for (slots, numbers, row), factor, block in zip(self.blocks, factors, blocks):
            total += factor * np.bincount(row, weights=numbers * scaled[start:start + block.size][slots], minlength=self.n)
            start += block.size
        return total


    def passed(self, blocks: list[Block], points: list[tuple], cost: float, sums: np.ndarray) -> np.ndarray:
        """The loss of every model of ``points``; their gradients, one a column, are added to ``sums``."""
        ks = [k for k, *_ in points]
        weight = np.stack([np.where(self.y > 0, c[1], c[0]) * (1.0 if held is None else self.fold != held)
                           for _, held, c, _ in points], axis=1)
        w = np.stack([x for *_, x in points], axis=1)
        factors = [self.known[:, ks, b] for b in range(len(blocks))]       # rows x models
        cuts = np.cumsum([0, *[b.size for b in blocks]])
        long = len(points) > 1 and sum(map(np.sum, self.lengths)) > LONG_ROWS * self.n
        margin = np.tile(w[-1], (self.n, 1))
        for (slots, numbers, row), factor, lengths, start in zip(self.blocks, factors, self.lengths, cuts):
            if long:
                ends = np.append(0, np.cumsum(lengths))
                mine = w[start:]
                dots = np.stack([numbers[a:b] @ mine.take(slots[a:b], axis=0) for a, b in zip(ends, ends[1:])])
            else:
                dots = np.stack([np.bincount(row, weights=numbers * w[start:, j][slots], minlength=self.n)
                                 for j in range(len(points))], axis=1)
            margin += factor * dots
        gap = np.maximum(0.0, 1.0 - self.y[:, None] * margin)
        pull = -2.0 * cost * weight * self.y[:, None] * gap
        for (slots, numbers, row), factor, lengths, block, start in zip(self.blocks, factors, self.lengths, blocks, cuts):
            pulled = pull * factor
            if long:        # a row has a slot once
                ends = np.append(0, np.cumsum(lengths))
                mine = sums[start:start + block.size]
                for i in np.flatnonzero(pulled.any(axis=1)).tolist():
                    a, b = ends[i], ends[i + 1]
                    mine[slots[a:b]] += numbers[a:b, None] * pulled[i]
            else:
                for j in range(len(points)):
                    sums[start:start + block.size, j] += np.bincount(slots, weights=numbers * pulled[row, j], minlength=block.size)
        sums[-1] += pull.sum(axis=0)
        return cost * (weight * gap * gap).sum(axis=0)


def chunks(batches: Iterable[pa.RecordBatch], blocks: list[Block]) -> Iterator[Rows]:
    """The packed rows of a task, about BATCH_ENTRIES entries at a time."""
    held, entries = [], 0
    for batch in batches:
        for pack, n in zip(batch.column("pack"), batch.column("entries").to_pylist()):
            if held and entries + n > BATCH_ENTRIES:
                yield Rows.opened(held, blocks)
                held, entries = [], 0
            held.append(pack.as_buffer().to_pybytes())
            entries += n
    if held:
        yield Rows.opened(held, blocks)


def idf_of_all(idf: list[np.ndarray | None], blocks: list[Block]) -> np.ndarray:
    """The idf of every slot, 1 for blocks without weighting and for the intercept."""
    return np.concatenate([*[np.ones(b.size) if x is None else x for x, b in zip(idf, blocks)], np.ones(1)])


def _sent(rows: list[tuple[int, int, float, np.ndarray]]) -> pa.RecordBatch:
    part, model, loss, vectors = zip(*rows) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([
        pa.array(part, pa.int32()), pa.array(model, pa.int32()), pa.array(loss, pa.float64()),
        pa.array([v.tobytes() for v in vectors], pa.binary())], names=["part", "model", "loss", "vector"])


def _added(batches: Iterable[pa.RecordBatch], part: int = 0) -> list[tuple[int, int, float, np.ndarray]]:
    sums: dict[int, list] = {}
    for batch in batches:
        for model, loss, raw in zip(batch.column("model").to_pylist(), batch.column("loss").to_pylist(), batch.column("vector")):
            held = sums.setdefault(model, [0.0, 0.0])
            held[0] += loss
            held[1] = held[1] + np.frombuffer(raw.as_buffer(), dtype=np.float64)
    return [(part, m, loss, vector) for m, (loss, vector) in sorted(sums.items())]


def summed(rows: DataFrame, part: Callable, models: int, size: int) -> dict[int, tuple[float, np.ndarray]]:
    """The (loss, vector) of every model, added over the tasks of ``part``; beyond GROUP_BYTES in two steps."""
    partial = rows.mapInArrow(part, PARTIAL)
    tasks = rows.rdd.getNumPartitions()
    groups = max(1, GROUP_BYTES // (8 * max(1, models * size)))
    if tasks > groups:
        dealt = partial.repartition(groups, F.pmod("part", F.lit(groups)))
        partial = dealt.mapInArrow(lambda batches: iter([_sent(_added(batches))]), PARTIAL)
    return {m: (loss, vector) for _, m, loss, vector in _added(partial.toArrow().to_batches())}


def tasks_of(rows: DataFrame, models: int) -> int:
    """The most tasks of a pass: every one sends a vector a model, so more of them cost more than they spread."""
    return rows.sparkSession.sparkContext.defaultParallelism * (2 if models == 1 else 1)


def _task() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def fold_frequencies(rows: DataFrame, blocks: list[Block], folds: list[int]) -> dict[int, list[np.ndarray]]:
    """By fold and weighted block, how many of the fold's rows hold each slot: one scan for all folds."""
    sizes = [b.size for b in blocks if b.weighted]
    kept = [b for b in blocks if b.weighted]

    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            held = Rows.of(batch, kept)
            for fold in np.unique(held.fold).tolist():
                inside = held.fold == fold
                seen = [np.bincount(slots[inside[row]], minlength=size) for (slots, _, row), size in zip(held.blocks, sizes)]
                counts[fold] = counts.get(fold, 0.0) + np.concatenate(seen).astype(np.float64)
        yield _sent([(_task(), fold, 0.0, c) for fold, c in sorted(counts.items())])

    total = sum(sizes)
    rows = rows.select("fold", "y", *[b.name for b in kept])
    with lowered(rows, FIRST_ROWS):   # how many entries a row has is known only after this scan
        found = summed(rows, part, len(folds), total) if total else {}
    cuts = np.cumsum([0, *sizes])
    empty = np.zeros(total)
    return {fold: [found.get(fold, (0.0, empty))[1][a:b] for a, b in zip(cuts, cuts[1:])] for fold in folds}


def bound_batches(rows: DataFrame, entries_per_row: float) -> None:
    """Let Spark read and send Python about BATCH_ENTRIES feature entries at a time. Settings are only ever lowered."""
    conf = rows.sparkSession.conf
    fit_in = max(64, int(BATCH_ENTRIES / max(1.0, entries_per_row)))
    for name in (SENT, READ):
        if not 0 < int(conf.get(name)) <= fit_in:
            conf.set(name, str(fit_in))


@contextmanager
def lowered(rows: DataFrame, fit_in: int) -> Iterator[None]:
    """At most ``fit_in`` rows in a batch that is read or sent to Python, for the jobs that run inside."""
    conf = rows.sparkSession.conf
    before = {name: conf.get(name) for name in (SENT, READ)}
    for name, value in before.items():
        if not 0 < int(value) <= fit_in:
            conf.set(name, str(fit_in))
    try:
        yield
    finally:
        for name, value in before.items():
            conf.set(name, value)


def smooth_idf(frequency: np.ndarray, rows: int) -> np.ndarray:
    """ln((1 + n) / (1 + df)) + 1; 0 for a term that no fitted row holds."""
    return np.where(frequency > 0, np.log((1.0 + rows) / (1.0 + frequency)) + 1.0, 0.0)


def _direction(g: np.ndarray, history: list[tuple[np.ndarray, np.ndarray, float]]) -> np.ndarray:
    q, used = g.copy(), []
    for s, d, r in reversed(history):
        a = r * s.dot(q)
        q -= a * d
        used.append(a)
    if history:
        s, d, r = history[-1]
        q *= 1.0 / (r * d.dot(d))
    for (s, d, r), a in zip(history, reversed(used)):
        q += (a - r * d.dot(q)) * s
    return -q


def _descend(
    slots: np.ndarray, values: np.ndarray, bounds: np.ndarray, y: np.ndarray, upper: np.ndarray, size: int, epochs: int
) -> np.ndarray:
    """Dual coordinate descent over rows held in memory; row i has the entries from bounds[i] to bounds[i + 1]."""
    w, bias, dual = np.zeros(size), 0.0, np.zeros(len(y))
    steep = np.add.reduceat(np.append(values * values, 0.0), bounds[:-1]) * (np.diff(bounds) > 0) + 1.0 + 1.0 / upper
    draws = np.random.default_rng(0)
    for _ in range(epochs):
        worst = 0.0
        for i in draws.permutation(len(y)).tolist():
            mine, x, a = slots[bounds[i]:bounds[i + 1]], values[bounds[i]:bounds[i + 1]], dual[i]
            slope = y[i] * (w[mine].dot(x) + bias) - 1.0 + a / upper[i]
            if a == 0.0 and slope >= 0.0:
                continue
            worst = max(worst, abs(slope))
            dual[i] = max(a - slope / steep[i], 0.0)
            w[mine] += (dual[i] - a) * y[i] * x
            bias += (dual[i] - a) * y[i]
        if worst < GAP:
            break
    w[-1] = bias
    return w


def start_points(
    rows: DataFrame, blocks: list[Block], problems: list[Problem], n_rows: list[int], cost: float
) -> list[tuple[np.ndarray, float]]:
    """For every problem the average of its solutions on chunks of rows, and the size of its gradient at zero.

    ``rows`` are packed; ``n_rows`` is the number of rows of each problem. A chunk stands for all rows, so
    its cost is raised accordingly; its solution is a start only, so it takes few turns, unless it is all rows. What is
    held in memory is a chunk.
    """
    size = sum(b.size for b in blocks) + 1
    cuts = np.cumsum([0, *[b.size for b in blocks]])
    context = rows.sparkSession.sparkContext
    told = context.broadcast([(idf_of_all(p.idf, blocks), p.held, p.row_weights, n) for p, n in zip(problems, n_rows)])

    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k_all = len(told.value)
        sums = [np.zeros(size) for _ in range(2 * k_all)]
        for held in chunks(batches, blocks):
            known = held.known
            order = np.argsort(np.concatenate([row for _, _, row in held.blocks]), kind="stable")
            slots = np.concatenate([s.astype(np.int64) + start for (s, _, _), start in zip(held.blocks, cuts)])[order]
            numbers = np.concatenate([x for _, x, _ in held.blocks])[order]
            of_row = np.concatenate([row for _, _, row in held.blocks])[order]
            block = np.concatenate([np.full(len(s), b) for b, (s, _, _) in enumerate(held.blocks)])[order]
            for k, (scale, left_out, row_weights, n) in enumerate(told.value):
                inside = held.fold != left_out if left_out is not None else np.ones(held.n, dtype=bool)
                mine = inside[of_row]
                if not inside.any():
                    continue
                x = (numbers * scale[slots] * known[of_row, k, block])[mine]
                y, weight = held.y[inside], np.where(held.y > 0, row_weights[1], row_weights[0])[inside]
                share = len(y) / n
                lengths = np.bincount(of_row, minlength=held.n)[inside]
                bounds = np.concatenate(([0], np.cumsum(lengths)))
                sums[k] += share * _descend(slots[mine], x, bounds, y, 2.0 * cost * weight / share, size,
                                            EPOCHS if len(y) == n else CHUNK_EPOCHS)
                pull = -2.0 * cost * weight * y
                sums[k_all + k] += np.bincount(slots[mine], weights=x * np.repeat(pull, lengths), minlength=size)
                sums[k_all + k][-1] += pull.sum()
        yield _sent([(_task(), k, 0.0, vector) for k, vector in enumerate(sums)])

    found = summed(rows, part, 2 * len(problems), size)
    return [(found[k][1], float(np.linalg.norm(found[len(problems) + k][1]))) for k in range(len(problems))]


class _Search:
    """L-BFGS of one model: holds the trial point that the next pass evaluates."""

    def __init__(self, start: np.ndarray, first: float):
        self.w, self.trial, self.first, self.step = None, start, first, 1.0
        self.history: list = []
        self.done = False

    def told(self, loss: float, g: np.ndarray, tolerance: float) -> None:
        if self.w is None:
            pass
        elif loss > self.loss + 1e-4 * self.step * self.slope and self.step > 1e-10:
            bend = loss - self.loss - self.step * self.slope
            self.step *= min(0.5, max(0.1, -self.slope * self.step / (2 * bend)))
            self.trial = self.w + self.step * self.way
            return
        else:
            s, d = self.trial - self.w, g - self.g
            if s.dot(d) > 1e-12:
                self.history = [*self.history, (s, d, 1.0 / s.dot(d))][-HISTORY:]
        self.w, self.loss, self.g = self.trial, loss, g
        if np.linalg.norm(g) <= tolerance * self.first or self.step <= 1e-10:
            self.done = True
            return
        self.way = _direction(g, self.history)
        self.slope = float(g.dot(self.way))
        self.step = 1.0 if self.history else min(1.0, 1.0 / float(np.linalg.norm(g)))
        self.trial = self.w + self.step * self.way


def with_factors(rows: DataFrame, blocks: list[Block], problems: list[Problem]) -> DataFrame:
    """What the passes read, written once: ``pack``, some rows with their factors by problem and block; ``entries``."""
    idf = rows.sparkSession.sparkContext.broadcast([p.idf for p in problems])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = Rows.of(batch, blocks)
            factors = np.array([held.factors(blocks, scale) for scale in idf.value])   # problems x blocks x rows
            for pack in held.packs(factors.transpose(2, 0, 1)):
                n = sum(len(x) for x in unpacked(pack)[4::3])
                yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([pack], pa.binary())], names=["entries", "pack"])

    tasks = rows.rdd.getNumPartitions()
    packs = rows.select("fold", "y", *[b.name for b in blocks]).mapInArrow(add, "entries long, pack binary")
    return written(packs, "training", compression="none").coalesce(tasks)


def fit(
    rows: DataFrame, blocks: list[Block], problems: list[Problem], n_rows: list[int], cost: float, max_iter: int,
    tolerance: float,
) -> list[Problem]:
    """The problems with their weights: those of all slots, block by block, and the intercept at the end.

    Minimises |w|^2 / 2 + cost * sum of c max(0, 1 - y m)^2 over rows, the intercept regularised as a
    feature that is always 1. A model is done once its gradient is ``tolerance`` of that at zero weights.
    """
    packs = with_factors(rows, blocks, problems)
    with lowered(packs, PACKS_READ):
        return _fitted(packs, blocks, problems, n_rows, cost, max_iter, tolerance)


def _fitted(
    rows: DataFrame, blocks: list[Block], problems: list[Problem], n_rows: list[int], cost: float, max_iter: int,
    tolerance: float,
) -> list[Problem]:
    size = sum(b.size for b in blocks) + 1
    context = rows.sparkSession.sparkContext
    searches = [_Search(*point) for point in start_points(rows, blocks, problems, n_rows, cost)]
    scales = [idf_of_all(p.idf, blocks) for p in problems]
    for number in range(max_iter):
        open_ = [k for k, s in enumerate(searches) if not s.done]
        if not open_:
            break
        points = context.broadcast([(k, problems[k].held, problems[k].row_weights, searches[k].trial * scales[k]) for k in open_])

        def part(batches: Iterable[pa.RecordBatch], points=points) -> Iterator[pa.RecordBatch]:
            sums, loss = np.zeros((size, len(points.value))), np.zeros(len(points.value))
            for held in chunks(batches, blocks):
                loss += held.passed(blocks, points.value, cost, sums)
            yield _sent([(_task(), k, float(loss[j]), sums[:, j]) for j, (k, *_) in enumerate(points.value)])

        found = summed(rows, part, len(open_), size)
        for k in open_:
            loss, g = found[k]
            trial = searches[k].trial
            searches[k].told(loss + 0.5 * float(trial.dot(trial)), g * scales[k] + trial, tolerance)
            problems[k].passes = number + 1
        points.unpersist()
    for p, s in zip(problems, searches):
        p.weights, p.loss = (s.w, s.loss) if s.w is not None else (s.trial, p.loss)
    return problems


def predicted(rows: DataFrame, blocks: list[Block], problems: list[Problem], keep: list[str]) -> DataFrame:
    """``keep`` and ``margin`` of the rows of every problem's left-out fold."""
    context = rows.sparkSession.sparkContext
    models = context.broadcast([(p.held, p.idf, p.weights * idf_of_all(p.idf, blocks)) for p in problems])
    kinds = {f.name: f.dataType for f in rows.schema.fields}

    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = Rows.of(batch, blocks)
            margin, mine = np.zeros(held.n), np.zeros(held.n, dtype=bool)
            for left_out, idf, w in models.value:
                inside = held.fold == left_out
                if inside.any():
                    margin = np.where(inside, held.margins(held.factors(blocks, idf), blocks, w), margin)
                    mine |= inside
            out = pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(margin)], names=[*keep, "margin"])
            yield out.filter(pa.array(mine))

    schema = ", ".join(f"`{c}` {kinds[c].simpleString()}" for c in keep) + ", margin double"
    return rows.mapInArrow(part, schema)
