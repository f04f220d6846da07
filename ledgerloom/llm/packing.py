"""Best-fit packing of token pieces into sequences by a configuration linear program.

A document's ids (public word BPE, then END) are cut only if they are more than
``capacity``, into pieces of that size.  Which pieces share a sequence depends on
their lengths alone, so the plan is made from the histogram of lengths, which
has at most ``capacity`` rows whatever the input:

1. Lengths of over ``SAND`` tokens go into classes of ``GRID`` tokens.  The
   configuration LP asks for the fewest sequences that cover all classes; it is
   solved by multiplicative weights: each step prices the classes, finds the best
   configuration by a knapsack dynamic program over the grid, uses some of it,
   and lowers the prices of what it covers.
2. The fractional numbers are rounded down, and the configurations are filled
   with real lengths, longest first; their last place, and the room that real
   lengths leave, takes the longest piece that still fits.
3. What is left, and the sand, goes in by best fit, longest first: each piece to
   the fullest sequence that still has room for it.

The plan is a list of runs (the same lengths in ``count`` sequences), so its size
follows the number of distinct lengths and LP steps, not the input.  Pieces of
equal length are interchangeable; each gets its number among them by a running
count per (length, hash bucket), and looks its place up in the plan.

Defined cases: null or empty text is one piece holding only END; rows with equal
doc_id and text are separate documents; extra columns are ignored; an empty
table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import store
from ledgerloom.llm.text import slices, text_of, tidy
from ledgerloom.llm.tokens import shared

CAPACITY = 4096
END = 1
GRID = 16
SAND = 256
STEPS = 2000
BUCKETS = 256


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# ------------------------------------------------------------------ the plan, from the histogram

def price(value: np.ndarray, units: int) -> np.ndarray:
    """The configuration (how many of each class 0..units) of the highest value that fits ``units``: knapsack DP."""
    best, choice = np.zeros(units + 1), np.zeros(units + 1, np.int64)
    for c in range(1, units + 1):
        total = best[c - 1::-1] + value[1:c + 1]
        k = int(np.argmax(total))
        if total[k] > best[c - 1]:
            best[c], choice[c] = total[k], k + 1
        else:
            best[c] = best[c - 1]
    out, c = np.zeros(units + 1, np.int64), units
    while c > 0:
        if choice[c]:
            out[choice[c]] += 1
            c -= choice[c]
        else:
            c -= 1
    return out


def fractional(counts: np.ndarray, units: int, steps: int = STEPS) -> dict[tuple, float]:
    """Configurations (as (class, number) pairs) and how often the LP uses them, by multiplicative weights."""
    there = np.flatnonzero(counts)
    use: dict[tuple, float] = defaultdict(float)
    if not len(there):
        return use
    covered = np.zeros(len(counts))                     # shares of the demand
    for _ in range(steps):
        weight = np.zeros(len(counts))
        weight[there] = np.exp(-8.0 * (covered[there] - covered[there].min())) / counts[there]
        # A class's price per step is its weight; bulk breaks ties, so that sequences get full.
        value = weight / weight.max() + 1e-3 * np.arange(len(counts)) / units * (counts > 0)
        value[counts == 0] = -1.0
        config = price(value, units)
        took = np.flatnonzero(config)
        step = float((counts[took] / config[took]).min()) * 0.2
        covered[took] += step * config[took] / counts[took]
        use[tuple((int(k), int(config[k])) for k in took)] += step
        if covered[there].min() >= 1.0:
            break
    scale = 1.0 / max(1.0, float(np.median(covered[there])))
    return {c: x * scale for c, x in use.items()}


@dataclass
class Run:
    """``count`` sequences that hold the same lengths: ``slots`` are (length, number) in order."""

    slots: list
    gap: int
    count: int


def plan_runs(histogram: dict[int, int], capacity: int = CAPACITY, steps: int = STEPS) -> list[Run]:
    left = {int(k): int(n) for k, n in histogram.items() if n}
    runs = [Run([(capacity, 1)], 0, left.pop(capacity))] if left.get(capacity) else []
    units = capacity // GRID
    counts = np.zeros(units + 1)
    there = np.zeros(capacity + 1, bool)                     # lengths of which some are left
    for size, n in left.items():
        if size > SAND:
            counts[-(-size // GRID)] += n
            there[size] = True

    def take(run: Run, most: int) -> Run | None:
        """Up to ``run.count`` of the sequences with one more piece, the longest there is of at most ``most`` tokens."""
        size = most - int(np.argmax(there[most::-1]))
        if not there[size]:
            return None
        n = min(run.count, left[size])
        left[size] -= n
        there[size] = left[size] > 0
        counts[-(-size // GRID)] -= n
        return Run([*run.slots, (size, 1)], run.gap - size, n)

    for config, times in sorted(fractional(counts.copy(), units, steps).items(), key=lambda x: (-x[1], x[0])):
        times = min([int(times), *(int(counts[k] // n) for k, n in config)])
        classes = [k for k, n in sorted(config, reverse=True) for _ in range(n)]
        todo = [(Run([], capacity, times), 0)] if times > 0 else []
        while todo:
            run, slot = todo.pop()
            # Real lengths are shorter than their classes; from the last slot on, the room decides.
            most = min(run.gap, classes[slot] * GRID) if slot < len(classes) - 1 else run.gap
            longer = take(run, most)
            if longer is None:
                runs.append(run)
                continue
            todo.append((longer, slot + 1))
            if longer.count < run.count:
                todo.append((Run(run.slots, run.gap, run.count - longer.count), slot))
    return best_fit(runs, left, capacity)


def best_fit(runs: list[Run], left: dict[int, int], capacity: int) -> list[Run]:
    """Puts what is left into the fullest sequences with room, longest first, opening new ones where none has room."""
    by_gap: list[list[Run]] = [[] for _ in range(capacity + 1)]
    for run in runs:
        by_gap[run.gap].append(run)
    open_at = np.array([bool(x) for x in by_gap])
    for size in sorted((k for k, n in left.items() if n), reverse=True):
        todo = left[size]
        while todo:
            gap = size + int(np.argmax(open_at[size:]))
            if open_at[gap]:
                run = by_gap[gap].pop()
                open_at[gap] = bool(by_gap[gap])
            else:
                each = min(capacity // size, todo)
                run = Run([], capacity, max(1, todo // each))
                gap = capacity
            each = min(gap // size, todo)
            n = min(run.count, todo // each)
            if n < run.count:
                by_gap[gap].append(Run(run.slots, gap, run.count - n))
                open_at[gap] = True
            rest = gap - each * size
            by_gap[rest].append(Run([*run.slots, (size, each)], rest, n))
            open_at[rest] = True
            todo -= n * each
    return [run for runs in by_gap for run in runs if run.slots]


class Plan:
    """Where the n-th piece of a length goes."""

    def __init__(self, runs: list[Run]):
        rows, upto, sequence = [], defaultdict(int), 0
        for run in runs:
            offset = 0
            for size, each in run.slots:
                rows.append((size, upto[size], each, sequence, offset))
                upto[size] += each * run.count
                offset += size * each
            sequence += run.count
        self.sequences = sequence
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.size, self.start, self.each, self.sequence, self.offset = table.T

    def place(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces by length and number."""
        if not len(size):
            return size, rank
        wide = int(max(self.start.max(), rank.max())) + 1
        row = np.searchsorted(self.size * wide + self.start, size * wide + rank, "right") - 1
        nth = rank - self.start[row]
        return self.sequence[row] + nth // self.each[row], self.offset[row] + nth % self.each[row] * size


# ------------------------------------------------------------------ Spark

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece; with ``with_ids`` its token ids too."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared(path)
        for batch in batches:
            docs_of = batch.column(0).to_pylist()
            for lo, hi, buf, off in slices(batch.column(1)):
                flat, bounds = words.encode([text_of(buf, off, i) for i in range(hi - lo)])
                out: list[tuple] = []
                for i in range(hi - lo):
                    ids = np.append(flat[bounds[i]:bounds[i + 1]], np.uint32(END)).astype("<u4")
                    for k, at in enumerate(range(0, len(ids), capacity)):
                        part = ids[at:at + capacity]
                        row = (docs_of[lo + i], k, at, len(part), zlib.crc32(part))
                        out.append((*row, part.astype(np.int32)) if with_ids else row)
                columns = list(zip(*out))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names[:len(columns)])
        tidy()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, PIECES + (", ids array<int>" if with_ids else ""))


def bucketed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(BUCKETS)).cast("int"))


def in_plan(rows: DataFrame, base: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` (pieces) with sequence_id and offset; ``base`` has the same pieces without ids, stored."""
    counts = base.groupBy("length", "bucket").count()
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # at most ``capacity`` rows
    plan = Plan(plan_runs(histogram, capacity))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = counts.select("length", "bucket", (F.sum("count").over(before) - F.col("count")).alias("before"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = rows.join(starts, ["length", "bucket"]).withColumn("rank", F.col("before") + F.row_number().over(inside) - 1)
    names = [c for c in rows.columns if c != "bucket"]
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            sequence, offset = plan.place(size, rank)
            kept = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                                             names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"{c} {kinds[c]}" for c in names)
    return ranked.select(*names, "rank").mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    base = store(bucketed(pieces(docs, capacity, path)), "pieces")
    return in_plan(base, base, capacity)


def pack_ids(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """As ``pack``, with every piece's token ids.  Ids are made a second time, which takes less room than keeping them."""
    base = store(bucketed(pieces(docs, capacity, path)), "pieces")
    return in_plan(bucketed(pieces(docs, capacity, path, with_ids=True)), base, capacity)
