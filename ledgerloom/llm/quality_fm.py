"""Quality score by a factorisation machine.

Inputs are hashed words (square root of the relative frequency, 2**14 buckets),
structure statistics of the text, and one piece of metadata (n_chars).  The
score of x is ``w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum (v_if x_i)^2)``:
all pairwise interactions through FACTORS-dimensional vectors, in time linear in
the number of inputs.  The model learns from a bounded sample of labelled
documents (``PER_CLASS`` of each label), none from the held-out fold; a quarter
of the sample calibrates the probability.  Labels, lang, source and doc_id are
no inputs.

Defined cases: null or empty text has no words and is scored by its structure
alone; n_chars that is null or absent is counted from the text; without labelled
rows of both kinds every score is 0.5; repeated rows give repeated results;
extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import fold, labelled
from ledgerloom.llm.logistic import adam, calibration, sigmoid
from ledgerloom.llm.text import hashes, slices, spans, structure

BITS = 14
WORDS = 1 << BITS
FACTORS = 6
PER_CLASS = 600
STEPS, RATE, DECAY = 100, 0.05, 1e-4
STATS = ("log_words", "log_chars", "word_length", "symbols", "duplicate_lines", "repeated_words", "distinct_words",
         "upper", "digits", "marks", "high", "lines")


def word_inputs(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value) of the hashed words, by row, and each row's share of distinct words."""
    rows = len(off) - 1
    start, end, row = spans(buf, off)
    bucket = (hashes(buf, start, end) >> np.uint64(64 - BITS)).astype(np.int64)
    key, n = np.unique(row * WORDS + bucket, return_counts=True)
    total = np.bincount(row, minlength=rows)
    at = key // WORDS
    return at, key % WORDS, np.sqrt(n / total[at]), np.bincount(at, minlength=rows) / np.maximum(total, 1)


def statistics(buf: np.ndarray, off: np.ndarray, distinct: np.ndarray, n_chars: np.ndarray) -> np.ndarray:
    """The STATS of every text, one column each."""
    s = {k: v.astype(float) for k, v in structure(buf, off).items()}
    share = lambda lo, hi: np.diff(np.concatenate([[0], np.cumsum((buf >= lo) & (buf <= hi))])[off]) / size
    size, words = np.maximum(np.diff(off), 1), np.maximum(s["n_words"], 1)
    points = np.diff(np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])[off])
    chars = np.where(n_chars < 0, points, n_chars)
    marks = share(33, 47) + share(58, 64) + share(91, 96) + share(123, 126)
    return np.stack([np.log1p(s["n_words"]), np.log1p(chars), s["word_chars"] / words, s["n_symbols"] / words,
                     s["n_dup_lines"] / words, s["n_repeat_words"] / words, distinct, share(65, 90), share(48, 57), marks,
                     share(128, 255), share(10, 10)], axis=1)


@dataclass(frozen=True)
class Model:
    bias: float
    linear: np.ndarray      # WORDS + len(STATS)
    factors: np.ndarray     # the same by FACTORS
    mean: np.ndarray
    spread: np.ndarray
    slope: float
    shift: float

    def scaled(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.mean) / self.spread, -4, 4) * 0.25

    def score(self, buf: np.ndarray, off: np.ndarray, n_chars: np.ndarray) -> np.ndarray:
        row, bucket, value, distinct = word_inputs(buf, off)
        x = self.scaled(statistics(buf, off, distinct, n_chars))
        rows = len(off) - 1
        z = self.bias + np.bincount(row, self.linear[bucket] * value, rows) + x @ self.linear[WORDS:]
        for f in range(self.factors.shape[1]):
            part = self.factors[bucket, f] * value
            dense = x * self.factors[WORDS:, f]
            z += 0.5 * ((np.bincount(row, part, rows) + dense.sum(axis=1)) ** 2
                        - np.bincount(row, part * part, rows) - (dense * dense).sum(axis=1))
        return sigmoid(self.slope * z + self.shift)


EMPTY = Model(0.0, np.zeros(WORDS + len(STATS)), np.zeros((WORDS + len(STATS), 1)), np.zeros(len(STATS)),
              np.ones(len(STATS)), 1.0, 0.0)


def lengths(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)


def inputs(sample: DataFrame) -> list[tuple]:
    """(doc_id, y, stats, buckets, values) of each sampled document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, off in slices(batch.column(1)):
                row, bucket, value, distinct = word_inputs(buf, off)
                stats = statistics(buf, off, distinct, lengths(batch.column(2).slice(lo, hi - lo)))
                cut = np.searchsorted(row, np.arange(hi - lo + 1))
                lists = lambda x, kind: pa.array([x[a:b] for a, b in zip(cut, cut[1:])], pa.list_(kind))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(3).slice(lo, hi - lo),
                     pa.array(list(stats), pa.list_(pa.float64())), lists(bucket.astype(np.int32), pa.int32()), lists(value, pa.float64())],
                    names=["doc_id", "y", "stats", "keys", "parts"])

    got = sample.select("doc_id", "text", "n_chars", "y").mapInArrow(
        run, "doc_id long, y int, stats array<double>, keys array<int>, parts array<double>").toArrow()
    rows = zip(*(got.column(c).to_pylist() if i < 2 else [x.values.to_numpy() for x in got.column(c)] for i, c in enumerate(got.column_names)))
    return sorted(rows, key=lambda r: (r[0], r[1], len(r[3])))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, factors: int = FACTORS) -> Model:
    rows = inputs(labelled(docs, labels, "quality", per_class))
    y = np.array([r[1] for r in rows], float)
    if len(set(y)) < 2:
        return EMPTY
    n, seen = len(rows), np.arange(len(rows)) % 4 != 3
    stats = np.stack([r[2] for r in rows])
    mean, spread = stats.mean(axis=0), stats.std(axis=0) + 1e-6
    shell = Model(0.0, EMPTY.linear, EMPTY.factors, mean, spread, 1.0, 0.0)
    dense = shell.scaled(stats)
    used, at = np.unique(np.concatenate([r[3] for r in rows]), return_inverse=True)
    # Inputs in one list, each row's statistics after its words; buckets that never occur keep weight 0.
    col = np.concatenate([at, np.tile(len(used) + np.arange(len(STATS)), n)])
    val = np.concatenate([np.concatenate([r[4] for r in rows]), dense.ravel()])
    row = np.concatenate([np.repeat(np.arange(n), [len(r[3]) for r in rows]), np.repeat(np.arange(n), len(STATS))])
    size = len(used) + len(STATS)
    w0, w = np.zeros(1), np.zeros(size)
    v = np.random.RandomState(1).normal(0, 0.05, (size, factors))
    balance = np.where(y > 0, 0.5 / max(1, (y[seen] > 0).sum()), 0.5 / max(1, (y[seen] == 0).sum())) * seen

    def forward() -> tuple[np.ndarray, list]:
        z, sums = w0[0] + np.bincount(row, w[col] * val, n), []
        for f in range(factors):
            part = v[col, f] * val
            sums.append(np.bincount(row, part, n))
            z = z + 0.5 * (sums[f] ** 2 - np.bincount(row, part * part, n))
        return z, sums

    def gradient() -> list[np.ndarray]:
        z, sums = forward()
        d = (sigmoid(z) - y) * balance
        each = d[row] * val
        gv = np.stack([np.bincount(col, each * (sums[f][row] - v[col, f] * val), size) for f in range(factors)], axis=1)
        return [np.array([d.sum()]), np.bincount(col, each, size) + DECAY * w, gv + DECAY * v]

    adam([w0, w, v], gradient, STEPS, RATE)
    z = forward()[0]
    slope, shift = calibration(z[~seen], y[~seen])
    linear, vectors = np.zeros(WORDS + len(STATS)), np.zeros((WORDS + len(STATS), factors))
    place = np.concatenate([used, WORDS + np.arange(len(STATS))])
    linear[place], vectors[place] = w, v
    return Model(float(w0[0]), linear, vectors, mean, spread, slope, shift)


def score(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    n_chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, off in slices(batch.column(1)):
                p = model.score(buf, off, lengths(batch.column(2).slice(lo, hi - lo)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(3).slice(lo, hi - lo), pa.array(p), pa.array((p >= least).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       n_chars.alias("n_chars"), (fold(F.col("doc_id")) == 1).alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
