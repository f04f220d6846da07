"""Quality rules: base counts, and a hashed n-gram logistic regression behind fixed thresholds.

Features are relative frequencies of hashed word 1- and 2-grams and of hashed
character (byte) 3-grams, each family in its own 2**16 buckets.  The model is
trained on a bounded sample of labelled documents (``PER_CLASS`` of each label,
none from the held-out fold), calibrated to probabilities on a quarter of that
sample that the weights have not seen, and applied in Arrow batches.  Because
the features are relative frequencies, a text's score is the mean weight of its
grams, so scoring is linear in the text and needs no per-text table.

A document is kept if it passes the base rules (at least 50 words; at most half
of its words in repeated 3-word windows) and its probability of being good is at
least KEEP.

Defined cases: null or empty text has no words and fails the base rules; without
labelled rows of both kinds every text gets probability 0.5, which is kept;
repeated rows give repeated results; extra columns are ignored; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import labelled
from ledgerloom.llm.logistic import adam, calibration, sigmoid
from ledgerloom.llm.text import BYTE_HASH, PRIME, hashes, slices, spans, structure, windows

BITS = 16
PER_CLASS = 400
KEEP = 0.5
LEAST_WORDS = 50
MOST_REPEATED = 50      # percent of words
STEPS, RATE, DECAY = 120, 1.0, 1e-6


def word_grams(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every word and every pair of neighbouring words."""
    start, end, row = spans(buf, off)
    h = hashes(buf, start, end)
    pairs, at = windows(h, row, 2)
    shift = np.uint64(64 - BITS)
    return np.concatenate([row, row[at]]), np.concatenate([h, pairs]).__rshift__(shift).astype(np.int64)


def char_grams(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, bucket): text i has the 3-grams bounds[0][i] up to bounds[1][i]."""
    if len(buf) < 3:
        return np.zeros((2, len(off) - 1), np.int64), np.zeros(0, np.int64)
    h = BYTE_HASH[buf]
    g = (h[:-2] * PRIME + h[1:-1]) * PRIME + h[2:]
    bucket = ((g ^ (g >> np.uint64(31))) * PRIME >> np.uint64(64 - BITS)).astype(np.int64)
    begin = np.minimum(off[:-1], len(bucket))
    return np.stack([begin, np.maximum(begin, np.minimum(off[1:] - 2, len(bucket)))]), bucket


@dataclass(frozen=True)
class Model:
    words: np.ndarray
    chars: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        rows = len(off) - 1
        row, bucket = word_grams(buf, off)
        n = np.bincount(row, minlength=rows)
        z = self.bias + np.bincount(row, self.words[bucket], rows) / np.maximum(n, 1)
        (begin, end), bucket = char_grams(buf, off)
        total = np.concatenate([[0.0], np.cumsum(self.chars[bucket], dtype=np.float64)])
        z += (total[end] - total[begin]) / np.maximum(end - begin, 1)
        return sigmoid(self.slope * z + self.shift)


EMPTY = Model(np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32), 0.0, 1.0, 0.0)


def frequencies(sample: DataFrame) -> list[tuple]:
    """(doc_id, y, buckets, frequencies) of each sampled document; the char family's buckets follow the words'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lo, hi, buf, off in slices(batch.column(1)):
                row, bucket = word_grams(buf, off)
                (begin, end), chars = char_grams(buf, off)
                for i in range(hi - lo):
                    keys, values = [], []
                    for base, grams in ((0, bucket[row == i]), (1 << BITS, chars[begin[i]:end[i]])):
                        k, n = np.unique(grams, return_counts=True)
                        keys.append(k + base)
                        values.append(n / max(1, len(grams)))
                    out.append((np.concatenate(keys).astype(np.int32), np.concatenate(values).astype(np.float32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([k for k, _ in out], pa.list_(pa.int32())),
                 pa.array([v for _, v in out], pa.list_(pa.float32()))], names=["doc_id", "y", "keys", "parts"])

    got = sample.select("doc_id", "text", "y").mapInArrow(run, "doc_id long, y int, keys array<int>, parts array<float>").toArrow()
    rows = zip(*(got.column(c).to_pylist() if i < 2 else [x.values.to_numpy() for x in got.column(c)] for i, c in enumerate(got.column_names)))
    return sorted(rows, key=lambda r: (r[0], r[1], len(r[2])))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    rows = frequencies(labelled(docs, labels, "quality", per_class))
    y = np.array([r[1] for r in rows], float)
    if len(set(y)) < 2:
        return EMPTY
    held = np.arange(len(rows)) % 4 == 3
    col = np.concatenate([r[2] for r in rows]).astype(np.int64)
    val = np.concatenate([r[3] for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r[2]) for r in rows])
    used, at = np.unique(col, return_inverse=True)       # only buckets that occur have a weight
    w, b = np.zeros(len(used)), np.zeros(1)
    seen = ~held
    balance = np.where(y > 0, 0.5 / max(1, (y[seen] > 0).sum()), 0.5 / max(1, (y[seen] == 0).sum())) * seen

    def scores() -> np.ndarray:
        return np.bincount(row, w[at] * val, len(rows)) + b[0]

    def gradient() -> list[np.ndarray]:
        d = (sigmoid(scores()) - y) * balance
        return [np.bincount(at, d[row] * val, len(used)) + DECAY * w, np.array([d.sum()])]

    adam([w, b], gradient, STEPS, RATE)
    z = scores()
    slope, shift = calibration(z[held], y[held])
    full = np.zeros(2 << BITS, np.float32)
    full[used] = w
    return Model(full[:1 << BITS], full[1 << BITS:], float(b[0]), slope, shift)


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, probability double")


def judge(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """One row per document, with the base counts, both verdicts and the probability of good quality."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, off in slices(batch.column(1)):
                s = structure(buf, off)
                p = model.probability(buf, off)
                failed = (s["n_words"] < LEAST_WORDS) | (100 * s["n_repeat_words"] > MOST_REPEATED * s["n_words"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *(pa.array(x.astype(np.int64)) for x in s.values()),
                     pa.array(failed), pa.array(~failed & (p >= keep)), pa.array(p)],
                    names=[x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)
