"""Toxicity by a subsequence string-kernel SVM on Nystroem landmarks.

The kernel compares two short strings by their common subsequences of three
letters: every occurrence weighs DECAY to the power of the letters it spans, and
spans stop at SPAN letters, so an insult with gaps or inserted characters still
shares most of its weight with the plain one.  It is normalised to 1 for equal
strings.

Strings are the words of a sentence: lower case, letters and digits only
(anything else inside a word is dropped, so ``lo-ser`` reads ``loser``), and runs
of single letters joined (``l o s e r``).  Words over LONGEST letters are read in
overlapping windows.  Training looks only at a bounded sample of labelled documents
(``PER_CLASS`` of each label, none from the held-out fold):

1. the words of their sentences are counted by label and place in Spark; words
   that are spread over toxic documents further than chance allows are the positive
   examples.  Some clean documents may quote or mislabel one: then it has to stand
   MORE_OFTEN times as often in toxic ones, and chance to be smaller.  Other words
   of clean documents are the negative examples; words that stand that much more
   often in toxic documents but too seldom to be sure are neither.  With no word
   beyond chance the most uneven ones are taken, and a warning says so;
2. LANDMARKS strings, half of either kind, span the Nystroem feature space
   ``K_mm^(-1/2) k_m(x)``, in which a linear SVM (squared hinge) is trained; all
   clean words are scored, those that look worst are added, and it is trained
   once more, where a positive example that has many of them near has to reach
   a lower margin than one that stands alone;
3. a text's values are its highest word, the sum and the number of its distinct
   words' positive values and the number of words (long clean texts meet a
   bad-looking word by chance); a logistic model of these, on sampled documents whose words were
   not used before, gives the probability.

The SVM is linear in the kernel's own features, so it folds into one weight for
each three letters, ``f(x) = <phi(x), W> / |phi(x)| + b``; scoring walks a word's
subsequences once, for all landmarks at the same time, and each distinct word of
a batch once.

Defined cases: null or empty text, or text without letters, scores as one whose
highest word has the lowest value; without labelled rows of both kinds every
score is 0, and also, with a warning, where their texts have no words to tell them apart; repeated rows give repeated results; extra columns are ignored by
``score`` and kept by ``clean``; an empty table gives an empty table.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import fold, labelled, map_rows, store
from ledgerloom.llm.logistic import sigmoid
from ledgerloom.llm.text import PRIME, mix, slices

DECAY, SPAN = 0.75, 6
LONGEST, OVERLAP = 24, 12         # letters of a window, the mark included
PER_CLASS = 1500
LANDMARKS = 256
POSITIVES, NEGATIVES, HARD = 600, 2000, 2000
FEW = 10                        # positive examples where no word is beyond chance
NEAR, LEAST_MARGIN = 0.5, 0.25   # strings this alike count as near; what a positive example has to reach at least
CHANCE, MIXED_CHANCE = 1e-3, 1e-6  # of a word in toxic documents only, and of one that stands in clean ones too
MORE_OFTEN = 10
CUT = 0.7
SLICE = 1 << 20                  # bytes of text taken at a time; a word takes some hundred bytes of working memory
SIZE, MARK = 64, 63             # letters are numbers 1..62, MARK stands before a word; 0 ends a string
FLOOR = -4.0                    # the score of a text without words


def alphabet() -> np.ndarray:
    """Code point -> letter number, 0 for what is no letter or digit.

    a-z are 1..26, digits 27..36; other letters share 37..62 by code point, and
    63 stands before the first letter of a word.
    """
    table = np.zeros(0x3000, np.uint8)
    for c in range(len(table)):
        low = chr(c).lower()[0]
        if "a" <= low <= "z":
            table[c] = ord(low) - 96
        elif "0" <= low <= "9":
            table[c] = ord(low) - 48 + 27
        elif low.isalnum():
            table[c] = 37 + ord(low) % 26
    return table


ALPHABET = alphabet()
GAPS = np.zeros(0x3000, bool)
GAPS[[9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x2028, 0x2029]] = True


# ------------------------------------------------------------------ strings of a batch

def letters(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(strings, row): every distinct string of every text, as letter numbers padded with 0 to LONGEST."""
    lead = (buf & 0xC0) != 0x80
    points = np.frombuffer(buf.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    row_of = np.searchsorted(off, np.flatnonzero(lead), "right") - 1
    if len(points) != len(row_of):                     # damaged UTF-8: one text at a time
        parts = [buf[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(off, off[1:])]
        points = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
        row_of = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    low = np.minimum(points, len(ALPHABET) - 1)
    code = np.where(points < len(ALPHABET), ALPHABET[low], (37 + points % 26).astype(np.uint8))
    gap = GAPS[low]
    fresh = np.ones(len(code), bool)
    fresh[1:] = row_of[1:] != row_of[:-1]
    inside = ~gap
    first = inside & (fresh | np.concatenate([[True], gap[:-1]]))
    word = np.cumsum(first) - 1                        # word number, valid where inside
    keep = inside & (code > 0)
    code, word = code[keep], word[keep]
    word_row = row_of[first]
    # Runs of three or more one-letter words of one text also count as one word.
    size = np.bincount(word, minlength=len(word_row))
    single = size == 1
    joined = np.zeros(len(word_row), np.int64)
    new = single & ~(np.concatenate([[False], single[:-1]]) & np.concatenate([[False], word_row[1:] == word_row[:-1]]))
    run = np.cumsum(new) - 1
    run_size = np.bincount(run[single], minlength=int(run[-1]) + 1 if len(run) else 0)
    long_run = np.zeros(len(word_row), bool)
    long_run[single] = run_size[run[single]] >= 3
    joined[long_run] = run[long_run]
    extra = long_run[word]
    base = len(word_row)
    runs_row = word_row[new]
    code = np.concatenate([code, code[extra]])
    word = np.concatenate([word, base + joined[word[extra]]])
    word_row = np.concatenate([word_row, runs_row])
    start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.zeros(0, np.int64)
    length = np.diff(np.concatenate([start, [len(word)]]))
    owner = word_row[word[start]] if len(word) else np.zeros(0, np.int64)
    # Windows of long words: every LONGEST - OVERLAP letters.
    step = LONGEST - OVERLAP
    more = np.maximum(0, -(-(length + 1 - LONGEST) // step))
    rep = np.repeat(np.arange(len(start)), more + 1)
    shift = (np.arange(len(rep)) - np.repeat(np.cumsum(more + 1) - (more + 1), more + 1)) * step
    start, owner, length = start[rep] + shift, owner[rep], np.minimum(LONGEST, length[rep] - shift)
    at = start[:, None] + np.arange(LONGEST)
    strings = np.where(np.arange(LONGEST) < length[:, None], np.concatenate([code, np.zeros(1, np.uint8)])[np.minimum(at, len(code))], 0)
    strings[shift == 0, 1:] = strings[shift == 0, :-1]       # a word's first window begins with the mark
    strings[shift == 0, 0] = MARK
    return strings.astype(np.uint8), owner


def keys(strings: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every string."""
    words = np.ascontiguousarray(strings).view(np.uint64).reshape(len(strings), -1)
    h = np.zeros(len(strings), np.uint64)
    for k in range(words.shape[1]):
        h = mix(h + words[:, k] + PRIME)
    return h


def distinct(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct strings, which of them each one is)."""
    _, first, back = np.unique(keys(strings), return_index=True, return_inverse=True)
    return strings[first], back


def spell(text: str) -> np.ndarray:
    """The letter numbers of one string (its first window)."""
    raw = np.frombuffer(text.encode(), np.uint8)
    return letters(raw, np.array([0, len(raw)]))[0][:1]


# ------------------------------------------------------------------ the kernel

TRIPLES = [(0, j, k) for j, k in combinations(range(1, SPAN), 2)]


def features(strings: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(rows, number of the three letters, weight) for every place and gap pattern."""
    width = int((strings > 0).any(axis=0).sum()) if len(strings) else 0
    s = strings[:, :width].astype(np.int64)
    for i in range(width - 2):
        for _, j, k in TRIPLES:
            if i + k >= width:
                continue
            rows = np.flatnonzero(s[:, i + k])
            if len(rows):
                yield rows, (s[rows, i] * SIZE + s[rows, i + j]) * SIZE + s[rows, i + k], DECAY ** (k + 1)


def phi(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The normalised feature vectors as (row, triple, value)."""
    found = [(r, t, np.full(len(r), w)) for r, t, w in features(strings)]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    row, triple, weight = (np.concatenate(x) for x in zip(*found))
    key, back = np.unique(row * SIZE**3 + triple, return_inverse=True)
    value = np.bincount(back, weight)
    row, triple = key // SIZE**3, key % SIZE**3
    norm = np.sqrt(np.bincount(row, value * value, len(strings)))
    return row, triple, value / norm[row]


def kernel(a: np.ndarray, b: np.ndarray, block: int = 512) -> np.ndarray:
    """The normalised kernel of all strings of ``a`` with those of the short list ``b``."""
    row, triple, value = phi(b)
    used, at = np.unique(triple, return_inverse=True)
    right = np.zeros((len(used) + 1, len(b)))
    right[at, row] = value
    out = np.zeros((len(a), len(b)))
    for lo in range(0, len(a), block):
        row, triple, value = phi(a[lo:lo + block])
        at = np.searchsorted(used, triple)
        hit = np.flatnonzero(used[np.minimum(at, len(used) - 1)] == triple) if len(used) else at[:0]
        row = row[hit]
        if len(row):
            begin = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            out[lo + row[begin]] = np.add.reduceat(right[at[hit]] * value[hit, None], begin)
    return out


@dataclass(frozen=True)
class Model:
    weights: np.ndarray     # one for each three letters
    bias: float
    document: np.ndarray    # logistic weights of a text's values, the bias last

    def of_strings(self, strings: np.ndarray, block: int = 4096) -> np.ndarray:
        """The decision value of every string; FLOOR without three letters."""
        out = np.full(len(strings), FLOOR)
        for lo in range(0, len(strings), block):
            part = strings[lo:lo + block]
            order = np.argsort((part > 0).sum(axis=1), kind="stable")
            total, square = np.zeros(len(part)), np.zeros(len(part))
            for piece in np.array_split(order, 8):             # strings of like lengths together
                s = part[piece]
                found = [(r, t, w) for r, t, w in features(s)]
                if not found:
                    continue
                for r, t, w in found:
                    total[piece[r]] += w * self.weights[t]
                row = np.concatenate([r for r, _, _ in found])
                key = row * SIZE**3 + np.concatenate([t for _, t, _ in found])
                weight = np.repeat([w for _, _, w in found], [len(r) for r, _, _ in found])
                order2 = np.argsort(key, kind="stable")
                key, weight = key[order2], weight[order2]
                begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                value = np.add.reduceat(weight, begin)
                square[piece] += np.bincount(key[begin] // SIZE**3, value * value, len(s))
            some = square > 0
            out[lo:lo + block][some] = total[some] / np.sqrt(square[some]) + self.bias
        return out

    def of_texts(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Per text: the highest decision value and, in logarithms, the sum and the number of the positive
        ones over distinct strings and the number of these strings."""
        rows = len(off) - 1
        best, total, hits, number = np.full(rows, FLOOR), np.zeros(rows), np.zeros(rows), np.zeros(rows)
        strings, owner = letters(buf, off)
        if len(strings):
            words, back = distinct(strings)
            value = self.of_strings(words)
            pairs = np.unique(owner * len(words) + back)
            row, value = pairs // len(words), value[pairs % len(words)]
            np.maximum.at(best, row, value)
            total, hits, number = (np.bincount(row, w, rows) for w in (np.clip(value, 0, 1), value > 0, np.ones(len(row))))
        return np.stack([np.clip(best, -1.5, 1.5), np.log1p(total), np.log1p(hits), np.log1p(number)], axis=1)

    def probability(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        return sigmoid(self.of_texts(buf, off) @ self.document[:-1] + self.document[-1])


EMPTY = Model(np.zeros(SIZE**3), 0.0, np.array([0.0, 0.0, 0.0, 0.0, -35.0]))


# ------------------------------------------------------------------ training

def word_counts(sample: DataFrame) -> DataFrame:
    """(string, bad, good): how widely each string is spread over toxic and clean documents.

    That is the lesser of the number of documents and of the different words
    that it follows: copies of one document show a word in one place again and
    again, and a single odd document shows it in many.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(2).to_numpy()
            for lo, hi, buf, off in slices(batch.column(1), SLICE):
                strings, owner = letters(buf, off)
                h = keys(strings)
                before = np.concatenate([[0], h[:-1]]).astype(np.uint64) if len(h) else h
                before[np.concatenate([[True], owner[1:] != owner[:-1]])[:len(h)]] = 0
                _, first = np.unique(mix(h + PRIME * before) + owner.astype(np.uint64), return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([strings[i].tobytes() for i in first], pa.binary()), pa.array(before[first].view(np.int64)),
                     batch.column(0).slice(lo, hi - lo).take(pa.array(owner[first])), pa.array(marks[lo:hi][owner[first]] == 1, pa.bool_())],
                    names=["string", "before", "doc_id", "bad"])

    rows = sample.select("doc_id", "text", "y").mapInArrow(run, "string binary, before long, doc_id long, bad boolean")
    spread = rows.groupBy("string", "bad").agg(F.least(F.count_distinct("before"), F.count_distinct("doc_id")).alias("n"))
    return spread.groupBy("string").agg(F.coalesce(F.sum(F.when(F.col("bad"), F.col("n"))), F.lit(0)).alias("bad"),
                                        F.coalesce(F.sum(F.when(~F.col("bad"), F.col("n"))), F.lit(0)).alias("good"))


def array_of(strings: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(x) for x in strings), np.uint8).reshape(-1, LONGEST)


def told_apart(counts: DataFrame, n_bad: int, n_good: int) -> DataFrame:
    """``counts`` of the strings with a letter triple, and: evidence, positive, negative.

    The evidence is the Chernoff bound, as a logarithm, against so many toxic documents among those of a word
    that has nothing to do with the label; for a word in toxic documents only it is the exact chance.
    """
    share = n_bad / (n_bad + n_good)
    bad, good = F.col("bad"), F.col("good")
    part = bad / (bad + good)
    evidence = F.when(part > share, bad * F.log(part / share) + F.when(good > 0, good * F.log((1 - part) / (1 - share))).otherwise(0.0)).otherwise(0.0)
    uneven = (bad >= 3) & (bad * n_good >= good * (n_bad * MORE_OFTEN))
    sure = F.when(good == 0, -np.log(CHANCE)).otherwise(-np.log(MIXED_CHANCE))
    letters_in = F.length(F.regexp_replace(F.hex("string"), "(00)+$", "")) / 2
    return counts.filter(letters_in >= 4).select(            # the mark and three letters
        "string", "bad", "good", evidence.alias("evidence"), (uneven & (evidence >= sure)).alias("positive"), ((good > 0) & ~uneven).alias("negative"))


def examples(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positive strings, their spread, negative strings), of bounded number."""
    positive = counts.filter("positive").orderBy(F.desc("bad"), "string").limit(POSITIVES).collect()
    if not positive:
        positive = counts.filter("evidence > 0").orderBy(F.desc("evidence"), "string").limit(FEW).collect()
        warnings.warn("toxicity: no word stands in toxic documents beyond chance; the most uneven ones are taken", stacklevel=2)
    taken = [r["string"] for r in positive]
    negative = [r["string"] for r in counts.filter("negative").orderBy(F.xxhash64("string"), "string").limit(NEGATIVES).collect()]
    return array_of(taken), np.array([r["bad"] for r in positive], float), array_of([x for x in negative if x not in set(taken)])


def hardest(counts: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(strings, spread) of the HARD words of clean documents that look worst to the model, out of all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = model.of_strings(array_of(batch.column(0).to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value)], names=["string", "good", "value"])

    scored = counts.filter("negative").select("string", "good").mapInArrow(run, "string binary, good long, value double")
    rows = scored.orderBy(F.desc("value"), "string").limit(HARD).collect()
    return array_of([r["string"] for r in rows]), np.array([r["good"] for r in rows], float)


def svm(x: np.ndarray, y: np.ndarray, margin: np.ndarray, decay: float = 3e-4) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss below each example's margin, both labels weighing the same, by Newton's method in the primal."""
    x = np.column_stack([x, np.ones(len(x))])
    balance = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    penalty = np.array([decay] * (x.shape[1] - 1) + [1e-6])
    loss = lambda w: (balance * np.maximum(0, margin - y * (x @ w)) ** 2).sum() + (penalty * w * w).sum() / 2
    w = np.zeros(x.shape[1])
    for _ in range(200):
        slack = np.maximum(0, margin - y * (x @ w))
        inside = x[slack > 0]
        h = 2 * (inside * balance[slack > 0, None]).T @ inside + np.diag(penalty)
        step = np.linalg.solve(h, -2 * x.T @ (balance * slack * y) + penalty * w)
        size = 1.0
        while size > 1e-9 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-7:
            break
    return w[:-1], float(w[-1])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3) -> np.ndarray:
    """Weights and bias, by Newton's method with halved steps on standardised columns."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    x = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    penalty = np.array([ridge] * (x.shape[1] - 1) + [1e-6])
    loss = lambda w: np.logaddexp(0, np.where(y > 0, -1, 1) * (x @ w)).sum() + (penalty * w * w).sum() / 2
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return np.append(w[:-1] / spread, w[-1] - (w[:-1] * mean / spread).sum())


def fit(positive: np.ndarray, negative: np.ndarray, landmarks: np.ndarray, margin: np.ndarray | float = 1.0) -> tuple[np.ndarray, float]:
    """(weight of every three letters, bias) of the SVM on Nystroem features; ``margin`` is what positives have to reach."""
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks))
    keep = values > 1e-6
    root = vectors[:, keep] / np.sqrt(values[keep])
    x = np.concatenate([kernel(positive, landmarks), kernel(negative, landmarks)]) @ root
    y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
    w, b = svm(x, y, np.where(y > 0, np.append(np.broadcast_to(margin, len(positive)), np.ones(len(negative))), 1.0))
    row, triple, value = phi(landmarks)
    return np.bincount(triple, value * (root @ w)[row], SIZE**3), b


def spaced(strings: np.ndarray, n: int) -> np.ndarray:
    """``n`` of the strings at even distances."""
    return strings[np.unique(np.linspace(0, len(strings) - 1, min(n, len(strings))).astype(int))] if len(strings) else strings


def purity(positive: np.ndarray, bad: np.ndarray, hard: np.ndarray, good: np.ndarray) -> np.ndarray:
    """How much of what is near each positive string, by squared kernel, stands in toxic documents."""
    toxic = (kernel(positive, positive) ** 2) @ bad
    return toxic / (toxic + (kernel(positive, hard) ** 2 * (kernel(positive, hard) >= NEAR)) @ good)


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    sample = labelled(docs, labels, "toxic", per_class)
    # Words come from two thirds of the sample, the document's logistic weights from the rest.
    third = F.pmod(F.xxhash64(F.lit("third"), "doc_id"), F.lit(3))
    words = sample.filter(third > 0)
    count = lambda rows: {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    rest, number = sample.filter(third == 0), count(words)
    if len(number) < 2 or len(count(rest)) < 2:          # too few labels for two parts
        words = rest = sample
        number = count(words)
        if len(number) < 2:
            return EMPTY
    counts = store(told_apart(word_counts(words), number[1], number[0]), "words")
    positive, bad, negative = examples(counts)
    if not len(positive) or not len(negative):
        warnings.warn("toxicity: the labelled texts have no words to tell them apart; every score is 0", stacklevel=2)
        return EMPTY
    half = LANDMARKS // 2
    first = Model(*fit(positive, negative, np.concatenate([spaced(positive, half), spaced(negative, half)])), EMPTY.document)
    hard, good = hardest(counts, first)
    landmarks = np.concatenate([spaced(positive, half), spaced(negative, half // 2), spaced(hard, half // 2)])
    margin = np.maximum(LEAST_MARGIN, 2 * purity(positive, bad, hard, good) - 1)
    model = Model(*fit(positive, np.concatenate([negative, hard]), landmarks, margin), EMPTY.document)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, off in slices(batch.column(0), SLICE):
                values = model.of_texts(buf, off)
                yield pa.RecordBatch.from_arrays([pa.array(list(values), pa.list_(pa.float64())), batch.column(1).slice(lo, hi - lo)],
                                                 names=["values", "y"])

    scored = rest.select("text", "y").mapInArrow(run, "values array<double>, y int").toArrow()  # a few numbers per sampled document
    y = scored.column("y").to_numpy().astype(float)
    x = np.array(scored.column("values").to_pylist())
    return Model(model.weights, model.bias, logistic(x[np.lexsort(x.T)], y[np.lexsort(x.T)]))


# ------------------------------------------------------------------ scoring

def score(docs: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, off in slices(batch.column(1), SLICE):
                p = model.probability(buf, off)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(p), pa.array((p >= cut).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       (fold(F.col("doc_id")) == 1).alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def clean(docs: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their own columns."""
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, off in slices(batch.column(text), SLICE):
                yield batch.slice(lo, hi - lo).filter(pa.array(model.probability(buf, off) < cut))

    return map_rows(docs, run)
