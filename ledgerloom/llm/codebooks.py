"""Vector code compression: product codes with slice-and-intersect searches.

A vector of integers is cut into PARTS equal parts, and each part is coded by
the nearest of ENTRIES entries of its own codebook.  Codebooks start as the
parts of the first vectors by vec_id and are refined by ROUNDS rounds over all
vectors: every part goes to its nearest entry, every entry becomes the floor of
its parts' mean.

The nearest entry is found without comparing all entries (``Slices``).  Per
dimension the entries' coordinates are sorted, and next to them stand prefix
masks: bit e of the i-th mask is set if entry e is among the i smallest
coordinates.  The entries within a radius of a coordinate are then two binary
searches and one XOR of prefix masks, and those within the radius in every
dimension are the AND of these masks, four uint64 words.  An initial radius,
taken from the codebook, is doubled until some entry is left; the best of those
left gives a distance that the nearest entry can't exceed, and a second slice
with this distance as its radius holds every entry that may be nearest.  Their
distances are compared as integers, so the result is exact, ties to the lower
index.

Spark scans the vectors once a round; a task returns one sum and count per entry
it used (at most PARTS * ENTRIES rows), which are added up before the driver
divides them: the driver holds the codebooks and nothing else.

Defined cases: rows whose vector is null or holds a null, NaN or infinite
component are dropped, and so are those with a component that is too large for
its squared distances to fit into 64 bits (about 90,000 at 128 components).
The table's length is that of the kept vector that comes first by vec_id (then
by components); vectors of other lengths, empty ones and lengths that PARTS
doesn't divide are dropped as well.  Null vec_ids come last.  With fewer
vectors than ENTRIES the codebooks are shorter.  Repeated rows are coded each;
null labels are one label; a sum of errors beyond 64 bits is null; extra
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import small_batches, store
from ledgerloom.llm.spread import spread_join

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
WORD = 64


class Slices:
    """One codebook with its sorted coordinates and prefix masks."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        count, dims = entries.shape
        self.words = -(-count // WORD)
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, order, axis=0)
        self.prefix = np.zeros((dims, count + 1, self.words), np.uint64)
        bit = np.uint64(1) << (order % WORD).astype(np.uint64)
        for d in range(dims):
            one = np.zeros((count, self.words), np.uint64)
            one[np.arange(count), order[:, d] // WORD] = bit[:, d]
            self.prefix[d, 1:] = np.bitwise_or.accumulate(one, axis=0)
        self.radius = self._initial()

    def _initial(self) -> int:
        """The median over the entries of the widest coordinate difference to the entry next to them."""
        if len(self.entries) < 2:
            return 1
        nearest = [np.partition(np.abs(self.entries - e).max(axis=1), 1)[1] for e in self.entries]
        return max(1, int(np.median(nearest)))

    def within(self, parts: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Per row the mask of the entries that differ by at most the row's radius in every dimension."""
        mask = np.full((len(parts), self.words), ~np.uint64(0))
        for d in range(parts.shape[1]):
            low = np.searchsorted(self.sorted[:, d], parts[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[:, d], parts[:, d] + radius, "right")
            mask &= self.prefix[d, high] ^ self.prefix[d, low]
        return mask

    def best(self, parts: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per row the nearest entry of its (non-empty) mask and the squared distance."""
        bits = np.unpackbits(mask.astype("<u8").view(np.uint8).reshape(len(mask), -1), axis=1, bitorder="little")
        at, entry = np.nonzero(bits)
        gap = parts[at] - self.entries[entry]
        distance = np.einsum("ij,ij->i", gap, gap)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        least = np.minimum.reduceat(distance, first)
        ties = np.where(distance == least[at], entry, len(self.entries))
        return np.minimum.reduceat(ties, first), least

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of every row, exact."""
        if not len(parts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        radius = np.full(len(parts), self.radius, np.int64)
        mask = self.within(parts, radius)
        empty = np.flatnonzero(~mask.any(axis=1))
        while len(empty):
            radius[empty] *= 2
            mask[empty] = self.within(parts[empty], radius[empty])
            empty = empty[~mask[empty].any(axis=1)]
        entry, distance = self.best(parts, mask)
        # The nearest entry differs by at most isqrt(distance) in every dimension.
        reach = np.sqrt(distance.astype(np.float64)).astype(np.int64) + 1
        more = np.flatnonzero(reach > radius)
        if len(more):
            entry[more], distance[more] = self.best(parts[more], self.within(parts[more], reach[more]))
        return entry, distance



def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, x): the kept rows with floor(SCALE * component) as longs."""
    x = F.col("embedding")
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    bound = F.sqrt(F.lit(float(1 << 60)) / F.size(x)) / F.lit(float(SCALE)) - 1
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter(x.isNotNull() & (F.size(x) > 0) & (F.size(x) % PARTS == 0)).filter(usable)
    rows = rows.filter(F.forall(x, lambda c: F.abs(c) < bound))
    return rows.select("vec_id", "label", F.transform(x, lambda c: F.floor(c * SCALE).cast("long")).alias("x"))


def part_arrays(batch: pa.RecordBatch, column: int) -> np.ndarray:
    """The batch's vectors as (rows, PARTS, dims)."""
    lists = batch.column(column)
    return lists.flatten().to_numpy().reshape(batch.num_rows, PARTS, -1) if batch.num_rows else np.zeros((0, PARTS, 1), np.int64)


def start(vectors: DataFrame) -> np.ndarray | None:
    """The first codebooks, (PARTS, entries, dims), of at most ENTRIES rows; None without rows."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(1).select(F.size("x")).collect()
    if not first:
        return None
    alike = vectors.filter(F.size("x") == first[0][0])
    rows = alike.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(ENTRIES).select("x").collect()
    x = np.array([r[0] for r in rows], np.int64).reshape(len(rows), PARTS, -1)
    return np.ascontiguousarray(x.transpose(1, 0, 2))


def refine(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every entry becomes the floor of the mean of the parts that are nearest to it."""
    dims = books.shape[2]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(book) for book in books]
        total, count = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            x = part_arrays(batch, 0)
            for part, s in enumerate(slices):
                entry, _ = s.nearest(x[:, part])
                np.add.at(total[part], entry, x[:, part])
                count[part] += np.bincount(entry, minlength=books.shape[1])
        part, entry = np.nonzero(count)
        columns = [pa.array(part), pa.array(entry), pa.array(count[part, entry])]
        columns += [pa.array(total[part, entry, d]) for d in range(dims)]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", *[f"s{d}" for d in range(dims)]])

    schema = "part long, entry long, n long, " + ", ".join(f"s{d} long" for d in range(dims))
    parts = vectors.select("x").mapInArrow(sums, schema)
    exact = [F.sum(F.col(f"s{d}").cast("decimal(20,0)")) for d in range(dims)]
    rows = parts.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*exact).alias("s")).collect()
    out = books.copy()
    for r in rows:
        out[r.part, r.entry] = [int(s) // r.n for s in r.s]
    return out


def digest(books: np.ndarray | None) -> str:
    """SHA-256 of all entries' integers by part, entry and position."""
    numbers = [] if books is None else books.reshape(-1).tolist()
    return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every vector; two hex digits per part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(book) for book in books]
        for batch in batches:
            x = part_arrays(batch, 2)
            found = [s.nearest(x[:, part]) for part, s in enumerate(slices)]
            codes = np.stack([entry for entry, _ in found], axis=1)
            error = sum(distance for _, distance in found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(["".join(f"{e:02x}" for e in row) for row in codes.tolist()], pa.string()),
                 pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

    return vectors.mapInArrow(run, "vec_id long, label long, code string, error long")


def label_errors(coded: DataFrame) -> DataFrame:
    """Adds label_error: the error summed over rows of one label.

    Sums are combined before they are shuffled, and come back to the rows of a label over salts."""
    total = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(20,0)")).try_cast("long").alias("label_error"))
    return spread_join(coded, total, ["label"], F.xxhash64("vec_id", "code"))


def compress(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Per kept vector: vec_id, code, error, label_error, codebooks_sha256."""
    small_batches(vectors.sparkSession)
    kept = store(integers(vectors), "integers")
    books = start(kept)
    if books is None:
        return vectors.sparkSession.createDataFrame(
            [], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    kept = kept.filter(F.size("x") == PARTS * books.shape[2])
    for _ in range(rounds):
        books = refine(kept, books)
    coded = store(encode(kept, books), "codes")
    return label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
