"""Near-duplicate documents by b-bit MinHash.

A document's set is its distinct 5-word shingles (64-bit hashes; with fewer
words the whole sequence is the one shingle).  Documents with equal sets form a
class and go on as one row.  Per class:

* HASHES minima of the set under random multiply-shift functions;
* keys, each a hash of a band of BAND_ROWS full minima: classes that share a key are
  candidates.  ``bands`` takes so many that at the threshold all of them miss with
  probability under MISS: 28 for 85 percent, 44 for 80;
* the lowest BITS bits of every minimum, packed into 64-bit words.  The share m
  of equal BITS-bit values, counted by bit operations, estimates similarity as
  (m - c) / (1 - c) with c = 2**-BITS for chance collisions.

Candidates are tried in two steps, so that a group of n near copies is not
turned into n^2 pairs:

1. In every bucket all classes are compared with one hub, the class with the
   largest buckets overall (the one nearest to the group's common text).
   Confirmed links give components.
2. What a star leaves open are pairs of one bucket that lie in different
   components.  The classes of such a bucket are taken as their symmetric
   differences from one reference set, the class with the largest buckets in the
   component of the bucket's hub.  With d the size of a difference, two sets x, y
   are linked if their differences share at least c elements, where
   2 c = d(x) + d(y) - (|x| + |y|) * (100 - percent) / (100 + percent), and c is
   over 0 unless both are linked with the reference itself.  So with the elements
   in one order, those seldom shared first, linked sets share one of the first
   d(x) - c + 1 and d(y) - c + 1.  Only pairs that do are tried: copies of one
   text with changes of their own share nothing there, however many they are.

In both steps a pair goes on if its sizes allow the threshold and its estimate
is within ``margin`` of it, and every link is confirmed on the full sets:
100 * intersection >= percent * union, with a ``percent`` of 85 unless the caller
gives another.  There is no cap.  What can be lost is a pair at the threshold
without a common key (MISS) or with an estimate of DEVIATIONS standard deviations
too low, about one in 10^9; a document is lost to its component only if that
holds for all of its links.

Defined cases: null or empty text, or text without words, has an empty set
(n_shingles 0), is linked with nothing and kept; null doc_ids are never a
component's name unless it has no other; rows with the same doc_id and equal
sets are one class, and rows with the same doc_id and different sets are
different classes; extra columns are ignored by ``duplicates`` and kept by
``deduplicate``; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import map_rows, store
from ledgerloom.llm.graph import components
from ledgerloom.llm.spread import spread_join
from ledgerloom.llm.text import LOWER, PRIME, hashes, mix, slices, spans, windows

SHINGLE = 5
HASHES, BITS = 512, 2
BAND_ROWS, MISS = 6, 2e-6
DEVIATIONS = 6
LANES = HASHES * BITS // 64
PERCENT = 85
CHANCE = 2.0 ** -BITS
_RANDOM = np.random.RandomState(85).randint(1, 2**63 - 1, (2, HASHES), dtype=np.int64).astype(np.uint64)
FACTORS = (_RANDOM[0] << np.uint64(1)) | np.uint64(1)
OFFSETS = _RANDOM[1]


def bands(percent: int) -> int:
    """How many bands leave a pair at the threshold without a common key with probability under MISS."""
    number = ceil(log(MISS) / log(1 - (percent / 100) ** BAND_ROWS)) if percent < 100 else 1
    if number * BAND_ROWS > HASHES:
        raise ValueError(f"{HASHES} minima are too few for pairs at {percent} percent")
    return number


def margin(percent: int) -> float:
    """DEVIATIONS standard deviations of the estimate at the threshold."""
    match = CHANCE + (1 - CHANCE) * percent / 100
    return DEVIATIONS * (match * (1 - match) / HASHES) ** 0.5 / (1 - CHANCE)


# ------------------------------------------------------------------ sets and signatures, in Arrow batches

def shingles(buf: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text, A-Z in lower case."""
    buf = LOWER[buf]
    rows = len(off) - 1
    start, end, row = spans(buf, off)
    h = hashes(buf, start, end)
    grams, at = windows(h, row, SHINGLE)
    gram_row = row[at]
    words = np.bincount(row, minlength=rows)
    cut, first = np.searchsorted(gram_row, np.arange(rows + 1)), np.searchsorted(row, np.arange(rows))
    out = []
    for i in range(rows):
        if words[i] >= SHINGLE:
            out.append(np.unique(grams[cut[i]:cut[i + 1]]))
        elif words[i]:
            whole = np.full(1, words[i], np.uint64)
            for x in h[first[i]:first[i] + words[i]]:
                whole = mix((whole ^ (whole >> np.uint64(32))) * PRIME + x)
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def fingerprint(items: np.ndarray) -> int:
    """A 64-bit hash of a set."""
    h = mix(items + np.uint64(len(items)))
    total = h.sum(dtype=np.uint64, keepdims=True) * PRIME + np.bitwise_xor.reduce(h, keepdims=True) + np.uint64(len(items))
    return int(mix(total).view(np.int64)[0])


def minima(sets: list[np.ndarray], block: int = 1 << 15) -> np.ndarray:
    """HASHES minima of every set (all ones for an empty one); sets are taken together in blocks of bounded size."""
    low = np.full((len(sets), HASHES), np.iinfo(np.uint64).max, np.uint64)
    size = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(size)
    lo = 0
    while lo < len(full):
        hi = lo + max(1, int(np.searchsorted(np.cumsum(size[full[lo:]]), block, "right")))
        at = full[lo:hi]
        items = np.concatenate([sets[i] for i in at])
        begin = np.cumsum(size[at]) - size[at]
        out = np.empty_like(items)
        for k in range(HASHES):
            np.multiply(items, FACTORS[k], out=out)
            out += OFFSETS[k]
            low[at, k] = np.minimum.reduceat(out, begin)
        lo = hi
    return low


def band_keys(low: np.ndarray, number: int) -> np.ndarray:
    """One key for each of ``number`` bands, different between bands."""
    parts = mix(low[:, :number * BAND_ROWS]).reshape(len(low), number, BAND_ROWS)
    acc = np.broadcast_to(np.arange(number, dtype=np.uint64) * PRIME, parts.shape[:2]).copy()
    for j in range(BAND_ROWS):
        acc = mix(acc * PRIME + parts[:, :, j])
    return acc.view(np.int64)


def packed(low: np.ndarray) -> np.ndarray:
    """The low bits of all minima, LANES words per row."""
    bits = mix(low) & np.uint64((1 << BITS) - 1)      # multiply-shift leaves its lowest bits weak
    bits = bits.reshape(len(low), LANES, 64 // BITS)
    shift = np.arange(0, 64, BITS, dtype=np.uint64)
    return np.bitwise_or.reduce(bits << shift, axis=2).view(np.int64)


SIGNATURE_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_shingles", T.LongType()), T.StructField("node", T.LongType()),
    T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("lanes", T.ArrayType(T.LongType()))])


def signatures(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, node (its set's fingerprint), bands, lanes."""
    number = bands(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, off in slices(batch.column(1)):
                sets = shingles(buf, off)
                low = minima(sets)
                lists = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([fingerprint(s) for s in sets], pa.int64()), lists(band_keys(low, number)), lists(packed(low))],
                    names=SIGNATURE_SCHEMA.names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SIGNATURE_SCHEMA)


def sets_of(docs: DataFrame) -> DataFrame:
    """(node, items) of every document with words; one row per document, not per class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, buf, off in slices(batch.column(0)):
                sets = [s for s in shingles(buf, off) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([fingerprint(s) for s in sets], pa.int64()),
                     pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["node", "items"])

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "node long, items array<long>")


# ------------------------------------------------------------------ candidates and links, in Spark

def estimate(a: Column, b: Column) -> Column:
    """Collision-corrected similarity of two packed signatures."""
    low = int(sum(1 << i for i in range(0, 64, BITS)))
    equal = F.lit(HASHES)
    for k in range(LANES):
        x = a[k].bitwiseXOR(b[k])
        for j in range(1, BITS):
            x = x.bitwiseOR(F.shiftrightunsigned(a[k].bitwiseXOR(b[k]), j))
        equal = equal - F.bit_count(x.bitwiseAND(F.lit(low - (1 << 64) if low >= 1 << 63 else low)))
    return (equal / HASHES - CHANCE) / (1 - CHANCE)


def possible(percent: int) -> Column:
    """Whether the rows a and b (n_shingles, lanes) may be a pair, by their sizes and their estimate."""
    sizes = [F.col(f"{x}.n_shingles") * 100 >= F.col(f"{y}.n_shingles") * percent for x, y in ("ab", "ba")]
    return sizes[0] & sizes[1] & (estimate(F.col("a.lanes"), F.col("b.lanes")) >= percent / 100 - margin(percent))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("a_items"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("b_items"))
    common = F.size(F.array_intersect("a_items", "b_items"))
    union = F.size("a_items") + F.size("b_items") - common
    return pairs.join(left, "a").join(right, "b").filter(common * 100 >= union * percent).select("a", "b")


def differences(rest: DataFrame, sets: DataFrame) -> DataFrame:
    """``rest`` (node, ref and more) with n and ref_n, the sizes of both sets, and apart, the elements that only one of them has."""
    own = rest.join(sets, "node")
    refs = sets.select(F.col("node").alias("ref"), F.col("items").alias("ref_items"))
    both = spread_join(own, refs, ["ref"], F.xxhash64("node"))
    apart = F.concat(F.array_except("items", "ref_items"), F.array_except("ref_items", "items"))
    return store(both.select(*rest.columns, F.size("items").cast("long").alias("n"),
                             F.size("ref_items").cast("long").alias("ref_n"), apart.alias("apart")), "differences")


def meeting(apart: DataFrame, lanes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of different roots and one ref that may be linked by the first common element of their differences.

    With the elements of a difference in one order per ref, ``left`` of them from a common one on, a linked pair has
    2 * left >= d + other d - (n + other n) * far / all at its first common one, on both sides.
    """
    far, every = 100 - percent, 100 + percent
    each = apart.select("node", "root", "ref", F.explode("apart").alias("item"))
    shared = each.groupBy("ref", "item").agg(F.count(F.lit(1)).alias("holders"), F.min("root").alias("least"), F.max("root").alias("most"))
    shared = shared.filter("least <> most").select("ref", "item", "holders")
    # Elements within one root join nothing; they are first in the order and go no further.
    last = each.select("node", "ref", "item").join(shared, ["ref", "item"]).groupBy("node", "ref").agg(
        F.array_sort(F.collect_list(F.struct("holders", "item"))).alias("last"))
    rows = apart.withColumn("d", F.size("apart").cast("long")).drop("apart").join(last, ["node", "ref"])
    rows = rows.select("*", F.posexplode("last")).withColumn("left", F.size("last") - F.col("pos")).withColumn("item", F.col("col.item"))
    # Who is in the ref's component meets only sets that are not linked with the ref; of others, sizes and the
    # triangle say how far the differences' sizes are apart.
    inside = (2 * F.col("left") - F.col("d")) * every >= (F.col("ref_n") - F.col("n")) * far
    outside = (F.col("d") - F.col("left")) * percent <= F.col("n") * far
    rows = rows.filter(F.when(F.col("root") == F.col("ref_root"), inside).otherwise(outside))
    rows = rows.select("node", "root", "ref", "item", "n", "d", "left").join(lanes, "node")
    a, b = rows.alias("a"), rows.alias("b")
    meets = (F.col("a.ref") == F.col("b.ref")) & (F.col("a.item") == F.col("b.item")) & (F.col("a.node") < F.col("b.node"))
    meets &= F.col("a.root") != F.col("b.root")
    meets &= (2 * F.least("a.left", "b.left") - F.col("a.d") - F.col("b.d")) * every + (F.col("a.n") + F.col("b.n")) * far >= 0
    meets &= possible(percent)
    return a.join(b, meets).select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()


def links(docs: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame | None:
    """(node, root) of the linked classes; None without any.  ``classes``: node, rep, n_shingles, bands, lanes."""
    keys = classes.filter("n_shingles > 0").select("node", "n_shingles", F.posexplode("bands").alias("band", "key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    # Only what shares a bucket with another class goes on.
    members = store(keys.join(shared, "key"), "members")
    weight = members.groupBy("node").agg(F.sum("members").alias("weight"))
    members = store(members.join(weight, "node"), "weighted")
    if members.isEmpty():
        return None
    wanted = members.select("node").distinct().join(classes.select("node", "rep"), "node").select(F.col("rep").alias("wanted")).distinct()
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = held.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
    sets = store(sets_of(held).groupBy("node").agg(F.first("items").alias("items")), "sets")

    hubs = members.groupBy("key").agg(F.max(F.struct("weight", "node"))["node"].alias("hub"))
    stars = members.join(hubs, "key").filter("node <> hub").select(
        F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    lanes = classes.select("node", "n_shingles", "lanes")
    a, b = lanes.alias("a"), lanes.alias("b")
    likely = stars.alias("s").join(a, F.col("s.a") == F.col("a.node")).join(b, F.col("s.b") == F.col("b.node")).filter(possible(percent))
    first = store(confirmed(likely.select("s.a", "s.b"), sets, percent), "links")
    roots = components(first)

    named = members.select("key", "node", "weight").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    most = F.max(F.struct("weight", "node", "root"))
    mixed = named.groupBy("key").agg(most["root"].alias("ref_root"), F.min("root").alias("least"), F.max("root").alias("most"))
    refs = named.groupBy("root").agg(most["node"].alias("ref")).withColumnRenamed("root", "ref_root")
    mixed = mixed.filter("least <> most").join(refs, "ref_root").select("key", "ref", "ref_root")
    rest = named.join(mixed, "key").select("node", "root", "ref", "ref_root").filter("node <> ref").distinct()
    apart = differences(rest, sets)
    near = apart.filter(F.size("apart") * (100 + percent) <= (F.col("n") + F.col("ref_n")) * (100 - percent))
    near = near.filter("root <> ref_root").select(F.col("node").alias("a"), F.col("ref").alias("b"))
    pairs = meeting(apart, lanes, percent).join(stars, ["a", "b"], "left_anti")
    second = store(near.unionByName(confirmed(pairs, sets, percent)), "links")
    if second.isEmpty():
        return roots
    # The first components stand for all of their links.
    kept = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).filter("a <> b")
    return components(kept.unionByName(second))


def grouped(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """The signatures of every document, and (node, root, component) of every class with words."""
    found = store(signatures(docs, percent), "signatures")
    classes = store(found.filter("n_shingles > 0").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
        F.first("lanes").alias("lanes")), "classes")
    roots = links(docs, classes, percent)
    named = classes.select("node", "rep")
    if roots is None:
        return found, named.select("node", F.col("node").alias("root"), F.col("rep").alias("component"))
    named = named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("rep").alias("component"))
    return found, named.join(least, "root").select("node", "root", "component")


def duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    rows, named = grouped(docs, percent)
    name = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", "node").join(named, "node", "left").select("doc_id", "n_shingles", name.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("doc_id").isNull() & F.col("component_id").isNull()))


def deduplicate(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: all without words, and of every component one row.

    It is the row with the component's own id; of equal ids the lowest fingerprint; of rows with equal ids and
    sets the least text, then the least of the other columns (by their JSON text).
    """
    rows, named = grouped(docs, percent)
    best = rows.filter("n_shingles > 0").select("doc_id", "node").join(named, "node").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("best"))
    keep = best.select(F.concat_ws("/", F.col("best.node"), F.col("best.doc_id")).alias("__key__"))
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, off in slices(batch.column(text)):
                nodes = pa.array([fingerprint(s) if len(s) else None for s in shingles(buf, off)], pa.int64())
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, nodes], names=[*batch.schema.names, "__node__"])

    marked = map_rows(docs, run, [T.StructField("__node__", T.LongType())])
    marked = marked.withColumn("__key__", F.concat_ws("/", "__node__", F.col("doc_id").cast("long")))
    own = marked.filter("__node__ IS NOT NULL").join(keep, "__key__", "left_semi")
    own = own.select(*[F.col(f"`{c}`") for c in marked.columns]).toDF(*[f"c{i}" for i in range(len(marked.columns))])
    row = [F.col(f"c{i}") for i in range(len(docs.columns))]
    order = F.struct(row[text], F.to_json(F.struct(*[c for i, c in enumerate(row) if i != text])))
    one = own.groupBy(own.columns[-1]).agg(F.min_by(F.struct(*row), order).alias("r")).select("r.*").toDF(*docs.columns)
    return marked.filter("__node__ IS NULL").drop("__node__", "__key__").unionByName(one)
