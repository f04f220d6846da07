"""Repeated byte strings by prefix doubling over a sorted set of positions.

A byte goes if it is covered by a string of LENGTH bytes that starts anywhere
else too.  Prefix doubling ranks all positions by their first bytes, then again
and again by the pair (rank, rank at an offset), with growing offsets, and lets
go of a position once its rank is unique or its string is long enough.  A row
per byte and round would be many times the input, so only some positions carry
ranks; no repeated string is lost by that:

* Inside a task the names of all strings of LENGTH // BASE bytes are built by doubling (1, 2,
  4, ... bytes).  The *anchor* of a LENGTH-byte string is the place of the least
  name within it, so equal strings have their anchors at the same offset.  One
  row per anchor stands for all starts that share it.
* Round 0 sorts the anchors by (name, name of the whole stretch that their
  starts cover).  An anchor whose name is unique is done: none of its strings
  repeats.  Where the stretch repeats, all its starts do.  One stretch of each
  kind goes on if its name also has a stretch that doesn't repeat.
* The next rounds sort pairs (rank, name of the bytes next to what has been
  ranked) for ever fewer starts: a node is a run of WIDTHS[i] offsets from the
  anchor, and its *core* is what all strings that start there have in common,
  LENGTH - WIDTHS[i] + 1 bytes, the core of the round before with some bytes
  more on either side.  A core with a unique rank ends its starts; a node whose
  own bytes repeat as a whole is repeated in all its starts; other nodes are
  ranked again by longer cores, until a core is the LENGTH-byte string itself.

Every round is one global sort in which rows are compared with their neighbours
(``runs.marked``), so a passage that a third of all documents share is spread
over many partitions.  Names and ranks of round 1 on have 128 bits.

Texts are told apart by two 64-bit hashes, so copies of a document are fetched,
cut and hashed once.  Text travels compressed.

Defined cases: a null text is empty; texts under LENGTH bytes lose nothing and
never repeat; repeated rows repeat each other's strings; cuts may fall inside a
character (the result is bytes); extra columns are ignored; an empty table gives
an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import small_batches, store
from ledgerloom.llm.runs import marked
from ledgerloom.llm.spread import spread_join
from ledgerloom.llm.text import PRIME, mix

LENGTH = 200
BASE = 4                        # round 0 names strings of a BASE-th of the length
WIDTHS = (25, 5, 1)             # starts of a node in the rounds after it
PIECE = 1 << 20                 # bytes a task looks at in one step
PLACE_BITS = 24
ANCHOR = "name long, stretch long, ta long, tb long, lo long, left int, right int"


def joined(a: np.ndarray, b: np.ndarray, offset: int) -> np.ndarray:
    """The names of pairs: ``a`` at a place, then ``b`` at ``offset`` after it."""
    n = len(b) - offset
    return mix(a[:n] * PRIME + b[offset:offset + n])


def names(x: np.ndarray, length: int) -> np.ndarray:
    """The 64-bit name of every string of ``length`` bytes, by doubling."""
    power, size = x.astype(np.uint64) + np.uint64(1), 1
    out, done = (power, 1) if length & 1 else (None, 0)
    while size * 2 <= length:
        power, size = joined(power, power, size), size * 2
        if length & size:
            out, done = (power, size) if out is None else (joined(out, power, done), done + size)
    return out


def least_in(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by doubling."""
    size = 1
    while size * 2 <= width:
        values, size = np.minimum(values[:-size], values[size:]), size * 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text, place, bytes) in groups of about PIECE; a longer text comes in pieces that overlap by length - 1."""
    group, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(0, len(text) - length + 1), PIECE):
            group.append((i, at, text[at:at + PIECE + length - 1]))
            size += len(group[-1][2])
            if size >= PIECE:
                yield group
                group, size = [], 0
    if group:
        yield group


def anchors(texts: list[bytes], length: int, base: int) -> Iterator[tuple]:
    """Arrays (text, name, stretch, lo, left, right): the anchor is at lo + left, its starts are lo to lo + left - right.

    ``left`` and ``right`` are the greatest and the least offset of the anchor from a start.
    """
    low = np.uint64((1 << PLACE_BITS) - 1)
    for group in pieces(texts, length):
        joint = b"".join(p[2] for p in group)
        sizes = np.array([len(p[2]) for p in group])
        ends = np.cumsum(sizes)
        name = names(np.frombuffer(joint, np.uint8), base)
        value = (name & ~low) | np.arange(len(name), dtype=np.uint64)
        anchor = (least_in(value, length - base + 1) & low).astype(np.int64)
        owner = np.repeat(np.arange(len(group)), sizes)[:len(anchor)]
        start = np.flatnonzero(np.arange(len(anchor)) + length <= ends[owner])
        anchor, owner = anchor[start], owner[start]
        first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])])
        final = np.r_[first[1:] - 1, len(start) - 1]
        lo, hi, anchor, owner = start[first], start[final], anchor[first], owner[first]
        view = memoryview(joint)
        stretch = np.array([xxhash.xxh3_64_intdigest(view[a:b + length]) for a, b in zip(lo.tolist(), hi.tolist())], np.uint64)
        text, place = np.array([p[0] for p in group])[owner], np.array([p[1] for p in group])[owner]
        begin = ends[owner] - sizes[owner]
        yield text, name[anchor].view(np.int64), stretch.view(np.int64), lo - begin + place, anchor - lo, anchor - hi


def texts_of(docs: DataFrame) -> DataFrame:
    """(ta, tb, text as bytes) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(text.alias("text"))
    return rows.select(*text_name(F.col("text")), F.col("text").cast("binary").alias("text"))


def text_name(text) -> list:
    return [F.xxhash64(F.lit(1), text).alias("ta"), F.xxhash64(F.lit(2), text).alias("tb")]


def anchor_rows(texts: DataFrame, length: int, base: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ta, tb = (batch.column(i).to_numpy() for i in (0, 1))
            for text, name, stretch, lo, left, right in anchors(batch.column(2).to_pylist(), length, base):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name), pa.array(stretch), pa.array(ta[text]), pa.array(tb[text]), pa.array(lo),
                     pa.array(left, pa.int32()), pa.array(right, pa.int32())],
                    names=["name", "stretch", "ta", "tb", "lo", "left", "right"])

    return texts.mapInArrow(run, ANCHOR)


def packed(texts: DataFrame, length: int) -> DataFrame:
    """One row (ta, tb, z) per different text of at least ``length`` bytes, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            z = pa.array([press.compress(t) for t in batch.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), z], names=["ta", "tb", "z"])

    long = texts.filter(F.octet_length("text") >= length)
    return long.mapInArrow(run, "ta long, tb long, z binary").dropDuplicates(["ta", "tb"])


STRETCH = "name long, stretch long, ta long, tb long, lo long, left int, right int, closed boolean, bytes binary"


def fetched(texts: DataFrame, needed: DataFrame, length: int) -> DataFrame:
    """The bytes of the ``needed`` stretches, from their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for ta, tb, z, spots in zip(*(c.to_pylist() for c in batch.columns)):
                text = press.decompress(z)
                out += [(s["name"], s["stretch"], ta, tb, s["lo"], s["left"], s["right"], s["closed"],
                         text[s["lo"]:s["lo"] + s["left"] - s["right"] + length]) for s in spots]
            if out:
                kinds = (*[pa.int64()] * 5, pa.int32(), pa.int32(), pa.bool_(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                 names=[f.split()[0] for f in STRETCH.split(", ")])

    # A text's spots are at most one per byte of it.
    spots = needed.groupBy("ta", "tb").agg(F.collect_list(F.struct("name", "stretch", "lo", "left", "right", "closed")).alias("spots"))
    return packed(texts, length).join(spots, ["ta", "tb"]).select("ta", "tb", "z", "spots").mapInArrow(run, STRETCH)


NODE = "core binary, own binary, name long, stretch long, x int, px int, py int, closed boolean"


def ranked(nodes: DataFrame, width: int, length: int) -> DataFrame:
    """The nodes' children, ``width`` offsets each.

    ``nodes`` are stretches with x, y (the first and last offset of the node) and rank, the key of the node's core.
    core: the key of the pair (rank, bytes next to the core); own: with all bytes of the stretch's own starts.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = xxhash.xxh3_128_digest
        for batch in batches:
            out = []
            for name, stretch, left, right, closed, data, x0, y0, rank in zip(*(c.to_pylist() for c in batch.columns)):
                for x in range(x0, y0 + 1, width):
                    y = min(x + width - 1, y0)
                    px, py = max(x, right), min(y, left)
                    if px > py:
                        continue
                    # An offset o starts at byte left - o of the stretch.
                    begin, end = left - x, left - y + length
                    if rank is None:
                        pair = b"%d,%d;%d:" % (x, y, name) + data[begin:end]
                    else:
                        pair = b"%d,%d;" % (x, y) + rank + data[begin:left - x0] + data[left - y0 + length:end]
                    core = key(pair)
                    own = key(core + b"%d,%d;" % (px, py) + data[left - py:begin] + data[end:left - px + length])
                    out.append((core, own, name, stretch, x, px, py, closed))
            if out:
                kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                 names=[f.split()[0] for f in NODE.split(", ")])

    return nodes.select("name", "stretch", "left", "right", "closed", "bytes", "x", "y", "rank").mapInArrow(run, NODE)


def repeated_starts(texts: DataFrame, length: int = LENGTH, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """(ta, tb, first, last): runs of places in a text from which ``length`` bytes are found elsewhere too.

    ``widths`` descend to 1.
    """
    base = max(1, length // BASE)
    # Stored, for a range sort reads its input twice.
    live = marked(store(anchor_rows(texts, length, base), "anchors"), ["name"], ["stretch"], ["ta", "tb", "lo"], "live")
    hi = F.col("lo") + F.col("left") - F.col("right")
    found = [live.filter("same").select("ta", "tb", F.col("lo").alias("first"), hi.alias("last"))]
    heads = live.filter("head").withColumnRenamed("same", "closed").drop("head")
    names_open = heads.filter("NOT closed").select("name").distinct()
    needed = spread_join(heads, names_open, ["name"], F.xxhash64("stretch"))
    stretches = store(fetched(texts, needed, length), "stretches")
    nodes = stretches.withColumns({"x": F.lit(0), "y": F.lit(length - base), "rank": F.lit(None).cast("binary")})
    places = stretches.select("name", "stretch", "ta", "tb", F.col("lo").alias("lo"), "left")
    for width in widths:
        rows = marked(ranked(nodes, width, length), ["core"], ["own"], ["name", "stretch"], "ranks")
        repeated = rows.filter(F.col("same") & ~F.col("closed")).select("name", "stretch", "px", "py").join(places, ["name", "stretch"])
        at = F.col("lo") + F.col("left")
        found.append(repeated.select("ta", "tb", (at - F.col("py")).alias("first"), (at - F.col("px")).alias("last")))
        if width > 1:
            # One of the equal ones goes on, as something to compare with; it is repeated already.
            heads = rows.filter("head").select("name", "stretch", "x", F.least(F.col("x") + width - 1, F.lit(length - base)).alias("y"),
                                               F.col("core").alias("rank"), (F.col("same") | F.col("closed")).alias("closed"))
            cores_open = heads.filter("NOT closed").select("rank").distinct()
            heads = spread_join(heads, cores_open, ["rank"], F.xxhash64("name", "stretch"))
            nodes = heads.join(stretches.drop("closed"), ["name", "stretch"])
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


CUT = "ta long, tb long, n_removed long, n_spans long, kept binary"


def cut(texts: DataFrame, starts: DataFrame, length: int = LENGTH, digest: bool = False) -> DataFrame:
    """Per different text with repeated strings: what is left of it (or, with ``digest``, its SHA-256)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for ta, tb, z, spots in zip(*(c.to_pylist() for c in batch.columns)):
                text = press.decompress(z)
                spans: list[list[int]] = []
                for first, last in sorted((s["first"], s["last"] + length) for s in spots):
                    if spans and first <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], last)
                    else:
                        spans.append([first, last])
                at = [0, *[p for s in spans for p in s], len(text)]
                kept = b"".join(text[a:b] for a, b in zip(at[::2], at[1::2]))
                out.append((ta, tb, len(text) - len(kept), len(spans), hashlib.sha256(kept).digest() if digest else kept))
            if out:
                kinds = (*[pa.int64()] * 4, pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                 names=[f.split()[0] for f in CUT.split(", ")])

    # Copies of a text have the same spots: at most one per byte of it.
    spots = starts.groupBy("ta", "tb").agg(F.collect_set(F.struct("first", "last")).alias("spots"))
    return packed(texts, length).join(spots, ["ta", "tb"]).select("ta", "tb", "z", "spots").mapInArrow(run, CUT)


def remove(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, kept): every document's bytes without the repeated ones."""
    small_batches(docs.sparkSession)
    texts = texts_of(docs)
    cuts = store(cut(texts, repeated_starts(texts, length), length), "cuts")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.cast("binary").alias("text"), *text_name(text))
    out = spread_join(rows, cuts, ["ta", "tb"], F.xxhash64("doc_id"), "left")
    return out.select("doc_id", F.coalesce("kept", "text").alias("kept"))


def digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    small_batches(docs.sparkSession)
    texts = texts_of(docs)
    cuts = store(cut(texts, repeated_starts(texts, length), length, digest=True), "cuts")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"),
                       F.sha2(text.cast("binary"), 256).alias("whole"), *text_name(text))
    out = spread_join(rows, cuts, ["ta", "tb"], F.xxhash64("doc_id"), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("doc_id", "n_bytes", zero("n_removed"), zero("n_spans"),
                      F.coalesce(F.lower(F.hex("kept")), "whole").alias("kept_sha256"))
