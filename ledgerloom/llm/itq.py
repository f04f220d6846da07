"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A bounded sample of the vectors gives a mean, principal axes and, by alternating
sign codes and an orthogonal Procrustes fit, a rotation after which the signs of
a vector's coordinates make a balanced binary code; vectors with fewer than BITS
components get the other bits from random directions.  Every vector is coded.
The code is cut into parts and indexed in one table for each ``match`` of them:
two vectors are candidates if any ``match`` parts are equal and the whole codes
differ in at most ``radius`` bits.  Each candidate pair is looked at once, in the
first table in which it meets, and reranked with the original vectors: a link
needs a cosine of at least ``least`` in double precision.

A bucket of a table is dealt into blocks of about BLOCK vectors, and a task
compares two blocks by matrix products.  It returns, not the links, but how many
vectors each of its vectors is linked with, and a spanning forest of the links:
rows in proportion to its vectors, from which links are counted and components
built.  Most buckets are one block; one that holds a third of all vectors is
spread over the pairs of its blocks.

How many bits a pair at the threshold differs in depends on the data: where the
vectors share a common direction, its angle about the mean is far wider than its
own.  So DRAWS vectors of the sample get partners at a cosine of exactly
``least``, half of them anywhere and half along differences of the sample, and
the radius and the first tables of LADDER are taken that bring RECALL of either
half together.  Where none do, and for vectors of another length than the
sample's most common one, the code's directions are random and not about the
mean: then the bits that a pair differs in follow from its cosine alone, so the
recall is the same for any data, at the price of more candidates.

Vectors are compared only within an equal label.  Rows with equal label and
direction-defining components (the same vector) are one class and go on as one
row with a count, so copies are never paired with each other.

Defined cases: a null label, a null or empty vector, a zero vector, and null,
NaN or infinite components link with nothing (n_links 0, own component, kept);
rows with the same vec_id and vector count as two vectors that are linked;
vectors of different lengths are never linked; extra columns are ignored; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import store
from ledgerloom.llm.graph import components
from ledgerloom.llm.spread import spread_join
from ledgerloom.llm.text import PRIME, mix

BITS = 64
RADIUS = 12                     # the least radius
#: (bits of a part, parts, parts that have to be equal), from the fewest chance candidates to the most.
LADDER = ((8, 8, 2), (7, 9, 2), (6, 10, 2), (8, 8, 1), (7, 9, 1), (6, 10, 1))
RECALL, DRAWS = 0.98, 8000
BLOCK = 512                     # vectors of a bucket that a task compares with as many others
FEW = 16                        # groups of so few vectors are compared together, pair by pair
SAMPLE = 4000
ROUNDS = 30
COSINE = 0.98


def directions(size: int, n: int = BITS) -> np.ndarray:
    """``n`` random directions of ``size`` dimensions, the same ones every time."""
    return np.random.RandomState(size).normal(size=(size, n))


@dataclass(frozen=True)
class Code:
    """``signs((x - mean) @ axes)`` for vectors of the length it was learnt for, signs along random directions for others."""

    mean: np.ndarray
    axes: np.ndarray

    def of(self, x: np.ndarray) -> np.ndarray:
        """The BITS-bit code of every row, as a signed 64-bit number."""
        z = (x - self.mean) @ self.axes if x.shape[1] == len(self.mean) else x @ directions(x.shape[1])
        return ((z > 0).astype(np.uint64) << np.arange(BITS, dtype=np.uint64)).sum(axis=1, dtype=np.uint64).view(np.int64)


def learn(x: np.ndarray, rounds: int = ROUNDS) -> Code:
    """Principal axes and the rotation that brings the data nearest to its own signs."""
    mean = x.mean(axis=0)
    _, _, axes = np.linalg.svd(x - mean, full_matrices=False)
    axes = axes[:BITS].T
    v = (x - mean) @ axes
    rotation = np.linalg.qr(np.random.RandomState(7).normal(size=(axes.shape[1],) * 2))[0]
    for _ in range(rounds):
        u, _, w = np.linalg.svd(np.where(v @ rotation > 0, 1.0, -1.0).T @ v)
        rotation = (u @ w).T
    return Code(mean, np.concatenate([axes @ rotation, directions(x.shape[1], BITS - axes.shape[1])], axis=1))


def undirected(size: int) -> Code:
    """A code of random directions alone."""
    return Code(np.zeros(size), directions(size))


@dataclass(frozen=True)
class Plan:
    """The tables over the code; with ``match`` 0 there are none."""

    width: int
    parts: int
    match: int
    radius: int

    def meet(self, differ: np.ndarray) -> np.ndarray:
        """Whether codes that differ in these bits are candidates."""
        return (np.bitwise_count(self.equal(differ)) >= self.match) & (np.bitwise_count(differ) <= self.radius)

    def equal(self, differ: np.ndarray) -> np.ndarray:
        """The parts without a differing bit, as a bit mask."""
        part, out = np.uint64((1 << self.width) - 1), np.zeros(differ.shape, np.uint16)
        for i in range(self.parts):
            out |= ((differ >> np.uint64(i * self.width)) & part == 0).astype(np.uint16) << np.uint16(i)
        return out

    def first(self, differ: np.ndarray) -> np.ndarray:
        """The first table in which codes that differ in these bits meet, as the mask of its parts."""
        equal = self.equal(differ)
        lowest = equal & (~equal + np.uint16(1))
        if self.match == 1:
            return lowest
        rest = equal ^ lowest
        return np.where(rest > 0, lowest | (rest & (~rest + np.uint16(1))), np.uint16(0))


EVERY = Plan(BITS, 1, 0, BITS)


def partners(x: np.ndarray, noise: np.ndarray, least: float) -> np.ndarray:
    """For every row of ``x``, a unit vector at a cosine of ``least`` in the direction of ``noise``."""
    noise = noise - (noise * x).sum(axis=1, keepdims=True) * x
    size = np.sqrt((noise * noise).sum(axis=1, keepdims=True))
    return least * x + np.sqrt(max(0.0, 1 - least * least)) * noise / np.maximum(size, 1e-12)


def differences(code: Code, x: np.ndarray, least: float) -> list[np.ndarray]:
    """The bits in which the codes of vectors like ``x`` and their partners differ, for the two kinds of partners."""
    rng = np.random.RandomState(11)
    draw = lambda: x[rng.randint(0, len(x), DRAWS // 2)]
    out = []
    for noise in (rng.normal(size=(DRAWS // 2, x.shape[1])), draw() - draw()):
        a = draw()
        out.append((code.of(a) ^ code.of(partners(a, noise, least))).view(np.uint64))
    return out


def chosen(differ: list[np.ndarray]) -> Plan:
    """The radius and the first tables of LADDER that bring RECALL of these pairs together; EVERY if none do."""
    radius = max(RADIUS, *(int(np.quantile(np.bitwise_count(d), 0.999, method="higher")) for d in differ))
    tables = (Plan(*step, radius) for step in LADDER)
    return next((p for p in tables if all(p.meet(d).mean() >= RECALL for d in differ)), EVERY)


def plan(x: np.ndarray, least: float) -> Plan:
    """The tables and the radius that bring pairs at the threshold together.

    A code fits the vectors it was learnt from better than others, so one half of the sample is coded as the other half says.
    """
    return chosen(differences(learn(x[::2]), x[1::2], least)) if len(x) > 1 else EVERY


def unit_rows(column: pa.Array) -> list[np.ndarray | None]:
    """Each vector in double precision at length 1; None where it can't be compared."""
    out: list[np.ndarray | None] = []
    for item in column:
        x = None if not item.is_valid or item.values.null_count else item.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
        if x is None or not len(x) or not np.isfinite(x).all():
            out.append(None)
            continue
        big = np.abs(x).max()
        if big == 0:
            out.append(None)
            continue
        x = x / big                          # no overflow in the norm
        out.append(x / np.sqrt((x * x).sum()))
    return out


def rows(vectors: DataFrame) -> DataFrame:
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")


def train(vectors: DataFrame, sample: int = SAMPLE, least: float = COSINE) -> tuple[Code, Plan]:
    """The code and its tables from the ``sample`` rows that come first by hash of vec_id."""
    some = rows(vectors).filter("embedding IS NOT NULL AND label IS NOT NULL").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample)
    found = [x for x in unit_rows(some.select("embedding").toArrow().column(0).combine_chunks()) if x is not None]
    sizes = [len(x) for x in found]
    size = max(sorted(set(sizes)), key=sizes.count) if sizes else 1
    x = np.stack([x for x in found if len(x) == size]) if found else np.ones((1, size))
    by = plan(x, least)
    if by.match:
        return learn(x), by
    code = undirected(size)
    by = chosen(differences(code, x, least))
    return code, by if by.match else Plan(*LADDER[-1], BITS)


CODED = "vec_id long, label long, node long, code long, unit array<double>"


def coded(vectors: DataFrame, code: Code) -> DataFrame:
    """Per vector: vec_id, label, node (the class: hash of label and components), code, unit; null node if not comparable."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = unit_rows(batch.column(2))
            labels = batch.column(1).to_pylist()
            nodes, codes = [None] * len(units), [0] * len(units)
            by_size: dict[int, list[int]] = {}
            for i, x in enumerate(units):
                if x is not None and labels[i] is not None:
                    by_size.setdefault(len(x), []).append(i)
                else:
                    units[i] = None
            for at in by_size.values():
                x = np.stack([units[i] for i in at])
                h = np.array([labels[i] for i in at], np.int64).view(np.uint64) + np.uint64(x.shape[1])
                for k in range(x.shape[1]):
                    h = mix(h * PRIME + x[:, k].copy().view(np.uint64))
                for i, node, c in zip(at, h.view(np.int64).tolist(), code.of(x).tolist()):
                    nodes[i], codes[i] = node, c
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(codes, pa.int64()),
                 pa.array([None if x is None else x for x in units], pa.list_(pa.float64()))],
                names=["vec_id", "label", "node", "code", "unit"])

    return rows(vectors).mapInArrow(run, CODED)


TABLED = ["key", "place", "label", "size"]
PAIR = [*TABLED, "low", "high"]


def tabled(classes: DataFrame, by: Plan) -> DataFrame:
    """(node, columns of PAIR, block): one row per class, table in which it meets another one, and pair of blocks of
    that bucket which its own block (a hash of the class) is in."""
    part = lambda code, i: F.shiftrightunsigned(code, i * by.width).bitwiseAND(F.lit((1 << by.width) - 1))
    places = F.array(*[F.struct(F.lit(sum(1 << i for i in t)).alias("place"),
                                F.xxhash64(F.lit(sum(1 << i for i in t)), *[part(F.col("code"), i) for i in t]).alias("key"))
                       for t in combinations(range(by.parts), by.match)])
    keys = classes.select("node", "label", F.size("unit").alias("size"), F.explode(places).alias("t")).select(
        "node", "label", "size", "t.place", "t.key")
    shared = keys.groupBy(*TABLED).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        *TABLED, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    met = spread_join(keys, shared, TABLED, F.xxhash64(F.lit(5), "node"))
    met = met.withColumn("block", F.pmod(F.xxhash64(F.lit(3), "node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return met.select("node", *TABLED, "block", other).select(
        "node", *TABLED, "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of an undirected graph, given as a boolean matrix."""
    left, out = np.ones(len(linked), bool), []
    for start in range(len(linked)):
        if not left[start]:
            continue
        left[start], front = False, [start]
        while front:
            a = front.pop()
            new = np.flatnonzero(linked[a] & left)
            left[new] = False
            out += [(a, b) for b in new.tolist()]
            front += new.tolist()
    return out


class Found:
    """What a task's comparisons come to: linked vectors per node, and edges."""

    def __init__(self, by: Plan, least: float):
        self.by, self.least = by, least
        self.nodes, self.others, self.a, self.b = [], [], [], []

    def few(self, group: np.ndarray, node, code, members, unit, block, cross, place) -> None:
        """Rows of small groups, pair by pair; ``cross`` says that only rows of different blocks are compared."""
        for step in range(1, FEW):
            i = np.flatnonzero(group[:-step] == group[step:]) if len(group) > step else np.zeros(0, int)
            if not len(i):
                break
            j = i + step
            differ = code[i] ^ code[j]
            ok = (np.bitwise_count(differ) <= self.by.radius) & (self.by.first(differ) == place[i]) & (~cross[i] | (block[i] != block[j]))
            i, j = i[ok], j[ok]
            near = np.einsum("ij,ij->i", unit[i], unit[j]) >= self.least
            i, j = i[near], j[near]
            self.nodes += [node[i], node[j]]
            self.others += [members[j], members[i]]
            self.a.append(node[i])
            self.b.append(node[j])

    def many(self, node, code, members, unit, block, cross: bool, place: int) -> None:
        """One large group: one block with itself, or two blocks."""
        one = block == block[0] if cross else np.ones(len(node), bool)
        x, y = np.flatnonzero(one), np.flatnonzero(~one) if cross else np.flatnonzero(one)
        if not len(y):
            return
        differ = code[x][:, None] ^ code[y][None, :]
        linked = (np.bitwise_count(differ) <= self.by.radius) & (self.by.first(differ) == place)
        if not cross:
            np.fill_diagonal(linked, False)
        if not linked.any():
            return
        linked &= unit[x] @ unit[y].T >= self.least
        if cross:
            graph = np.zeros((len(node),) * 2, bool)
            graph[np.ix_(x, y)] = linked
            graph |= graph.T
        else:
            graph = linked | linked.T
        some = graph.any(axis=1)
        self.nodes.append(node[some])
        self.others.append(graph[some] @ members)
        edges = forest(graph)
        self.a.append(node[[a for a, _ in edges]] if edges else node[:0])
        self.b.append(node[[b for _, b in edges]] if edges else node[:0])

    def batch(self) -> pa.RecordBatch:
        empty = np.zeros(0, np.int64)
        node, at = np.unique(np.concatenate([*self.nodes, empty]), return_inverse=True)
        others = np.zeros(len(node), np.int64)
        np.add.at(others, at, np.concatenate([*self.others, empty]))
        a, b = np.concatenate([*self.a, empty]), np.concatenate([*self.b, empty])
        self.nodes, self.others, self.a, self.b = [], [], [], []
        nulls = pa.nulls(len(node), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([node, a])), pa.concat_arrays([nulls, pa.array(b)]),
             pa.array(np.concatenate([others, np.zeros(len(a), np.int64)]))], names=["a", "b", "others"])


def links(classes: DataFrame, by: Plan, least: float = COSINE) -> DataFrame:
    """Rows (a, null, others): so many vectors of other classes are linked with class a, added up over the rows of a;
    and rows (a, b, 0): links between classes that connect what is connected."""
    rows = tabled(classes, by).join(classes.select("node", "code", "members", "unit"), "node")
    rows = rows.select(*PAIR, "block", "node", "code", "members", "unit").repartition(*PAIR).sortWithinPartitions(*PAIR)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, left = Found(by, least), None
        for batch in batches:
            table = pa.Table.from_batches([batch] if left is None else [*left.to_batches(), batch])
            keys = [table.column(c).to_numpy() for c in PAIR]
            new = np.concatenate([[True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys])])
            last = int(np.flatnonzero(new)[-1])
            left = table.slice(last)                       # its group may go on
            if last:
                compare(found, table.slice(0, last))
                yield found.batch()
        if left is not None:
            compare(found, left)
            yield found.batch()

    return rows.mapInArrow(run, "a long, b long, others long")


def compare(found: Found, table: pa.Table) -> None:
    """All whole groups of ``table``, those of one vector length at a time."""
    size = table.column("size").to_numpy()
    for length in np.unique(size).tolist():
        at = np.flatnonzero(size == length)
        some = table.take(pa.array(at)).combine_chunks()
        column = lambda c: some.column(c).to_numpy()
        keys = [column(c) for c in PAIR]
        group = np.cumsum(np.concatenate([[True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys])])) - 1
        code, node, members, block, place = column("code").view(np.uint64), column("node"), column("members"), column("block"), column("place")
        unit = np.concatenate([c.flatten().to_numpy() for c in some.column("unit").chunks]).reshape(len(at), length)
        cross = column("low") != column("high")
        count = np.bincount(group)
        small = count[group] <= FEW
        found.few(group[small], node[small], code[small], members[small], unit[small], block[small], cross[small], place[small])
        for g in np.flatnonzero(count > FEW):
            i = slice(*np.searchsorted(group, [g, g + 1]))
            found.many(node[i], code[i], members[i], unit[i], block[i], bool(cross[i.start]), int(place[i.start]))


def near_vectors(vectors: DataFrame, least: float = COSINE, sample: int = SAMPLE) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    code, by = train(vectors, sample, least)
    all_rows = store(coded(vectors, code), "codes")
    classes = store(all_rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("members"), F.first("label").alias("label"),
        F.first("code").alias("code"), F.first("unit").alias("unit")), "classes")
    found = store(links(classes, by, least), "links")
    roots = components(found.filter("b IS NOT NULL").select("a", "b"))
    others = found.filter("b IS NULL").groupBy("a").agg(F.sum("others").alias("others"))
    named = classes.select("node", "rep", "members").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = spread_join(named, named.groupBy("root").agg(F.min("rep").alias("component")), ["root"], F.xxhash64("node"))
    named = named.join(others.withColumnRenamed("a", "node"), "node", "left").select(
        "node", "component", (F.col("members") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    out = spread_join(all_rows.select("vec_id", "node"), named, ["node"], F.xxhash64("vec_id"), "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                     F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
