"""The prefix trie of conversations, by ROLLUP over positional turn columns.

A turn is named by two 64-bit hashes of (role, text) and the text's bytes.  A
conversation's turns are laid out in blocks of WIDTH positional columns t1, t2,
...; the first block has the turns 1 to WIDTH, the next one the following, and
every block row carries the node that the blocks before it lead to.  Then one

    GROUP BY block, node before, ROLLUP (t1, ..., tWIDTH)

aggregates all prefixes of all conversations together: the group with the first
j columns is the node at depth block * WIDTH + j, and grouping_id says j.

The node before a block is named by the XOR of 64-bit hashes of (turn, position)
over the turns before it, twice with different seeds, so it is a running
aggregate and needs no round per block; a long conversation's running values
are taken over segments of SEGMENT blocks first and then inside each.

Subtree sums come from the same ROLLUP.  Every node has a representative, its
smallest member; a conversation represents exactly the nodes of its path from
some depth ``own`` on.  Summed over the members c of a node at depth d,

* a childless node that c represents counts one leaf,
* depth d + 1 of c counts one child where c represents it, and
* the bytes of c's turns from d to own - 1 are the bytes that c shares with
  smaller members, turn by turn: together n_convs - 1 times each node's bytes.

So a first ROLLUP finds ``own`` and a second one has all columns.

Rows are sorted over the whole cluster by (conversation, turn, role, text), and
a conversation's positions continue over the partitions it spans, so one with a
third of all turns isn't one task's.  The digest of the conversations that end
at a node is read from runs of RUN joined ids, which the sorted partitions make
before the hash follows them.

Defined cases: null role or text is empty; turns go by (turn, role, text), null
turns first; repeated rows are repeated turns; rows without conv_id belong to no
conversation and are left out; c - c % 5 takes the remainder with the sign of c;
extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import small_batches, store
from ledgerloom.llm.spread import salts, spread_join

WIDTH = 8                       # positional columns of a block
SEGMENT = 1024                  # blocks of a segment
HEAD, STEP = 9, 5               # c takes crc32(c) % HEAD turns of c - c % STEP
RUN = 4096
SEEDS = (11, 23)                # of the two hashes
TURN_COLUMNS = [f"t{j}" for j in range(1, WIDTH + 1)]


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, position, turn): position from 1 in (turn, role, text) order; turn is (a, b, bytes)."""
    empty = F.lit("")
    role, text = (F.coalesce(F.col(c).cast("string"), empty) for c in ("role", "text"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                role.alias("role"), text.alias("text")).filter("conv_id IS NOT NULL")
    name = F.struct(*[F.xxhash64(F.lit(s), F.length("role"), "role", "text").alias(n) for s, n in zip(SEEDS, "ab")],
                    F.octet_length("text").cast("long").alias("bytes"))
    by = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    spread = rows.repartitionByRange(salts(rows), *by).sortWithinPartitions(*by)
    dealt = store(spread.select("conv_id", name.alias("t"), F.spark_partition_id().alias("part"),
                                F.monotonically_increasing_id().alias("row")), "turns")
    inside = Window.partitionBy("part", "conv_id").orderBy("row")
    # One row per partition and conversation in it; only those that span partitions have several.
    counts = dealt.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("conv_id", "part", before.alias("before"))
    placed = dealt.withColumn("i", F.row_number().over(inside)).join(offsets, ["conv_id", "part"])
    return placed.select("conv_id", (F.col("before") + F.col("i")).cast("long").alias("position"), "t")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: (conv_id, position, t) and one row (conv_id, length) each."""
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % STEP
    heads = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD).cast("long")
    convs = sizes.select("conv_id", "n", base.alias("base"), heads.alias("h"))
    lengths = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(lengths, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken"), F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("rest"))
    convs = store(convs, "rebuilt")
    # A base has at most STEP * 2 - 1 dependants and HEAD - 1 turns that they take.
    first = turns.filter(F.col("position") < HEAD).withColumnRenamed("conv_id", "base")
    shared = convs.filter("taken > 0").join(first, "base").filter("position <= taken").select("conv_id", "position", "t")
    own = spread_join(turns, convs.select("conv_id", "h", "taken"), ["conv_id"], F.col("position"))
    own = own.filter("position > h").select("conv_id", (F.col("position") - F.col("h") + F.col("taken")).alias("position"), "t")
    return shared.unionByName(own), convs.select("conv_id", (F.col("taken") + F.col("rest")).alias("length"))


def step_hash(t: Column, position: Column, which: int) -> Column:
    return F.xxhash64(F.lit(SEEDS[which]), t["a"], t["b"], position)


def xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def blocks(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Block rows: conv_id, block, ka, kb (the node before), bytes_before, and the columns t1, t2, ...

    A conversation without turns has one block without any.
    """
    slot = (F.col("position") - 1) % WIDTH
    block = F.expr(f"(position - 1) DIV {WIDTH}")
    pivot = [F.max(F.when(slot == j, F.col("t"))).alias(c) for j, c in enumerate(TURN_COLUMNS)]
    rows = turns.groupBy("conv_id", block.alias("block")).agg(
        *pivot, *[F.bit_xor(step_hash(F.col("t"), F.col("position"), k)).alias(c) for k, c in enumerate(("xa", "xb"))],
        F.sum("t.bytes").alias("bytes"))
    rows = store(rows.withColumn("segment", F.expr(f"block DIV {SEGMENT}")), "blocks")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    parts = rows.groupBy("conv_id", "segment").agg(F.bit_xor("xa").alias("xa"), F.bit_xor("xb").alias("xb"), F.sum("bytes").alias("bytes"))
    w = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv_id", "segment", zero(F.bit_xor("xa").over(w)).alias("sa"), zero(F.bit_xor("xb").over(w)).alias("sb"),
                         zero(F.sum("bytes").over(w)).alias("s_bytes"))
    w = Window.partitionBy("conv_id", "segment").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumns({"ia": zero(F.bit_xor("xa").over(w)), "ib": zero(F.bit_xor("xb").over(w)), "i_bytes": zero(F.sum("bytes").over(w))})
    placed = placed.join(parts, ["conv_id", "segment"]).select(
        "conv_id", "block", xor(F.col("sa"), F.col("ia")).alias("ka"), xor(F.col("sb"), F.col("ib")).alias("kb"),
        (F.col("s_bytes") + F.col("i_bytes")).alias("bytes_before"), *TURN_COLUMNS)
    nothing = [F.lit(None).cast(turns.schema["t"].dataType).alias(c) for c in TURN_COLUMNS]
    none = convs.filter("length = 0").select(
        "conv_id", *[F.lit(0).cast("long").alias(c) for c in ("block", "ka", "kb", "bytes_before")], *nothing)
    return placed.unionByName(none)


def rolled(rows: DataFrame, measures: str) -> DataFrame:
    """One row per node: block, ka, kb, t1, ..., level (columns of the node in its block) and the ``measures``.

    Groups that end in a column without a turn, and the empty level of any but the first block, are no nodes.
    """
    level = f"{WIDTH} - length(replace(lpad(bin(grouping_id()), {3 + WIDTH}, '0'), '0', ''))"
    groups = rows.sparkSession.sql(
        f"SELECT block, ka, kb, {', '.join(TURN_COLUMNS)}, {level} AS level, {measures} "
        f"FROM {{rows}} GROUP BY block, ka, kb, ROLLUP ({', '.join(TURN_COLUMNS)})", rows=rows)
    last = F.element_at(F.array(*[F.col(c).isNotNull() for c in TURN_COLUMNS]), F.greatest(F.col("level"), F.lit(1)))
    return groups.filter(F.when(F.col("level") == 0, F.col("block") == 0).otherwise(last))


def node_key(which: int, upto: Column) -> Column:
    """The running hash at the first ``upto`` columns of a block."""
    key = F.col("ka" if which == 0 else "kb")
    for j, c in enumerate(TURN_COLUMNS, 1):
        position = F.col("block") * WIDTH + j
        key = xor(key, F.when(upto >= j, step_hash(F.col(c), position, which)).otherwise(F.lit(0).cast("long")))
    return key


DEPTH = f"block * {WIDTH} + level"


def measured(rows: DataFrame) -> DataFrame:
    """The second ROLLUP.  ``rows`` are blocks with the conversation's length, own and leaf."""
    upto = F.col("bytes_before")
    columns = {"s0": F.greatest(F.col("own_bytes"), F.lit(0).cast("long")),
               "c0": ((F.col("own") <= 1) & (F.col("length") >= 1)).cast("int")}
    for j, c in enumerate(TURN_COLUMNS, 1):
        depth = F.col("block") * WIDTH + j
        columns[f"s{j}"] = F.greatest(F.col("own_bytes") - upto, F.lit(0).cast("long"))
        columns[f"c{j}"] = ((F.col("own") <= depth + 1) & (F.col("length") >= depth + 1)).cast("int")
        upto = upto + F.coalesce(F.col(c)["bytes"], F.lit(0).cast("long"))
    wide = rows.withColumns(columns)
    pick = lambda x: f"element_at(array({', '.join(f'{x}{j}' for j in range(WIDTH + 1))}), level + 1)"
    sums = [f"sum({x}{j}) AS {x}{j}" for x in "sc" for j in range(WIDTH + 1)]
    nodes = rolled(wide, ", ".join(["min(conv_id) AS conv_id", "count(*) AS n_convs", "sum(leaf) AS n_leaves", *sums]))
    level = F.col("level")
    return nodes.select(
        "conv_id", F.expr(DEPTH).cast("long").alias("depth"), "n_convs", F.expr(pick("c")).alias("n_children"), "n_leaves",
        F.expr(pick("s")).alias("saved_tokens"), node_key(0, level).alias("ka"), node_key(1, level).alias("kb"),
        node_key(0, level - 1).alias("pa"), node_key(1, level - 1).alias("pb"))


def end_digests(ends: DataFrame) -> DataFrame:
    """(ka, kb, ends_sha256): the conversations that end at a node, ascending, joined and hashed.

    ``ends`` has one row (ka, kb, conv_id) per conversation.  The sorted partitions join up to RUN ids of a
    node to one row; the hash then follows a node's rows in order.
    """
    order = ["ka", "kb", "conv_id"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []
        make = lambda rows: pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["ka", "kb", "first", "ids"])
        for batch in batches:
            done = []
            for a, b, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if (a, b) != key or len(ids) == RUN:
                    if ids:
                        done.append((*key, ids[0], ",".join(map(str, ids))))
                    key, ids = (a, b), []
                ids.append(conv)
            if done:
                yield make(done)
        if ids:
            yield make([(*key, ids[0], ",".join(map(str, ids)))])

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        make = lambda rows: pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string()))], names=["ka", "kb", "ends_sha256"])
        for batch in batches:
            done = []
            for a, b, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3))):
                if (a, b) != key:
                    if state is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = (a, b), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield make(done)
        if state is not None:
            yield make([(*key, state.hexdigest())])

    runs = ends.repartitionByRange(salts(ends), *order).sortWithinPartitions(*order).mapInArrow(join, "ka long, kb long, first long, ids string")
    runs = runs.repartition("ka", "kb").sortWithinPartitions("ka", "kb", "first")
    return runs.mapInArrow(follow, "ka long, kb long, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the rebuilt conversations' trie; columns as the module's text and op12 name them."""
    small_batches(conversations.sparkSession)
    turns, convs = rebuilt(store(numbered(conversations), "numbered"))
    convs = store(convs, "lengths")
    rows = store(blocks(turns, convs), "placed")
    # The first ROLLUP: which conversation represents a node, and whether the node has children.
    lengths = spread_join(rows, convs, ["conv_id"], F.col("block"))
    reps = rolled(lengths, f"min(conv_id) AS conv_id, max(length) AS longest").withColumn("depth", F.expr(DEPTH))
    reps = reps.groupBy("conv_id").agg(F.min(F.when(F.col("depth") > 0, F.col("depth"))).alias("own"),
                                       F.max((F.col("longest") == F.col("depth")).cast("int")).alias("leaf"))
    paths = convs.join(reps, "conv_id", "left").select(
        "conv_id", "length", F.coalesce("own", F.col("length") + 1).alias("own"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    # Bytes of the turns before ``own``, from the block that holds the last of them.
    cut = rows.select("conv_id", "block", "bytes_before", F.transform(F.array(*TURN_COLUMNS), lambda t: F.coalesce(t["bytes"], F.lit(0).cast("long"))).alias("sizes"))
    cut = cut.join(paths.withColumn("block", F.expr(f"(greatest(own - 1, 1) - 1) DIV {WIDTH}")), ["conv_id", "block"])
    inside = F.slice("sizes", 1, (F.col("own") - 1 - F.col("block") * WIDTH).cast("int"))
    own_bytes = F.col("bytes_before") + F.aggregate(inside, F.lit(0).cast("long"), lambda s, x: s + x)
    paths = store(cut.select("conv_id", "length", "own", "leaf", own_bytes.alias("own_bytes")), "paths")
    nodes = store(measured(spread_join(rows, paths, ["conv_id"], F.col("block"))), "nodes")
    # The node where a conversation ends: its last block.
    last = F.col("length") - F.col("block") * WIDTH
    ends = rows.join(convs.withColumn("block", F.expr(f"(greatest(length, 1) - 1) DIV {WIDTH}")), ["conv_id", "block"])
    ends = ends.select(node_key(0, last).alias("ka"), node_key(1, last).alias("kb"), "conv_id")
    parents = nodes.select(F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("depth").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    children = nodes.withColumn("above", F.col("depth") - 1)
    named = spread_join(children, parents, ["pa", "pb", "above"], F.col("conv_id"), "left")
    out = named.join(end_digests(ends), ["ka", "kb"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
