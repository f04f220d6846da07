"""Sharding by vector bin packing: bytes, tokens and rows are balanced together.

The law is ``bytes``: shards get nearly equal sums of sizes (UTF-8 bytes of the
text plus 16), and, as a second aim, nearly equal words and rows.  Rows with
equal texts form a group, and a group stays in one shard unless it alone would
take over half of a shard, in any of the three sums; then it is dealt in parts
of at most about that size.

Placing is greedy: the largest first, each item goes to the shard where the dot
product of its (bytes, tokens, rows) with the shard's residual capacity is
highest, all in shares of the whole, among the shards that still have room for
its bytes; where none has, to the one with the most room.  The items are the heavy groups, of which
there can be at most 3 * GRAIN because each has over 1/GRAIN of some sum, and
GRAIN bundles into which all other groups are hashed.  So the driver places at
most 4 * GRAIN items (plus 6 * shards parts), however many documents there are;
the sums behind them and everything per row are joins, aggregates and windows.

Defined cases: null text counts as empty (size 16, crc32 0); rows are ordered
within a shard by hash cell, doc_id, text_crc32, and rows equal in these are
interchangeable; extra columns are ignored by ``assign`` and kept by ``write``;
an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD, id_text, store

GRAIN = 8192
CELLS = 1024
SUMS = ("size", "tokens", "rows")
LAW = "bytes"
#: The law's own sum counts more than the others.
EMPHASIS = (4.0, 1.0, 1.0)


def measured(docs: DataFrame, carry: bool = False) -> DataFrame:
    """Per row: doc_id, size, text_crc32, tokens, group; with ``carry`` the whole row too."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"),
        F.xxhash64(text, F.crc32(text.cast("binary"))).alias("group"),
        F.pmod(F.xxhash64(id_text(F.col("doc_id")), text), F.lit(1 << 20)).cast("int").alias("draw"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []))


def place(items: np.ndarray, shards: int, emphasis: tuple = EMPHASIS) -> np.ndarray:
    """The shard of every item; ``items`` holds shares of the whole, one column for each sum."""
    residual = np.full((shards, items.shape[1]), 1.0 / shards)
    weights, out = np.array(emphasis), np.empty(len(items), np.int32)
    for i in np.lexsort((np.arange(len(items)), -items[:, 0])):
        fits = residual[:, 0] >= items[i, 0]
        score = np.where(fits, residual @ (items[i] * weights), -np.inf) if fits.any() else residual[:, 0]
        out[i] = best = int(np.argmax(score))
        residual[best] -= items[i]
    return out


def layout(rows: DataFrame, shards: int, grain: int) -> tuple[DataFrame, DataFrame]:
    """(heavy groups with their number of parts, shard of every item)."""
    spark = rows.sparkSession
    groups = rows.groupBy("group").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"),
                                       F.count(F.lit(1)).alias("rows"))
    total = [max(1, x or 0) for x in groups.agg(*[F.sum(c).alias(c) for c in SUMS]).first()]
    share = F.greatest(*[F.col(c) / F.lit(float(t)) for c, t in zip(SUMS, total)])
    bundle = F.when(share > 1.0 / grain, F.lit(-1)).otherwise(F.pmod(F.xxhash64("group"), F.lit(grain))).cast("int")
    # Heavy groups keep their key, all others add up in their bundle: at most 4 * grain rows.
    found = groups.withColumn("bundle", bundle).groupBy("bundle", F.when(F.col("bundle") < 0, F.col("group")).otherwise(F.lit(0)).alias("group")).agg(
        *[F.sum(c).alias(c) for c in SUMS]).toArrow().sort_by([("bundle", "ascending"), ("group", "ascending")])
    found = {c: found.column(c).to_numpy() for c in found.column_names}
    heavy = found["bundle"] < 0
    sums = np.stack([found[c] / float(t) for c, t in zip(SUMS, total)], axis=1)
    parts = np.where(heavy, np.ceil(sums.max(axis=1, initial=0.0) * shards * 2), 1).astype(int)
    parts = np.maximum(1, np.minimum(parts, found["rows"]))
    item = np.repeat(np.arange(len(parts)), parts)
    part = np.arange(len(item)) - np.repeat(np.cumsum(parts) - parts, parts)
    shares = sums[item] / parts[item, None]
    key = np.where(heavy, found["group"], found["bundle"])
    frame = lambda columns: spark.createDataFrame(pa.table(columns))
    heavies = frame({"group": pa.array(key[heavy], pa.int64()), "parts": pa.array(parts[heavy], pa.int32())})
    if (parts > 1).any():
        # Rows are dealt to the parts by hash: their real sums, at most 6 * shards rows.
        dealt = rows.join(F.broadcast(heavies.filter("parts > 1")), "group").groupBy(
            "group", F.pmod("draw", "parts").alias("part")).agg(
            F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")).collect()
        real = {(r["group"], r["part"]): [r[c] / t for c, t in zip(SUMS, total)] for r in dealt}
        for i in np.flatnonzero(heavy[item] & (parts[item] > 1)):
            shares[i] = real.get((int(key[item[i]]), int(part[i])), [0.0] * len(SUMS))
    shard = place(shares, shards)
    return heavies, frame({"heavy": pa.array(heavy[item], pa.bool_()), "key": pa.array(key[item], pa.int64()),
                           "part": pa.array(part, pa.int32()), "shard": pa.array(shard, pa.int32())})


def placed(rows: DataFrame, base: DataFrame, shards: int, grain: int) -> DataFrame:
    """``rows`` with shard and slot; ``base`` has the same rows without what they carry."""
    heavy, items = layout(base, shards, grain)

    def in_shards(rows: DataFrame) -> DataFrame:
        # Both frames have at most 4 * grain + 6 * shards short rows.
        rows = rows.join(F.broadcast(heavy), "group", "left").select(
            "*", F.col("parts").isNotNull().alias("heavy"),
            F.when(F.col("parts").isNotNull(), F.col("group")).otherwise(F.pmod(F.xxhash64("group"), F.lit(grain))).alias("key"),
            F.coalesce(F.pmod("draw", "parts"), F.lit(0)).cast("int").alias("part"))
        return rows.join(F.broadcast(items), ["heavy", "key", "part"]).withColumn(
            "cell", F.pmod(F.hash("draw"), F.lit(CELLS)))

    counts = in_shards(base).groupBy("shard", "cell").count()
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = counts.select("shard", "cell", (F.sum("count").over(before) - F.col("count")).alias("start"))
    inside = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "draw")
    return in_shards(rows).join(starts, ["shard", "cell"]).withColumn(
        "slot", F.col("start") + F.row_number().over(inside) - 1)


def assign(docs: DataFrame, shards: int = 40, grain: int = GRAIN) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, tokens."""
    rows = store(measured(docs), "shard-rows")
    return placed(rows, rows, shards, grain).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "tokens")


def write(docs: DataFrame, path: str, shards: int = 40, grain: int = GRAIN) -> None:
    """Writes the documents' own columns to ``path``, one folder ``shard=<n>`` each, every file in slot order."""
    rows = placed(measured(docs, carry=True), store(measured(docs), "shard-rows"), shards, grain)
    rows = rows.select("row.*", F.col("shard").alias("__shard__"), F.col("slot").alias("__slot__"))
    rows = rows.repartitionByRange("__shard__", "__slot__").sortWithinPartitions("__shard__", "__slot__")
    rows.drop("__slot__").withColumnRenamed("__shard__", "shard").write.partitionBy("shard").parquet(path)
