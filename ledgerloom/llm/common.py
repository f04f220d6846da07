"""Small shared pieces of the operators."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import scratch_path

WORD = "[^\\x20\\x09-\\x0D]+"
GAP = "[\\x20\\x09-\\x0D]+"


#: Bytes and rows of an Arrow batch.  Each running task holds a few batches, in the JVM and in its worker.
BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20, "spark.sql.execution.arrow.maxRecordsPerBatch": 2000}


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to BATCH, so that long texts don't fill a worker's memory."""
    for key, most in BATCH.items():
        now = int(spark.conf.get(key).rstrip("b"))
        if now <= 0 or now > most:
            spark.conf.set(key, most)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Writes the frame to the cluster's shared folder and reads it back: later
    branches share the rows, and a lost executor costs a read."""
    spark = df.sparkSession
    small_batches(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, run: Callable, extra: list[T.StructField] | None = None) -> DataFrame:
    """``mapInArrow`` over all columns, whatever their names: ``run`` sees them as c0, c1, ... and
    returns them (and then the ``extra`` ones); the result has the old names again."""
    small_batches(df.sparkSession)
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    schema = T.StructType([*plain.schema.fields, *(extra or [])])
    return plain.mapInArrow(run, schema).toDF(*df.columns, *[f.name for f in extra or []])


def id_text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def fold(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 3; 1 is held out."""
    return F.crc32(id_text(doc_id).cast("binary")) % 3


def labelled(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, text, n_chars, y) of at most ``per_class`` documents of each label, stored.

    Only documents with a text and outside the held-out fold count, the lowest
    by hash of doc_id; an id with two different labels is left out, and of rows
    with the same doc_id one counts, the least by hash of its text.  The bound
    is what a model may learn labels from; everything else covers all rows.
    Warns where either label has no document.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    marks = marks.filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & (fold(F.col("doc_id")) != 1))
    marks = marks.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("most")).filter("y = most").drop("most")
    n_chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       n_chars.alias("n_chars")).filter("text IS NOT NULL")
    there = marks.join(rows.select("doc_id"), "doc_id", "left_semi")
    pick = lambda y: there.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
    # At most 2 * per_class rows of two numbers.
    chosen = rows.join(F.broadcast(pick(0).unionByName(pick(1))), "doc_id")
    one = chosen.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "n_chars")).alias("r"))
    sample = store(one.select("doc_id", "r.text", "r.n_chars", "y"), "labelled")
    found = {r["y"] for r in sample.select("y").distinct().collect()}
    if found != {0, 1}:
        warnings.warn(f"no document with a text is labelled {label} = {sorted({0, 1} - found)}: nothing can be learnt", stacklevel=3)
    return sample
