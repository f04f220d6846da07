"""Incremental Bronze landing (optional S1 + S2 as a stream, SURVEY 2.14).

A file-source stream over a landing folder is processed with
``trigger(availableNow=True)``: everything present when the query starts is
taken in bounded micro-batches, then the query stops.  Each micro-batch is
landed through ``foreachBatch`` under the id of the query (which its checkpoint
keeps) and its epoch -- and since landing the same batch id replaces that batch,
one replayed after a failure (same query, epoch and files, per the checkpoint) is
idempotent, while another feed or a new checkpoint never meets its ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerloom.sources.landing import land


def epoch_batch_id(stream_id: str, epoch: int) -> str:
    return f"{stream_id}-{epoch:09d}"


def file_stream(spark: SparkSession, landing_dir: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int = 64, options: dict | None = None) -> DataFrame:
    """The files under ``landing_dir`` as a stream; ``_source_file`` is each row's own file."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.load(landing_dir).withColumn("_source_file", F.col("_metadata.file_path"))


def land_batches(stream: DataFrame, bronze_path: str, checkpoint: str,
                 change: Callable[[DataFrame], DataFrame] | None = None) -> tuple[int, StreamingQuery]:
    """Runs ``stream`` on all there is and lands each micro-batch (after ``change``); returns their number and the ended query."""
    epochs: list[int] = []

    def _land(batch: DataFrame, epoch: int) -> None:
        # The query's id, the same for all runs of a checkpoint; Spark hands it to the thread that runs the batch.
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not stream_id:
            raise RuntimeError("a micro-batch without the id of its query")
        land(change(batch) if change else batch, bronze_path, epoch_batch_id(stream_id, epoch))
        epochs.append(epoch)

    query = (stream.writeStream.foreachBatch(_land)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return len(epochs), query


def land_stream(spark: SparkSession, landing_dir: str, schema: StructType, bronze_path: str,
                checkpoint: str, fmt: str = "parquet", max_files_per_trigger: int = 64,
                options: dict | None = None) -> int:
    """Land every file under ``landing_dir`` into ``bronze_path``; returns the
    number of micro-batches run.  The checkpoint records which files are done, so
    a rerun lands only new files."""
    stream = file_stream(spark, landing_dir, schema, fmt, max_files_per_trigger, options)
    return land_batches(stream, bronze_path, checkpoint)[0]
