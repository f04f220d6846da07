"""De-duplication on the way in (D1 as a stream): state for a while, late rows aside.

Two queries run one after the other over the same files, each with its own
checkpoint, each until there are no more files:

* the first keeps one row per id by ``dropDuplicatesWithinWatermark``: an id
  stays in the state store until the watermark (the latest event time seen,
  less ``delay``) has passed its row by ``delay``, so copies are found across
  micro-batches and restarts while the state holds ids of a bounded time;
* the second puts aside what the first could not take, with the reason:
  ``id`` (no id), ``time`` (no event time) or ``late`` (the row came after the
  watermark had passed it, and no copy of it has been accepted).

Both land their micro-batches in versioned Bronze tables under the query's id and
epoch, so a micro-batch that runs again after a failure takes its own place.

Copies are taken to be copies: of rows with one id the first to arrive stays, and
within a micro-batch any of them.  Where copies differ, land them all
(``landing_stream``) and let Silver choose.  For large state set
``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.sources import landing
from ledgerloom.streaming.landing_stream import file_stream, land_batches


@dataclass
class DedupRun:
    """Micro-batches of the first query, with the ids in its state after each and the ids it let go in each."""
    batches: int
    state: list[int]
    expired: list[int]


def unique_rows(stream: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """One row per id among the rows that have an id and an event time and aren't late."""
    usable = stream.filter(F.col(key).isNotNull()).withColumn("_event_time", F.col(event_time).try_cast("timestamp"))
    timed = usable.filter(F.col("_event_time").isNotNull()).withWatermark("_event_time", delay)
    return timed.dropDuplicatesWithinWatermark([key]).drop("_event_time")


def refused(batch: DataFrame, accepted: DataFrame | None, key: str, event_time: str) -> DataFrame:
    """The rows of ``batch`` whose id is not among the accepted ones, with the reason."""
    left = batch if accepted is None else batch.join(accepted.select(key), key, "left_anti")
    reason = F.when(F.col(key).isNull(), "id").when(F.col(event_time).try_cast("timestamp").isNull(), "time").otherwise("late")
    return left.withColumn("reason", reason).select(*batch.columns, "reason")


def dedup_stream(spark: SparkSession, landing_dir: str, schema: StructType, accepted_path: str, refused_path: str,
                 checkpoint: str, key: str = "transaction_id", event_time: str = "transaction_date", delay: str = "2 days",
                 fmt: str = "parquet", max_files_per_trigger: int = 64, options: dict | None = None) -> DedupRun:
    """Takes every new file under ``landing_dir``: unique rows to ``accepted_path``, the others' outcasts to ``refused_path``."""
    root = checkpoint.rstrip("/")
    stream = lambda: file_stream(spark, landing_dir, schema, fmt, max_files_per_trigger, options)
    batches, query = land_batches(unique_rows(stream(), key, event_time, delay), accepted_path, f"{root}/unique")

    def outcasts(batch: DataFrame) -> DataFrame:
        accepted = landing.read_bronze(batch.sparkSession, accepted_path) if landing.versions(spark, accepted_path) else None
        return refused(batch, accepted, key, event_time)

    land_batches(stream(), refused_path, f"{root}/refused", outcasts)
    steps = [p.stateOperators[0] for p in query.recentProgress if p.stateOperators]
    return DedupRun(batches, [s.numRowsTotal for s in steps], [s.numRowsRemoved for s in steps])
