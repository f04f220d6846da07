"""Bronze landing.

Raw files are read against a fixed contract (or, on request, with inference),
stamped with audit columns and written as one folder
``_batch_id=<id>/_version=<microseconds>`` of a Parquet (or other) table.  A new
batch id adds rows; landing the same id again supersedes that batch and no
other, also when the replay has no rows.  The table is what the last version of
each batch holds; superseded versions stay, so the table can be read as of any
earlier moment, from the folders' names alone.

A version is written to a staging folder, which readers don't see, and moved to
its place when it is complete: a write that is killed leaves the table as it was.
(A store whose renames are copies may show a version while it is being moved;
use one whose renames are atomic.)
"""

from __future__ import annotations

import re
import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerloom.session import lean_disk
from ledgerloom.sources import files
from ledgerloom.sources.contracts import BRONZE_AUDIT, CORRUPT_RECORD, require_schema, with_corrupt_column
from ledgerloom.sources.tables import observed

BATCH_COLUMN = "_batch_id"
VERSION_COLUMN = "_version"
STAGING = "_staging"            # a leading underscore hides it from readers
_BATCH_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def new_batch_id() -> str:
    """One id per run: ``yyyyMMddHHmmss`` in UTC, sortable as text."""
    return datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S")


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | None = None,
             infer: bool = False, keep_corrupt: bool = True) -> DataFrame:
    """Header CSV scan.

    With a ``schema`` (the default way) fields that do not parse become NULL and
    the raw line is kept in ``_corrupt_record`` (PERMISSIVE mode); no inference
    pass.  ``infer=True`` reproduces the reference's ``inferSchema`` read.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None:
        full = with_corrupt_column(schema) if keep_corrupt else schema
        reader = reader.schema(full).option("columnNameOfCorruptRecord", CORRUPT_RECORD)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def with_audit(df: DataFrame, batch_id: str, source: str | None = None, at: datetime | None = None) -> DataFrame:
    """``_ingested_at``, ``_source_file``, ``_batch_id``.

    ``_source_file`` is ``source`` if given, else a column of that name that the
    frame already has, else the per-row file path from the scan metadata.
    ``_ingested_at`` is ``at`` if given, else the time of the job.
    """
    if source is not None:
        src = F.lit(source)
    else:
        src = F.col("_source_file" if "_source_file" in df.columns else "_metadata.file_path")
    return df.withColumns({
        "_ingested_at": F.current_timestamp() if at is None else F.lit(at),
        "_source_file": src,
        BATCH_COLUMN: F.lit(batch_id),
    })


def land(df: DataFrame | list[DataFrame], bronze_path: str, batch_id: str, source: str | None = None,
         expected: list[str] | None = None, fmt: str = "parquet", partition_by: list[str] | None = None) -> int:
    """S2 + S7: write one version of a batch of a Bronze table and return its row count.

    The count is observed during the write itself (no second pass).  Landing the
    same ``batch_id`` again supersedes that batch only.  ``partition_by`` adds
    business columns below the version's folder.  A batch may come in parts
    (``tables.passes``): they are written one after the other, under one
    ``_ingested_at``, and become visible together.
    """
    if not _BATCH_ID.fullmatch(batch_id):
        raise ValueError(f"a batch id is letters, digits, '.', '_' and '-': {batch_id!r}")
    parts = df if isinstance(df, list) else [df]
    if expected:
        require_schema(parts[0], expected, "landed batch")
    spark, root = parts[0].sparkSession, bronze_path.rstrip("/")
    staged, rows, at = f"{root}/{STAGING}/{uuid.uuid4().hex}", 0, datetime.now(timezone.utc) if len(parts) > 1 else None
    for part in parts:
        obs = Observation(f"land_{batch_id}")
        with lean_disk(spark):
            audited = with_audit(part, batch_id, source, at).drop(BATCH_COLUMN).observe(obs, F.count(F.lit(1)).alias("rows"))
            writer = audited.write.format(fmt).mode("append").option("partitionOverwriteMode", "static")
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            writer.save(staged)
        rows += int(observed(obs).get("rows", 0))
    # Versions ascend within the table, whatever the clock does; a place taken by another writer is passed over.
    version = max([time.time_ns() // 1000, *(int(v) + 1 for _, v in versions(spark, root)[-1:])])
    while not files.publish(spark, staged, f"{root}/{BATCH_COLUMN}={batch_id}/{VERSION_COLUMN}={version:020d}"):
        version += 1
    return rows


def versions(spark: SparkSession, bronze_path: str) -> list[tuple[str, str]]:
    """(batch id, version) of every landing, in the order in which they became visible."""
    found = files.matching(spark, f"{bronze_path.rstrip('/')}/{BATCH_COLUMN}=*/{VERSION_COLUMN}=*")
    pairs = [tuple(part.split("=", 1)[1] for part in path.split("/")[-2:]) for path in found]
    return sorted(pairs, key=lambda p: (p[1], p[0]))


def _last(landed: list[tuple[str, str]]) -> list[tuple[str, str]]:
    return sorted(dict(landed).items())


def _read(spark: SparkSession, bronze_path: str, chosen: list[tuple[str, str]], fmt: str, contract: StructType | None = None) -> DataFrame:
    """The chosen versions as one frame, under ``contract`` if there is one (without, under the schema of one of them).

    Batch ids are the text they are (partition discovery would turn 007 into 7)."""
    root = bronze_path.rstrip("/")
    if not chosen:
        raise ValueError(f"nothing has landed in {bronze_path}")
    paths = [f"{root}/{BATCH_COLUMN}={b}/{VERSION_COLUMN}={v}" for b, v in chosen]
    reader = spark.read.format(fmt).option("basePath", root)
    text = {BATCH_COLUMN, VERSION_COLUMN}
    found = reader.load(paths).schema.fields
    if contract is not None:
        own = {f.name for f in contract.fields}
        found = [*contract.fields, *(f for f in found if f.name not in own and f.name in (*text, *BRONZE_AUDIT))]
    declared = StructType([StructField(f.name, StringType()) if f.name in text else f for f in found])
    rows = spark.read.format(fmt).option("basePath", root).schema(declared).load(paths)
    return require_schema(rows.drop(VERSION_COLUMN), list(BRONZE_AUDIT), "bronze table")


def read_bronze(spark: SparkSession, bronze_path: str, fmt: str = "parquet", contract: StructType | None = None) -> DataFrame:
    """The Bronze table as it is now, audit columns included: the last version of every batch."""
    return _read(spark, bronze_path, _last(versions(spark, bronze_path)), fmt, contract)


def read_batch(spark: SparkSession, bronze_path: str, batch_id: str, fmt: str = "parquet") -> DataFrame:
    """The last version of one batch; no other folder is read."""
    return _read(spark, bronze_path, [p for p in _last(versions(spark, bronze_path)) if p[0] == batch_id], fmt)


def version_at(moment: datetime) -> str:
    """The version that a landing at ``moment`` would have had."""
    return f"{int(moment.astimezone(timezone.utc).timestamp() * 1_000_000):020d}"


def as_of(spark: SparkSession, bronze_path: str, batch_id: str | None = None, version: str | datetime | None = None,
          fmt: str = "parquet") -> DataFrame:
    """The table as it was when ``batch_id`` was last landed, or right after ``version`` (one of ``versions``, or a moment).

    Of every batch the last version up to then: rows that a later replay has superseded are there again, rows it
    brought are not.  Ids need no order.  Nothing landed until then is an error.
    """
    landed = versions(spark, bronze_path)
    if (batch_id is None) == (version is None):
        raise ValueError("as of a batch or of a version")
    if batch_id is not None:
        version = dict(landed).get(batch_id, "")
    until = version_at(version) if isinstance(version, datetime) else version
    return _read(spark, bronze_path, _last([p for p in landed if p[1] <= until]), fmt)


def expire_versions(spark: SparkSession, bronze_path: str, before: str | datetime) -> list[tuple[str, str]]:
    """Removes the versions that no ``as_of`` from ``before`` on reads, and says which.  Staging folders of
    writes that failed go too, so no other landing may run meanwhile."""
    until, root = version_at(before) if isinstance(before, datetime) else before, bronze_path.rstrip("/")
    landed = versions(spark, root)
    needed = {*_last([p for p in landed if p[1] <= until]), *(p for p in landed if p[1] > until)}
    gone = [p for p in landed if p not in needed]
    for batch, version in gone:
        files.remove(spark, f"{root}/{BATCH_COLUMN}={batch}/{VERSION_COLUMN}={version}")
    files.remove(spark, f"{root}/{STAGING}")
    return gone


def without_batch(bronze: DataFrame, batch_id: str) -> DataFrame:
    """Roll a bad batch back (read side)."""
    return bronze.filter(F.col(BATCH_COLUMN) != F.lit(batch_id))


def quarantine_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a contract-read frame into (good rows, malformed rows)."""
    if CORRUPT_RECORD not in df.columns:
        return df, df.limit(0)
    bad = F.col(CORRUPT_RECORD).isNotNull()
    return df.filter(~bad).drop(CORRUPT_RECORD), df.filter(bad)
