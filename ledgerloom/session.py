"""Session factory (S10) and the shared scratch location.

The library never builds its own session inside an operator: every function takes
DataFrames, and the few that write take ``spark`` explicitly.  ``get_spark`` is a
convenience for scripts, tests and the bench.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_spark(app_name: str = "ledgerloom", master: str | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build or fetch a session with the settings the library relies on.

    * session time zone pinned to UTC, so casting strings or NTZ values to
      timestamps never depends on the machine (SURVEY Q6, oracle facts);
    * AQE on, with partition coalescing and skew-join splitting;
    * ANSI left on (Spark 4 default); operators use ``try_*`` where reference
      semantics expect NULL instead of an error.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # getOrCreate may return an existing session: apply the runtime SQL confs anyway.
    for key, value in conf.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    return spark


#: Bytes of input, or of a shuffle, that one task reads.  Rows grow about twentyfold from Parquet to a sort or a
#: hash map, so a task's share stays in memory where Spark's defaults (128 and 64 MB) would spill.
TASK_BYTES = 16 << 20
_TASK_CONF = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")


def small_tasks(spark: SparkSession) -> None:
    """Lowers the session's task sizes to TASK_BYTES: more tasks for the same rows, and aggregates that don't spill."""
    for key in _TASK_CONF:
        if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)) > TASK_BYTES:
            spark.conf.set(key, f"{TASK_BYTES}b")


_BLOOM = "spark.sql.optimizer.runtime.bloomFilter"
#: What keeps a step small on disk.  The files of its shuffles go when the job that wrote them ends, where the default
#: waits until the driver collects garbage; a semi-join that has to shuffle drops rows by a Bloom filter of 8 MB (fit for
#: some eight million keys) before it does, whatever the tables' sizes; and Parquet is written in Zstandard.
_LEAN_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", f"{_BLOOM}.enabled": "true",
              f"{_BLOOM}.applicationSideScanSizeThreshold": "1b", f"{_BLOOM}.creationSideThreshold": "1g",
              f"{_BLOOM}.expectedNumItems": str(8 << 20), f"{_BLOOM}.maxNumItems": str(8 << 20),
              f"{_BLOOM}.numBits": str(8 << 23), f"{_BLOOM}.maxNumBits": str(8 << 23),
              "spark.sql.parquet.compression.codec": "zstd"}


@contextmanager
def lean_disk(spark: SparkSession) -> Iterator[None]:
    """Within it, jobs run with _LEAN_CONF.  A frame made within it is for one run: its shuffles are gone after that."""
    before = {key: spark.conf.get(key, None) for key in _LEAN_CONF}
    for key, value in _LEAN_CONF.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for written tables and checkpoints.

    It is read from ``spark.checkpoint.dir`` (which the cluster names) or the
    context's checkpoint folder.  Only a session of one process (``local`` or
    ``local[n]``: tests, a laptop), where no other machine has to read it, gets a
    folder of its own if neither is set; anywhere else that is an error.
    """
    current = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique table location under the shared folder, deleted when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path
