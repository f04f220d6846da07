"""Layer tables on Parquet.

Writers overwrite (optionally only the partitions present in the frame) and
count rows through an ``Observation`` filled by the write, so a write is one
job, not two.  Period reads filter on the partition columns, which Catalyst
turns into partition pruning.
"""

from __future__ import annotations

import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import scratch_path
from ledgerloom.sources import files
from ledgerloom.sources.contracts import require_schema


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"       # the folder of a NULL partition value


def observed(obs: Observation) -> dict:
    """What a write has observed.  A plan that turns out to be empty while it runs is replaced by no plan at all,
    observation included; then there is nothing to be had and nothing was written."""
    try:
        return obs.get
    except Py4JJavaError as none:
        if "AssertionError" not in str(none.java_exception):
            raise
        return {}


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                dynamic: bool = False, sort_within: list[str] | None = None, fmt: str = "parquet",
                grouped: bool = False, append: bool = False) -> int:
    """Overwrite ``path`` and return the number of rows written.

    ``fmt`` is any installed file source (``parquet``, ``orc``, or a table format whose package is there).

    ``dynamic=True`` replaces only the partitions present in ``df`` (one month,
    one batch).  ``sort_within`` orders rows inside each file (O5) without a
    global sort.  ``grouped`` says that the frame is read from a table with the same
    partitions: its tasks hold few of them each, and no shuffle is needed.
    ``append=True`` adds to what is there.
    """
    obs = Observation("write_table")
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if partition_by and not grouped:
        # Cluster rows of a partition value into few tasks (few files per
        # directory); REBALANCE lets AQE split a partition value that is skewed.
        out = out.hint("rebalance", *partition_by)
    if sort_within:
        out = out.sortWithinPartitions(*sort_within)
    # Explicit either way, whatever the session's default.
    writer = out.write.format(fmt).mode("append" if append else "overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return int(observed(obs).get("rows", 0))


#: A pass reads at least so many bytes, and there are at most so many passes: a step's shuffles stand on disk for
#: one pass at a time, and every pass reads the input again.
PASS_BYTES, MOST_PASSES = 64 << 20, 4


def passes(df: DataFrame, key: str, size: int) -> list[DataFrame]:
    """The rows of ``df`` in parts by hash of ``key``, as many parts as ``size`` bytes of input ask for.

    Where ``key`` groups or joins the rows below, the optimizer takes the choice of a part down to the scans, and each part
    shuffles its share only.
    """
    n = max(1, min(MOST_PASSES, size // PASS_BYTES))
    return [df] if n == 1 else [df.filter(F.pmod(F.xxhash64(key), F.lit(n)) == i) for i in range(n)]


def write_passes(parts: list[DataFrame], path: str, partition_by: list[str] | None = None) -> int:
    """``write_table`` for a table in parts, written one after the other beside ``path`` and published when all are there."""
    if len(parts) == 1:
        return write_table(parts[0], path, partition_by)
    spark, (folder, name) = parts[0].sparkSession, path.rstrip("/").rsplit("/", 1)
    staged = f"{folder}/_staging/{name}-{uuid.uuid4().hex}"
    rows = sum(write_table(part, staged, partition_by, append=True) for part in parts)
    files.remove(spark, path)
    if not files.publish(spark, staged, path):
        raise FileExistsError(f"{path} has been written by another run")
    return rows


def stored(df: DataFrame, name: str) -> DataFrame:
    """A table of the application: later steps share its rows, and a lost executor costs a read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, path: str, name: str, key: str, buckets: int | None = None) -> DataFrame:
    """Writes ``df`` in files by hash of ``key``, sorted by it, as the table ``name`` of the session's catalog.

    Tables with equally many buckets are joined and grouped by the key without an exchange.  One task reads a
    bucket, so this is for tables whose rows per key are bounded.  By default there are as many buckets as
    shuffle partitions.
    """
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(n, key).write.format("parquet").option("path", path).mode("overwrite")
     .bucketBy(n, key).sortBy(key).saveAsTable(name))
    return df.sparkSession.table(name)


def in_partitions(partitions: list[tuple], columns: list[str]) -> Column:
    """Whether a row lies in one of the partitions; plain comparisons, which prune folders."""
    one = lambda values: reduce(lambda a, b: a & b, [F.col(c).isNull() if v is None else F.col(c) == v
                                                     for c, v in zip(columns, values)])
    return reduce(lambda a, b: a | b, [one(p) for p in partitions], F.lit(False))


def replace_partitions(df: DataFrame, path: str, partition_by: list[str], partitions: list[tuple], grouped: bool = False) -> int:
    """Makes ``df`` the content of just these partitions of ``path`` and returns the number of rows written.

    All rows of ``df`` lie in them.  Other partitions keep their files; one that gets no rows is removed, which a
    dynamic overwrite alone would leave as it was.  ``df`` may read ``path``: folders change when all rows are written.
    ``grouped`` as in ``write_table``.
    """
    if not partitions:
        return 0
    folder = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(NO_VALUE))) for c in partition_by])
    obs = Observation("replace_partitions")
    seen = df.observe(obs, F.count(F.lit(1)).alias("rows"), F.collect_set(folder).alias("folders"))
    writer = (seen if grouped else seen.hint("rebalance", *partition_by)).write.format("parquet").mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).save(path)
    # One name per partition.
    written = observed(obs)
    filled = set(written.get("folders") or [])
    for values in partitions:
        name = "/".join(f"{c}={NO_VALUE if v is None else v}" for c, v in zip(partition_by, values))
        if name not in filled:
            files.remove(df.sparkSession, f"{path.rstrip('/')}/{name}")
    return int(written.get("rows") or 0)


def read_table(spark: SparkSession, path: str, required: list[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """A layer table by path."""
    df = spark.read.format(fmt).load(path)
    return require_schema(df, required, "layer table") if required else df


def read_period(spark: SparkSession, path: str, start: tuple[int, int], end: tuple[int, int],
                year: str = "txn_year", month: str = "txn_month") -> DataFrame:
    """Months ``start..end`` (inclusive, as (year, month)) of a table
    partitioned by ``year``/``month``; only those directories are read."""
    return spark.read.parquet(path).filter(period_filter(start, end, year, month))


def period_filter(start: tuple[int, int], end: tuple[int, int], year: str = "txn_year",
                  month: str = "txn_month"):
    """Plain comparisons of the partition columns, which a metastore can prune by too."""
    y, m = F.col(year), F.col(month)
    return (y.between(start[0], end[0]) & ((y > start[0]) | (m >= start[1])) & ((y < end[0]) | (m <= end[1])))


def last_months(end: tuple[int, int], n: int) -> tuple[tuple[int, int], tuple[int, int]]:
    """The ``n`` months ending with ``end`` as a (start, end) pair, e.g. "last 3 months"."""
    idx = end[0] * 12 + (end[1] - 1) - (n - 1)
    return (idx // 12, idx % 12 + 1), end


def export_csv(df: DataFrame, path: str) -> None:
    """Header CSV export (one directory of part files)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def verify_layer(df: DataFrame, required: dict | list[str], what: str = "layer", least_rows: int = 0) -> dict[str, int]:
    """Fail when contract columns are missing, have other types (``required``
    as a mapping) or there are fewer rows than ``least_rows``; else the row and
    column counts, which the reference printed."""
    require_schema(df, required, what)
    rows = df.count()
    if rows < least_rows:
        raise ValueError(f"{what} has {rows} rows, at least {least_rows} are expected")
    return {"rows": rows, "columns": len(df.columns)}
