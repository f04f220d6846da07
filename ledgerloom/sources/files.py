"""Folders of a table through Hadoop's file system API: listing, sizes, publishing, removing.

Only names are handled here, one call per folder; rows are Spark's.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a glob, ascending; none if nothing does."""
    place, fs = _place(spark, pattern)
    return sorted(s.getPath().toString() for s in (fs.globStatus(place) or []))


def publish(spark: SparkSession, staged: str, target: str) -> bool:
    """Moves a finished folder to its place, in one step of the file system; False if the place is taken."""
    place, fs = _place(spark, target)
    if fs.exists(place):
        return False
    fs.mkdirs(place.getParent())
    return bool(fs.rename(_place(spark, staged)[0], place))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a path, 0 if there is no such path."""
    place, fs = _place(spark, path)
    return fs.getContentSummary(place).getLength() if fs.exists(place) else 0


def remove(spark: SparkSession, path: str) -> None:
    place, fs = _place(spark, path)
    fs.delete(place, True)
