"""Top-1 per group.

``ties="all"`` is the reference's ``rank() == 1`` -- every tied row survives,
which breaks a one-row-per-group grain (SURVEY Q1).  ``ties="one"`` (default)
keeps one row: highest value, then the smallest label.  Either way Catalyst
plans a ``WindowGroupLimit`` below the window, so each partition keeps only its
leading rows before the full sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, group: list[str], value: str, label: str, ties: str = "one") -> DataFrame:
    """Rows of ``df`` that rank first by ``value`` (descending) within ``group``."""
    if ties not in ("one", "all"):
        raise ValueError("ties must be 'one' or 'all'")
    if ties == "all":
        w = Window.partitionBy(*group).orderBy(F.col(value).desc())
        ranked = df.withColumn("_rank", F.rank().over(w))
    else:
        w = Window.partitionBy(*group).orderBy(F.col(value).desc(), F.col(label).asc_nulls_first())
        ranked = df.withColumn("_rank", F.row_number().over(w))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")
