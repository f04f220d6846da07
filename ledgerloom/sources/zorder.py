"""Tables clustered by several columns at once.

A table sorted by customer is fast for one customer and slow for one day.  Here
each column is cut into 2**BITS ranges of about equal numbers of rows, the bits
of the ranges' numbers are interleaved (a Z-order), and rows are range-partitioned
and sorted by that number: every file and row group then covers a small part of
each column, and Parquet's minima and maxima let a filter on either skip most of
them.  The number is made of column expressions and is not stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 6


def cuts(df: DataFrame, columns: list[str], bits: int = BITS) -> dict[str, list]:
    """Per column the distinct values that part it into 2**bits ranges of about equal size; one row reaches the driver."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in columns]).first()
    return {c: sorted(set(found[c] or [])) for c in columns}


def interleaved(ranges: list[Column], bits: int = BITS) -> Column:
    """The bits of the numbers, the first column's highest."""
    key = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for r in ranges:
            key = key * 2 + F.shiftright(r.cast("long"), bit).bitwiseAND(F.lit(1).cast("long"))
    return key


def zorder_key(df: DataFrame, columns: list[str], bits: int = BITS) -> Column:
    """The Z-order number of a row: NULLs lie in the first range."""
    at = cuts(df, columns, bits)

    def number(c: str) -> Column:
        if not at[c]:
            return F.lit(0)
        bounds = F.array(*[F.lit(v) for v in at[c]]).cast(f"array<{df.schema[c].dataType.simpleString()}>")
        return F.when(F.col(c).isNull(), 0).otherwise(F.size(F.filter(bounds, lambda b: b <= F.col(c))))

    return interleaved([number(c) for c in columns], bits)


def write_clustered(df: DataFrame, path: str, columns: list[str], files: int | None = None, bits: int = BITS) -> None:
    """Writes ``df`` (stored or cheap: it is read three times, for the cuts, the ranges and the rows) in Z-order.

    ``files`` is the number of ranges, by default the session's shuffle partitions.
    """
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("_z", zorder_key(df, columns, bits))
    keyed.repartitionByRange(n, "_z", *columns).sortWithinPartitions("_z", *columns).drop("_z").write.mode("overwrite").parquet(path)
