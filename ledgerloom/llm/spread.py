"""Joins and numbering that survive a key with a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salts(df: DataFrame) -> int:
    """As many salts as the session has shuffle partitions, so they grow with the cluster."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def spread_join(rows: DataFrame, one: DataFrame, keys: list[str], salt: Column, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``one``, which has at most one row per key, on columns that may be null.

    The rows of a hot key are dealt over salts.  Only those (key, salt) pairs that occur are made, by a
    distinct that is combined before its shuffle, so the copies of ``one`` are never more than ``rows``,
    and a key has at most one copy per salt.
    """
    n = salts(rows)
    dealt = rows.withColumn("_salt", F.pmod(salt, F.lit(n)).cast("int"))
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    pairs = dealt.select(*keys, "_salt").distinct()
    extra = [c for c in one.columns if c not in keys]
    copies = pairs.alias("p").join(one.alias("o"), same("p", "o")).select("p.*", *[f"o.{c}" for c in extra])
    joined = dealt.alias("r").join(copies.alias("c"), [*same("r", "c"), F.col("r._salt") == F.col("c._salt")], how)
    return joined.select(*[f"r.{c}" for c in rows.columns], *[f"c.{c}" for c in extra])
