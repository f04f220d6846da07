"""Quantiles of any period from stored monthly sketches.

Exact quartiles (``quality``) rank the histogram of the period they are asked
for.  A KLL sketch of a month is a few kilobytes whatever the month holds, and
the sketches of months merge to the sketch of their period, so later questions
read the stored sketches and no transaction.  The price is an error in rank: with
K the value returned for p lies between the exact quantiles of p - RANK_ERROR and
p + RANK_ERROR but for a chance of about one percent per question (the data
sketches library states 0.65 % at 99 % confidence for k = 400, single-sided; the
bound here leaves three times that).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 400
RANK_ERROR = 0.02


def monthly_sketches(df: DataFrame, column: str, keys: list[str], k: int = K) -> DataFrame:
    """One row per ``keys`` (say, year and month): the number of values and their sketch.  Partial sketches
    are made in the map tasks and merged after the shuffle."""
    return df.filter(F.col(column).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(column).cast("double"), k).alias("sketch"))


def merged(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of months to sketches of longer periods (or of all, without keys)."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles(sketches: DataFrame, probs: tuple[float, ...], names: tuple[str, ...]) -> DataFrame:
    """Adds one column per probability."""
    return sketches.withColumns({name: F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for p, name in zip(probs, names)})


def rank_check(df: DataFrame, column: str, sketches: DataFrame, keys: list[str], probs: tuple[float, ...] = (0.25, 0.5, 0.75),
               error: float = RANK_ERROR) -> DataFrame:
    """Per period and probability whether the sketch's quantile lies where it should, by counting the values under it.

    Columns: keys, p, n, within.  The quantile v of p is right if at most (p + error) * n values are less than v
    and at least (p - error) * n are not greater.  ``df`` is aggregated to one row per period and probability.
    """
    names = tuple(f"_q{i}" for i in range(len(probs)))
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.col(q).alias("v")) for p, q in zip(probs, names)])).alias("_e")
    asked = quantiles(sketches, probs, names).select(*keys, each).select(*keys, "_e.p", "_e.v")
    # A few rows per period; the planner decides whether to broadcast them.
    pairs = df.filter(F.col(column).isNotNull()).select(*keys, F.col(column).cast("double").alias("_x")).join(asked, keys)
    counted = pairs.groupBy(*keys, "p").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_x") < F.col("v")).alias("_less"),
                                            F.count_if(F.col("_x") <= F.col("v")).alias("_upto"))
    slack = F.lit(error) * F.col("n")
    right = (F.col("_less") <= F.col("p") * F.col("n") + slack) & (F.col("_upto") >= F.col("p") * F.col("n") - slack)
    return counted.select(*keys, "p", "n", right.alias("within"))
