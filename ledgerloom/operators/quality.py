"""Quality checks and source profiles.

Per-column statistics are computed in one pass and unpivoted afterwards,
frequency tables are grouped counts.  Quantiles are exact and distributed: totals
per bucket of a fixed logarithmic grid say where the asked ranks lie, and only
the values in those buckets are ranked -- no collection of the values, and no job
before the result is asked for.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, NumericType

from ledgerloom.functions.numeric import half_up, half_up_quotient, int_div

#: Key columns the Silver gate expects to be complete.
GATE_COLUMNS = ["transaction_id", "customer_id", "amount", "transaction_date", "merchant_category"]
#: Standard deviations are rounded to 6 decimals: the streaming moment update
#: makes the last bits depend on the order rows are combined in.
STDDEV_SCALE = 6


def null_report(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row, one column per input column holding its NULL count
    (0, not NULL, on an empty input)."""
    cols = columns or df.columns
    return df.agg(*[F.coalesce(F.sum(F.col(c).isNull().cast("long")), F.lit(0)).alias(c) for c in cols])


def _mean(c: str, dtype) -> F.Column:
    if isinstance(dtype, DecimalType):
        return F.sum(c).cast("double") / F.count(c)
    return F.avg(F.col(c).cast("double"))


def numeric_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``describe()`` as typed rows -- column_name, count, mean, stddev
    (sample, 6 dp), min, max -- computed in one aggregation and unpivoted."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = columns or [c for c, t in types.items() if isinstance(t, NumericType)]
    stats = []
    for i, c in enumerate(cols):
        stats += [F.count(c).alias(f"n{i}"), _mean(c, types[c]).alias(f"mean{i}"),
                  half_up(F.stddev_samp(F.col(c).cast("double")), STDDEV_SCALE).alias(f"sd{i}"),
                  F.min(c).cast("double").alias(f"min{i}"), F.max(c).cast("double").alias(f"max{i}")]
    wide = df.agg(*stats)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("count"), F.col(f"mean{i}").alias("mean"),
                 F.col(f"sd{i}").alias("stddev"), F.col(f"min{i}").alias("min"), F.col(f"max{i}").alias("max"))
        for i, c in enumerate(cols)]))
    return wide.select(rows.alias("r")).select("r.*")


#: Steps of the logarithmic grid that quantile buckets lie on, per factor e.
GRID_PER_E = 64


def _bucket(column: str) -> F.Column:
    """A bucket that never falls when the value rises: a logarithmic grid on either side of zero."""
    x = F.col(column).cast("double")
    step = F.floor(F.log(F.abs(x)) * F.lit(float(GRID_PER_E))) + F.lit(1 << 20)   # positive for every double
    return F.when(x > 0, step).when(x < 0, -step).otherwise(F.lit(0)).cast("long")


def quantile_buckets(df: DataFrame, column: str, probs: tuple[float, ...]) -> DataFrame:
    """One row (i, _bucket, _rank) per probability: the bucket that holds the value of rank ceil(p * n), and its rank in there.

    The grid has at most some 180,000 buckets over all doubles, whatever the
    input, so the one-task window over bucket totals is bounded.
    """
    totals = df.filter(F.col(column).isNotNull()).groupBy(_bucket(column).alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    below = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = totals.select("_bucket", "_n", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_off"),
                           F.sum("_n").over(Window.partitionBy()).alias("_total"))
    asked = []
    for i, p in enumerate(probs):
        frac = Fraction(str(p))
        k = int_div(F.col("_total") * F.lit(frac.numerator) + F.lit(frac.denominator - 1), F.lit(frac.denominator))
        rank = F.greatest(k, F.lit(1).cast("long")) - F.col("_off")
        asked.append(F.when((rank > 0) & (rank <= F.col("_n")), F.struct(F.lit(i).alias("i"), rank.alias("_rank"))))
    return placed.select("_bucket", F.explode(F.array_compact(F.array(*asked))).alias("_a")).select("_bucket", "_a.i", "_a._rank")


def exact_quantiles(df: DataFrame, column: str, probs: tuple[float, ...] = (0.25, 0.5, 0.75),
                    names: tuple[str, ...] = ("p25", "p50", "p75")) -> DataFrame:
    """Lower quantiles -- the value of rank ``ceil(p * n)`` -- computed exactly.  One row, one column per ``p``.

    Totals per bucket say which buckets hold the ranks asked for; only the values
    in there are counted and ranked.  ``df`` is scanned twice, and what is
    shuffled is bucket totals and the values of a few buckets, counted map-side.
    """
    asked = quantile_buckets(df, column, probs)                       # at most one row per probability
    rows = df.filter(F.col(column).isNotNull()).select(column, _bucket(column).alias("_bucket"))
    inside = rows.join(F.broadcast(asked.select("_bucket").distinct()), "_bucket").groupBy("_bucket", column).agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy("_bucket").orderBy(column).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = inside.withColumn("_cum", F.sum("_n").over(running)).join(F.broadcast(asked), "_bucket")
    hits = ranked.filter((F.col("_cum") >= F.col("_rank")) & (F.col("_cum") - F.col("_n") < F.col("_rank")))
    return hits.agg(*[F.min(F.when(F.col("i") == i, F.col(column))).alias(name) for i, name in enumerate(names)])


def quartile_profile(df: DataFrame, column: str, scale: int = 2) -> DataFrame:
    """Count, mean, std, min, 25/50/75 % and max of one column, rounded to
    ``scale`` decimals (pandas ``describe().round(2)``)."""
    c = F.col(column)
    moments = df.agg(F.count(c).alias("count"), F.sum(c.cast("decimal(34,4)")).alias("_sum"), F.min(c).alias("min"),
                     F.max(c).alias("max"), F.stddev_samp(c.cast("double")).alias("_std"), F.lit(1).alias("_one"))
    picks = exact_quantiles(df, column).withColumn("_one", F.lit(1))
    return moments.join(picks, "_one").select(                        # one row each
        "count", half_up_quotient("_sum", "count", scale).alias("mean"), half_up(F.col("_std"), scale).alias("std"),
        *[F.col(x).cast("double").alias(x) for x in ("min", "p25", "p50", "p75", "max")])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency table, most frequent first."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(column).asc_nulls_first()))


def relative_frequency(df: DataFrame, column: str, decimals: int = 1) -> DataFrame:
    """Share of rows per value in percent, ``decimals`` places (the
    reference: ``value_counts(normalize=True).round(3) * 100``).  The total is a
    scalar subquery, so the distinct values are never brought into one task."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = df.agg(F.count(F.lit(1)).alias("rows")).scalar()
    return (counts.select(column, "count", half_up_quotient(F.col("count") * F.lit(100), total, decimals).alias("share_pct"))
            .orderBy(F.col("count").desc(), F.col(column).asc_nulls_first()))


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent values (ties by value); a top-k report."""
    return value_counts(df.filter(F.col(column).isNotNull()), column).limit(n)


def day_histogram(txn: DataFrame, transaction_type: str = "CREDIT") -> DataFrame:
    """Transactions of one type per day of month, in day order."""
    return (txn.filter(F.col("transaction_type") == transaction_type)
            .groupBy("txn_day").agg(F.count(F.lit(1)).alias("count")).orderBy("txn_day"))


def quality_gate(txn: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL counts of the key columns, amount statistics and a verdict --
    ``passed`` is true when every key column is complete (the reference only
    printed "should all be 0")."""
    cols = columns or GATE_COLUMNS
    nulls = [F.coalesce(F.sum(F.col(c).isNull().cast("long")), F.lit(0)).alias(f"null_{c}") for c in cols]
    out = txn.agg(*nulls, F.count(F.lit(1)).alias("rows"),
                  (F.sum("amount").cast("double") / F.count("amount")).alias("amount_mean"),
                  half_up(F.stddev_samp(F.col("amount").cast("double")), STDDEV_SCALE).alias("amount_stddev"),
                  F.min("amount").cast("double").alias("amount_min"),
                  F.max("amount").cast("double").alias("amount_max"))
    passed = None
    for c in cols:
        cond = F.col(f"null_{c}") == 0
        passed = cond if passed is None else passed & cond
    return out.withColumn("passed", passed)


def row_count(df: DataFrame) -> int:
    """Number of rows (an action; prefer ``tables.write_table``'s observed
    count when the rows are being written anyway)."""
    return df.count()


def preview(df: DataFrame, n: int = 10, columns: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows of a column subset, for display."""
    return (df.select(*columns) if columns else df).limit(n)
