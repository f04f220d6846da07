"""Income that comes back at regular intervals.

The reference knows pay days by the calendar (``signals``).  Here pay is what
recurs, whatever its day.  The definition is ours:

* *like* credits are those of one customer and one amount class, the number of
  digits before the point and the first of them (18,400 and 18,950 are both
  "1 of five digits");
* the *gaps* are the days between neighbouring days with like credits;
* the *interval* is the most frequent gap, the shortest on ties;
* *regularity* is the share of the gaps that differ from the interval by at most
  ``SLACK`` days (months have 28 to 31);
* income recurs with at least ``LEAST_GAPS`` gaps and a regularity of ``LEAST_SHARE`` percent.

Credits are reduced to days before any window, so a customer with a third of all
rows has as many rows as days; gaps are reduced to counts per gap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.marts import credits

SLACK, LEAST_GAPS, LEAST_SHARE = 3, 3, 75
#: Names of intervals by their first and last number of days.
RHYTHMS = (("weekly", 6, 8), ("fortnightly", 12, 16), ("monthly", 26, 33))


def amount_class(amount: str | Column) -> Column:
    """Digits before the point, then the first of them: 18,400 -> 51; under 1: 10."""
    whole = F.floor(amount).cast("decimal(22,0)").cast("string")
    return (F.length(whole) * 10 + F.substring(whole, 1, 1).cast("int")).cast("int")


def recurring_credits(txn: DataFrame, slack: int = SLACK, least_gaps: int = LEAST_GAPS, least_share: int = LEAST_SHARE) -> DataFrame:
    """Per customer and amount class with at least two days of credits: days, gaps, interval, rhythm, regularity, is_recurring."""
    like = ["customer_id", "amount_class"]
    days = credits(txn).select("customer_id", amount_class("amount").alias("amount_class"), F.to_date("transaction_date").alias("day")).distinct()
    gap = F.date_diff("day", F.lag("day").over(Window.partitionBy(*like).orderBy("day")))
    counts = days.withColumn("gap", gap).filter("gap IS NOT NULL").groupBy(*like, "gap").agg(F.count(F.lit(1)).alias("n"))
    # One entry per different gap.
    gaps = counts.groupBy(*like).agg(F.collect_list(F.struct("gap", "n")).alias("g"), F.sum("n").alias("gaps"),
                                     F.min(F.struct((-F.col("n")).alias("n"), "gap")).getField("gap").alias("interval"))
    near = F.aggregate(F.filter("g", lambda x: F.abs(x["gap"] - F.col("interval")) <= slack), F.lit(0).cast("long"), lambda s, x: s + x["n"])
    rhythm = F.lit("other")
    for name, first, last in RHYTHMS:
        rhythm = F.when(F.col("interval").between(first, last), name).otherwise(rhythm)
    return gaps.withColumn("near", near).select(
        *like, (F.col("gaps") + 1).alias("days"), "gaps", "interval", rhythm.alias("rhythm"),
        (F.col("near") / F.col("gaps")).alias("regularity"),
        ((F.col("gaps") >= least_gaps) & (F.col("near") * 100 >= F.col("gaps") * least_share)).alias("is_recurring"))
