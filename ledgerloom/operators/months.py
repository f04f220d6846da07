"""Customer months that merge: distinct counts, channels and exact sums for any period.

A distinct count of a month says nothing about a year.  A month's *set* does:
merchants and categories are numbered, and a customer-month keeps its numbers as
bits, 64 to a word, words without a bit left out.  Sets unite by OR word by word,
and a count of bits is the exact distinct count, so every period is taken from
the stored months and Silver isn't read again.  (Spark's ``bitmap_construct_agg``
makes 4,096 bytes per group whatever it holds; a customer-month has a few words.)

The table has one row per customer and month, so no customer has more rows than
there are months.  Stored bucketed by customer (``tables.write_bucketed``) next to
customers in the same buckets, the whole profile is joined and grouped where the
rows lie, without an exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.numeric import exact_mean
from ledgerloom.operators import marts
from ledgerloom.operators.marts import MONTH, debits
from ledgerloom.sources import tables

WORD_BITS = 64
SETS = {"merchants": "merchant_name", "categories": "merchant_category"}
ROW_BITS = 33                   # of monotonically_increasing_id; the bits above are the partition


def numbered(values: DataFrame, column: str, first: int = 0) -> DataFrame:
    """(column, number): the distinct non-NULL values, numbered from ``first`` without gaps in their order.

    Values are sorted over the cluster and stored; the partitions' counts, one row each, give where a partition starts.
    """
    row = F.monotonically_increasing_id()
    ranked = tables.stored(values.filter(F.col(column).isNotNull()).select(column).distinct().orderBy(column).select(
        column, F.shiftright(row, ROW_BITS).alias("_part"), row.bitwiseAND((1 << ROW_BITS) - 1).alias("_row")), "numbers")
    counts = ranked.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return ranked.join(starts, "_part").select(column, (F.col("_start") + F.col("_row") + first).alias("number"))


def extended(numbers: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """``numbers`` with new values numbered after the old ones, whose numbers (in stored sets) stay as they are."""
    first = numbers.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
    return numbers.unionByName(numbered(values.join(numbers, column, "left_anti"), column, first))


def words(numbers: Column) -> tuple[Column, Column]:
    """(word, bit) of a number."""
    return F.call_function("div", numbers, F.lit(WORD_BITS)), F.call_function(
        "shiftleft", F.lit(1).cast("long"), (numbers % WORD_BITS).cast("int"))


def united(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, word, bits) to one row per key and word: sets are united."""
    return rows.groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits"))


def month_sets(txn: DataFrame, column: str, numbers: DataFrame, name: str) -> DataFrame:
    """Per customer-month the set of ``column`` among the debits, as an array of (word, bits)."""
    word, bit = words(F.col("number"))
    pairs = debits(txn).filter(F.col(column).isNotNull()).select(*MONTH, column).distinct()
    rows = united(pairs.join(numbers, column).select(*MONTH, word.alias("word"), bit.alias("bits")), MONTH)
    return rows.groupBy(*MONTH).agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias(name))


def month_channels(txn: DataFrame) -> DataFrame:
    """Per customer-month the exact spend, and the debits of every channel as an array of (channel, n)."""
    money = F.sum("amount")
    rows = debits(txn).groupBy(*MONTH, "channel").agg(F.count(F.lit(1)).alias("n"), money.alias("_spend"))
    kind = rows.schema["_spend"].dataType
    return rows.groupBy(*MONTH).agg(F.sum("_spend").cast(kind).alias("spend"),
                                    F.array_sort(F.collect_list(F.struct("channel", "n"))).alias("channels"))


def customer_months(txn: DataFrame, numbers: dict[str, DataFrame], ties: str = "one", summary: DataFrame | None = None) -> DataFrame:
    """K3 with what merges: the exact spend, the sets of SETS and the channels of every customer-month with debits.

    ``summary`` is the stored monthly summary (made with the same ``ties``); without it the summary is computed here.
    With ``ties="all"`` a month of tied categories has several rows; those but the first carry nothing that adds up.
    """
    state = month_channels(txn).filter(F.col("customer_id").isNotNull() & F.col("txn_year").isNotNull() & F.col("txn_month").isNotNull())
    for name, column in SETS.items():
        state = state.join(month_sets(txn, column, numbers[name], name), MONTH, "left")
    summary = marts.monthly_summary(txn, ties) if summary is None else summary
    if ties == "one":
        return summary.join(state, MONTH)
    first = summary.groupBy(*MONTH).agg(F.min("top_category").alias("_first"))
    state = state.join(first, MONTH)
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"m.{c}")) for c in MONTH] + [F.col("s._first").eqNullSafe(F.col("m.top_category"))]
    return summary.alias("m").join(state.alias("s"), same, "left").select(
        "m.*", *[f"s.{c}" for c in state.columns if c not in (*MONTH, "_first")])


def distinct_counts(months: DataFrame, name: str, keys: list[str], out: str) -> DataFrame:
    """Exact distinct counts of a set over any grouping of the stored months."""
    rows = months.select(*keys, F.explode(name).alias("_w")).select(*keys, "_w.word", "_w.bits")
    return united(rows, keys).groupBy(*keys).agg(F.sum(F.bit_count("bits")).alias(out))


def lifetime(months: DataFrame) -> DataFrame:
    """A10 from the stored months."""
    sums = months.filter("spend IS NOT NULL").groupBy("customer_id").agg(F.sum("spend").alias("spend"), F.sum("debit_txn_count").alias("n"))
    diversity = distinct_counts(months, "categories", ["customer_id"], "category_diversity")
    return sums.join(diversity, "customer_id", "left").select(
        "customer_id", F.col("spend").cast("double").alias("lifetime_spend"), F.col("n").alias("lifetime_txn_count"),
        exact_mean("spend", "n").alias("avg_txn_value"), F.coalesce("category_diversity", F.lit(0).cast("long")).alias("category_diversity"))


def preferred_channel(months: DataFrame) -> DataFrame:
    """W2 (one channel per customer, the smallest name on ties) from the stored months."""
    rows = months.select("customer_id", F.explode("channels").alias("_c")).select("customer_id", "_c.channel", "_c.n")
    counts = rows.groupBy("customer_id", "channel").agg(F.sum("n").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("channel").isNotNull().alias("_named"), "channel"))
    return counts.groupBy("customer_id").agg(best.alias("_b")).select("customer_id", F.col("_b.channel").alias("preferred_channel"))


def customer_profile(customers: DataFrame, months: DataFrame, threshold: float = marts.STRESS_THRESHOLD) -> DataFrame:
    """K4 from customers and the stored months alone; no transaction is read."""
    out = customers
    for part in (lifetime(months), preferred_channel(months), marts.stress_by_customer(months, threshold)):
        out = out.join(part, "customer_id", "left")
    return out
