"""Gold: monthly summary (K3) and lifetime profile (K4), with their parts.

Every part filters Silver to its transaction type first, so the filter and the
columns it needs reach the Parquet scan, and aggregates on its own keys only:
one exchange, after a map-side combine, or two where values are counted
distinct.

The monthly summary reads Silver twice instead of the four joined scans of the
plain definition:

    Silver --(partial | exchange month+category | final)--> category totals
           --(partial | exchange month | final)--> month measures and top category
    Silver debits --(distinct month+merchant, exchange)--> merchants per month

Each exchange is on month keys and follows a partial aggregation, so a customer
with a third of all rows is combined inside each map task and spread over its
months and categories; no step brings one customer's rows together.  The
profile groups the stored monthly table and three small aggregates by customer,
which are again combined before they are shuffled.

Money is summed as exact decimals and becomes double at the output edge; ratios
are exact HALF_UP roundings (``half_up_quotient``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.calendar import month_index
from ledgerloom.functions.numeric import exact_mean, half_up_quotient
from ledgerloom.operators.ranking import top_per_group

MONTH = ["customer_id", "txn_year", "txn_month"]
STRESS_THRESHOLD = 0.6      # fixed value: profile flag is avg month-end ratio > 0.6 (strict)
RATIO_SCALE = 4             # fixed value: ratios rounded to 4 decimals


def debits(txn: DataFrame) -> DataFrame:
    return txn.filter(F.col("transaction_type") == "DEBIT")


def credits(txn: DataFrame) -> DataFrame:
    return txn.filter(F.col("transaction_type") == "CREDIT")


def _month_end(month_end_from: int | None) -> F.Column:
    """Silver's flag, or the rule again with another first day."""
    return F.col("is_month_end") if month_end_from is None else F.col("txn_day") >= month_end_from


# ---------------------------------------------------------------- monthly parts


def monthly_spend(txn: DataFrame) -> DataFrame:
    """Debit totals per customer-month (months with at least one debit).

    Silver has no NULL ids, so counting ids is counting rows."""
    return debits(txn).groupBy(*MONTH).agg(
        F.sum("amount").cast("double").alias("total_spend"),
        F.count(F.lit(1)).alias("debit_txn_count"),
        F.count_distinct("merchant_name").alias("unique_merchants"),
        exact_mean(F.sum("amount"), F.count(F.lit(1))).alias("avg_txn_amount"),
        F.max("amount").cast("double").alias("max_txn_amount"))


def monthly_income(txn: DataFrame) -> DataFrame:
    """Credit totals per customer-month (months with at least one credit)."""
    return credits(txn).groupBy(*MONTH).agg(
        F.sum("amount").cast("double").alias("total_income_received"),
        F.count(F.lit(1)).alias("credit_txn_count"))


def month_end_spend(txn: DataFrame, month_end_from: int | None = None) -> DataFrame:
    """Debit spend from the month-end day on, per customer-month that has some."""
    return debits(txn).filter(_month_end(month_end_from)).groupBy(*MONTH).agg(
        F.sum("amount").cast("double").alias("month_end_spend"))


def category_spend(txn: DataFrame, exact: bool = False) -> DataFrame:
    """Debit spend per customer-month-category (``exact=True``: as decimal)."""
    total = F.sum("amount")
    return debits(txn).groupBy(*MONTH, "merchant_category").agg(
        (total if exact else total.cast("double")).alias("cat_spend"))


def top_category(txn: DataFrame, ties: str = "one") -> DataFrame:
    """The highest-spend category of each customer-month."""
    top = top_per_group(category_spend(txn, exact=True), MONTH, "cat_spend", "merchant_category", ties)
    return top.select(*MONTH, F.col("merchant_category").alias("top_category"))


def _category_totals(txn: DataFrame, month_end_from: int | None) -> DataFrame:
    """Every additive measure of the month, per customer-month-category."""
    debit, credit = F.col("transaction_type") == "DEBIT", F.col("transaction_type") == "CREDIT"
    amount = F.col("amount")
    return txn.filter(debit | credit).groupBy(*MONTH, "merchant_category").agg(
        F.sum(F.when(debit, amount)).alias("spend"), F.count_if(debit).alias("n_debits"),
        F.max(F.when(debit, amount)).alias("max_spend"),
        F.sum(F.when(debit & _month_end(month_end_from), amount)).alias("month_end"),
        F.sum(F.when(credit, amount)).alias("income"), F.count_if(credit).alias("n_credits"))


def monthly_summary(txn: DataFrame, ties: str = "one", stamp: bool = False,
                    month_end_from: int | None = None) -> DataFrame:
    """K3: one row per customer-month with debits.

    Same values as the plain join form: months with credits only are absent
    (Q2); month-end spend and its ratio are NULL without spend from the
    month-end day (Q3; ``fill_zero`` turns them into zeros); income, credit
    count and spend-to-income are NULL in a month without credits (Q4).

    ``ties="one"`` (default) keeps one top category, the smallest on ties;
    ``ties="all"`` reproduces ``rank() == 1``: a month repeats once per category
    tied for the highest spend; the month's measures are a window over its
    category totals, which are made and shuffled once.
    """
    if ties not in ("one", "all"):
        raise ValueError("ties must be 'one' or 'all'")
    cats = _category_totals(txn, month_end_from)
    has_debit = F.col("n_debits") > 0
    measures = {
        "spend": F.sum("spend"), "debit_txn_count": F.sum("n_debits"), "max_spend": F.max("max_spend"),
        "month_end": F.sum("month_end"), "income": F.sum("income"), "n_credits": F.sum("n_credits"),
        "_top": F.min(F.when(has_debit, F.struct((-F.col("spend")).alias("v"), F.col("merchant_category").alias("label"))))}
    if ties == "all":
        month = Window.partitionBy(*MONTH)
        months = cats.select(*MONTH, *[m.over(month).alias(name) for name, m in measures.items()], has_debit.alias("_debit"),
                             F.col("spend").alias("_cat"), F.col("merchant_category").alias("top_category"))
        months = months.filter(F.col("_debit") & (F.col("_cat") == -F.col("_top.v"))).drop("_debit", "_cat")
    else:
        months = cats.groupBy(*MONTH).agg(*[m.alias(name) for name, m in measures.items()]).filter("debit_txn_count > 0")
        months = months.withColumn("top_category", F.col("_top.label"))
    merchants = debits(txn).groupBy(*MONTH).agg(F.count_distinct("merchant_name").alias("unique_merchants"))
    out = months.join(merchants, MONTH).select(
        *MONTH, F.col("spend").cast("double").alias("total_spend"), "debit_txn_count", "unique_merchants",
        exact_mean("spend", "debit_txn_count").alias("avg_txn_amount"),
        F.col("max_spend").cast("double").alias("max_txn_amount"),
        F.col("income").cast("double").alias("total_income_received"),
        F.when(F.col("n_credits") > 0, F.col("n_credits")).alias("credit_txn_count"),
        F.col("month_end").cast("double").alias("month_end_spend"), "top_category",
        half_up_quotient("month_end", "spend", RATIO_SCALE).alias("month_end_stress_ratio"),
        half_up_quotient("spend", "income", RATIO_SCALE).alias("spend_to_income_ratio"))
    return out.withColumn("_gold_processed_at", F.current_timestamp()) if stamp else out


def fill_zero(monthly: DataFrame) -> DataFrame:
    """Q3: months without month-end spend get 0 for the spend and its ratio."""
    return monthly.fillna(0.0, subset=["month_end_spend", "month_end_stress_ratio"])


# ---------------------------------------------------------------- profile parts


def lifetime_stats(txn: DataFrame) -> DataFrame:
    """A10: lifetime debit measures per customer with at least one debit."""
    return debits(txn).groupBy("customer_id").agg(
        F.sum("amount").cast("double").alias("lifetime_spend"),
        F.count(F.lit(1)).alias("lifetime_txn_count"),
        exact_mean(F.sum("amount"), F.count(F.lit(1))).alias("avg_txn_value"),
        F.count_distinct("merchant_category").alias("category_diversity"))


def preferred_channel(txn: DataFrame, ties: str = "one") -> DataFrame:
    """The channel with the most debits per customer."""
    counts = debits(txn).groupBy("customer_id", "channel").agg(F.count(F.lit(1)).alias("cnt"))
    top = top_per_group(counts, ["customer_id"], "cnt", "channel", ties)
    return top.select("customer_id", F.col("channel").alias("preferred_channel"))


def stress_by_customer(monthly: DataFrame, threshold: float = STRESS_THRESHOLD) -> DataFrame:
    """A11 + F8: mean month-end ratio and mean spend-to-income ratio per customer
    (NULL months skipped), and the strict ``> threshold`` flag.

    The ratios have 4 decimals, so their sums are taken exactly and the flag
    compares ``sum > threshold * count`` -- a customer whose months average
    exactly 0.6 is never flagged through floating-point drift.
    """
    exact = lambda c: F.sum(F.col(c).cast("decimal(28,4)"))
    sums = monthly.groupBy("customer_id").agg(
        exact("month_end_stress_ratio").alias("_s_sum"), F.count("month_end_stress_ratio").alias("_s_n"),
        exact("spend_to_income_ratio").alias("_i_sum"), F.count("spend_to_income_ratio").alias("_i_n"))
    return sums.select(
        "customer_id",
        F.when(F.col("_s_n") > 0, exact_mean("_s_sum", "_s_n")).alias("avg_stress_ratio"),
        F.when(F.col("_i_n") > 0, exact_mean("_i_sum", "_i_n")).alias("avg_spend_to_income"),
        F.when(F.col("_s_n") > 0, F.col("_s_sum") > F.lit(threshold).cast("decimal(10,4)") * F.col("_s_n"))
         .alias("is_financially_stressed"))


PROFILE_MEASURES = ["lifetime_spend", "lifetime_txn_count", "avg_txn_value", "category_diversity",
                    "preferred_channel", "avg_stress_ratio", "avg_spend_to_income", "is_financially_stressed"]
ACTIVITY = ["active_months", "first_month", "last_month"]


def activity(monthly: DataFrame) -> DataFrame:
    """Months with debits and the first and last of them (``year * 12 + month - 1``), per customer."""
    month = month_index("txn_year", "txn_month")
    return monthly.groupBy("customer_id").agg(
        F.count_distinct("txn_year", "txn_month").alias("active_months"),
        F.min(month).alias("first_month"), F.max(month).alias("last_month"))


def customer_profile(customers: DataFrame, txn: DataFrame, monthly: DataFrame | None = None, ties: str = "one",
                     stamp: bool = False, threshold: float = STRESS_THRESHOLD,
                     with_activity: bool = False) -> DataFrame:
    """K4: every Silver customer with lifetime measures, preferred channel and
    stress (NULL measures for customers without debits, J4).

    ``monthly`` is the stored monthly summary (made with the same ``ties``);
    without it the summary is computed here.  ``with_activity=True`` keeps three
    extra columns used by K5.

    ``ties="all"`` is the rank semantics: a customer with tied channels appears
    once per channel, and tied categories repeat months inside the stress means.
    """
    monthly = monthly_summary(txn, ties) if monthly is None else monthly
    out = customers.join(lifetime_stats(txn), "customer_id", "left")
    out = out.join(preferred_channel(txn, ties), "customer_id", "left")
    out = out.join(stress_by_customer(monthly, threshold), "customer_id", "left")
    if with_activity:
        out = out.join(activity(monthly), "customer_id", "left")
    if not stamp:
        return out.drop("_silver_processed_at")
    return out.withColumn("_gold_processed_at", F.current_timestamp())
