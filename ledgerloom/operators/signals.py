"""Behavioural signals the reference claims but does not code.

The definitions are ours (SURVEY 2.12), built on the same Silver and Gold
relations and only from built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions.calendar import month_index
from ledgerloom.functions.numeric import half_up_quotient
from ledgerloom.functions.text import upper_trim
from ledgerloom.operators.marts import MONTH, debits
from ledgerloom.operators.ranking import top_per_group

# Income band cuts, from the reference's segment income ranges
# (entry level from 5,000; professional from 18,000).
INCOME_BAND_CUTS = (5000, 18000)
INCOME_BANDS = ("low", "middle", "high")

# The reference's merchant catalogue -- (category, display name, code).
REFERENCE_MERCHANTS = [
    ("grocery", "Shoprite", "SHOPRITE"),
    ("grocery", "Checkers", "CHECKERS"),
    ("grocery", "Pick n Pay", "PICK N PAY"),
    ("grocery", "Woolworths Food", "WOOLWORTHS"),
    ("grocery", "Spar", "SPAR"),
    ("grocery", "Boxer", "BOXER"),
    ("fuel", "Engen", "ENGEN"),
    ("fuel", "Shell", "SHELL"),
    ("fuel", "BP", "BP"),
    ("fuel", "Sasol", "SASOL"),
    ("fuel", "Total", "TOTAL"),
    ("telecoms", "Vodacom Airtime", "VODACOM"),
    ("telecoms", "MTN Airtime", "MTN"),
    ("telecoms", "Cell C Airtime", "CELL C"),
    ("telecoms", "Telkom Mobile", "TELKOM"),
    ("telecoms", "Vodacom Data", "VODACOM DATA"),
    ("telecoms", "MTN Data", "MTN DATA"),
    ("streaming", "Netflix", "NETFLIX"),
    ("streaming", "DStv", "DSTV"),
    ("streaming", "Showmax", "SHOWMAX"),
    ("streaming", "Spotify", "SPOTIFY"),
    ("banking_fees", "Monthly Account Fee", "BANK FEE"),
    ("banking_fees", "ATM Withdrawal Fee", "ATM FEE"),
    ("banking_fees", "Transaction Fee", "TXN FEE"),
    ("fast_food", "KFC", "KFC"),
    ("fast_food", "Nandos", "NANDOS"),
    ("fast_food", "McDonald's", "MCDONALDS"),
    ("fast_food", "Steers", "STEERS"),
    ("fast_food", "Chicken Licken", "CHICKEN LICKEN"),
    ("pharmacy", "Clicks", "CLICKS"),
    ("pharmacy", "Dis-Chem", "DIS-CHEM"),
    ("pharmacy", "Alpha Pharm", "ALPHA PHARM"),
    ("transport", "Uber", "UBER"),
    ("transport", "Bolt", "BOLT"),
    ("transport", "Gautrain", "GAUTRAIN"),
    ("load_shedding", "Builders Warehouse", "BUILDERS"),
    ("load_shedding", "Makro Generator", "MAKRO"),
    ("load_shedding", "Incredible Connection", "INCREDIBLE"),
    ("load_shedding", "Candles & Lamps", "GAME STORES"),
    ("insurance", "Discovery Life", "DISCOVERY"),
    ("insurance", "Old Mutual", "OLD MUTUAL"),
    ("insurance", "Sanlam", "SANLAM"),
]


def _month_hits(txn: DataFrame, hit: Column) -> DataFrame:
    """Per customer: months with any transaction, and months where ``hit`` holds
    for at least one transaction (two aggregations: customer-month, customer)."""
    months = txn.groupBy("customer_id", "txn_year", "txn_month").agg(F.max(hit.cast("int")).alias("_hit"))
    return months.groupBy("customer_id").agg(F.count(F.lit(1)).alias("active_months"),
                                             F.count_if(F.col("_hit") == 1).alias("pay_months"))


def pay_cycle_customers(txn: DataFrame, day_rule: Column, min_share: float = 0.5,
                        flag: str = "is_regular") -> DataFrame:
    """Customers with a credit matching ``day_rule`` in at least ``min_share`` of
    their active months."""
    hit = (F.col("transaction_type") == "CREDIT") & day_rule
    counts = _month_hits(txn, hit)
    num, den = int(round(min_share * 100)), 100
    return counts.select("customer_id", "active_months", "pay_months",
                         (F.col("pay_months") * F.lit(den) >= F.col("active_months") * F.lit(num)).alias(flag))


def salary_earners(txn: DataFrame, min_share: float = 0.5) -> DataFrame:
    """salaried = a credit inside the salary period (days 24-26) in at least
    half of the active months."""
    return pay_cycle_customers(txn, F.col("is_salary_period"), min_share, "is_salaried")


def grant_recipients(txn: DataFrame, day: int = 1, min_share: float = 0.5) -> DataFrame:
    """Grant recipient = a credit on day ``day`` (the 1st) in at least half of
    the active months."""
    return pay_cycle_customers(txn, F.col("txn_day") == F.lit(day), min_share, "is_grant_recipient")


def category_spikes(txn: DataFrame, trailing: int = 3, threshold: float = 1.5,
                    category: str | None = None) -> DataFrame:
    """A category's share of all debit spend in a month against its mean share
    over the ``trailing`` previous calendar months; ``is_spike`` when the ratio
    reaches ``threshold``.  Shares are exact to 4 decimals.

    Both windows run over aggregated rows (one per category and month).
    """
    debits = txn.filter(F.col("transaction_type") == "DEBIT")
    if category is not None:
        cat_filter = F.col("merchant_category") == F.lit(category)
    cat = debits.groupBy("txn_year", "txn_month", "merchant_category").agg(F.sum("amount").alias("_cat"))
    month_total = F.sum("_cat").over(Window.partitionBy("txn_year", "txn_month"))
    share_units = F.call_function("div", F.col("_cat") * F.lit(20000) + month_total, month_total * F.lit(2))
    shares = cat.select("txn_year", "txn_month", "merchant_category",
                        share_units.alias("_share_units"),
                        month_index("txn_year", "txn_month").alias("_idx"))
    if category is not None:
        shares = shares.filter(cat_filter)
    w = (Window.partitionBy("merchant_category").orderBy("_idx")
         .rangeBetween(-trailing, -1))
    trail = shares.select("*", F.sum("_share_units").over(w).alias("_t_sum"),
                          F.count("_share_units").over(w).alias("_t_n"))
    thr_units = int(round(threshold * 100))
    return trail.select(
        "merchant_category", "txn_year", "txn_month",
        (F.col("_share_units") / F.lit(10000.0)).alias("share"),
        F.when(F.col("_t_n") > 0, F.col("_t_sum") / (F.col("_t_n") * F.lit(10000.0))).alias("trailing_share"),
        half_up_quotient(F.col("_share_units") * F.col("_t_n"), F.col("_t_sum"), 4).alias("spike_ratio"),
        F.when(F.col("_t_sum") > 0,
               F.col("_share_units") * F.col("_t_n") * F.lit(100) >= F.col("_t_sum") * F.lit(thr_units))
         .alias("is_spike"))


def income_band(customers: DataFrame, cuts: tuple[int, int] = INCOME_BAND_CUTS) -> DataFrame:
    """Low (< 5,000), middle (< 18,000) or high monthly income."""
    inc = F.col("monthly_income")
    band = (F.when(inc < cuts[0], F.lit(INCOME_BANDS[0]))
            .when(inc < cuts[1], F.lit(INCOME_BANDS[1]))
            .when(inc.isNotNull(), F.lit(INCOME_BANDS[2])))
    return customers.withColumn("income_band", band)


def favourite_category(txn: DataFrame, ties: str = "one") -> DataFrame:
    """The category with the highest lifetime debit spend per customer."""
    spend = debits(txn).groupBy("customer_id", "merchant_category").agg(F.sum("amount").alias("_spend"))
    top = top_per_group(spend, ["customer_id"], "_spend", "merchant_category", ties)
    return top.select("customer_id", F.col("merchant_category").alias("favourite_category"))


def average_monthly_spend(txn: DataFrame) -> DataFrame:
    """Lifetime debit spend / months with debits, 2 dp, per customer."""
    months = debits(txn).groupBy(*MONTH).agg(F.sum("amount").alias("_spend"))
    return months.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("active_months"),
        half_up_quotient(F.sum("_spend"), F.count(F.lit(1)), 2).alias("avg_monthly_spend"))


def reference_merchants(spark: SparkSession) -> DataFrame:
    """The reference's merchant catalogue as a dimension (42 literal rows)."""
    return spark.createDataFrame(REFERENCE_MERCHANTS, "category string, display_name string, code string")


def merchant_dimension(txn: DataFrame) -> DataFrame:
    """J5 (learned form): each merchant's dominant debit category (most
    transactions; smallest category on ties) -- one row per merchant."""
    counts = (txn.filter((F.col("transaction_type") == "DEBIT") & F.col("merchant_name").isNotNull()
                         & F.col("merchant_category").isNotNull())
              .groupBy("merchant_name", "merchant_category").agg(F.count(F.lit(1)).alias("_n")))
    top = top_per_group(counts, ["merchant_name"], "_n", "merchant_category")
    return top.select("merchant_name", F.col("merchant_category").alias("category"))


def assign_categories(txn: DataFrame, dimension: DataFrame, key: str = "merchant_name",
                      dim_key: str = "merchant_name") -> DataFrame:
    """``assigned_category`` from a merchant dimension (left join on the
    standardised name), falling back to the transaction's own category.

    Spellings of the dimension that standardise to one name are one row (the
    smallest category), so a transaction never fans out.  Whether to broadcast
    the dimension is left to the planner and, at run time, to its real size.
    """
    dim = dimension.select(upper_trim(dim_key).alias("_dim_key"), F.col("category").alias("_dim_category"))
    dim = dim.filter("_dim_key IS NOT NULL").groupBy("_dim_key").agg(F.min("_dim_category").alias("_dim_category"))
    joined = txn.join(dim, upper_trim(key) == F.col("_dim_key"), "left")
    return (joined.withColumn("assigned_category", F.coalesce(F.col("_dim_category"), F.col("merchant_category")))
            .drop("_dim_key", "_dim_category"))
