"""Silver: clean transactions and customers.

Order of operations follows the reference: de-duplicate first (on the raw id),
then cast, standardise, derive calendar parts and flags, then filter.  Two
deliberate differences, both documented in the README:

* the survivor of a duplicate id is deterministic (``keep_first``);
* rows whose date is NULL or unparsable are quarantined instead of flowing on
  with NULL year/month (SURVEY Q10), and so are amounts that money can't hold;
  ``quarantined_transactions`` returns both.

The NULL-id filter is applied before de-duplication: all NULL ids would collapse
into one row that the reference drops afterwards anyway, so the result is the
same and the filter reaches the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.calendar import MONTH_END_FROM_DAY, SALARY_PERIOD_DAYS, date_part_columns, flag_columns
from ledgerloom.functions.casts import to_double, to_money, to_timestamp
from ledgerloom.functions.text import lower_trim, title_trim, upper_trim
from ledgerloom.operators.dedup import keep_first

#: Tie-break among copies of one transaction id: after a usable copy the typed date and amount, then these.
TXN_TIEBREAK = ["merchant_name", "merchant_category", "transaction_type", "channel", "customer_id"]
#: Tie-break among copies of one customer id, after a usable copy.
CUSTOMER_TIEBREAK = ["segment", "province"]


def _dtype(df: DataFrame, name: str):
    return df.schema[name].dataType


def _typed(df: DataFrame) -> tuple[F.Column, F.Column]:
    """Amount and date as Silver types them."""
    return (to_money("amount", _dtype(df, "amount")) if "amount" in df.columns else F.lit(None).cast("decimal(22,4)"),
            to_timestamp("transaction_date", _dtype(df, "transaction_date")) if "transaction_date" in df.columns
            else F.lit(None).cast("timestamp_ntz"))


def dedup_transactions(df: DataFrame) -> DataFrame:
    """One row per non-NULL ``transaction_id``.

    A copy that Silver can use (positive amount, date, customer) wins over one
    that it would drop; among equals the earliest date and the smallest amount,
    compared as typed values whatever the input's types, NULLs last.
    """
    amount, date = _typed(df)
    customer = F.col("customer_id").isNotNull() if "customer_id" in df.columns else F.lit(True)
    unusable = ~(F.coalesce(amount > 0, F.lit(False)) & date.isNotNull() & customer)
    return keep_first(df.filter(F.col("transaction_id").isNotNull()), "transaction_id",
                      [unusable, date, amount, *TXN_TIEBREAK])


def surviving_transactions(df: DataFrame) -> DataFrame:
    """D1 once for all that follows: one raw row per id, with the typed date's txn_year and txn_month (NULL without one).

    Silver and the quarantine are two filters of this table, and it can be merged with a later batch
    (``plans.upsert``), for the least of all copies is the least of the old survivor and the new copies.
    """
    _, date = _typed(df)
    return dedup_transactions(df).withColumns({"txn_year": F.year(date), "txn_month": F.month(date)})


def standardise_transactions(df: DataFrame) -> DataFrame:
    """X1/X2/X4/X5 on the transaction columns present in ``df``."""
    cols = {}
    if "amount" in df.columns:
        cols["amount"] = to_money("amount", _dtype(df, "amount"))
    if "transaction_date" in df.columns:
        cols["transaction_date"] = to_timestamp("transaction_date", _dtype(df, "transaction_date"))
    for name in ("merchant_name", "transaction_type", "channel"):
        if name in df.columns:
            cols[name] = upper_trim(name)
    if "merchant_category" in df.columns:
        cols["merchant_category"] = lower_trim("merchant_category")
    return df.withColumns(cols)


def add_calendar(df: DataFrame, month_end_from: int = MONTH_END_FROM_DAY,
                 salary_days: tuple[int, int] = SALARY_PERIOD_DAYS) -> DataFrame:
    """Date parts then pay-cycle flags."""
    return df.withColumns(date_part_columns("transaction_date")).withColumns(
        flag_columns(month_end_from, salary_days))


def valid_transactions(df: DataFrame) -> DataFrame:
    """F2/F4 (+Q10): positive amount, ids present, a usable date."""
    return df.filter((F.col("amount") > 0) & F.col("transaction_id").isNotNull()
                     & F.col("customer_id").isNotNull() & F.col("transaction_date").isNotNull())


def clean_transactions(df: DataFrame, month_end_from: int = MONTH_END_FROM_DAY,
                       salary_days: tuple[int, int] = SALARY_PERIOD_DAYS, stamp: bool = True,
                       dedup: bool = True) -> DataFrame:
    """K1: raw or Bronze transactions -> Silver transactions.  ``dedup=False`` for input whose ids are unique."""
    rows = dedup_transactions(df) if dedup else df.filter(F.col("transaction_id").isNotNull())
    out = valid_transactions(add_calendar(standardise_transactions(rows), month_end_from, salary_days))
    return out.withColumn("_silver_processed_at", F.current_timestamp()) if stamp else out


def quarantined_transactions(df: DataFrame, dedup: bool = True) -> DataFrame:
    """Q10: de-duplicated rows that Silver can't hold, with the ``reason``:

    ``amount``  a positive number that has no exact form as money (too large, or under half of its last digit);
    ``date``    every other rule passes, but the date is missing or unparsable.

    Columns keep their raw types and values.
    """
    rows = dedup_transactions(df) if dedup else df.filter(F.col("transaction_id").isNotNull())
    amount, date = _typed(rows)
    positive = F.coalesce(F.col("amount").try_cast("double") > 0, F.lit(False))
    held = F.coalesce(amount > 0, F.lit(False))
    reason = F.when(positive & ~held, F.lit("amount")).when(held & date.isNull(), F.lit("date"))
    return rows.filter(F.col("customer_id").isNotNull()).withColumn("reason", reason).filter("reason IS NOT NULL")


def clean_customers(df: DataFrame, stamp: bool = True) -> DataFrame:
    """K2: dedup on customer_id, ``initcap`` province, lower segment, income to
    double, keep positive incomes.  A copy with a positive income wins over others."""
    income = to_double("monthly_income")
    out = keep_first(df.filter(F.col("customer_id").isNotNull()), "customer_id",
                     [~F.coalesce(income > 0, F.lit(False)), *CUSTOMER_TIEBREAK, income])
    cols = {}
    if "province" in out.columns:
        cols["province"] = title_trim("province")
    if "segment" in out.columns:
        cols["segment"] = lower_trim("segment")
    cols["monthly_income"] = income
    out = out.withColumns(cols).filter(F.col("monthly_income") > 0)
    return out.withColumn("_silver_processed_at", F.current_timestamp()) if stamp else out


def flag_nulls(df: DataFrame, columns: list[str] | None = None, name: str = "_null_flags") -> DataFrame:
    """C8 ("flag nulls", claimed by the reference, not coded there; our definition):
    an array with the names of the listed columns that are NULL in the row."""
    cols = columns or df.columns
    flags = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols]))
    return df.withColumn(name, flags)


def ledger_by_time(txn: DataFrame) -> DataFrame:
    """The ledger in time order (ties by id).  A global sort: Spark samples
    the keys and range-partitions, so every task sorts one slice of the time
    line; use ``tables.write_table(..., sort_within=...)`` when per-file order is
    enough."""
    return txn.orderBy(F.col("transaction_date").asc_nulls_first(), F.col("transaction_id").asc_nulls_first())
