"""Steps that read, shuffle and hold no more than they need (findings of round 3)."""

from __future__ import annotations

from conftest import SF_SMALL, txn_row
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ledgerloom import session
from ledgerloom.operators import curate, marts, months
from ledgerloom.operators.dedup import keep_first
from ledgerloom.plans import messy
from ledgerloom.sources.bindings import DriverTables

SPLIT = "spark.sql.files.maxPartitionBytes"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_driver_tables_lower_the_size_of_a_task_and_never_raise_it(spark):
    before = spark.conf.get(SPLIT)
    try:
        spark.conf.set(SPLIT, "128MB")
        DriverTables(spark, SF_SMALL)
        assert spark.conf.get(SPLIT) == f"{session.TASK_BYTES}b"
        spark.conf.set(SPLIT, "1MB")
        DriverTables(spark, SF_SMALL)
        assert spark.conf.get(SPLIT) == "1MB"
    finally:
        spark.conf.set(SPLIT, before)


def test_ranked_columns_travel_once_and_the_survivor_is_the_same(spark):
    rows = spark.createDataFrame([(1, 5, None, "x"), (1, 5, "b", "z"), (1, 5, "b", "y"), (2, None, "a", "q"), (2, 9, "z", None),
                                  (None, 1, "n", "n"), (None, 1, None, "m")], "id int, a int, b string, c string")
    first = keep_first(rows, "id", ["b", F.col("a") > 5, "a"])
    plan = optimized(first)
    assert "n0" in plan and "f2" in plan and "f0" not in plan and "f1" not in plan
    assert {tuple(r) for r in first.collect()} == {(1, 5, "b", "y"), (2, None, "a", "q"), (None, 1, "n", "n")}


def test_messy_and_late_rows_are_copies_of_one_pass_over_the_ledger(spark):
    tables = DriverTables(spark, SF_SMALL)
    for rows in (messy.messy_ledger(tables), messy.late_copies(tables, 5)):
        plan = optimized(rows)
        assert "Union" not in plan and plan.count("Aggregate") == 1


def test_messy_ledger_copies_by_order_key(spark):
    rows = messy.messy_ledger(DriverTables(spark, SF_SMALL))
    key = F.split("transaction_id", "-")[0].cast("long")
    per_id = rows.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("transaction_date").isNull()).alias("dateless"),
                                                F.count_if(F.col("amount") == "?").alias("numberless")).withColumn("key", key)
    wrong = per_id.filter((F.col("n") != F.when(key % 3 < 2, 2).otherwise(1))
                          | (F.col("numberless") != F.when(key % 3 == 1, 1).otherwise(0))
                          | ((key % 29 != 1) & (F.col("dateless") != F.when(key % 3 == 0, 1).otherwise(0))))
    assert per_id.count() > 0 and wrong.count() == 0


def _silver(raw_txn):
    return curate.clean_transactions(raw_txn([
        txn_row("1", "c", "2024-01-03", "5", category="a", channel="POS"),
        txn_row("2", "c", "2024-01-21", "5", category="b", channel=None, merchant="M"),
        txn_row("3", "c", "2024-01-04", "2", category="d"), txn_row("4", "c", "2024-01-05", "9", "CREDIT", category="e"),
        txn_row("5", "d", "2024-02-05", "9", "CREDIT"), txn_row("6", "d", "2024-03-05", "1.5", category=None)]), stamp=False)


def test_tied_months_make_their_category_totals_once(spark, raw_txn):
    out = marts.monthly_summary(_silver(raw_txn), ties="all")
    assert optimized(out).count("Join Inner") == 1
    got = {(r.customer_id, r.txn_month, r.top_category, r.total_spend, r.debit_txn_count, r.unique_merchants,
            r.total_income_received, r.month_end_spend) for r in out.collect()}
    assert got == {("c", 1, "a", 12.0, 3, 2, 9.0, 5.0), ("c", 1, "b", 12.0, 3, 2, 9.0, 5.0), ("d", 3, None, 1.5, 1, 1, None, None)}


def test_month_channels_bring_the_exact_spend(spark, raw_txn):
    out = months.month_channels(_silver(raw_txn))
    assert out.schema["spend"].dataType == DecimalType(32, 4)
    got = {(r.customer_id, r.txn_month): (float(r.spend), [tuple(c) for c in r.channels]) for r in out.collect()}
    assert got == {("c", 1): (12.0, [(None, 1), ("POS", 2)]), ("d", 3): (1.5, [("POS", 1)])}
