"""Plan shape: what Catalyst must do for the design to hold at scale."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerloom.operators import marts


def plan_of(spark, name):
    # Without the pruning subqueries, which show a reused branch a second time.
    spark.conf.set("spark.sql.optimizer.dynamicPartitionPruning.enabled", "false")
    try:
        df = entry.queries()[name](spark, SF_SMALL)
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.optimizer.dynamicPartitionPruning.enabled")


def scans(plan):
    return [line for line in plan.splitlines() if "FileScan parquet" in line]


def test_silver_reads_each_raw_table_once_and_dedups_below_the_joins(spark):
    plan = plan_of(spark, "clean_transactions")
    assert len(scans(plan)) == 4                          # lineitem + three dimensions, each once
    assert plan.count("lineitem.parquet") == 1
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1
    # the exchange that brings copies together is under every join
    lines = plan.splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(l_orderkey" in line and "l_linenumber" in line)
    assert exchange > max(i for i, line in enumerate(lines) if "Join" in line)
    assert "partial_min" in "\n".join(lines[exchange:])   # copies of a hot key shrink in each map task


PARTS = {"monthly_spend": 2, "monthly_income": 1, "month_end_spend": 1, "category_spend": 1, "top_category": 2,
         "preferred_channel": 2, "lifetime_stats": 2, "favourite_category": 2, "avg_monthly_spend": 2}


@pytest.mark.parametrize("name", sorted(PARTS))
def test_gold_parts_push_their_type_and_shuffle_no_more_than_needed(spark, name):
    plan = plan_of(spark, name)
    wanted = "CREDIT" if name == "monthly_income" else "DEBIT"
    assert len(scans(plan)) == 1 and f"EqualTo(transaction_type,{wanted})" in scans(plan)[0]
    assert "transaction_id" not in scans(plan)[0].split("ReadSchema")[1]
    assert plan.count("Exchange hashpartitioning") == PARTS[name]
    assert "partial_" in plan.split("Exchange hashpartitioning")[-1]


def test_monthly_summary_exchanges_on_month_keys_after_partial_aggregation(spark):
    plan = plan_of(spark, "monthly_summary")
    assert len(scans(plan)) == 2                          # Silver for the measures, Silver debits for the merchants
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and all("txn_month" in line for line in exchanges)
    assert "transaction_id" not in " ".join(x.split("ReadSchema")[1] for x in scans(plan))
    for branch in plan.split("Exchange hashpartitioning")[1:]:
        assert "HashAggregate" in branch or "SortAggregate" in branch


def test_hot_customer_is_spread_before_any_task_holds_it(spark):
    """One customer with most rows over many merchants: what leaves the map side
    is one row per (month, category) and per (month, merchant), not its rows."""
    rows = spark.range(20000, numPartitions=4).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id") % 500)).alias("customer_id"),
        (F.lit(2024) - F.col("id") % 2).cast("int").alias("txn_year"), (F.col("id") % 12 + 1).cast("int").alias("txn_month"),
        (F.col("id") % 28 + 1).cast("int").alias("txn_day"), (F.col("id") % 28 >= 19).alias("is_month_end"),
        F.lit(1).cast("decimal(22,4)").alias("amount"), F.lit("DEBIT").alias("transaction_type"),
        F.concat(F.lit("m"), F.col("id") % 40).alias("merchant_name"),
        F.concat(F.lit("k"), F.col("id") % 5).alias("merchant_category"))
    plan = marts.monthly_summary(rows)._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Exchange hashpartitioning(customer_id" in line:
            assert "txn_year" in line and "txn_month" in line
    out = marts.monthly_summary(rows).filter("customer_id = 'hot'").collect()
    assert sum(r.debit_txn_count for r in out) == rows.filter("customer_id = 'hot'").count()


def test_profile_reads_the_stored_monthly_table(spark):
    plan = plan_of(spark, "customer_profile")
    assert sum("gold-customer-monthly-summary" in x for x in scans(plan)) == 1


def test_top_category_uses_group_limit(spark):
    assert "WindowGroupLimit" in plan_of(spark, "top_category")


def test_scan_prunes_columns_and_pushes_filters(spark):
    raw = plan_of(spark, "clean_transactions")
    # columns no step needs are never read from the raw tables
    for unused in ("l_quantity", "l_discount", "l_tax", "l_shipdate", "o_totalprice", "p_name", "s_acctbal"):
        assert unused not in raw
    assert "PushedFilters: [IsNotNull(o_custkey), IsNotNull(o_orderdate), IsNotNull(o_orderkey)]" in raw
    report = plan_of(spark, "category_totals")
    assert "ReadSchema: struct<amount:decimal(22,4),transaction_type:string,merchant_category:string>" in report
    assert "EqualTo(transaction_type,DEBIT)" in report


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "month_end_stress_ratio" in df.columns
