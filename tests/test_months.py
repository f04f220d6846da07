"""Customer months that merge (A4, A10, W2) and the shared layout of the profile."""

from __future__ import annotations

import random

import pytest
from conftest import SF_SMALL, txn_row
from pyspark.sql import functions as F

from ledgerloom.operators import curate, marts, months
from ledgerloom.plans.lake import Lake
from ledgerloom.session import scratch_path
from ledgerloom.sources import tables


@pytest.fixture(scope="module")
def txn(spark):
    rng = random.Random(4)
    rows = [txn_row(f"t{i}", f"c{rng.choice((1, 1, 1, 2, 3))}", f"202{rng.choice((3, 4))}-0{rng.randint(1, 4)}-1{rng.randint(0, 9)} 10:00:00",
                    f"{rng.randint(1, 90)}.50", "CREDIT" if i % 9 == 0 else "DEBIT", rng.choice([None, *(f"M{k:03d}" for k in range(200))]),
                    rng.choice([None, *(f"cat{k}" for k in range(5))]), rng.choice([None, "POS", "ATM"])) for i in range(900)]
    columns = "transaction_id string, customer_id string, transaction_date string, amount string, transaction_type string, merchant_name string, merchant_category string, channel string"
    return tables.stored(curate.clean_transactions(spark.createDataFrame(rows, columns), stamp=False), "txn")


@pytest.fixture(scope="module")
def numbers(txn):
    return {name: tables.stored(months.numbered(txn, column), name) for name, column in months.SETS.items()}


def as_set(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_numbers_are_dense_and_stay_when_values_come(spark, txn, numbers):
    got = {r.merchant_name: r.number for r in numbers["merchants"].collect()}
    assert sorted(got.values()) == list(range(len(got))) and list(sorted(got)) == sorted(got, key=got.get)
    more = spark.createDataFrame([("A NEW ONE",), ("M001",), (None,), ("ZZ",)], "merchant_name string")
    then = {r.merchant_name: r.number for r in months.extended(numbers["merchants"], more, "merchant_name").collect()}
    assert {k: v for k, v in then.items() if k in got} == got
    assert then["A NEW ONE"] == len(got) and then["ZZ"] == len(got) + 1 and len(then) == len(got) + 2
    assert months.numbered(txn.limit(0), "merchant_name").count() == 0


@pytest.mark.parametrize("keys", [["customer_id"], ["customer_id", "txn_year"], ["txn_month"], ["customer_id", "txn_year", "txn_month"]])
def test_united_sets_count_distinct(txn, numbers, keys):
    stored = months.customer_months(txn, numbers)
    want = marts.debits(txn).groupBy(*keys).agg(F.count_distinct("merchant_name").alias("n"))
    assert as_set(months.distinct_counts(stored, "merchants", keys, "n")) == as_set(want.filter("n > 0"))


def test_profile_from_months_equals_the_one_from_transactions(spark, txn, numbers):
    customers = spark.createDataFrame([("c1", "a"), ("c2", "b"), ("none", "c")], "customer_id string, segment string")
    stored = months.customer_months(txn, numbers)
    assert as_set(months.customer_profile(customers, stored)) == as_set(marts.customer_profile(customers, txn))


def test_months_of_a_batch_unite_with_stored_ones(txn, numbers):
    """Months made apart, with numbers shared, give what all together give."""
    early, late = txn.filter("txn_year = 2023"), txn.filter("txn_year = 2024")
    both = months.customer_months(early, numbers).unionByName(months.customer_months(late, numbers))
    assert as_set(both) == as_set(months.customer_months(txn, numbers))


def test_ties_add_up_once(txn, numbers):
    tied = txn.withColumn("amount", F.lit(1).cast(txn.schema["amount"].dataType))
    stored = months.customer_months(tied, numbers, ties="all")
    assert stored.count() > stored.select(*marts.MONTH).distinct().count()
    assert as_set(months.lifetime(stored)) == as_set(marts.lifetime_stats(tied))


def test_profile_of_shared_buckets_has_no_exchange(spark, monkeypatch):
    lake = Lake(spark, SF_SMALL)
    customers, stored = lake.bucketed_customers(), lake.customer_months()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = months.customer_profile(customers, stored)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 4
    assert as_set(months.customer_profile(customers, stored)) == as_set(
        marts.customer_profile(lake.customers(), lake.txn(), lake.monthly_summary()))


def test_bucketed_table_holds_its_rows(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 17)
    back = tables.write_bucketed(df, scratch_path(spark, "bucketed"), "ledgerloom_test_bucketed", "k", 4)
    assert as_set(back) == as_set(df)
    assert "Exchange" not in back.groupBy("k", "id").count()._jdf.queryExecution().executedPlan().toString()
