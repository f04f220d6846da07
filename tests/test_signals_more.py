"""Longest codes (J5, C9), recurring income (C1, C2) and quantiles from sketches."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from conftest import txn_row
from pyspark.sql import functions as F

from ledgerloom.operators import curate, merchants, recurrence, signals, sketches


def test_the_longest_code_wins(spark):
    names = ["VODACOM DATA 0412 SANDTON", "vodacom  data", " Vodacom 12", "VODACOMDATA", "BP", "BPX STORE", "PICK N PAY 1", "PICK N", "", " ", None, "NOBODY"]
    txn = spark.createDataFrame([(i, n, "own") for i, n in enumerate(names)], "id int, merchant_name string, merchant_category string")
    got = {r.merchant_name: (r.matched_code, r.assigned_category) for r in merchants.assign_by_code(txn, signals.reference_merchants(spark)).collect()}
    assert got == {"VODACOM DATA 0412 SANDTON": ("VODACOM DATA", "telecoms"), "vodacom  data": ("VODACOM DATA", "telecoms"),
                   " Vodacom 12": ("VODACOM", "telecoms"), "VODACOMDATA": (None, "own"), "BP": ("BP", "fuel"), "BPX STORE": (None, "own"),
                   "PICK N PAY 1": ("PICK N PAY", "grocery"), "PICK N": (None, "own"), "": (None, "own"), " ": (None, "own"),
                   None: (None, "own"), "NOBODY": (None, "own")}


def test_codes_of_any_length_and_none(spark):
    txn = spark.createDataFrame([("a b c d e f", "own")], "merchant_name string, merchant_category string")
    codes = spark.createDataFrame([("A", "1"), ("a b c", "2"), ("A B C", "0"), ("", "9"), (None, "9")], "code string, category string")
    assert merchants.assign_by_code(txn, codes).first().assigned_category == "0"
    assert merchants.assign_by_code(txn, codes.limit(0)).first().assigned_category == "own"


def test_prefixes_join_by_equality(spark):
    txn = spark.createDataFrame([("a b", "own")], "merchant_name string, merchant_category string")
    plan = merchants.assign_by_code(txn, signals.reference_merchants(spark))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


@pytest.fixture(scope="module")
def paid(spark):
    rng, rows = random.Random(6), []

    def credit(customer, day, amount):
        rows.append(txn_row(f"t{len(rows)}", customer, (datetime(2024, 1, 1) + timedelta(days=day)).strftime("%Y-%m-%d 08:00:00"), amount, "CREDIT"))

    day = 24
    for month in range(10):                               # monthly, moved by weekends
        credit("monthly", day + rng.choice((-1, 0, 1)), f"{18000 + rng.randint(0, 900)}.00")
        day += (31, 29, 31, 30)[month % 4]
    for week in range(12):
        credit("weekly", 7 * week, "900.00")
        credit("weekly", 7 * week, "901.00")             # twice a day is one day
    for day in sorted(rng.sample(range(300), 10)):
        credit("random", day, "18000.00")
    credit("twice", 3, "100.00")
    credit("twice", 33, "100.00")
    credit("once", 3, "100.00")
    columns = "transaction_id string, customer_id string, transaction_date string, amount string, transaction_type string, merchant_name string, merchant_category string, channel string"
    return curate.clean_transactions(spark.createDataFrame(rows, columns), stamp=False)


def test_regular_pay_is_told_from_random_credits(paid):
    got = {r.customer_id: r for r in recurrence.recurring_credits(paid).collect()}
    assert set(got) == {"monthly", "weekly", "random", "twice"}
    assert got["monthly"].is_recurring and got["monthly"].rhythm == "monthly" and got["monthly"].regularity == 1.0
    assert got["weekly"].is_recurring and (got["weekly"].rhythm, got["weekly"].interval, got["weekly"].days) == ("weekly", 7, 12)
    assert not got["random"].is_recurring
    assert not got["twice"].is_recurring and got["twice"].regularity == 1.0       # too few gaps to tell


def test_amount_classes(spark):
    df = spark.createDataFrame([("0.50",), ("9.99",), ("18400.00",), ("18950.00",), ("20000.00",)], "a string").select(
        recurrence.amount_class(F.col("a").cast("decimal(22,4)")).alias("c"))
    assert [r.c for r in df.collect()] == [10, 19, 51, 51, 52]


def test_merged_sketches_answer_for_any_period(spark):
    values = random.Random(5)
    df = spark.createDataFrame([(i % 12, i % 3, values.random() ** 3 * 1e6) for i in range(6000)], "month long, year long, x double")
    monthly = sketches.monthly_sketches(df, "x", ["year", "month"])
    for keys in (["year"], ["month"], []):
        periods = sketches.merged(monthly, keys)
        assert periods.agg(F.sum("n")).first()[0] == 6000
        if keys:
            assert sketches.rank_check(df, "x", periods, keys).filter("NOT within").count() == 0
    assert sketches.merged(monthly.limit(0), ["year"]).count() == 0
