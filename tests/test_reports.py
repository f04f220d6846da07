"""Insights, quality profiles and signals on micro-fixtures."""

from __future__ import annotations

from conftest import txn_row

from ledgerloom.operators import curate, marts, quality, signals
from ledgerloom.plans import insights


def test_null_report_zero_on_empty_and_counts(raw_txn):
    empty = quality.null_report(raw_txn([])).first()
    assert all(v == 0 for v in empty.asDict().values())
    r = quality.null_report(raw_txn([txn_row("t", None, None, "1")]), ["customer_id", "transaction_date",
                                                                       "amount"]).first()
    assert (r.customer_id, r.transaction_date, r.amount) == (1, 1, 0)


def test_quality_gate_passes_on_silver(raw_txn):
    s = curate.clean_transactions(raw_txn([txn_row("t", "c", "2024-01-01 00:00:00", "2.50")]), stamp=False)
    g = quality.quality_gate(s).first()
    assert g.passed is True and g.rows == 1 and g.amount_mean == 2.5


def test_frequency_tables(raw_txn, raw_customers):
    s = curate.clean_transactions(raw_txn(
        [txn_row(f"t{i}", "c", f"2024-01-{1 + i:02d} 00:00:00", "1.00", "CREDIT" if i < 2 else "DEBIT")
         for i in range(5)]), stamp=False)
    assert [(r.transaction_type, r["count"]) for r in quality.value_counts(s, "transaction_type").collect()] == \
        [("DEBIT", 3), ("CREDIT", 2)]
    assert [(r.txn_day, r["count"]) for r in quality.day_histogram(s).collect()] == [(1, 1), (2, 1)]
    cust = curate.clean_customers(raw_customers([("a", "x", "p", "1"), ("b", "x", "p", "1"), ("c", "y", "p", "1")]),
                                  stamp=False)
    mix = {r.segment: r.share_pct for r in quality.relative_frequency(cust, "segment").collect()}
    assert mix == {"x": 66.7, "y": 33.3}


def test_insight_reports(raw_txn, raw_customers):
    rows = [txn_row("a", "c1", "2024-01-05 10:00:00", "24.00"),
            txn_row("b", "c1", "2024-01-25 10:00:00", "48.00"),
            txn_row("c", "c2", "2024-01-25 10:00:00", "24.00", category="fuel")]
    s = curate.clean_transactions(raw_txn(rows), stamp=False)
    f = s
    cust = curate.clean_customers(raw_customers([("c1", "A", "gauteng", "10"), ("c2", "A", "gauteng", "10"),
                                                 ("c3", "B", "limpopo", "10")]), stamp=False)
    profile = marts.customer_profile(cust, f, with_activity=True)
    seg = {r.segment: (r.avg_monthly_spend, r.customer_count) for r in
           insights.spend_by_segment(profile, 24).collect()}
    assert seg == {"a": (2.0, 2), "b": (None, 1)}
    assert insights.spend_by_segment(profile, None).first().avg_monthly_spend == 48.0
    report = insights.stress_report(profile).first()
    assert (report.total_customers, report.stressed_customers, report.stressed_pct, report.not_stressed_pct) == \
        (3, 2, 66.7, 33.3)
    prov = {r.province: r for r in insights.stress_by_province(profile).collect()}
    assert prov["Gauteng"].avg_stress_pct == 83.3 and prov["Gauteng"].stressed_customers == 2
    assert prov["Limpopo"].stressed_customers is None    # sum of NULL flags, as the reference
    cats = {r.merchant_category: r.total_spend_millions for r in insights.category_totals(s).collect()}
    assert cats == {"grocery": 0.0, "fuel": 0.0}
    vol = insights.monthly_volume(s).first()
    assert (vol.period, vol.txn_count) == ("2024-01", 3)


def test_signals(raw_txn, raw_customers):
    rows = [txn_row("s1", "c1", "2024-01-25 08:00:00", "100.00", "CREDIT", "SALARY", "income", "EFT"),
            txn_row("s2", "c1", "2024-02-10 08:00:00", "5.00"),
            txn_row("g1", "c2", "2024-01-01 08:00:00", "50.00", "CREDIT", "GRANT", "income", "EFT"),
            txn_row("g2", "c2", "2024-02-01 08:00:00", "50.00", "CREDIT", "GRANT", "income", "EFT")]
    s = curate.clean_transactions(raw_txn(rows), stamp=False)
    sal = {r.customer_id: (r.active_months, r.pay_months, r.is_salaried) for r in signals.salary_earners(s).collect()}
    assert sal["c1"] == (2, 1, True) and sal["c2"] == (2, 0, False)
    grant = {r.customer_id: r.is_grant_recipient for r in signals.grant_recipients(s).collect()}
    assert grant == {"c1": False, "c2": True}
    bands = {r.customer_id: r.income_band for r in signals.income_band(curate.clean_customers(raw_customers(
        [("a", "s", "p", "4999.99"), ("b", "s", "p", "5000"), ("c", "s", "p", "18000")]), stamp=False)).collect()}
    assert bands == {"a": "low", "b": "middle", "c": "high"}


def test_category_spike(raw_txn):
    rows = []
    for m in range(1, 5):
        rows.append(txn_row(f"g{m}", "c", f"2024-{m:02d}-05 10:00:00", "90.00"))
        rows.append(txn_row(f"l{m}", "c", f"2024-{m:02d}-06 10:00:00", "10.00" if m < 4 else "60.00",
                            category="load_shedding"))
    s = curate.clean_transactions(raw_txn(rows), stamp=False)
    out = {(r.merchant_category, r.txn_month): r for r in signals.category_spikes(s).collect()}
    apr = out[("load_shedding", 4)]
    assert apr.share == 0.4 and apr.trailing_share == 0.1 and apr.spike_ratio == 4.0 and apr.is_spike is True
    assert out[("load_shedding", 1)].is_spike is None


def test_merchant_lookup(raw_txn, spark):
    rows = [txn_row("a", "c", "2024-01-05 10:00:00", "1.00", merchant=" shoprite ", category=None),
            txn_row("b", "c", "2024-01-05 10:00:00", "1.00", merchant="UNKNOWN", category="misc")]
    s = curate.clean_transactions(raw_txn(rows), stamp=False)
    dim = signals.reference_merchants(spark).withColumnRenamed("display_name", "merchant_name")
    got = {r.transaction_id: r.assigned_category for r in signals.assign_categories(s, dim).collect()}
    assert got == {"a": "grocery", "b": "misc"}
    assert len(signals.REFERENCE_MERCHANTS) == 42


def test_exact_quantiles_against_brute_force(spark):
    import math
    import random
    rng = random.Random(7)
    values = [rng.choice([5, 5, 5, 5]) if i % 3 == 0 else rng.randint(1, 400) for i in range(2000)]
    values += [None] * 10
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(13)
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        got = quality.exact_quantiles(df, "v", (0.1, 0.25, 0.5, 0.75, 0.99, 1.0),
                                      ("a", "b", "c", "d", "e", "f")).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    clean = sorted(v for v in values if v is not None)
    expect = [clean[math.ceil(p * len(clean)) - 1] for p in (0.1, 0.25, 0.5, 0.75, 0.99, 1.0)]
    assert list(got) == expect


def test_lookup_never_fans_out(raw_txn, spark):
    s = curate.clean_transactions(raw_txn([txn_row("a", "c", "2024-01-05 10:00:00", "1.00", merchant="SPAR")]), stamp=False)
    dim = spark.createDataFrame([("Spar", "x"), (" SPAR ", "grocery"), (None, "y")], "merchant_name string, category string")
    assert [r.assigned_category for r in signals.assign_categories(s, dim).collect()] == ["grocery"]


def test_quartile_profile_against_pandas_and_without_early_jobs(spark):
    import pandas as pd
    values = [float(v) for v in (3, 1, 4, 1, 5, 9, 2, 6, -5, 0, -5)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    r = quality.quartile_profile(df, "v").first()
    p = pd.Series(values)
    assert (r["count"], r["mean"], r["std"], r["min"], r["max"]) == (11, round(p.mean(), 2), round(p.std(), 2), -5.0, 9.0)
    ranked = sorted(values)
    assert (r["p25"], r["p50"], r["p75"]) == (ranked[2], ranked[5], ranked[8])
    empty = quality.quartile_profile(df.limit(0), "v").first()
    assert empty["count"] == 0 and empty["mean"] is None and empty["p50"] is None
