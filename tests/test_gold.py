"""Gold rules and invariants."""

from __future__ import annotations

import pytest
from conftest import txn_row
from pyspark.sql import functions as F

from ledgerloom.operators import curate, marts


def silver(raw_txn, rows):
    return curate.clean_transactions(raw_txn(rows), stamp=False)


def facts(raw_txn, rows):
    return silver(raw_txn, rows)


def by_key(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_rank_ties_one_row_by_default_all_with_ties(raw_txn):
    rows = [txn_row("a", "c1", "2024-01-05 10:00:00", "10.00", category="fuel", channel="ATM"),
            txn_row("b", "c1", "2024-01-06 10:00:00", "10.00", category="grocery", channel="POS"),
            txn_row("c", "c1", "2024-01-07 10:00:00", "1.00", category="pharmacy", channel="POS"),
            txn_row("d", "c1", "2024-01-08 10:00:00", "1.00", category="pharmacy", channel="ATM")]
    f = facts(raw_txn, rows)
    one = marts.monthly_summary(f).collect()
    assert len(one) == 1 and one[0].top_category == "fuel"
    all_ = marts.monthly_summary(f, ties="all").collect()
    assert sorted(r.top_category for r in all_) == ["fuel", "grocery"]
    assert [r.preferred_channel for r in marts.preferred_channel(f).collect()] == ["ATM"]
    assert sorted(r.preferred_channel for r in marts.preferred_channel(f, "all").collect()) == ["ATM", "POS"]
    assert marts.top_category(f).count() == 1 and marts.top_category(f, "all").count() == 2


def test_credit_only_month_absent(raw_txn):
    rows = [txn_row("a", "c1", "2024-01-05 10:00:00", "100.00", "CREDIT", "SALARY", "income", "EFT"),
            txn_row("b", "c1", "2024-02-05 10:00:00", "10.00")]
    out = marts.monthly_summary(facts(raw_txn, rows)).collect()
    assert [(r.txn_year, r.txn_month) for r in out] == [(2024, 2)]


def test_no_month_end_and_no_income_give_nulls(raw_txn):
    rows = [txn_row("a", "c1", "2024-01-05 10:00:00", "10.00"),
            txn_row("b", "c1", "2024-01-19 10:00:00", "30.00", category="fuel")]
    r = marts.monthly_summary(facts(raw_txn, rows)).first()
    assert r.month_end_spend is None and r.month_end_stress_ratio is None
    assert r.total_income_received is None and r.credit_txn_count is None and r.spend_to_income_ratio is None
    assert (r.total_spend, r.debit_txn_count, r.unique_merchants, r.avg_txn_amount, r.max_txn_amount) == \
        (40.0, 2, 1, 20.0, 30.0)
    assert r.top_category == "fuel"


def test_monthly_measures_and_ratios(raw_txn):
    rows = [txn_row("a", "c1", "2024-03-05 10:00:00", "30.00", merchant="A"),
            txn_row("b", "c1", "2024-03-21 10:00:00", "60.00", merchant="B"),
            txn_row("c", "c1", "2024-03-25 10:00:00", "10.00", merchant="B"),
            txn_row("d", "c1", "2024-03-25 11:00:00", "300.00", "CREDIT", "SALARY", "income", "EFT"),
            txn_row("e", "c1", "2024-03-26 11:00:00", "100.00", "CREDIT", "SALARY", "income", "EFT")]
    r = marts.monthly_summary(facts(raw_txn, rows)).first()
    assert r.total_spend == 100.0 and r.month_end_spend == 70.0 and r.unique_merchants == 2
    assert r.total_income_received == 400.0 and r.credit_txn_count == 2
    assert r.month_end_stress_ratio == 0.7 and r.spend_to_income_ratio == 0.25


def test_ratio_is_exact_half_up(raw_txn):
    # 1 / 8 = 0.125 exactly -> 4 dp keeps it; 1 / 3 -> 0.3333; 2 / 3 -> 0.6667
    rows = [txn_row("a", "c1", "2024-01-05 10:00:00", "2.00"),
            txn_row("b", "c1", "2024-01-25 10:00:00", "1.00"),
            txn_row("c", "c2", "2024-01-05 10:00:00", "1.00"),
            txn_row("d", "c2", "2024-01-25 10:00:00", "2.00"),
            txn_row("e", "c3", "2024-01-05 10:00:00", "19999.00"),
            txn_row("f", "c3", "2024-01-25 10:00:00", "1.00")]
    out = by_key(marts.monthly_summary(facts(raw_txn, rows)), "customer_id")
    assert out[("c1",)].month_end_stress_ratio == 0.3333
    assert out[("c2",)].month_end_stress_ratio == 0.6667
    assert out[("c3",)].month_end_stress_ratio == 0.0001   # 1/20000 = 0.00005 -> HALF_UP


def _month(tid, cust, month, total_cents, month_end_cents):
    early = total_cents - month_end_cents
    rows = []
    if early:
        rows.append(txn_row(f"{tid}e", cust, f"2024-{month:02d}-05 10:00:00", f"{early / 100:.2f}"))
    if month_end_cents:
        rows.append(txn_row(f"{tid}l", cust, f"2024-{month:02d}-25 10:00:00", f"{month_end_cents / 100:.2f}"))
    return rows


def test_stress_edges(raw_txn, raw_customers):
    rows = _month("x", "exact", 1, 1000, 600)
    rows += _month("p1", "plus", 1, 1000000, 600200)
    for m in range(2, 6):
        rows += _month(f"p{m}", "plus", m, 1000, 600)
    rows += _month("h", "high", 1, 1000, 700)
    rows += _month("n", "none", 1, 1000, 0)
    f = facts(raw_txn, rows)
    stress = by_key(marts.stress_by_customer(marts.monthly_summary(f)), "customer_id")
    assert stress[("exact",)].is_financially_stressed is False
    assert stress[("plus",)].is_financially_stressed is True
    assert stress[("plus",)].avg_stress_ratio == pytest.approx(0.60004)
    assert stress[("high",)].is_financially_stressed is True
    assert stress[("none",)].is_financially_stressed is None and stress[("none",)].avg_stress_ratio is None
    customers = curate.clean_customers(raw_customers(
        [(c, "s", "p", "100") for c in ("exact", "plus", "high", "none", "idle")]), stamp=False)
    profile = by_key(marts.customer_profile(customers, f), "customer_id")
    assert [profile[(c,)].is_financially_stressed for c in ("exact", "plus", "high", "none")] == \
        [False, True, True, None]
    idle = profile[("idle",)]
    assert idle.lifetime_spend is None and idle.preferred_channel is None and idle.category_diversity is None


def test_profile_equals_join_form(raw_txn, raw_customers):
    rows = []
    for i in range(40):
        cust = f"c{i % 4}"
        day = 1 + (i * 7) % 28
        ttype = "CREDIT" if i % 9 == 0 else "DEBIT"
        rows.append(txn_row(f"t{i}", cust, f"2024-{1 + i % 3:02d}-{day:02d} 10:00:00", f"{5 + i}.25", ttype,
                            f"M{i % 5}", ["fuel", "grocery", "pharmacy"][i % 3], ["POS", "ATM", "EFT"][i % 2]))
    f = facts(raw_txn, rows)
    customers = curate.clean_customers(raw_customers([(f"c{i}", "s", "p", "100") for i in range(5)]), stamp=False)
    single = marts.customer_profile(customers, f)
    joined = (customers.drop("_silver_processed_at")
              .join(marts.lifetime_stats(f), "customer_id", "left")
              .join(marts.preferred_channel(f), "customer_id", "left")
              .join(marts.stress_by_customer(marts.monthly_summary(f)), "customer_id", "left"))
    assert sorted(map(tuple, single.collect())) == sorted(map(tuple, joined.select(*single.columns).collect()))


def test_invariants_on_driver_tables(spark):
    from ledgerloom.plans.catalog import Layers
    layers = Layers(spark, "/root/testdata/sf0.001")
    f = layers.silver_txn()
    monthly = marts.monthly_summary(f)
    assert monthly.count() == monthly.select("customer_id", "txn_year", "txn_month").distinct().count()
    cat_total = (marts.category_spend(f, exact=True).groupBy("customer_id", "txn_year", "txn_month")
                 .agg(F.sum("cat_spend").cast("double").alias("s")))
    joined = monthly.join(cat_total, ["customer_id", "txn_year", "txn_month"])
    assert joined.filter(F.col("s") != F.col("total_spend")).count() == 0
    assert monthly.filter(F.col("month_end_spend") > F.col("total_spend")).count() == 0
    customers = layers.silver_customers()
    profile = marts.customer_profile(customers, f)
    assert profile.count() == customers.count()


def test_hot_id_and_hot_customer(raw_txn):
    # one id repeated many times, one customer holding most rows
    rows = [txn_row("hot", "big", "2024-01-05 10:00:00", f"{1 + i % 7}.00") for i in range(300)]
    rows += [txn_row(f"t{i}", "big", f"2024-01-{1 + i % 28:02d} 10:00:00", "2.00", merchant=f"M{i % 3}")
             for i in range(200)]
    rows += [txn_row("x", "small", "2024-01-05 10:00:00", "3.00")]
    s = silver(raw_txn, rows)
    assert s.filter("transaction_id = 'hot'").count() == 1
    assert float(s.filter("transaction_id = 'hot'").first().amount) == 1.0
    out = by_key(marts.monthly_summary(s), "customer_id")
    assert out[("big",)].debit_txn_count == 201 and out[("big",)].total_spend == 401.0
    assert out[("big",)].unique_merchants == 4 and out[("small",)].total_spend == 3.0


def test_empty_input_gives_typed_empty_gold(raw_txn, raw_customers):
    f = facts(raw_txn, [])
    monthly = marts.monthly_summary(f)
    assert monthly.count() == 0
    assert dict(monthly.dtypes)["month_end_stress_ratio"] == "double"
    customers = curate.clean_customers(raw_customers([("c1", "s", "p", "10")]), stamp=False)
    profile = marts.customer_profile(customers, f)
    r = profile.first()
    assert profile.count() == 1 and r.lifetime_spend is None and r.is_financially_stressed is None
    from ledgerloom.plans import insights
    report = insights.stress_report(profile.limit(0)).first()
    assert (report.total_customers, report.stressed_customers, report.stressed_pct) == (0, 0, None)


def test_profile_ties_all_fans_out_like_rank(raw_txn, raw_customers):
    rows = [txn_row("a", "c1", "2024-01-05 10:00:00", "10.00", channel="ATM"),
            txn_row("b", "c1", "2024-01-06 10:00:00", "10.00", channel="POS")]
    f = facts(raw_txn, rows)
    customers = curate.clean_customers(raw_customers([("c1", "s", "p", "10")]), stamp=False)
    assert marts.customer_profile(customers, f).count() == 1
    fanned = marts.customer_profile(customers, f, ties="all").collect()
    assert sorted(r.preferred_channel for r in fanned) == ["ATM", "POS"]


def test_largest_legal_amount_keeps_the_summary_alive(raw_txn):
    rows = [txn_row("a", "c1", "2024-01-25 10:00:00", "999999999999999.00"), txn_row("b", "c1", "2024-01-05 10:00:00", "1.00")]
    r = marts.monthly_summary(silver(raw_txn, rows)).first()
    assert r.month_end_spend == 999999999999999.0 and r.month_end_stress_ratio == 1.0


def test_fill_zero(raw_txn):
    r = marts.fill_zero(marts.monthly_summary(silver(raw_txn, [txn_row("a", "c1", "2024-01-05 10:00:00", "10.00")]))).first()
    assert (r.month_end_spend, r.month_end_stress_ratio, r.spend_to_income_ratio) == (0.0, 0.0, None)
