"""Column functions: exact rounding against Python's decimal arithmetic, text and calendar helpers."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions.calendar import month_index, period_label
from ledgerloom.functions.numeric import half_up, half_up_quotient

cents = st.integers(min_value=-10**12, max_value=10**12)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(cents, cents), min_size=1, max_size=50), st.integers(min_value=0, max_value=4))
def test_half_up_quotient_matches_decimal(spark, pairs, scale):
    df = spark.createDataFrame([(Decimal(a).scaleb(-2), Decimal(b).scaleb(-2)) for a, b in pairs],
                               "a decimal(18,2), b decimal(18,2)")
    got = [r.q for r in df.select(half_up_quotient("a", "b", scale).alias("q")).collect()]
    for (a, b), q in zip(pairs, got):
        if b == 0:
            assert q is None
            continue
        exact = (Decimal(a) / Decimal(b)).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)
        assert q == float(exact), (a, b, scale, q, exact)


def test_half_up_on_ties(spark):
    df = spark.createDataFrame([(0.125,), (2.5,), (-2.5,), (0.0,)], "x double")
    got = [r.y for r in df.select(half_up("x", 0).alias("y")).collect()]
    assert got == [0.0, 3.0, -3.0, 0.0]
    q = spark.createDataFrame([(1, 8), (1, 20000), (2, 3)], "a long, b long")
    assert [r.q for r in q.select(half_up_quotient("a", "b", 4).alias("q")).collect()] == [0.125, 0.0001, 0.6667]


def test_period_label_and_month_index(spark):
    r = spark.createDataFrame([(2024, 3)], "txn_year int, txn_month int").select(
        period_label().alias("p"), month_index().alias("i")).first()
    assert r.p == "2024-03" and r.i == 2024 * 12 + 2


def test_quotients_of_large_sums_do_not_overflow(spark):
    df = spark.createDataFrame([(Decimal("999999999999999.00"), Decimal("1000000000000000.00")),
                                (Decimal("0.29"), Decimal("1.00")), (Decimal("9e17"), Decimal("0.0001"))],
                               "a decimal(22,4), b decimal(22,4)")
    got = [r.q for r in df.select(half_up_quotient("a", "b", 4).alias("q")).collect()]
    assert got == [1.0, 0.29, 9e21]
    total = df.groupBy().agg(half_up_quotient(F.sum("a"), F.sum("b"), 4).alias("q")).first().q
    assert total == round((Decimal("999999999999999.29") + Decimal("9e17")) / Decimal("1000000000000001.0001"), 4).__float__()
