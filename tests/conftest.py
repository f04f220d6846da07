from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"

RAW_TXN_DDL = ("transaction_id string, customer_id string, transaction_date string, amount string, "
               "transaction_type string, merchant_name string, merchant_category string, channel string")
CUSTOMER_DDL = "customer_id string, segment string, province string, monthly_income string"


@pytest.fixture(scope="session")
def spark():
    session = get_spark("ledgerloom-tests", master="local[*]", shuffle_partitions=8,
                        extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="ledgerloom-tests-")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def txn_row(tid, cust, date, amount, ttype="DEBIT", merchant="SHOP", category="grocery", channel="POS"):
    return (tid, cust, date, amount, ttype, merchant, category, channel)


@pytest.fixture
def raw_txn(spark):
    def make(rows):
        return spark.createDataFrame(rows, RAW_TXN_DDL)
    return make


@pytest.fixture
def raw_customers(spark):
    def make(rows):
        return spark.createDataFrame(rows, CUSTOMER_DDL)
    return make
