"""Every registered query against its DuckDB formulation on the sf0.001 tables
(the driver repeats this at sf0.01)."""

from __future__ import annotations

import os

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry
from ledgerloom.plans.catalog import QUERIES
from ledgerloom.plans.oracle_sql import ORACLE
from tools.oracle_check import TABLES, rows_of

# The training-data queries have their own tests, beside their folder.
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert rows_of(df.columns, s_rows) == rows_of(d_cols, d_rows)
