"""Silver and Gold brought up to date by batches (S2, S4, K1, D1), against full rebuilds."""

from __future__ import annotations

import os

import pytest
from conftest import txn_row

from ledgerloom.plans import pipeline, upsert
from ledgerloom.plans.pipeline import MONTHS, QUARANTINE, SURVIVORS, Layout
from ledgerloom.session import scratch_path
from ledgerloom.sources import landing, tables

STAMPS = ("_silver_processed_at", "_gold_processed_at", "_ingested_at")


def rows_of(spark, layout, layer, name):
    df = tables.read_table(spark, layout.path(layer, name))
    return sorted(map(str, df.select(*sorted(c for c in df.columns if c not in STAMPS)).collect()))


def files_of(layout, name, month):
    folder = layout.path("silver", name).replace("file:", "") + f"/txn_year={month[0]}/txn_month={month[1]}"
    return {f: os.stat(f"{folder}/{f}").st_mtime_ns for f in os.listdir(folder)} if os.path.isdir(folder) else None


def land(layout, df, batch):
    pipeline.land_raw(df, layout, "transactions", batch, "s")


def rebuilt(spark, layout):
    """The same Bronze, built as a whole elsewhere."""
    other = Layout(scratch_path(spark, "rebuilt"))
    for batch in sorted({b for b, _ in landing.versions(spark, layout.path("bronze", "transactions"))}):
        rows = landing.read_batch(spark, layout.path("bronze", "transactions"), batch).drop("_ingested_at", "_batch_id", "_source_file")
        land(other, rows, batch)
    land_customers(spark, other)
    pipeline.build_silver(spark, other)
    return other


def land_customers(spark, layout):
    rows = [("c1", "S", "gauteng", "1000"), ("c2", "S", "limpopo", "2000")]
    pipeline.land_raw(spark.createDataFrame(rows, "customer_id string, segment string, province string, monthly_income string"),
                      layout, "customers", "b1", "s")


FIRST = [txn_row("t1", "c1", "2024-01-05 10:00:00", "10.00"), txn_row("t1", "c1", "2024-01-06 10:00:00", "11.00"),
         txn_row("t2", "c1", "2024-02-25 10:00:00", "30.00"), txn_row("t3", "c2", "2024-03-25 10:00:00", "5.00", merchant=" spar"),
         txn_row("t4", "c2", "2024-04-01 08:00:00", "7.00"), txn_row("t5", "c1", None, "8.00"), txn_row("t6", "c1", "2024-01-09 10:00:00", "-1"),
         txn_row("t7", "c2", "2024-05-01 08:00:00", "9.00"), txn_row(None, "c2", "2024-05-01 08:00:00", "9.00")]


@pytest.fixture
def layout(spark, raw_txn):
    made = Layout(scratch_path(spark, "lake"))
    land(made, raw_txn(FIRST), "b1")
    land_customers(spark, made)
    pipeline.build_silver(spark, made)
    return made


def same_as_rebuild(spark, layout):
    whole = rebuilt(spark, layout)
    for name in (SURVIVORS, "transactions", QUARANTINE):
        assert rows_of(spark, layout, "silver", name) == rows_of(spark, whole, "silver", name), name


LATE = [txn_row("t1", "c1", "2024-01-04 10:00:00", "12.00"),                    # earlier, same month
        txn_row("t2", "c1", "2024-01-20 10:00:00", "31.00"),                    # moves to another month, its own is left empty
        txn_row("t3", "c2", "2024-03-26 10:00:00", "4.00"),                     # loses
        txn_row("t5", "c1", "2024-04-02 10:00:00", "8.00"),                     # leaves the quarantine
        txn_row("t6", "c1", None, "6.00"),                                      # still unusable
        txn_row("t8", "c2", "never", "2.00"), txn_row("t9", "c2", "2024-06-01 10:00:00", "1.00")]


def test_a_batch_rewrites_the_months_it_touches(spark, raw_txn, layout):
    untouched = {m: files_of(layout, t, m) for m in ((2024, 3), (2024, 5)) for t in ("transactions",)}
    survivors = files_of(layout, SURVIVORS, (2024, 5))
    land(layout, raw_txn(LATE), "b2")
    done = upsert.upsert_silver(spark, layout, "b2")
    assert {(2024, 1), (2024, 2), (2024, 4), (2024, 6), (None, None)} == set(done.months)
    assert all(files and files_of(layout, "transactions", m) == files for m, files in untouched.items())
    assert survivors == files_of(layout, SURVIVORS, (2024, 5))
    assert files_of(layout, "transactions", (2024, 2)) is None                   # nothing is left of the emptied month
    same_as_rebuild(spark, layout)


def test_a_replay_takes_rows_back(spark, raw_txn, layout):
    land(layout, raw_txn(LATE), "b2")
    upsert.upsert_silver(spark, layout, "b2")
    land(layout, raw_txn([txn_row("t9", "c2", "2024-07-01 10:00:00", "1.00"), txn_row("t1", "c1", "2024-02-01 00:00:00", "1.00")]), "b2")
    upsert.upsert_silver(spark, layout, "b2")
    same_as_rebuild(spark, layout)
    land(layout, raw_txn([]), "b2")
    upsert.upsert_silver(spark, layout, "b2")
    same_as_rebuild(spark, layout)
    assert upsert.upsert_silver(spark, layout, "b2").months == []                # nothing more to do


@pytest.mark.parametrize("fails_at", [0, 1, 2])
def test_a_killed_run_is_made_good_by_the_next(spark, raw_txn, layout, monkeypatch, fails_at):
    land(layout, raw_txn(LATE), "b2")
    real, calls = tables.replace_partitions, []

    def killed(*args):
        calls.append(args)
        if len(calls) > fails_at:
            raise KeyboardInterrupt
        return real(*args)

    monkeypatch.setattr(tables, "replace_partitions", killed)
    with pytest.raises(KeyboardInterrupt):
        upsert.upsert_silver(spark, layout, "b2")
    monkeypatch.setattr(tables, "replace_partitions", real)
    upsert.upsert_silver(spark, layout, "b2")
    same_as_rebuild(spark, layout)


def test_a_batch_without_rows(spark, raw_txn, layout):
    land(layout, raw_txn([]), "b3")
    assert upsert.upsert_silver(spark, layout, "b3").months == []
    same_as_rebuild(spark, layout)


def test_a_batch_with_other_columns(spark, raw_txn, layout):
    rows = raw_txn([txn_row("t20", "c2", "2024-06-02 10:00:00", "1.00")])
    land(layout, rows.drop("channel").withColumn("store", rows.transaction_id), "b4")
    upsert.upsert_silver(spark, layout, "b4")
    silver = tables.read_table(spark, layout.path("silver", "transactions"))
    new = silver.filter("transaction_id = 't20'").first()
    assert new.channel is None and "store" not in silver.columns and silver.count() == 6


def test_gold_months_follow(spark, raw_txn, layout):
    pipeline.build_gold(spark, layout)
    land(layout, raw_txn(LATE), "b2")
    done = upsert.upsert_silver(spark, layout, "b2")
    upsert.upsert_gold_months(spark, layout, done.months)
    whole = rebuilt(spark, layout)
    pipeline.build_gold(spark, whole)
    name = "customer_monthly_summary"
    assert rows_of(spark, layout, "gold", name) == rows_of(spark, whole, "gold", name)


def test_replaced_partitions_prune_and_leave_others(spark):
    path = scratch_path(spark, "table")
    make = lambda rows: spark.createDataFrame(rows, "id int, txn_year int, txn_month int")
    tables.write_table(make([(1, 2024, 1), (2, 2024, 2), (3, None, None), (4, 2024, 3)]), path, partition_by=MONTHS)
    assert tables.replace_partitions(make([(5, 2024, 2)]), path, MONTHS, [(2024, 2), (None, None)]) == 1
    assert sorted(r.id for r in tables.read_table(spark, path).collect()) == [1, 4, 5]
    plan = tables.read_table(spark, path).filter(tables.in_partitions([(2024, 2), (2024, 3)], MONTHS))
    scan = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "PartitionFilters: []" not in scan
    assert tables.replace_partitions(make([]), path, MONTHS, []) == 0
