"""Landing, building and upserting Silver leave no shuffles behind and never need the disk for all of them at once."""

from __future__ import annotations

import time

import pytest
from conftest import txn_row
from pyspark.sql import functions as F

from ledgerloom.plans import pipeline, upsert
from ledgerloom.plans.pipeline import MONTHS, SURVIVORS, Layout
from ledgerloom.session import _LEAN_CONF, lean_disk, scratch_path
from ledgerloom.sources import landing, tables

TABLES = (SURVIVORS, "transactions", pipeline.QUARANTINE)
ROWS = [txn_row(f"t{i % 40}", f"c{i % 3}" if i % 7 else None, f"2024-{i % 5 + 1:02d}-{i % 28 + 1:02d} 10:00:00" if i % 6 else None, str(i % 9))
        for i in range(90)] + [txn_row(None, "c", "2024-01-01", "1"), txn_row("q1", "c1", None, "8")]
LATE = [txn_row(f"t{i}", "c9", f"2023-12-{i % 28 + 1:02d} 10:00:00", "3") for i in range(0, 60, 4)]


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (disk.apply(i).getName() for i in range(disk.size())) if n.startswith("shuffle_")}


def contents(spark, layout):
    found = {}
    for name in TABLES:
        df = tables.read_table(spark, layout.path("silver", name))
        found[name] = sorted(map(str, df.select(*sorted(c for c in df.columns if c not in ("_silver_processed_at", "_ingested_at"))).collect()))
    return found


def build(spark, raw_txn, raw_customers):
    layout = Layout(scratch_path(spark, "lake"))
    pipeline.land_raw(tables.passes(raw_txn(ROWS), "transaction_id", 5), layout, "transactions", "b1", "s")
    pipeline.land_raw(raw_customers([("c1", "S", "gauteng", "1000")]), layout, "customers", "b1", "s")
    counts = pipeline.build_silver(spark, layout)
    pipeline.land_raw(raw_txn(LATE), layout, "transactions", "b2", "s")
    upsert.upsert_silver(spark, layout, "b2")
    pipeline.land_raw(raw_txn(LATE[::2]), layout, "transactions", "b2", "s")
    upsert.upsert_silver(spark, layout, "b2")
    return layout, counts


def test_shuffles_go_with_the_job_that_wrote_them(spark, raw_txn, raw_customers):
    raw, customers = raw_txn(ROWS), raw_customers([("c1", "S", "gauteng", "1000")])
    settings = {k: spark.conf.get(k, None) for k in _LEAN_CONF}
    before = shuffle_files(spark)
    build(spark, lambda rows: raw if rows is ROWS else raw_txn(rows), lambda rows: customers)
    until = time.time() + 20                    # files are removed in the background
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert settings == {k: spark.conf.get(k, None) for k in _LEAN_CONF}


def test_parts_make_the_tables_that_one_pass_makes(spark, raw_txn, raw_customers, monkeypatch):
    whole, counts = build(spark, raw_txn, raw_customers)
    monkeypatch.setattr(tables, "PASS_BYTES", 1)
    parts, again = build(spark, raw_txn, raw_customers)
    assert contents(spark, parts) == contents(spark, whole) and again == counts
    bronze = landing.read_batch(spark, parts.path("bronze", "transactions"), "b1")
    assert bronze.count() == len(ROWS) and bronze.select("_ingested_at").distinct().count() == 1


def test_each_row_is_in_one_part_and_the_choice_reaches_the_scan(spark, raw_txn):
    path = scratch_path(spark, "rows")
    raw_txn(ROWS).write.parquet(path)
    first = pipeline.curate.surviving_transactions(spark.read.parquet(path))
    assert len(tables.passes(first, "transaction_id", tables.PASS_BYTES)) == 1
    parts = tables.passes(first, "transaction_id", 1 << 50)
    assert len(parts) == tables.MOST_PASSES
    assert sorted(str(r) for p in parts for r in p.collect()) == sorted(map(str, first.collect()))
    plan = parts[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("xxhash64")                   # printed from the top down
    rows = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
    assert sum(p.count() for p in tables.passes(rows, "k", 1 << 50)) == 3


def test_a_killed_part_leaves_the_table_as_it_was(spark, monkeypatch):
    path = f"{scratch_path(spark, 'lake')}/table"
    make = lambda n: spark.range(n).select("id", F.lit(2024).alias("txn_year"), F.lit(1).alias("txn_month"))
    tables.write_table(make(3), path, MONTHS)
    real, calls = tables.write_table, []

    def killed(*args, **more):
        calls.append(args)
        if len(calls) > 1:
            raise KeyboardInterrupt
        return real(*args, **more)

    monkeypatch.setattr(tables, "write_table", killed)
    with pytest.raises(KeyboardInterrupt):
        tables.write_passes([make(5), make(6)], path, MONTHS)
    assert tables.read_table(spark, path).count() == 3
    monkeypatch.setattr(tables, "write_table", real)
    assert tables.write_passes([make(5), make(6)], path, MONTHS) == 11 == tables.read_table(spark, path).count()


def test_rows_of_few_ids_are_filtered_before_a_shuffle(spark):
    path, few = scratch_path(spark, "rows"), scratch_path(spark, "few")
    spark.range(1000).select(F.col("id").cast("string").alias("transaction_id"), "id").write.parquet(path)
    spark.createDataFrame([("7",), ("7",), ("900",), ("x",), (None,), ("",)], "transaction_id string").write.parquet(few)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with lean_disk(spark):
            found = upsert._among(spark.read.parquet(path), spark.read.parquet(few))
            assert "might_contain" in found._jdf.queryExecution().optimizedPlan().toString()
            assert sorted(r.id for r in found.collect()) == [7, 900]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
