"""Landing, layer tables, time travel and the streaming lander."""

from __future__ import annotations

import os
from datetime import datetime, timezone

import pytest
from conftest import txn_row
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.plans.lake import Lake
from ledgerloom.plans.pipeline import Layout, ingest_csv, run_pipeline
from ledgerloom.session import scratch_path
from ledgerloom.sources import contracts, landing, tables
from ledgerloom.streaming.landing_stream import land_stream

CSV_HEADER = ("transaction_id,customer_id,transaction_date,amount,transaction_type,merchant_name,"
              "merchant_category,channel,province,segment\n")


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_batch_replay_and_as_of(spark):
    path = scratch_path(spark, "bronze")
    b1 = spark.createDataFrame([("t1", 1), ("t2", 2)], "transaction_id string, v int")
    b2 = spark.createDataFrame([("t3", 3)], "transaction_id string, v int")
    assert landing.land(b1, path, "b1", "s") == 2
    assert landing.land(b1, path, "b1", "s") == 2          # replay replaces, does not append
    assert landing.land(b2, path, "b2", "s") == 1
    bronze = landing.read_bronze(spark, path)
    assert sorted((r.transaction_id, r._batch_id) for r in bronze.collect()) == \
        [("t1", "b1"), ("t2", "b1"), ("t3", "b2")]
    assert sorted(r.transaction_id for r in landing.as_of(spark, path, "b1").collect()) == ["t1", "t2"]
    assert sorted(r.transaction_id for r in landing.without_batch(bronze, "b1").collect()) == ["t3"]
    plan = landing.without_batch(bronze, "b1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_batch_id" in plan


def test_empty_replay_clears_and_ids_need_no_order(spark):
    path = scratch_path(spark, "bronze")
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], "transaction_id string")
    landing.land(rows("a"), path, "007", "s")
    landing.land(rows("b"), path, "b10", "s")
    landing.land(rows("c"), path, "b2", "s")
    bronze = landing.read_bronze(spark, path)
    assert sorted(r.transaction_id for r in landing.as_of(spark, path, "b10").collect()) == ["a", "b"]
    assert sorted(r._batch_id for r in bronze.collect()) == ["007", "b10", "b2"]
    assert landing.land(rows(), path, "b10", "s") == 0
    assert sorted(r.transaction_id for r in landing.read_bronze(spark, path).collect()) == ["a", "c"]
    with pytest.raises(ValueError):
        landing.land(rows("x"), path, "../b1", "s")


def test_other_formats_and_business_partitions(spark):
    path, table = scratch_path(spark, "bronze"), scratch_path(spark, "table")
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "transaction_id string, province string")
    landing.land(df, path, "b1", "s", fmt="orc", partition_by=["province"])
    assert landing.read_bronze(spark, path, fmt="orc").count() == 2
    assert tables.write_table(df, table, fmt="orc") == 2 and tables.read_table(spark, table, fmt="orc").count() == 2


def test_numeric_batch_ids_stay_text(spark):
    path = scratch_path(spark, "bronze")
    landing.land(spark.createDataFrame([("t1",)], "transaction_id string"), path, "20240101120000", "s")
    assert dict(landing.read_bronze(spark, path).dtypes)["_batch_id"] == "string"


def test_csv_contract_keeps_corrupt_lines(spark):
    path = scratch_path(spark, "raw").replace("file:", "") + "/transactions.csv"
    _write(path, CSV_HEADER
           + "t1,c1,2024-01-05 10:00:00,10.50,DEBIT,Shoprite,grocery,POS,Gauteng,salaried_professional\n"
           + "t2,c1,not-a-date,abc,DEBIT,Shoprite,grocery,POS,Gauteng,salaried_professional\n")
    df = landing.read_csv(spark, path, contracts.RAW_TRANSACTIONS)
    good, bad = landing.quarantine_corrupt(df)
    assert [r.transaction_id for r in good.collect()] == ["t1"]
    assert [r.transaction_id for r in bad.collect()] == ["t2"]
    assert good.first().amount == "10.50"
    audited = landing.with_audit(df, "b9")
    r = audited.first()
    assert r._batch_id == "b9" and r._source_file.endswith("transactions.csv")


def test_partitioned_write_and_pruned_read(spark):
    path = scratch_path(spark, "silver")
    df = spark.createDataFrame([(i, 2024, 1 + i % 12) for i in range(24)], "id int, txn_year int, txn_month int")
    assert tables.write_table(df, path, partition_by=["txn_year", "txn_month"]) == 24
    start, end = tables.last_months((2024, 12), 3)
    assert (start, end) == ((2024, 10), (2024, 12))
    back = tables.read_period(spark, path, start, end)
    assert back.count() == 6
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    # dynamic overwrite replaces only the month present in the frame
    tables.write_table(spark.createDataFrame([(100, 2024, 1)], "id int, txn_year int, txn_month int"), path,
                       partition_by=["txn_year", "txn_month"], dynamic=True)
    assert tables.read_table(spark, path).count() == 24 - 2 + 1


def test_verify_layer_counts_and_raises(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert tables.verify_layer(df, {"a": df.schema["a"].dataType}) == {"rows": 1, "columns": 1}
    with pytest.raises(ValueError, match="expected"):
        tables.verify_layer(df, ["a"], least_rows=2)
    try:
        tables.verify_layer(df, ["a", "_batch_id"])
    except ValueError as e:
        assert "_batch_id" in str(e)
    else:
        raise AssertionError("missing column not reported")


def test_stream_lander_is_incremental(spark):
    landing_dir = scratch_path(spark, "landing")
    schema = "transaction_id string, amount double"
    spark.createDataFrame([("t1", 1.0), ("t2", 2.0)], schema).coalesce(1).write.parquet(landing_dir + "/f1")
    bronze, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "ckpt")
    st = StructType.fromDDL(schema)
    assert land_stream(spark, landing_dir + "/*", st, bronze, ckpt) >= 1
    spark.createDataFrame([("t3", 3.0)], schema).coalesce(1).write.parquet(landing_dir + "/f2")
    land_stream(spark, landing_dir + "/*", st, bronze, ckpt)
    rows = landing.read_bronze(spark, bronze)
    assert sorted(r.transaction_id for r in rows.collect()) == ["t1", "t2", "t3"]
    assert rows.select("_batch_id").distinct().count() >= 2


def test_pipeline_end_to_end(spark, raw_txn, raw_customers):
    layout = Layout(scratch_path(spark, "lake"))
    txn = raw_txn([txn_row("t1", "c1", "2024-01-05 10:00:00", "10.00"),
                   txn_row("t1", "c1", "2024-01-05 10:00:00", "10.00"),
                   txn_row("t2", "c1", "2024-01-25 10:00:00", "30.00")])
    cust = raw_customers([("c1", "S", "gauteng", "1000")])
    counts = run_pipeline(spark, layout, txn, cust, batch_id="b1")
    assert counts["bronze.transactions"] == 3 and counts["silver.transactions"] == 2
    assert counts["gold.customer_monthly_summary"] == 1 and counts["gold.customer_profile"] == 1
    gold = tables.read_table(spark, layout.path("gold", "customer_monthly_summary"))
    r = gold.first()
    assert r.total_spend == 40.0 and r.month_end_stress_ratio == 0.75
    assert "_gold_processed_at" in gold.columns


def test_csv_infer_mode_and_export(spark):
    path = scratch_path(spark, "raw").replace("file:", "") + "/customers.csv"
    _write(path, "customer_id,segment,province,monthly_income,income_day,spending_intensity,account_opened\n"
                 "CUS000001,salaried_professional,Gauteng,23145.77,25.0,high,2021-03-04\n"
                 "CUS000002,informal_income,Limpopo,3000.00,,low,2020-02-01\n")
    inferred = landing.read_csv(spark, path, infer=True)
    types = dict(inferred.dtypes)
    assert types["monthly_income"] == "double" and types["income_day"] == "double"
    typed = landing.read_csv(spark, path, contracts.RAW_CUSTOMERS)
    assert dict(typed.dtypes)["account_opened"] == "date"
    out = scratch_path(spark, "export")
    tables.export_csv(typed.drop("_corrupt_record"), out)
    back = landing.read_csv(spark, out, contracts.RAW_CUSTOMERS, keep_corrupt=False)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, typed.drop("_corrupt_record").collect()))


def test_lake_follows_its_inputs(spark, tmp_path):
    src, work = "/root/testdata/sf0.001", f"file://{tmp_path}/sf"
    for name in ("lineitem", "orders", "part", "supplier", "customer", "nation", "region"):
        spark.read.parquet(f"{src}/{name}.parquet").write.parquet(f"{work}/{name}.parquet")
    first = Lake(spark, work)
    path, n_customers = first.silver_transactions_path(), first.customers().count()
    assert Lake(spark, work).silver_transactions_path() == path          # same inputs, same tables
    spark.read.parquet(f"{src}/customer.parquet").limit(10).write.mode("overwrite").parquet(f"{work}/customer.parquet")
    assert Lake(spark, work).customers().count() < n_customers


def test_two_feeds_never_share_batches(spark):
    schema, bronze = "transaction_id string", scratch_path(spark, "bronze")
    for name in ("a1", "x1"):
        files = scratch_path(spark, "feed")
        spark.createDataFrame([(name,)], schema).write.parquet(files)
        land_stream(spark, files, StructType.fromDDL(schema), bronze, scratch_path(spark, "ckpt"))
    rows = landing.read_bronze(spark, bronze).collect()
    assert sorted(r.transaction_id for r in rows) == ["a1", "x1"]
    assert all(r._source_file.endswith(".parquet") for r in rows)


def test_rebuild_leaves_no_stale_month_and_quarantine_is_written(spark, raw_txn, raw_customers):
    layout, cust = Layout(scratch_path(spark, "lake")), raw_customers([("c1", "S", "gauteng", "1000")])
    run_pipeline(spark, layout, raw_txn([txn_row("t1", "c1", "2024-01-05 10:00:00", "10.00")]), cust, "b1")
    moved = raw_txn([txn_row("t1", "c1", "2024-02-05 10:00:00", "10.00"), txn_row("t2", "c1", "never", "10.00")])
    counts = run_pipeline(spark, layout, moved, cust, "b1")
    silver = tables.read_table(spark, layout.path("silver", "transactions"))
    assert [(r.transaction_id, r.txn_month) for r in silver.collect()] == [("t1", 2)]
    assert counts["silver.transactions_quarantine"] == 1
    assert tables.verify_layer(silver, contracts.SILVER_TXN)["rows"] == 1


def test_csv_path_to_bronze_keeps_corrupt_lines(spark):
    layout, path = Layout(scratch_path(spark, "lake")), scratch_path(spark, "raw").replace("file:", "") + "/customers.csv"
    _write(path, "customer_id,segment,province,monthly_income,income_day,spending_intensity,account_opened\n"
                 "CUS000001,a,Gauteng,23145.77,25.0,high,2021-03-04\nCUS000002,b,Limpopo,much,,low,2020-02-01\n")
    counts = ingest_csv(spark, layout, "customers", path, contracts.RAW_CUSTOMERS, "b1")
    assert counts == {"customers": 1, "customers_corrupt": 1}
    bad = landing.read_bronze(spark, layout.path("bronze", "customers_corrupt")).first()
    assert bad._corrupt_record.startswith("CUS000002")


def test_pipeline_replay_is_idempotent(spark, raw_txn, raw_customers):
    layout = Layout(scratch_path(spark, "lake"))
    txn = raw_txn([txn_row("t1", "c1", "2024-01-05 10:00:00", "10.00")])
    cust = raw_customers([("c1", "S", "gauteng", "1000")])
    first = run_pipeline(spark, layout, txn, cust, batch_id="b1")
    again = run_pipeline(spark, layout, txn, cust, batch_id="b1")
    assert first == again
    assert landing.read_bronze(spark, layout.path("bronze", "transactions")).count() == 1


def _ids(df):
    return sorted(r.transaction_id for r in df.collect())


def test_versions_of_a_batch_stay_readable(spark):
    path = scratch_path(spark, "bronze")
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], "transaction_id string")
    landing.land(rows("a", "b"), path, "b1", "s")
    landing.land(rows("c"), path, "b2", "s")
    then = landing.versions(spark, path)[-1][1]
    landing.land(rows("a2"), path, "b1", "s")
    landing.land(rows(), path, "b2", "s")
    assert _ids(landing.read_bronze(spark, path)) == ["a2"] == _ids(landing.read_batch(spark, path, "b1"))
    assert _ids(landing.as_of(spark, path, version=then)) == ["a", "b", "c"]
    assert _ids(landing.as_of(spark, path, "b1")) == ["a2", "c"]           # b2 was emptied later
    assert _ids(landing.as_of(spark, path, version=datetime.now(timezone.utc))) == ["a2"]
    order = landing.versions(spark, path)
    assert [b for b, _ in order] == ["b1", "b2", "b1", "b2"] and order == sorted(order, key=lambda p: p[1])
    # Only versions that nothing from ``then`` on reads go.
    assert landing.expire_versions(spark, path, then) == []
    assert landing.expire_versions(spark, path, order[2][1]) == [order[0]]
    assert _ids(landing.as_of(spark, path, "b1")) == ["a2", "c"]
    with pytest.raises(ValueError, match="nothing has landed"):
        landing.as_of(spark, path, version="0")
    with pytest.raises(ValueError):
        landing.as_of(spark, path)


def test_a_killed_write_leaves_the_old_version(spark):
    path = scratch_path(spark, "bronze")
    landing.land(spark.createDataFrame([("a",)], "transaction_id string"), path, "b1", "s")
    # Some tasks write their rows, the last one fails.
    broken = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") < 999, F.col("id").cast("string")).otherwise(
        F.raise_error(F.lit("lost")).cast("string")).alias("transaction_id"))
    with pytest.raises(Exception, match="lost"):
        landing.land(broken, path, "b1", "s")
    assert _ids(landing.read_bronze(spark, path)) == ["a"] and len(landing.versions(spark, path)) == 1


def test_versions_ascend_when_the_clock_does_not(spark, monkeypatch):
    path = scratch_path(spark, "bronze")
    rows = lambda i: spark.createDataFrame([(i,)], "transaction_id string")
    landing.land(rows("a"), path, "b1", "s")
    monkeypatch.setattr(landing.time, "time_ns", lambda: 5_000)
    landing.land(rows("b"), path, "b1", "s")
    assert _ids(landing.read_bronze(spark, path)) == ["b"]
