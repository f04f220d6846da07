"""Contracts that grow (S1, S8, S11) and tables clustered by two columns."""

from __future__ import annotations

import glob
from datetime import date, timedelta
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.session import scratch_path
from ledgerloom.sources import evolution, landing, tables, zorder

ddl = StructType.fromDDL


def test_two_batches_of_different_columns_read_as_one_table(spark):
    path = scratch_path(spark, "bronze")
    first = spark.createDataFrame([("a", 1, Decimal("1.50"), date(2024, 1, 2), 1.5)], "id string, n int, amount decimal(8,2), day date, f float")
    second = spark.createDataFrame([("b", 5_000_000_000, Decimal("2.1234"), None, 2.5, "x")],
                                   "id string, n long, amount decimal(22,4), day timestamp_ntz, f double, extra string")
    contract = evolution.land_evolving(first, path, "b1", first.schema, "s")
    contract = evolution.land_evolving(second, path, "b2", contract, "s")
    assert contract.simpleString() == "struct<id:string,n:bigint,amount:decimal(22,4),day:timestamp_ntz,f:double,extra:string>"
    assert evolution.contract_of(spark, path) == contract
    rows = {r.id: r for r in evolution.read_evolved(spark, path).collect()}
    assert (rows["a"].n, rows["a"].amount, rows["a"].f, rows["a"].extra, rows["a"]._batch_id) == (1, Decimal("1.5000"), 1.5, None, "b1")
    assert rows["a"].day.isoformat() == "2024-01-02T00:00:00"
    assert (rows["b"].n, rows["b"].amount, rows["b"].extra) == (5_000_000_000, Decimal("2.1234"), "x")


@pytest.mark.parametrize("old, new, says", [("n long", "n int", "column n narrows from bigint to int"), ("n int", "n string", "column n changes"),
                                            ("a decimal(10,4)", "a decimal(8,2)", "column a narrows"), ("d double", "d int", "column d narrows"),
                                            ("n long", "n double", "column n changes")])
def test_a_narrowing_raises_with_the_column(spark, old, new, says):
    with pytest.raises(ValueError, match=says):
        evolution.evolve(ddl("id string, " + old), ddl(new))


def test_a_refused_batch_leaves_the_table(spark):
    path = scratch_path(spark, "bronze")
    wide = spark.createDataFrame([("a", 1)], "id string, n long")
    contract = evolution.land_evolving(wide, path, "b1", wide.schema, "s")
    with pytest.raises(ValueError, match="column n"):
        evolution.land_evolving(spark.createDataFrame([("b", 1)], "id string, n int"), path, "b2", contract, "s")
    assert [b for b, _ in landing.versions(spark, path)] == ["b1"]
    fewer = evolution.land_evolving(spark.createDataFrame([("c",)], "id string"), path, "b3", contract, "s")
    assert fewer == contract and evolution.read_evolved(spark, path, fewer).count() == 2


def test_fields_without_a_place_are_rescued(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([("1", "2.5", "x", None), ("2", "much", None, "q"), ("3", None, None, None)], "id string, amount string, more string, z string").coalesce(
        1).write.option("header", True).csv(path)
    rows = {r.id: r for r in evolution.read_csv_rescued(spark, path, ddl("id int, amount decimal(6,2), channel string")).collect()}
    assert rows[1]._rescued == {"more": "x"} and rows[1].amount == Decimal("2.50") and rows[1].channel is None
    assert rows[2]._rescued == {"amount": "much", "z": "q"} and rows[2].amount is None
    assert rows[3]._rescued is None
    plain = evolution.read_csv_rescued(spark, path, ddl("id string, amount string, more string, z string"))
    assert plain.filter("_rescued IS NOT NULL").count() == 0 and plain.count() == 3


def share_read(path, column, value):
    """The share of row groups whose minimum and maximum leave the value possible."""
    hit = total = 0
    for f in glob.glob(path.replace("file:", "") + "/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            total, hit = total + 1, hit + (s is not None and s.has_min_max and s.min <= value <= s.max)
    return hit / total


def test_either_column_reads_few_row_groups(spark):
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(256)]
    df = tables.stored(spark.range(40_000).select(
        (F.pmod(F.xxhash64("id"), F.lit(500))).alias("customer"), F.date_add(F.lit(days[0]), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(256)).cast("int")).alias("day"),
        "id"), "rows")
    path, by_customer = scratch_path(spark, "z"), scratch_path(spark, "sorted")
    zorder.write_clustered(df, path, ["customer", "day"], files=64)
    df.repartitionByRange(64, "customer").write.parquet(by_customer)
    assert tables.read_table(spark, path).exceptAll(df).count() == 0 == df.exceptAll(tables.read_table(spark, path)).count()
    assert share_read(by_customer, "day", days[77]) == 1.0
    # An eighth of each range where files keep to the cells; the sampled bounds of the ranges cut across some.
    assert share_read(path, "day", days[77]) <= 0.34 and share_read(path, "customer", 123) <= 0.34


def test_interleaving_and_nulls(spark):
    got = spark.createDataFrame([(0b11, 0b00), (0b01, 0b10)], "a int, b int").select(zorder.interleaved([F.col("a"), F.col("b")], 2).alias("z"))
    assert [r.z for r in got.collect()] == [0b1010, 0b0110]
    df = spark.createDataFrame([(None, 1), (5, None), (None, None)], "a int, b int")
    path = scratch_path(spark, "z")
    zorder.write_clustered(df, path, ["a", "b"], files=2)
    assert tables.read_table(spark, path).count() == 3
    zorder.write_clustered(df.limit(0), scratch_path(spark, "z"), ["a", "b"])
