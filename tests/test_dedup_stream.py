"""De-duplication as a stream: state over micro-batches, expiry, late and unusable rows."""

from __future__ import annotations

import pytest
from pyspark.sql.types import StructType

from ledgerloom.operators import curate
from ledgerloom.session import scratch_path
from ledgerloom.sources import landing
from ledgerloom.streaming.dedup_stream import dedup_stream

SCHEMA = "transaction_id string, customer_id string, transaction_date string, amount string"


def row(i, day, amount="1.00"):
    return (i, "c1", None if day is None else f"2024-01-{day:02d} 10:00:00", amount)


class Feed:
    def __init__(self, spark):
        self.spark = spark
        self.files, self.accepted, self.refused, self.checkpoint = (scratch_path(spark, n) for n in ("feed", "acc", "ref", "cp"))

    def take(self, *rows, delay="2 days"):
        self.spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(self.files)
        return self.run(delay)

    def run(self, delay="2 days"):
        return dedup_stream(self.spark, self.files, StructType.fromDDL(SCHEMA), self.accepted, self.refused, self.checkpoint, delay=delay)

    def ids(self, path):
        return sorted((r.transaction_id or "", getattr(r, "reason", "")) for r in landing.read_bronze(self.spark, path).collect())


@pytest.fixture
def feed(spark):
    return Feed(spark)


def test_copies_across_batches_equal_the_batch_result(spark, feed):
    parts = [[row("a", 1), row("b", 2), row("a", 1)], [row("b", 2), row("c", 3)], [row("c", 3), row("a", 1), row("d", 4)]]
    for part in parts:
        feed.take(*part, delay="10 days")
    rows = [r for part in parts for r in part]
    want = curate.dedup_transactions(spark.createDataFrame(rows, SCHEMA)).collect()
    got = landing.read_bronze(spark, feed.accepted).select("transaction_id", "customer_id", "transaction_date", "amount").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert feed.ids(feed.refused) == []


def test_state_expires_and_late_rows_are_put_aside(spark, feed):
    feed.take(row("a", 1), row("b", 2))
    run = feed.take(row("c", 20))                       # the watermark goes to the 18th
    assert run.state[-1] == 1 and sum(run.expired) == 2   # only c is held
    feed.take(row("late", 3), row("c", 20), row("e", 21), row(None, 21), row("timeless", None), row("a", 1))
    assert feed.ids(feed.accepted) == [("a", ""), ("b", ""), ("c", ""), ("e", "")]
    assert feed.ids(feed.refused) == [("", "id"), ("late", "late"), ("timeless", "time")]


def test_a_run_without_new_files_changes_nothing(spark, feed):
    feed.take(row("a", 1), row("b", 2))
    before = landing.versions(spark, feed.accepted)
    feed.run()
    assert feed.ids(feed.accepted) == [("a", ""), ("b", "")]
    assert [b for b, _ in before] == [b for b, _ in landing.versions(spark, feed.accepted)][:len(before)]
