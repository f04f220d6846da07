"""Silver by batches: a new batch rewrites the months it touches and no others.

``build_silver`` de-duplicates all of Bronze; here the table of survivors it
leaves is merged with one batch.  The least of all copies of an id is the least
of its old survivor and its new copies, so the merge gives the table that a full
rebuild would, from the batch and the survivors' id column:

1. the batch's ids are looked up among the survivors by a semi-join; where the
   batch had been landed before, survivors that came from it are taken back, and
   only for their ids Bronze's other batches are read again;
2. the least copies among these few rows are the new survivors;
3. the months in which changed ids stand, or stood, are rewritten in the
   survivors, in Silver and in the quarantine (``tables.replace_partitions``).

The tables keep their columns: one that a batch brings and the survivors lack waits
in Bronze for the next full build, one that the batch lacks is NULL.

A run that is killed can be run again: what is replaced is found in every table
by the ids that stand there, not remembered.  The months are the only thing that
reaches the driver, a row per month touched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import curate, marts
from ledgerloom.plans.pipeline import MONTHS, QUARANTINE, SURVIVORS, Layout, silver_from_survivors
from ledgerloom.session import lean_disk
from ledgerloom.sources import landing, tables

ID = "transaction_id"


@dataclass
class Upsert:
    """Months rewritten in Silver (and the quarantine), and the rows written per table."""
    months: list[tuple]
    rows: dict[str, int]


def _among(table: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``table`` with one of these ids.  The comparison, true of every id that can match, is what Spark asks
    for to build a Bloom filter of the ids (``session.lean_disk``), so that a large table isn't shuffled for few ids."""
    return table.join(ids.filter(F.length(F.col(ID).cast("string")) >= 0), ID, "left_semi")


def _months_of(table: DataFrame, ids: DataFrame) -> set[tuple]:
    found = _among(table, ids).select(*MONTHS).distinct().collect()
    return {tuple(r) for r in found}


def changed_survivors(spark: SparkSession, layout: Layout, batch_id: str) -> tuple[DataFrame, DataFrame]:
    """(rows, ids): the new survivors of the ids whose survivor changes, and all these ids; an id may have no row left."""
    bronze = layout.path("bronze", "transactions")
    old = tables.read_table(spark, layout.path("silver", SURVIVORS))
    incoming = landing.read_batch(spark, bronze, batch_id)
    batch = F.col(landing.BATCH_COLUMN) == batch_id
    taken_back = tables.stored(old.filter(batch).select(ID), "taken-back")
    candidates = incoming.unionByName(_among(old.filter(~batch).drop(*MONTHS), incoming.select(ID)), allowMissingColumns=True)
    if not taken_back.isEmpty():
        rest = _among(landing.read_bronze(spark, bronze).filter(~batch), taken_back)
        candidates = candidates.unionByName(rest, allowMissingColumns=True)
    winners = curate.surviving_transactions(candidates.select(*[c for c in old.columns if c not in MONTHS]))
    # A winner from another batch is the old survivor again, unless that one has been taken back.
    again = taken_back.withColumn("_again", F.lit(True))
    rows = tables.stored(winners.join(again, ID, "left").filter(batch | F.col("_again")).drop("_again").select(*old.columns), "winners")
    return rows, tables.stored(rows.select(ID).unionByName(taken_back).distinct(), "changed-ids")


def upsert_silver(spark: SparkSession, layout: Layout, batch_id: str) -> Upsert:
    """Brings the survivors, Silver and the quarantine up to date with one (landed) batch of transactions."""
    with lean_disk(spark):
        rows, ids = changed_survivors(spark, layout, batch_id)
        path = {t: layout.path("silver", t) for t in (SURVIVORS, "transactions", QUARANTINE)}
        table = {t: tables.read_table(spark, p) for t, p in path.items()}
        come = {tuple(r) for r in rows.select(*MONTHS).distinct().collect()}
        months = sorted(come | _months_of(table[SURVIVORS], ids), key=str)
        # Months that an earlier, killed run has left behind in the two filters are found here.
        touched = sorted({*months, *_months_of(table["transactions"], ids), *_months_of(table[QUARANTINE], ids)}, key=str)
        here = table[SURVIVORS].filter(tables.in_partitions(months, MONTHS)).join(ids, ID, "left_anti")
        written = {SURVIVORS: tables.replace_partitions(here.unionByName(rows), path[SURVIVORS], MONTHS, months)}
        survivors = tables.read_table(spark, path[SURVIVORS]).filter(tables.in_partitions(touched, MONTHS))
        for name, part in zip(("transactions", QUARANTINE), silver_from_survivors(survivors)):
            written[name] = tables.replace_partitions(part.select(*table[name].columns), path[name], MONTHS, touched, True)
        return Upsert(touched, written)


def upsert_gold_months(spark: SparkSession, layout: Layout, months: list[tuple], ties: str = "one") -> int:
    """K3 for just these months of Silver: the monthly summary's other months keep their files."""
    months = [m for m in months if None not in m]
    path = layout.path("gold", "customer_monthly_summary")
    txn = tables.read_table(spark, layout.path("silver", "transactions")).filter(tables.in_partitions(months, MONTHS))
    summary = marts.monthly_summary(txn, ties, stamp=True)
    return tables.replace_partitions(summary.select(*tables.read_table(spark, path).columns), path, MONTHS, months)
