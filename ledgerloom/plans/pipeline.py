"""The layered pipeline as jobs: land -> Silver -> Gold tables on Parquet.

Each step writes a table and returns its observed row count.  Gold reads the
Silver table (not the raw files), and the profile reads the stored monthly
summary: on a cluster every later step restarts from written tables, not from
lineage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.operators import curate, marts
from ledgerloom.session import lean_disk
from ledgerloom.sources import files, landing, tables


MONTHS = ["txn_year", "txn_month"]
SURVIVORS, QUARANTINE = "transactions_survivors", "transactions_quarantine"


@dataclass
class Layout:
    """Table locations under one root (the shared folder on a cluster)."""
    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"


def land_raw(df: DataFrame | list[DataFrame], layout: Layout, name: str, batch_id: str, source: str | None = None) -> int:
    return landing.land(df, layout.path("bronze", name), batch_id, source)


def ingest_csv(spark: SparkSession, layout: Layout, name: str, csv_path: str, schema: StructType, batch_id: str) -> dict[str, int]:
    """S1 + S2 in one call: a CSV path to a Bronze batch.  Lines that break the
    contract go, with their raw text, to the batch of the same id of ``<name>_corrupt``."""
    good, bad = landing.quarantine_corrupt(landing.read_csv(spark, csv_path, schema))
    return {name: landing.land(good, layout.path("bronze", name), batch_id),
            f"{name}_corrupt": landing.land(bad, layout.path("bronze", f"{name}_corrupt"), batch_id, csv_path)}


def silver_from_survivors(survivors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(Silver, quarantine), both with their month columns."""
    months = [F.col(c) for c in MONTHS]
    return (curate.clean_transactions(survivors.drop(*MONTHS), dedup=False),
            curate.quarantined_transactions(survivors.withColumns({f"_{c}": m for c, m in zip(MONTHS, months)}).drop(*MONTHS), dedup=False)
            .withColumnsRenamed({f"_{c}": c for c in MONTHS}))


def build_silver(spark: SparkSession, layout: Layout) -> dict[str, int]:
    """Silver from all of Bronze: each table is replaced as a whole, so a row that
    has moved to another month leaves nothing behind.

    Bronze is de-duplicated once, into a table of survivors, in parts by id so that the
    whole of it is never on disk as shuffles; Silver, and what it can't hold with its
    reason (Q10), are two filters of that table, whose files are by month already."""
    bronze = layout.path("bronze", "transactions")
    with lean_disk(spark):
        survivors = curate.surviving_transactions(landing.read_bronze(spark, bronze))
        cust = curate.clean_customers(landing.read_bronze(spark, layout.path("bronze", "customers")))
        counts = {"transactions_survivors": tables.write_passes(
            tables.passes(survivors, "transaction_id", files.size(spark, bronze)), layout.path("silver", SURVIVORS), MONTHS)}
        silver, quarantine = silver_from_survivors(tables.read_table(spark, layout.path("silver", SURVIVORS)))
        counts["transactions"] = tables.write_table(silver, layout.path("silver", "transactions"), MONTHS, grouped=True)
        counts["transactions_quarantine"] = tables.write_table(quarantine, layout.path("silver", QUARANTINE), MONTHS, grouped=True)
        return counts | {"customers": tables.write_table(cust, layout.path("silver", "customers"))}


def build_gold(spark: SparkSession, layout: Layout, ties: str = "one") -> dict[str, int]:
    txn = tables.read_table(spark, layout.path("silver", "transactions"))
    customers = tables.read_table(spark, layout.path("silver", "customers"))
    monthly = layout.path("gold", "customer_monthly_summary")
    counts = {"customer_monthly_summary": tables.write_table(
        marts.monthly_summary(txn, ties, stamp=True), monthly, partition_by=["txn_year", "txn_month"])}
    counts["customer_profile"] = tables.write_table(
        marts.customer_profile(customers, txn, tables.read_table(spark, monthly), ties, stamp=True),
        layout.path("gold", "customer_profile"))
    return counts


def run_pipeline(spark: SparkSession, layout: Layout, transactions: DataFrame, customers: DataFrame,
                 batch_id: str | None = None) -> dict[str, int]:
    """Land both inputs as one batch, then build Silver and Gold."""
    batch = batch_id or landing.new_batch_id()
    counts = {"bronze.transactions": land_raw(transactions, layout, "transactions", batch, "transactions"),
              "bronze.customers": land_raw(customers, layout, "customers", batch, "customers")}
    counts.update({f"silver.{k}": v for k, v in build_silver(spark, layout).items()})
    counts.update({f"gold.{k}": v for k, v in build_gold(spark, layout).items()})
    return counts
