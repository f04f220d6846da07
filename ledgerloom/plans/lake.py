"""Materialised layers over one input directory: the Silver and Gold tables.

The layered design reads each layer from the table below it, never from the
raw files: Gold is built from the Silver table, reports read Gold (SURVEY 3.3,
7.5).  ``Lake`` writes those tables on first use with plain overwrites into a
scratch folder of the application and remembers where; they belong to the state
of the input files (path, length, modification time) as they are listed when the
``Lake`` is made, so changed input means new tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.operators import curate, marts, months
from ledgerloom.session import scratch_path
from ledgerloom.sources import tables
from ledgerloom.sources.bindings import DriverTables

LEDGER_INPUTS = ["lineitem", "orders", "part", "supplier", "customer", "nation", "region"]
#: (application, input state, table) -> where it was written, or its name in the session's catalog.
_WRITTEN: dict[tuple, str] = {}


def input_state(spark: SparkSession, sf_dir: str, inputs: list[str]) -> tuple:
    """Every data file of the inputs, with its length and modification time."""
    jvm, files = spark.sparkContext._jvm, []
    for name in inputs:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        listed = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
        while listed.hasNext():
            status = listed.next()
            files.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(files))


class Lake:
    """Silver and Gold tables derived from one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.raw = DriverTables(spark, sf_dir)
        self.state = (spark.sparkContext.applicationId, input_state(spark, self.raw.sf_dir, LEDGER_INPUTS))

    def _path(self, name: str, build: Callable[[], DataFrame], partition_by: list[str] | None = None) -> str:
        key = (*self.state, name)
        if key not in _WRITTEN:
            path = scratch_path(self.spark, name)
            tables.write_table(build(), path, partition_by=partition_by)
            _WRITTEN[key] = path
        return _WRITTEN[key]

    # ---------------------------------------------------------------- Silver
    def silver_transactions_path(self) -> str:
        return self._path("silver-transactions", lambda: curate.clean_transactions(self.raw.unique_ledger(), dedup=False),
                          partition_by=["txn_year", "txn_month"])

    def silver_customers(self) -> DataFrame:
        return tables.read_table(self.spark, self._path(
            "silver-customers", lambda: curate.clean_customers(self.raw.raw_customers())))

    def txn(self) -> DataFrame:
        """Silver transactions without the processing stamp."""
        return tables.read_table(self.spark, self.silver_transactions_path()).drop("_silver_processed_at")

    def customers(self) -> DataFrame:
        return self.silver_customers().drop("_silver_processed_at")

    # ---------------------------------------------------------------- Gold
    def monthly_summary(self, ties: str = "one") -> DataFrame:
        path = self._path(f"gold-customer-monthly-summary-{ties}",
                          lambda: marts.monthly_summary(self.txn(), ties, stamp=True),
                          partition_by=["txn_year", "txn_month"])
        return tables.read_table(self.spark, path).drop("_gold_processed_at")

    def customer_profile(self) -> DataFrame:
        """Gold profile, with the activity columns (months with debits, first and last)."""
        path = self._path("gold-customer-profile", lambda: marts.customer_profile(
            self.silver_customers(), self.txn(), self.monthly_summary(), stamp=True, with_activity=True))
        return tables.read_table(self.spark, path).drop("_gold_processed_at", "_silver_processed_at")

    def _bucketed(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        key = (*self.state, name)
        if key not in _WRITTEN:
            path = scratch_path(self.spark, name)
            table = "ledgerloom_" + path.rsplit("/", 1)[-1].replace("-", "_")
            tables.write_bucketed(build(), path, table, "customer_id")
            _WRITTEN[key] = table
        return self.spark.table(_WRITTEN[key])

    def numbers(self) -> dict[str, DataFrame]:
        """The numbers of merchants and categories that the sets of the customer months are made of."""
        return {name: tables.read_table(self.spark, self._path(f"numbers-{name}", lambda c=column: months.numbered(self.txn(), c)))
                for name, column in months.SETS.items()}

    def customer_months(self) -> DataFrame:
        """Gold customer months that merge, and customers, in the same buckets by customer."""
        return self._bucketed("gold-customer-months", lambda: months.customer_months(
            self.txn(), self.numbers(), summary=self.monthly_summary()))

    def bucketed_customers(self) -> DataFrame:
        return self._bucketed("silver-customers-bucketed", self.customers)

    def build(self) -> None:
        """Materialise every layer now (a pipeline run)."""
        self.silver_customers()
        self.customer_profile()
