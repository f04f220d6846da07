"""Binding of the driver's TPC-H-style tables to the canonical ledger.

The reference works on two files -- customers and transactions -- produced by a
simulator.  The test tables are a star schema instead, so the canonical relations
are declared as views over them:

* ledger  = lineitem -> orders -> part -> supplier (left joins: a transaction is
  never lost for a missing dimension row; Silver drops what it must);
* customers = customer -> nation -> region;
* an event ledger over ``events`` for true times of day.

Everything is a lazy DataFrame: Catalyst prunes the columns each query needs
and pushes filters into the Parquet scans.  Join strategies are Spark's choice:
small dimensions are broadcast by the planner's size estimate (and by AQE at run
time from actual sizes); large ones are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.casts import MONEY
from ledgerloom.operators.dedup import keep_first
from ledgerloom.session import small_tasks

# The event ledger's channel for JSON ``k`` modulo 4, in this order.
EVENT_CHANNELS = ["POS", "MOBILE", "ONLINE", "ATM"]


# The column types of the driver tables.  Reading with a declared
# schema skips the footer-inference job that ``spark.read.parquet`` runs per path.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag"]


def unique_lines(lineitem: DataFrame) -> DataFrame:
    """D1 on the fact table itself: one line per (order, line number), before any
    dimension is joined, so only the six columns of the ledger are shuffled and
    copies never pass through the joins.  Date and customer come from the order
    and are the same for all copies; a copy with a positive amount wins, then
    the smallest amount, supplier, part and flag, NULLs last."""
    money = F.col("l_extendedprice").try_cast(MONEY)
    return keep_first(lineitem.select(*LINE_COLUMNS), ["l_orderkey", "l_linenumber"],
                      [~F.coalesce(money > 0, F.lit(False)), money, "l_suppkey", "l_partkey", "l_returnflag"])


def ledger_from_tpch(lineitem: DataFrame, orders: DataFrame, part: DataFrame,
                     supplier: DataFrame) -> DataFrame:
    """Canonical raw transactions.

    transaction_id = ``l_orderkey-l_linenumber`` (the tables repeat such pairs, so
    deduplication has real work); customer = order's customer; date = order date;
    amount = extended price as money; CREDIT for returned lines, DEBIT
    otherwise; merchant = supplier name; category = part type; channel = order
    priority.
    """
    li = lineitem.select(*LINE_COLUMNS)
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    p = part.select("p_partkey", "p_type")
    s = supplier.select("s_suppkey", "s_name")
    joined = (li.join(o, li.l_orderkey == o.o_orderkey, "left")
                .join(p, li.l_partkey == p.p_partkey, "left")
                .join(s, li.l_suppkey == s.s_suppkey, "left"))
    return joined.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("transaction_date"),
        F.col("l_extendedprice").try_cast(MONEY).alias("amount"),
        F.when(F.col("l_returnflag") == "R", F.lit("CREDIT")).otherwise(F.lit("DEBIT"))
         .alias("transaction_type"),
        F.col("s_name").alias("merchant_name"),
        F.col("p_type").alias("merchant_category"),
        F.col("o_orderpriority").alias("channel"),
    )


def customers_from_tpch(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Canonical raw customers: segment = market segment, province = region name,
    monthly income = account balance (some are <= 0, which Silver drops)."""
    c = customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = nation.select("n_nationkey", "n_regionkey")
    r = region.select("r_regionkey", "r_name")
    joined = (c.join(n, c.c_nationkey == n.n_nationkey, "left")
               .join(r, n.n_regionkey == r.r_regionkey, "left"))
    return joined.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("r_name").alias("province"),
        F.col("c_acctbal").alias("monthly_income"),
    )


def ledger_from_events(events: DataFrame) -> DataFrame:
    """Canonical raw transactions over the event stream table.

    Signups are credits, everything else debits; merchant = JSON ``k`` of
    ``props``; category = event type; channel picked by ``k`` modulo 4.
    """
    k = F.get_json_object(F.col("props"), "$.k")
    channel_idx = (k.try_cast("int") % F.lit(len(EVENT_CHANNELS))) + F.lit(1)
    channels = F.array(*[F.lit(c) for c in EVENT_CHANNELS])
    return events.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("transaction_date"),
        F.col("value").try_cast(MONEY).alias("amount"),
        F.when(F.col("event_type") == "signup", F.lit("CREDIT")).otherwise(F.lit("DEBIT"))
         .alias("transaction_type"),
        k.alias("merchant_name"),
        F.col("event_type").alias("merchant_category"),
        F.try_element_at(channels, channel_idx).alias("channel"),
    )


class DriverTables:
    """Lazy access to one scale-factor directory and its canonical views."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        small_tasks(spark)
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def raw_ledger(self) -> DataFrame:
        return ledger_from_tpch(self.table("lineitem"), self.table("orders"),
                                self.table("part"), self.table("supplier"))

    def unique_ledger(self) -> DataFrame:
        """The raw ledger with one row per transaction id (D1 below the joins)."""
        return ledger_from_tpch(unique_lines(self.table("lineitem")), self.table("orders"),
                                self.table("part"), self.table("supplier"))

    def raw_customers(self) -> DataFrame:
        return customers_from_tpch(self.table("customer"), self.table("nation"), self.table("region"))

    def raw_event_ledger(self) -> DataFrame:
        return ledger_from_events(self.table("events"))
