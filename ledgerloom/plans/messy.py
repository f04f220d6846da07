"""The driver tables with faults put in, so that every cleaning rule has work to do.

All rows of the tables stay; copies with faults are added to them, and some
values are replaced, by fixed rules on the keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.signals import REFERENCE_MERCHANTS
from ledgerloom.sources.bindings import DriverTables, ledger_from_tpch, unique_lines

# What replaces an amount, and for which order keys (modulo, remainder).
FAULTY_AMOUNTS = [("100000000000000000", 23, 1), ("0.004", 23, 2), ("0.00001", 23, 3), ("5000000000000000000", 23, 4),
                  ("n/a", 23, 5), ("-3.50", 23, 6), ("", 23, 7)]


LATE_YEAR = 1997


def messy_ledger(tables: DriverTables) -> DataFrame:
    """The ledger as text.  Per order key: faulty amounts (FAULTY_AMOUNTS); a
    missing date (mod 29 = 1), a missing customer (29 = 2) and a missing channel
    (29 = 3); a second copy that is unusable (mod 3 = 0: no date, or mod 3 = 1:
    an amount that is no number); and spaces and case around the texts."""
    key = F.split("transaction_id", "-")[0].cast("long")
    ledger = ledger_from_tpch(unique_lines(tables.table("lineitem")), tables.table("orders"),
                              tables.table("part"), tables.table("supplier"))
    amount = F.col("amount").cast("string")
    for value, modulo, rest in FAULTY_AMOUNTS:
        amount = F.when(key % modulo == rest, F.lit(value)).otherwise(amount)
    rows = ledger.select(
        "transaction_id", F.when(key % 29 != 2, F.col("customer_id").cast("string")).alias("customer_id"),
        F.when(key % 29 != 1, F.date_format("transaction_date", "yyyy-MM-dd HH:mm:ss")).alias("transaction_date"),
        amount.alias("amount"), F.concat(F.lit(" "), F.lower("transaction_type")).alias("transaction_type"),
        F.concat(F.lower("merchant_name"), F.lit("  ")).alias("merchant_name"),
        F.upper("merchant_category").alias("merchant_category"),
        F.when(key % 29 != 3, F.col("channel")).alias("channel"))
    # Copies are made of the finished row, so the tables are read, de-duplicated and joined once.
    copies = F.when(key % 3 == 0, F.array(F.lit("row"), F.lit("dateless"))).when(
        key % 3 == 1, F.array(F.lit("row"), F.lit("numberless"))).otherwise(F.array(F.lit("row")))
    copied = rows.withColumn("_copy", F.explode(copies))
    return copied.withColumns({
        "transaction_date": F.when(F.col("_copy") != "dateless", F.col("transaction_date")),
        "amount": F.when(F.col("_copy") == "numberless", F.lit("?")).otherwise(F.col("amount"))}).drop("_copy")


def messy_customers(tables: DriverTables) -> DataFrame:
    """Customers with, for every second one, a copy without income and one in another segment."""
    rows = tables.raw_customers().withColumn("monthly_income", F.col("monthly_income").cast("string"))
    even = F.col("customer_id") % 2 == 0
    return (rows.unionByName(rows.filter(even).withColumn("monthly_income", F.lit(None).cast("string"))
                             .withColumn("segment", F.lit("AAA")))
            .unionByName(rows.filter(even).withColumn("segment", F.lit("ZZZ"))))


def tied(txn: DataFrame) -> DataFrame:
    """Silver with every amount 1 and the category cut to its first word, so that months have tied categories."""
    return txn.withColumns({"amount": F.lit(1).cast(txn.schema["amount"].dataType),
                            "merchant_category": F.split("merchant_category", " ")[0]})


def catalogue_named(txn: DataFrame) -> DataFrame:
    """Silver with merchants renamed to the catalogue's by the number in their name; every 43rd keeps its own."""
    names = F.array(*[F.lit(name) for _category, name, _code in REFERENCE_MERCHANTS])
    number = F.regexp_extract("merchant_name", "([0-9]+)$", 1).cast("int") % (len(REFERENCE_MERCHANTS) + 1)
    return txn.withColumn("merchant_name", F.coalesce(F.get(names, number), F.col("merchant_name")))


def late_copies(tables: DriverTables, every: int) -> DataFrame:
    """A later batch of the ledger as text, for the orders of LATE_YEAR with keys divisible by ``every``: each row 40 days
    earlier, a copy without a date, and for order keys divisible by 4 also a transaction of a new id."""
    key = F.split("transaction_id", "-")[0].cast("long")
    ledger = ledger_from_tpch(unique_lines(tables.table("lineitem")), tables.table("orders"),
                              tables.table("part"), tables.table("supplier"))
    rows = ledger.filter((key % every == 0) & (F.year("transaction_date") == LATE_YEAR)).withColumns({
        "customer_id": F.col("customer_id").cast("string"), "amount": F.col("amount").cast("string"),
        "transaction_date": F.date_format(F.col("transaction_date") - F.expr("INTERVAL 40 DAYS"), "yyyy-MM-dd HH:mm:ss")})
    copies = F.when(key % 4 == 0, F.array(F.lit("row"), F.lit("dateless"), F.lit("late"))).otherwise(
        F.array(F.lit("row"), F.lit("dateless")))
    copied = rows.withColumn("_copy", F.explode(copies))
    return copied.withColumns({
        "transaction_date": F.when(F.col("_copy") != "dateless", F.col("transaction_date")),
        "transaction_id": F.when(F.col("_copy") == "late", F.concat("transaction_id", F.lit("-late"))).otherwise(
            F.col("transaction_id"))}).drop("_copy")


def store_named(txn: DataFrame) -> DataFrame:
    """Silver with merchants written as a ledger writes them, by the number in their name: a catalogue code with a
    store's number and town, for every 44th the code with letters run on to it, and every 43rd keeps its own."""
    codes = F.array(*[F.lit(code) for _category, _name, code in REFERENCE_MERCHANTS])
    number = F.regexp_extract("merchant_name", "([0-9]+)$", 1).cast("int")
    code = F.get(codes, number % (len(REFERENCE_MERCHANTS) + 1))
    written = F.when(number % 44 == 7, F.concat(code, F.lit("X STORE"))).otherwise(
        F.concat(code, F.lit("  "), F.lpad((number % 977).cast("string"), 4, "0"), F.lit(" SANDTON")))
    return txn.withColumn("merchant_name", F.coalesce(written, F.col("merchant_name")))
