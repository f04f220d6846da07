"""Schema contracts per layer.

The reference infers types at the edge; inference costs a pass over the data
and drifts with the file.  Here each layer has a fixed ``StructType`` and a
check that fails loudly when a table does not honour it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (BooleanType, DataType, DateType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType, TimestampNTZType, TimestampType)

from ledgerloom.functions.casts import MONEY

CORRUPT_RECORD = "_corrupt_record"

#: customers.csv as landed.  ``income_day`` is written as ``25.0`` by the source
#: (a float column with gaps), so it is read as double.
RAW_CUSTOMERS = StructType([
    StructField("customer_id", StringType()),
    StructField("segment", StringType()),
    StructField("province", StringType()),
    StructField("monthly_income", DoubleType()),
    StructField("income_day", DoubleType()),
    StructField("spending_intensity", StringType()),
    StructField("account_opened", DateType()),
])

#: transactions.csv as landed.
RAW_TRANSACTIONS = StructType([
    StructField("transaction_id", StringType()),
    StructField("customer_id", StringType()),
    StructField("transaction_date", TimestampNTZType()),
    StructField("amount", StringType()),     # typed in Silver, where what money can't hold is quarantined
    StructField("transaction_type", StringType()),
    StructField("merchant_name", StringType()),
    StructField("merchant_category", StringType()),
    StructField("channel", StringType()),
    StructField("province", StringType()),
    StructField("segment", StringType()),
])

#: Columns every layer above raw must carry.
BRONZE_AUDIT = {"_ingested_at": TimestampType(), "_source_file": StringType(), "_batch_id": StringType()}

#: Columns Silver types or adds on transactions.
SILVER_TXN = {
    "transaction_id": None, "customer_id": None, "amount": MONEY, "transaction_date": TimestampNTZType(),
    "txn_year": IntegerType(), "txn_month": IntegerType(), "txn_day": IntegerType(),
    "txn_day_of_week": IntegerType(), "txn_hour": IntegerType(), "is_weekend": BooleanType(),
    "is_month_end": BooleanType(), "is_salary_period": BooleanType(),
}

#: Core ledger columns the Silver and Gold operators read (types of the key
#: columns are free: the driver binding uses bigint customer ids).
LEDGER_COLUMNS = ["transaction_id", "customer_id", "transaction_date", "amount", "transaction_type",
                  "merchant_name", "merchant_category", "channel"]

MONTHLY_SUMMARY = {
    "customer_id": None, "txn_year": IntegerType(), "txn_month": IntegerType(),
    "total_spend": DoubleType(), "debit_txn_count": LongType(), "unique_merchants": LongType(),
    "avg_txn_amount": DoubleType(), "max_txn_amount": DoubleType(),
    "total_income_received": DoubleType(), "credit_txn_count": LongType(),
    "month_end_spend": DoubleType(), "top_category": StringType(),
    "month_end_stress_ratio": DoubleType(), "spend_to_income_ratio": DoubleType(),
}


def schema_problems(df: DataFrame, required: dict[str, DataType | None] | list[str]) -> list[str]:
    """Missing columns and type mismatches (``None`` type = any type accepted)."""
    if isinstance(required, list):
        required = {c: None for c in required}
    actual = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for name, dtype in required.items():
        if name not in actual:
            problems.append(f"missing column {name}")
        elif dtype is not None and actual[name] != dtype:
            problems.append(f"column {name}: expected {dtype.simpleString()}, got {actual[name].simpleString()}")
    return problems


def require_schema(df: DataFrame, required: dict[str, DataType | None] | list[str], what: str = "table") -> DataFrame:
    """Raise when ``df`` breaks the contract; return it unchanged otherwise."""
    problems = schema_problems(df, required)
    if problems:
        raise ValueError(f"{what} breaks its contract: " + "; ".join(problems))
    return df


def with_corrupt_column(schema: StructType) -> StructType:
    """The contract plus the raw-line column that PERMISSIVE parsing fills."""
    if CORRUPT_RECORD in schema.fieldNames():
        return schema
    return StructType(schema.fields + [StructField(CORRUPT_RECORD, StringType())])
