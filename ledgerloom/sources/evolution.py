"""Contracts that grow (S1, S8, S11): new columns, wider types, and what a contract has no place for.

A later batch may bring columns that earlier ones did not have and hold larger
values than they could.  The table's contract grows with it (``evolve``); older
files stay as they are and are read under the wide contract, their missing
columns as NULL.  A batch that would make a column narrower, or another kind of
thing, is refused by name.

At the CSV edge nothing of a line is lost: fields that the contract does not
know, or whose text is no value of their type, are kept as text in the map
column ``_rescued`` (NULL if there are none).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType,
                               StringType, StructField, StructType, TimestampNTZType)

from ledgerloom.sources import landing

RESCUED = "_rescued"
#: Digits of the whole-number types, narrowest first.
WHOLE = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 20}


def widens(old: DataType, new: DataType) -> bool:
    """Whether every value of ``old`` is a value of ``new`` and Parquet files of ``old`` can be read as ``new``."""
    if old == new:
        return True
    if old in WHOLE:
        if new in WHOLE:
            return WHOLE[new] >= WHOLE[old]
        if isinstance(new, DecimalType):
            return new.precision - new.scale >= WHOLE[old]
        return isinstance(new, DoubleType) and WHOLE[old] <= WHOLE[IntegerType()]
    if isinstance(old, DecimalType) and isinstance(new, DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return (isinstance(old, FloatType) and isinstance(new, DoubleType)) or (isinstance(old, DateType) and isinstance(new, TimestampNTZType))


def evolve(contract: StructType, batch: StructType) -> StructType:
    """The contract that holds the old batches and this one: the old columns, widened where need be, then the new ones.

    A batch may lack columns.  One whose type is narrower than the contract's, or unrelated to it, raises."""
    known = {f.name: f for f in batch.fields}
    fields = []
    for f in contract.fields:
        new = known.pop(f.name, f).dataType
        if not widens(f.dataType, new):
            how = "narrows" if widens(new, f.dataType) else "changes"
            raise ValueError(f"column {f.name} {how} from {f.dataType.simpleString()} to {new.simpleString()}")
        fields.append(StructField(f.name, new))
    return StructType(fields + [StructField(f.name, f.dataType) for f in batch.fields if f.name in known])


def land_evolving(df: DataFrame, bronze_path: str, batch_id: str, contract: StructType, source: str | None = None) -> StructType:
    """Lands the batch if the contract can grow to hold it, and returns the grown contract."""
    grown = evolve(contract, df.schema)
    landing.land(df, bronze_path, batch_id, source)
    return grown


def contract_of(spark: SparkSession, bronze_path: str) -> StructType:
    """The contract that the current batches ask for, in the order in which they came (one footer per batch)."""
    audit = {landing.BATCH_COLUMN, landing.VERSION_COLUMN, *landing.BRONZE_AUDIT}
    last = dict(landing.versions(spark, bronze_path))
    contract = StructType([])
    for batch, _ in sorted(last.items(), key=lambda p: p[1]):
        schema = landing.read_batch(spark, bronze_path, batch).schema
        contract = evolve(contract, StructType([f for f in schema.fields if f.name not in audit]))
    return contract


def read_evolved(spark: SparkSession, bronze_path: str, contract: StructType | None = None) -> DataFrame:
    """All batches under one contract (by default the one they ask for), audit columns included."""
    return landing.read_bronze(spark, bronze_path, contract=contract or contract_of(spark, bronze_path))


def read_csv_rescued(spark: SparkSession, path: str | list[str], contract: StructType) -> DataFrame:
    """A CSV with a header (the same in all files of ``path``) under a contract, with ``_rescued``.

    Columns are found by name, in any order; a column of the contract that the file lacks is NULL."""
    text = spark.read.option("header", True).csv(path)
    there, types = text.columns, {f.name: f.dataType for f in contract.fields}
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in there else F.lit(None).cast(f.dataType).alias(f.name)
             for f in contract.fields]
    lost = [F.when(F.col(c).try_cast(types[c]).isNull(), F.col(c)) if c in types else F.col(c) for c in there
            if not (c in types and types[c] == StringType())]
    names = [c for c in there if not (c in types and types[c] == StringType())]
    if not names:
        return text.select(*typed, F.lit(None).cast("map<string,string>").alias(RESCUED))
    rest = F.map_filter(F.map_from_arrays(F.array(*[F.lit(c) for c in names]), F.array(*lost)), lambda _, v: v.isNotNull())
    return text.select(*typed, F.when(F.size(rest) > 0, rest).alias(RESCUED))
