"""Safe casts.

Under Spark 4 ANSI mode a malformed value raises; the reference ran with ANSI
off, where it became NULL (SURVEY Q6).  These helpers keep the NULL semantics
with the ``try_*`` built-ins and leave already-typed columns untouched.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, TimestampType

#: Money is exact inside the pipeline, double only at the edge: 18
#: digits before the point, four behind.  What is positive but has no such form
#: (1e18 and more, under 0.00005) goes to quarantine, see ``operators.curate``.
MONEY = DecimalType(22, 4)


def to_money(col: str, dtype: DataType) -> Column:
    """Amount -> decimal(22,4); unparsable text -> NULL."""
    c = F.col(col)
    return c if dtype == MONEY else c.try_cast(MONEY)


def to_double(col: str) -> Column:
    """X4 for non-money measures (monthly income): text or number -> double."""
    return F.col(col).try_cast("double")


def to_timestamp(col: str, dtype: DataType) -> Column:
    """transaction_date -> timestamp without zone.

    Text is read as the wall-clock time it shows (NULL on garbage).  A stored
    instant becomes its UTC wall-clock time.  Either way the calendar parts
    never depend on the session's time zone.
    """
    c = F.col(col)
    if isinstance(dtype, TimestampType):
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast("timestamp_ntz"))
    return c.try_cast("timestamp_ntz")
