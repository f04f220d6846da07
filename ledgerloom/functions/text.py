"""Text standardisation.

All three are JVM built-ins; ``trim`` strips spaces only (not tabs), exactly as
the Silver layer it reproduces.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def upper_trim(col) -> Column:
    """``upper(trim(s))`` -- merchant names, transaction type, channel."""
    return F.upper(F.trim(_c(col)))


def lower_trim(col) -> Column:
    """``lower(trim(s))`` -- merchant category, segment."""
    return F.lower(F.trim(_c(col)))


def title_trim(col) -> Column:
    """``initcap(trim(s))`` -- province.

    Spark's ``initcap`` upper-cases the first letter of each space-separated word
    and lower-cases the rest, so ``KwaZulu-Natal`` becomes ``Kwazulu-natal``
    (SURVEY Q12, pinned by a unit test).
    """
    return F.initcap(F.trim(_c(col)))
