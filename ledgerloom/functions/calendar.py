"""Calendar parts and pay-cycle flags.

Every flag is a plain column expression with its thresholds as parameters, so
Catalyst folds them into the scan's projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The thresholds the reference uses.
MONTH_END_FROM_DAY = 20          # is_month_end: day of month >= 20
SALARY_PERIOD_DAYS = (24, 26)    # is_salary_period: day of month between 24 and 26, inclusive
WEEKEND_DAYS = (1, 7)            # dayofweek: 1 = Sunday, 7 = Saturday


def date_part_columns(ts: str = "transaction_date") -> dict[str, Column]:
    """Year, month, day of month, day of week (1 = Sunday), hour, weekend."""
    c = F.col(ts)
    dow = F.dayofweek(c)
    return {
        "txn_year": F.year(c),
        "txn_month": F.month(c),
        "txn_day": F.dayofmonth(c),
        "txn_day_of_week": dow,
        "txn_hour": F.hour(c),
        "is_weekend": dow.isin(list(WEEKEND_DAYS)),
    }


def is_month_end(day: Column | str = "txn_day", from_day: int = MONTH_END_FROM_DAY) -> Column:
    """F8: ``day >= from_day`` (code says >= 20; SURVEY Q5 keeps it as a parameter)."""
    d = F.col(day) if isinstance(day, str) else day
    return d >= F.lit(from_day)


def is_salary_period(day: Column | str = "txn_day", days: tuple[int, int] = SALARY_PERIOD_DAYS) -> Column:
    """inclusive ``day BETWEEN lo AND hi``."""
    d = F.col(day) if isinstance(day, str) else day
    return d.between(days[0], days[1])


def flag_columns(month_end_from: int = MONTH_END_FROM_DAY,
                 salary_days: tuple[int, int] = SALARY_PERIOD_DAYS) -> dict[str, Column]:
    return {
        "is_month_end": is_month_end("txn_day", month_end_from),
        "is_salary_period": is_salary_period("txn_day", salary_days),
    }


def period_label(year: str = "txn_year", month: str = "txn_month") -> Column:
    """``yyyy-MM`` with a zero-padded month."""
    return F.format_string("%04d-%02d", F.col(year), F.col(month))


def month_index(year: str = "txn_year", month: str = "txn_month") -> Column:
    """Months since year 0: consecutive calendar months differ by exactly 1."""
    return F.col(year) * 12 + F.col(month) - 1
