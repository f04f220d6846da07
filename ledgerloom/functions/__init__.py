"""Column-level functions: text, casts, calendar flags, exact rounding."""

from ledgerloom.functions.calendar import (date_part_columns, flag_columns, is_month_end,
                                           is_salary_period, month_index, period_label)
from ledgerloom.functions.casts import MONEY, to_double, to_money, to_timestamp
from ledgerloom.functions.numeric import exact_mean, half_up, half_up_quotient, int_div
from ledgerloom.functions.text import lower_trim, title_trim, upper_trim

__all__ = [
    "MONEY", "date_part_columns", "exact_mean", "flag_columns", "half_up", "half_up_quotient", "int_div",
    "is_month_end", "is_salary_period", "lower_trim", "month_index", "period_label", "title_trim", "to_double",
    "to_money", "to_timestamp", "upper_trim",
]
