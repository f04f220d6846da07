"""Exact rounding and money arithmetic.

Money is summed as decimal, which is exact and independent of row order
(SURVEY Q20).  Ratios and rounded figures are then produced with integer
arithmetic, so a value such as ``round(a / b, 4)`` is the true HALF_UP rounding
of the exact quotient -- the same number in every engine, whatever the order
in which partial sums were combined.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: From here on a double has no room for 4 decimals, and an exact quotient in units of 10^-4 none in a long.
_EXACT_BELOW = 9e13


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def int_div(a, b) -> Column:
    """Integral division of exact numbers (SQL ``div``): truncates toward zero, no rounding."""
    return F.call_function("div", _c(a), _c(b))


def half_up_quotient(num, den, scale: int) -> Column:
    """``round(num / den, scale)`` with HALF_UP on the exact quotient, as double.

    ``num`` and ``den`` are exact (decimal or integral) columns of any size.  The
    quotient is formed with integral division of decimals, so no intermediate
    rounding occurs.  Quotients of 9e13 and more, whose doubles are coarser than
    4 decimals, are the plain double quotient.  NULL when either side is NULL or
    the divisor is zero (the reference, with ANSI off, also gave NULL there).
    """
    n, d = _c(num), _c(den)
    k = 10 ** scale
    wide = lambda x, factor: F.abs(x).cast("decimal(38,4)") * F.lit(factor)
    quotient = int_div(wide(n, 2 * k) + F.abs(d), wide(d, 2))
    signed = F.when((n < 0) != (d < 0), -quotient).otherwise(quotient) / F.lit(float(k))
    plain = n.cast("double") / d.cast("double")
    return F.when(d != 0, F.when(F.abs(plain) < _EXACT_BELOW, signed).otherwise(plain))


def half_up(col, scale: int) -> Column:
    """HALF_UP (away from zero) rounding of a double: ``sign(x) * floor(|x| * 10^s + 0.5) / 10^s``.

    For floating-point means that have no exact form; the expression is the same
    IEEE computation in every engine.
    """
    x = _c(col)
    k = float(10 ** scale)
    return F.signum(x) * F.floor(F.abs(x) * F.lit(k) + F.lit(0.5)) / F.lit(k)


def exact_mean(total, count) -> Column:
    """Mean as double: an exact (decimal or integral) sum divided by the count."""
    return _c(total).cast("double") / _c(count)
