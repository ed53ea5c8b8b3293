"""Exact decimal rounding of ratios.

``round(a / b * 100, 2)`` evaluated in floating point gives different last
digits in different engines (and differs from the exact value at .xx5 ties).
These helpers compute ``round(num / den * factor, scale)`` exactly, half away
from zero, with integer arithmetic on decimal(38,0): the ratio is never
represented as a double.  Division by zero gives NULL (not an error), like
``try_divide``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT = "decimal(38,0)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def unscaled(x, scale: int) -> Column:
    """Integer value of a decimal column with ``scale`` places (x * 10^scale)."""
    c = _c(x)
    if scale:
        c = c * F.lit(Decimal(10 ** scale))
    return c.cast(_INT)


def _floor_div(a: Column, b: Column) -> Column:
    """floor(a / b) for a >= 0, b > 0, exact (the quotient is integral)."""
    return ((a - a % b) / b).cast(_INT)


def ratio(num, den, scale: int = 2, factor: int = 1, num_scale: int = 0,
          den_scale: int = 0, precision: int = 18) -> Column:
    """round(num / den * factor, scale) as decimal(precision, scale).

    ``num_scale``/``den_scale`` are the decimal places of the inputs (0 for
    integer columns such as counts).
    """
    n = unscaled(num, num_scale) * F.lit(Decimal(factor * 10 ** (den_scale + scale)))
    d = unscaled(den, den_scale) * F.lit(Decimal(10 ** num_scale))
    n, d = n.cast(_INT), d.cast(_INT)
    an, ad = F.abs(n), F.abs(d)
    q = _floor_div(an * 2 + ad, ad * 2)
    signed = F.when((n < 0) != (d < 0), -q).otherwise(q)
    step = F.lit(Decimal(1).scaleb(-scale)) if scale else F.lit(1)
    out = (signed.cast(f"decimal({precision},0)") * step).cast(f"decimal({precision},{scale})")
    return F.when(d != 0, out)


def pct(num, den, scale: int = 2, num_scale: int = 0, den_scale: int = 0) -> Column:
    """Percentage ``num/den*100`` rounded to ``scale`` places, exact."""
    return ratio(num, den, scale=scale, factor=100, num_scale=num_scale, den_scale=den_scale)


def mean(total, count, scale: int = 2, total_scale: int = 2) -> Column:
    """Average from an exact sum and a count, rounded to ``scale`` places."""
    return ratio(total, count, scale=scale, num_scale=total_scale)
