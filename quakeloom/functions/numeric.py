"""Rounding and missing-value helpers that stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def known(c: ColumnOrName) -> Column:
    """A DOUBLE with NaN turned into null, so that both count as missing."""
    return F.nanvl(as_col(c), F.lit(None).cast("double"))


def is_known(*names: str) -> Column:
    """All columns present: neither null (pushed to the scan) nor NaN."""
    test = F.lit(True)
    for name in names:
        test = test & F.col(name).isNotNull() & ~F.isnan(name)
    return test


def scaled_half_even(c: ColumnOrName, digits: int) -> Column:
    """Array-library rounding: scale, round half to even, scale back."""
    factor = float(10 ** digits)
    return F.rint(as_col(c) * factor) / factor + F.lit(0.0)


def exact_half_even(c: ColumnOrName, digits: int) -> Column:
    """Round to decimal digits by the exact binary value, ties to even.

    The product with the power of ten may itself round onto a false tie. Its
    rounding error is recovered exactly by splitting the factor into halves of
    at most 26 bits, and its sign then decides the tie. The argument appears
    many times, so pass a column rather than a long expression.
    """
    x = as_col(c)
    factor = float(10 ** digits)
    product = x * factor
    nearest = F.rint(product)
    carry = x * 134217729.0  # 2^27 + 1
    high = carry - (carry - x)
    error = (high * factor - product) + (x - high) * factor
    step = (
        F.when((product - nearest == 0.5) & (error > 0), 1.0)
        .when((product - nearest == -0.5) & (error < 0), -1.0)
        .otherwise(0.0)
    )
    return (nearest + step) / factor + F.lit(0.0)


def settled(c: ColumnOrName) -> Column:
    """A mean or deviation cut to nine decimals.

    Sums of doubles differ in their last bits with the order of the rows; cut
    first, a mean that lies on a rounding tie rounds the same way on any
    partitioning.
    """
    return F.rint(as_col(c) * 1e9) / 1e9


def half_up_integer(c: ColumnOrName) -> Column:
    """Nearest whole number, ties away from zero, without decimal arithmetic."""
    x = as_col(c)
    nearest = F.rint(x)
    return F.when(F.abs(x - nearest) == 0.5, x + F.signum(x) * 0.5).otherwise(nearest) + F.lit(0.0)


def half_even_integer(c: ColumnOrName) -> Column:
    return F.rint(as_col(c)) + F.lit(0.0)
