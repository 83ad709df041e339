"""Exact sums of amounts stored as doubles.

Sums of doubles depend on the order of the rows, and a decimal per row is slow.
Amounts are turned into whole units (cents for two places) and added as integers;
a decimal is made once per group.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

AMOUNT = "decimal(24,{scale})"
_LOW_BITS = 20


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def units(column: str | Column, scale: int = 2) -> Column:
    """The amount in whole units of ``10 ** -scale``."""
    return F.rint(_col(column) * F.lit(float(10**scale))).cast("bigint")


def from_units(column: str | Column, scale: int = 2) -> Column:
    """Whole units as a decimal amount."""
    unit = F.lit(f"{10**-scale:.{scale}f}").cast(f"decimal({scale},{scale})")
    return (_col(column).cast("decimal(30,0)") * unit).cast(AMOUNT.format(scale=scale))


def sum_units(column: str | Column, scale: int = 2) -> Column:
    """The exact sum of whole units as a decimal amount.

    High and low bits are added apart, so that the sum of a very large group
    cannot overflow a 64-bit integer.
    """
    column = _col(column)
    high = F.sum(F.shiftright(column, _LOW_BITS)).cast("decimal(20,0)")
    low = F.sum(column.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))).cast("decimal(20,0)")
    return from_units(high * F.lit(1 << _LOW_BITS).cast("decimal(8,0)") + low, scale)


def sum_amount(column: str | Column, scale: int = 2) -> Column:
    """The exact sum of an amount column."""
    return sum_units(units(column, scale), scale)
