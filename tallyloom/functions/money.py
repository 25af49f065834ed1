"""Exact money arithmetic.

Money columns arrive as doubles with two decimals. They are turned into whole
units (cents, or ten-thousandths for a price times a percentage), summed as
decimals and scaled back at the end. Addition order then cannot change a
result, which at 10^12 rows a double sum does not guarantee even for whole
amounts, and a bigint sum could overflow there. What is no number, or too large
to count in such units, is null and left out of a sum; the rules count it.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _hundredths(col: str) -> Column:
    return F.rint(F.col(col) * 100).try_cast("bigint")


def cents(col: str) -> Column:
    """A money column in cents, as decimal(18,0), which Spark keeps in a long."""
    return _hundredths(col).try_cast("decimal(18,0)")


def revenue_units(price: str = "l_extendedprice", discount: str = "l_discount") -> Column:
    """price * (1 - discount) in ten-thousandths, as decimal(18,0)."""
    rest = F.try_subtract(F.lit(100), _hundredths(discount))
    return F.try_multiply(_hundredths(price), rest).try_cast("decimal(18,0)")


def total_cents(units: Column) -> Column:
    """The sum of cents as money, decimal(38,2)."""
    return (F.sum(units) * F.lit(Decimal("0.01"))).cast("decimal(38,2)")


def total_revenue(units: Column) -> Column:
    """The sum of revenue units as money rounded to cents, decimal(38,2)."""
    return F.round(F.sum(units) * F.lit(Decimal("0.0001")), 2).cast("decimal(38,2)")
