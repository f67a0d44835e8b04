"""Money arithmetic: exact decimals for revenue, tolerant comparison for checks."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

TOLERANCE = Decimal("0.01")
COMPARABLE = "decimal(38,6)"


def line_total(quantity: Column, price: Column) -> Column:
    """Quantity times price as decimal(18,2), half a cent rounded up; overflow raises under ANSI."""
    return (quantity * price).cast("decimal(18,2)")


def safe_double(value: Column) -> Column:
    """The value as double, NULL where it is not a number."""
    return value.try_cast("double")


def difference(left: Column, right: Column) -> Column:
    return F.abs(left.cast(COMPARABLE) - right.cast(COMPARABLE))


def within_tolerance(left: Column, right: Column) -> Column:
    """True when both sides are there and differ by at most one cent."""
    return F.coalesce(difference(left, right) <= F.lit(TOLERANCE), F.lit(False))
