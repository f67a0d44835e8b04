"""Identifier, label and date rules of the raw tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_padded(number: Column, width: int) -> Column:
    """A non-negative number padded to ``width`` digits; larger numbers keep all their digits.

    Several times faster than ``format_string``, which runs a Java formatter on every row.
    """
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def padded_id(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), zero_padded(number, 3))


def order_id(run_date: Column, order_number: Column, line_number: Column) -> Column:
    """``O``, the run date without dashes, then order and line number."""
    day = F.replace(run_date, F.lit("-"), F.lit(""))
    return F.concat(F.lit("O"), day, zero_padded(order_number, 3), F.lit("-"), line_number.cast("string"))


def line_key(order_id: Column) -> tuple[Column, Column]:
    """Order and line number of an ``order_id``."""
    parts = F.split(F.substring(order_id, 10, 1000), "-")
    return F.get(parts, 0).cast("bigint"), F.get(parts, 1).cast("int")


def display_name(category: Column, number: Column) -> Column:
    return F.concat(category, F.lit(" Product "), zero_padded(number, 2))


def pick(values: Sequence[str], index: Column) -> Column:
    """The value at ``index`` modulo the list length."""
    position = (F.pmod(index, F.lit(len(values))) + 1).cast("int")
    return F.element_at(F.array(*map(F.lit, values)), position)


def days_after(start: Column, offset: Column, window: int) -> Column:
    """``start`` plus ``offset`` days, wrapped into a window of ``window`` days."""
    return F.date_add(start, F.pmod(offset, F.lit(window)).cast("int"))
