"""How the columns of new rows fit those of a table: the same, one widening to the other, or a clash.

A type widens to another if every value of it is a value of the other, exactly. That orders the types:

    tinyint < smallint < int < bigint          each below the decimals with room for its digits
    tinyint, smallint < float < double         int < double, bigint is not: a double holds 53 bits
    decimal(p, s) < decimal(q, t)              where neither digits before nor after the point are lost
    date < timestamp_ntz                       void < every type
    arrays, maps and structs                   as their parts; structs by the same field names in order

The least type above two others, where there is one, is what a table is widened to.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import types as T

INTEGERS = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
EXACT_IN = {T.FloatType: (T.ByteType, T.ShortType), T.DoubleType: (T.ByteType, T.ShortType, T.IntegerType, T.FloatType)}
MOST_DIGITS = 38


class TypeClash(ValueError):
    """Columns that cannot be loaded without loss; names each with both types."""


class Match(NamedTuple):
    """What a table needs before rows can be loaded: new columns, and wider types of columns it has."""

    new: list[T.StructField]
    wider: dict[str, T.DataType]


def widens(found: T.DataType, wanted: T.DataType) -> bool:
    """Whether every value of ``found`` is a value of ``wanted``."""
    kind, goal = type(found), type(wanted)
    if kind is T.NullType:
        return True
    if goal is T.DecimalType and kind in DIGITS:
        return wanted.precision - wanted.scale >= DIGITS[kind]
    if kind is T.DecimalType and goal is T.DecimalType:
        return wanted.scale >= found.scale and wanted.precision - wanted.scale >= found.precision - found.scale
    if kind in INTEGERS and goal in INTEGERS:
        return INTEGERS.index(kind) <= INTEGERS.index(goal)
    if kind in EXACT_IN.get(goal, ()) or (kind, goal) == (T.DateType, T.TimestampNTZType):
        return True
    parts = _parts(found, wanted)
    if parts is not None:
        return all(widens(left, right) for left, right in parts)
    return found == wanted


def common(left: T.DataType, right: T.DataType) -> T.DataType | None:
    """The least type that both widen to, or None."""
    if widens(left, right):
        return right
    if widens(right, left):
        return left
    decimals = [_as_decimal(side) for side in (left, right)]
    if all(decimals):
        scale = max(d.scale for d in decimals)
        whole = max(d.precision - d.scale for d in decimals)
        return T.DecimalType(whole + scale, scale) if whole + scale <= MOST_DIGITS else None
    if all(widens(side, T.DoubleType()) for side in (left, right)):
        return T.DoubleType()
    parts = _parts(left, right)
    if parts is None:
        return None
    joined = [common(a, b) for a, b in parts]
    return None if None in joined else _rebuilt(left, joined)


def match_columns(
    found: T.StructType, table: T.StructType, name: str, add_columns: bool = False, widen: bool = False
) -> Match:
    """What loading rows of ``found`` into a table asks for; raises ``TypeClash`` if that is not allowed.

    All problems are named at once. A column that the rows lack is one, since its values would be lost;
    new columns and columns that need a wider type are allowed on request.
    """
    there = {field.name: field.dataType for field in table.fields}
    given = {field.name: field.dataType for field in found.fields}
    new = [field for field in found.fields if field.name not in there]
    problems = [f"{column} ({kind.simpleString()}) is absent" for column, kind in there.items() if column not in given]
    if new and not add_columns:
        problems += [f"{f.name} ({f.dataType.simpleString()}) is new; add_columns=True adds it" for f in new]
    wider = {}
    for column, kind in given.items():
        if column not in there or widens(kind, there[column]):
            continue
        both = f"{column} is {there[column].simpleString()} and would get {kind.simpleString()}"
        least = common(kind, there[column])
        if least is None:
            problems.append(f"{both}, which no type holds together")
        elif widen:
            wider[column] = least
        else:
            problems.append(f"{both}; widen=True makes it {least.simpleString()}")
    if problems:
        raise TypeClash(f"{name}: " + "; ".join(problems))
    return Match(new, wider)


def _as_decimal(kind: T.DataType) -> T.DecimalType | None:
    if isinstance(kind, T.DecimalType):
        return kind
    return T.DecimalType(DIGITS[type(kind)], 0) if type(kind) in DIGITS else None


def _parts(left: T.DataType, right: T.DataType) -> list[tuple[T.DataType, T.DataType]] | None:
    """The parts of two nested types side by side; None if they are not nested alike."""
    if type(left) is not type(right):
        return None
    if isinstance(left, T.ArrayType):
        return [(left.elementType, right.elementType)]
    if isinstance(left, T.MapType):
        return [(left.keyType, right.keyType), (left.valueType, right.valueType)]
    if isinstance(left, T.StructType) and left.names == right.names:
        return [(a.dataType, b.dataType) for a, b in zip(left.fields, right.fields)]
    return None


def _rebuilt(like: T.DataType, parts: list[T.DataType]) -> T.DataType:
    make: dict[type, Callable[[], T.DataType]] = {
        T.ArrayType: lambda: T.ArrayType(parts[0]),
        T.MapType: lambda: T.MapType(*parts),
        T.StructType: lambda: T.StructType([T.StructField(n, p) for n, p in zip(like.names, parts)]),
    }
    return make[type(like)]()
