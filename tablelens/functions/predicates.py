"""Row predicates with one meaning each: strict operators, real and/or, day-grain dates.

Comparisons keep the column bare and put all work on the literal side, so
Catalyst pushes them to the file scan.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ONE_DAY = dt.timedelta(days=1)


def as_day(value: str | dt.date) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def eq(col: Column, value: object) -> Column:
    return col == F.lit(value)


def ne(col: Column, value: object) -> Column:
    """Not equal; rows without a value pass."""
    return ~col.eqNullSafe(F.lit(value))


def number(col: Column, op: str, value: float, is_text: bool = False) -> Column:
    """Compare as numbers with gt, ge, lt or le. Text cells that hold no number drop out."""
    return _compare(col.try_cast("double") if is_text else col, op, F.lit(value))


def _compare(col: Column, op: str, bound: Column) -> Column:
    if op == "gt":
        return col > bound
    if op == "ge":
        return col >= bound
    if op == "lt":
        return col < bound
    if op == "le":
        return col <= bound
    raise ValueError(f"unknown comparison {op!r}")


def day(col: Column, op: str, value: str | dt.date) -> Column:
    """Compare a date or timestamp column with a whole day (eq, gt, ge, lt, le)."""
    start = as_day(value)
    after = start + ONE_DAY
    if op == "eq":
        return (col >= F.lit(start)) & (col < F.lit(after))
    if op == "gt":
        return col >= F.lit(after)
    if op == "le":
        return col < F.lit(after)
    return _compare(col, op, F.lit(start))


def day_range(
    col: Column, start: str | dt.date | None = None, end: str | dt.date | None = None
) -> Column:
    """Rows of the closed day range; a missing end is open."""
    parts = []
    if start is not None:
        parts.append(day(col, "ge", start))
    if end is not None:
        parts.append(day(col, "le", end))
    return all_of(*parts)


def all_of(*parts: Column) -> Column:
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)


def any_of(*parts: Column) -> Column:
    return reduce(lambda a, b: a | b, parts)


def is_null(col: Column) -> Column:
    return col.isNull()


def not_null(col: Column) -> Column:
    return col.isNotNull()


def is_empty(col: Column) -> Column:
    return F.length(col) == 0


def has_value(col: Column) -> Column:
    """Neither null nor empty when written as text."""
    return col.isNotNull() & (col.cast("string") != "")


def get_record(df: DataFrame, key: str, value: object) -> DataFrame:
    """The row with this key, or none. The value is brought to the key's type."""
    wanted = F.lit(str(value)).try_cast(df.schema[key].dataType)
    return df.where(df[key] == wanted).limit(1)
