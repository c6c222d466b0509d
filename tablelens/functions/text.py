"""Cell rendering."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the cell rendering.
MAX_CELL = 500
CUT_MARK = "... [truncated]"


def truncate_text(col: Column, limit: int = MAX_CELL) -> Column:
    """Text for display: null becomes empty, longer text is cut and marked."""
    cut = F.concat(F.substring(col, 1, limit), F.lit(CUT_MARK))
    return F.coalesce(F.when(F.length(col) > limit, cut).otherwise(col), F.lit(""))


def record_as_map(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """Each row as MAP(column -> display text) without null and empty cells."""
    pairs = []
    for name in columns or df.columns:
        pairs += [F.lit(name), truncate_text(df[name].cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v != "")


def strip_suffix(col: Column, chars: str = "_") -> Column:
    """Drop trailing characters."""
    return F.rtrim(col, F.lit(chars))
