"""Choosing columns by list or by rule."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column name for Spark SQL, whatever signs it holds."""
    return "`" + name.replace("`", "``") + "`"


def fresh(name: str, *frames: DataFrame) -> str:
    """`name`, with as many underscores before it as make it no column of `frames`."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_values(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The rows that have a value in every named column."""
    for name in names:
        df = df.where(F.col(quoted(name)).isNotNull())
    return df


def names_of(spec: str | Iterable[str] | None) -> list[str]:
    """Column names from a comma list or an iterable; blanks are trimmed away."""
    if spec is None:
        return []
    parts = spec.split(",") if isinstance(spec, str) else spec
    return [p.strip() for p in parts if p.strip()]


def pick_columns(df: DataFrame, select: str | Iterable[str] | None) -> DataFrame:
    """Project to the named columns; no names keep all of them."""
    names = names_of(select)
    return df.select(*[df[quoted(n)] for n in names]) if names else df


def visible_columns(
    df: DataFrame,
    label: Callable[[str], str],
    hidden: str = "internal",
    show_all: bool = False,
) -> DataFrame:
    """Hide the columns that `label` marks as `hidden`, unless `show_all`."""
    if show_all:
        return df
    return df.select(*[df[c] for c in df.columns if label(c) != hidden])
