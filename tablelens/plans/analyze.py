"""One entry point for the reporting modes: describe, period, pivot, counts, aggregate."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.projection import names_of
from ..operators.aggregate import AggSpec, group_agg, pivot, value_counts, with_total
from ..operators.calendar import resample, resample_filled
from ..operators.normalize import apply_value_maps, normalization_notes, stored_value_maps
from ..operators.paging import sort_keys
from ..operators.summary import columns_of, describe_numeric, describe_text, describe_timestamp

STATS = ("count", "unique", "top", "freq", "mean", "std", "min", "p25", "p50", "p75", "max")


def describe(df: DataFrame) -> DataFrame:
    """Summary statistics of every numeric, text and time column, written as text."""
    parts = []
    if columns_of(df, T.NumericType):
        parts.append(describe_numeric(df))
    if columns_of(df, T.StringType):
        parts.append(describe_text(df))
    if columns_of(df, T.DateType, T.TimestampType, T.TimestampNTZType):
        parts.append(describe_timestamp(df))
    if not parts:
        raise ValueError("no numeric, text or time column to describe")
    as_text = [
        p.select("column", *[F.col(s).cast("string") for s in p.columns if s != "column"])
        for p in parts
    ]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), as_text)
    return both.select("column", *[s for s in STATS if s in both.columns])


def analyze(
    df: DataFrame,
    groupby: str | Iterable[str] = (),
    aggregate: AggSpec = (),
    where: Column | str | None = None,
    sort: str = "",
    limit: int | None = None,
    period: str = "",
    pivot_column: str = "",
    value_maps: Mapping[str, Mapping[str, str] | DataFrame] | None = None,
) -> DataFrame:
    """Filter, normalise the grouping values, aggregate, sort and limit.

    The filter sees the recorded values. Without groupby and aggregate the
    result is `describe`. A period takes its date from the first group column
    and goes before a pivot. A pivot keeps the order of its group columns.
    With a limit, column total_groups says how many rows there are without it.
    """
    keys = names_of(groupby)
    aggregate = aggregate if isinstance(aggregate, str) else list(aggregate)
    if where is not None:
        df = df.where(where)
    if keys and value_maps:
        mapped = {k: m for k, m in value_maps.items() if k in (*keys, pivot_column)}
        df = apply_value_maps(df, mapped)

    if not keys and not aggregate:
        return describe(df)
    if period:
        if not keys:
            raise ValueError("a period needs a date column in groupby")
        date, further = keys[0], keys[1:]
        if further:
            out = resample(df, date, period, aggregate, further)
        else:
            out = resample_filled(df, date, period, aggregate)
        order = ["period_start", *further]
    elif pivot_column:
        if not keys or not aggregate:
            raise ValueError("a pivot needs groupby columns and an aggregate")
        out, order, sort = pivot(df, keys, pivot_column, aggregate), keys, ""
    elif not aggregate:
        out, order = value_counts(df, keys), ["count desc", *keys]
    else:
        out, order = group_agg(df, keys, aggregate), keys

    if limit is not None:
        out = with_total(out)
    if sort or order:
        out = out.orderBy(*sort_keys(out, [*names_of(sort), *order]))
    return out if limit is None else out.limit(limit)


def analyze_from_store(
    df: DataFrame, table: str, store: DataFrame, groupby: str | Iterable[str] = (), **options
) -> tuple[DataFrame, DataFrame]:
    """`analyze` under the value maps that a context store holds for `table`, and what they changed.

    The second result has one row (field, old, new, count) per entry that
    changed rows, counted after the filter and before the change. Options are
    those of `analyze` but `value_maps`.
    """
    keys = names_of(groupby)
    pivoted = options.get("pivot_column") or ""
    fields = [f for f in dict.fromkeys([*keys, pivoted]) if keys and f in columns_of(df, T.StringType)]
    maps = stored_value_maps(store, table, fields)
    result = analyze(df, groupby=keys, value_maps=maps, **options)
    where = options.get("where")
    rows = df if where is None else df.where(where)
    if not maps:
        return result, df.sparkSession.createDataFrame([], "field string, old string, new string, count bigint")
    return result, normalization_notes(rows, maps)
