"""Grouped, scalar and pivoted aggregation over a closed set of eight functions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.projection import fresh, quoted, with_values
from .quantiles import exact_quantiles

#: Values of a column that a pivot turns into columns.
MOST_VALUES = 1_000
FUNCTIONS = ("sum", "count", "mean", "min", "max", "median", "nunique", "std")


@dataclass(frozen=True)
class Agg:
    """One function over one column; the result column is `{column}_{func}`."""

    func: str
    column: str

    def __post_init__(self) -> None:
        if self.func not in FUNCTIONS:
            raise ValueError(f"unknown function {self.func!r}, use one of {', '.join(FUNCTIONS)}")

    @property
    def name(self) -> str:
        return f"{self.column}_{self.func}"

    def over(self, value: Column) -> Column:
        """The aggregate expression; median is not one, see `exact_quantiles`."""
        build = {
            "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),
            "count": F.count,
            "mean": F.avg,
            "min": F.min,
            "max": F.max,
            "nunique": F.count_distinct,
            "std": F.stddev_samp,
        }[self.func]
        return build(value).alias(self.name)


AggSpec = str | Iterable[Agg]


def agg_list(spec: AggSpec, columns: Sequence[str]) -> list[Agg]:
    """Aggregates from Agg objects or from text such as "sum:Amount,count:Amount".

    The functions of one column stand together, in the order of first mention.
    """
    if isinstance(spec, str):
        pairs = [part.partition(":") for part in spec.split(",") if part.strip()]
        for func, colon, _ in pairs:
            if not colon:
                raise ValueError(f"expected function:column, got {func.strip()!r}")
        aggs = [Agg(func.strip().lower(), column.strip()) for func, _, column in pairs]
    else:
        aggs = list(spec)
    for a in aggs:
        if a.column not in columns:
            raise ValueError(f"no column {a.column!r}, there are: {', '.join(columns)}")
    order = list(dict.fromkeys(a.column for a in aggs))
    return sorted(dict.fromkeys(aggs), key=lambda a: order.index(a.column))


def group_agg(df: DataFrame, keys: Sequence[str], spec: AggSpec) -> DataFrame:
    """One row per group of non-null keys, or one row in all where `keys` is empty.

    Spark aggregates within each task before the shuffle, so a hot key sends
    one row per task. Distinct counts shuffle on (keys, value) first, and the
    median never holds a group in one task.
    """
    keys, aggs = list(keys), agg_list(spec, df.columns)
    kept = with_values(df, keys)
    plain = [a.over(measured(kept, a.column)) for a in aggs if a.func != "median"]
    medians = [a for a in aggs if a.func == "median"]
    by = [quoted(k) for k in keys]
    # a group whose values are all null still appears, so the groups come from the rows
    out = kept.groupBy(*by).agg(*(plain or [F.count("*").alias("_rows")]))
    if medians:
        # all median columns share the passes of one call
        middles = exact_quantiles(kept, keys, [a.column for a in medians], {"middle": 0.5})
        picks = [F.max(F.when(F.col("column") == a.column, F.col("middle"))).alias(a.name) for a in medians]
        if keys:
            # groups have no null key, so plain equality finds them
            names = [fresh(f"_key{i}", out) for i in range(len(by))]
            found = middles.groupBy(*[F.col(k).alias(n) for k, n in zip(by, names, strict=True)]).agg(*picks)
            out = out.join(found, [F.col(k) == F.col(n) for k, n in zip(by, names, strict=True)], "left")
        else:
            row = middles.agg(F.struct(*picks)).scalar()
            out = out.withColumns({a.name: row[a.name] for a in medians})
    return out.select(*by, *[quoted(a.name) for a in aggs])


def measured(df: DataFrame, column: str) -> Column:
    """The values of a column; NaN counts as no value, as it does for a reader of reports."""
    value = df[quoted(column)]
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value)
    return value


def scalar_agg(df: DataFrame, spec: AggSpec) -> DataFrame:
    """Aggregates over all rows, as one row."""
    return group_agg(df, [], spec)


def value_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per group of non-null keys, most frequent first, ties by key."""
    by = [quoted(k) for k in keys]
    counts = with_values(df, keys).groupBy(*by).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), *by)


def count_records(df: DataFrame, where: Column | str | None = None) -> DataFrame:
    """The number of rows as a one-row table; no match counts 0."""
    return (df if where is None else df.where(where)).agg(F.count("*").alias("count"))


def with_total(df: DataFrame, total: str = "total_groups") -> DataFrame:
    """Add the row count of `df` to every row, as a scalar subquery.

    A window over all rows would pull them into one task.
    """
    return df.withColumn(total, df.agg(F.count("*")).scalar())


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per label and their share of all labelled rows in percent."""
    counts = with_values(df, [column]).groupBy(quoted(column)).agg(F.count("*").alias("count"))
    # from the counts, not from the rows again
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("percent", F.col("count") * 100.0 / total)


def pivot_values(df: DataFrame, column: str, limit: int | None = None) -> list | None:
    """The distinct non-null values of a pivot column, sorted; None if there are more than `limit`."""
    found = with_values(df.select(quoted(column)), [column]).distinct()
    rows = (found if limit is None else found.limit(limit + 1)).collect()
    return None if limit is not None and len(rows) > limit else sorted(row[0] for row in rows)


def pivot(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    spec: AggSpec,
    values: Sequence | None = None,
    most_values: int | None = MOST_VALUES,
) -> DataFrame:
    """Cross table: groups as rows, the values of `column` as columns, empty cells 0.

    Where `column` has more than `most_values` values, the cells are returned
    as rows (keys, column, aggregate) instead, so what is collected and planned
    is bounded; None means that the caller knows them to be few.

    Only the first aggregate counts. Cells are aggregated per (keys, value)
    before they are turned into columns. Pass `values` to save the pass that
    finds them; values found are those with at least one non-null cell, and
    without them a given value keeps its column.
    """
    keys, first = list(keys), agg_list(spec, df.columns)[0]
    kept = with_values(df, [*keys, column])
    cells = group_agg(kept, [*keys, column], [first])
    always_filled = first.func in ("sum", "count", "nunique")
    if not always_filled:
        # a group without any value gives no cell and no row
        cells = with_values(cells, [first.name])
    if values is None:
        values = pivot_values(kept if always_filled else cells, column, most_values)
    if values is None:
        return cells
    cell, name = F.first(quoted(first.name), ignorenulls=True), fresh("_column", cells)
    by = [quoted(k) for k in keys]
    wide = cells.withColumnRenamed(column, name).groupBy(*by).pivot(name, list(values)).agg(cell)
    if any(isinstance(wide.schema[k].dataType, (T.DoubleType, T.FloatType)) for k in keys):
        return wide.na.fill(0, subset=[quoted(c) for c in wide.columns if c not in keys])  # a key may be NaN
    return wide.na.fill(0)  # keys are never null; not by name, as values may differ in case alone
