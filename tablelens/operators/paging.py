"""Sorting, paging and keeping the most recent rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.projection import names_of, pick_columns, quoted
from .aggregate import with_total
from .rank_index import RANGE_ROWS, RankIndex, comes_after, sort_clauses


def sort_keys(df: DataFrame, spec: str | Iterable[str]) -> list[Column]:
    """Sort columns of a spec; nulls come last both ways."""
    columns = [(df[quoted(name)], down) for name, down in sort_clauses(spec)]
    return [col.desc_nulls_last() if down else col.asc_nulls_last() for col, down in columns]


def order_by(df: DataFrame, spec: str | Iterable[str]) -> DataFrame:
    """Total order over several columns in one range-partitioned sort.

    End the list with a unique column: it makes the order repeatable and lets
    the range partitioner split a value that holds a large share of the rows.
    """
    return df.orderBy(*sort_keys(df, spec))


def top_rows(df: DataFrame, spec: str | Iterable[str], n: int) -> DataFrame:
    """The first `n` rows of an order: every task keeps its own first `n`, those are merged."""
    return order_by(df, spec).limit(n)


def _counted(df: DataFrame, total: str) -> DataFrame:
    if total in df.columns:
        raise ValueError(f"there is a column {total!r}; name the total otherwise")
    return with_total(df, total)


def page_records(
    df: DataFrame,
    orderby: str | Iterable[str],
    top: int = 20,
    skip: int = 0,
    where: Column | str | None = None,
    select: str | Iterable[str] | None = None,
    total: str = "total",
) -> DataFrame:
    """One page of the filtered, sorted table, with the filtered row count as column `total`.

    A page far down passes all rows before it through one task; `page_at` and
    `page_after` do not.
    """
    counted = _counted(df if where is None else df.where(where), total)
    page = order_by(counted, orderby).offset(skip).limit(top)
    return pick_columns(page, [*names_of(select), total] if select else None)


def page_at(
    df: DataFrame,
    orderby: str | Iterable[str],
    top: int = 20,
    skip: int = 0,
    where: Column | str | None = None,
    select: str | Iterable[str] | None = None,
    total: str = "total",
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """As `page_records`, for any depth: only the ranges of the order that hold the page are sorted.

    Counting the ranges runs at once; beyond a first page that is small, rows
    before the page are counted and neither moved nor sorted.
    """
    held = df if where is None else df.where(where)
    if total in held.columns:
        raise ValueError(f"there is a column {total!r}; name the total otherwise")
    index = RankIndex(held, orderby, range_rows)
    first = index.range_of(skip)
    end = skip + top - 1
    last = first if end < first.before + first.rows else index.range_of(end)
    rows = index.within(first.low, last.high)
    page = order_by(rows, orderby).offset(skip - first.before).limit(top).withColumn(total, F.lit(index.total).cast("long"))
    return pick_columns(page, [*names_of(select), total] if select else None)


def first_rows(df: DataFrame, spec: str | Iterable[str], n: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The first `n` rows of an order, in no order.

    Up to `range_rows` rows meet in one task. More are found by counting: all
    rows before the range of the last one stay, and only that range is sorted.
    """
    if n <= range_rows:
        return top_rows(df, spec, n)
    index = RankIndex(df, spec, range_rows)
    if n >= index.total:
        return df
    edge = index.range_of(n - 1)
    at_edge = top_rows(index.within(edge.low, edge.high), spec, n - edge.before)
    return at_edge if edge.low is None else df.where(~index.after(edge.low)).unionByName(at_edge)


def page_after(
    df: DataFrame,
    orderby: str | Iterable[str],
    last: Mapping[str, object] | object,
    top: int = 20,
    where: Column | str | None = None,
    select: str | Iterable[str] | None = None,
    total: str | None = None,
) -> DataFrame:
    """The page that follows the row `last` in an order. Deep pages cost no more than the first.

    `last` maps each sort column to that row's value, null too; for a single
    sort column it may be the value itself. With `total`, that column holds the
    row count of the filtered table.
    """
    clauses = sort_clauses(orderby)
    if not isinstance(last, Mapping):
        last = {clauses[0][0]: last}
    held = df if where is None else df.where(where)
    if total:
        held = _counted(held, total)
    after = comes_after(df, clauses, [last[name] for name, _ in clauses])
    page = order_by(held.where(after), orderby).limit(top)
    return pick_columns(page, [*names_of(select), *([total] if total else [])] if select else None)


def keep_most_recent(
    df: DataFrame, n: int, date: str | None, tiebreak: Sequence[str], range_rows: int = RANGE_ROWS
) -> DataFrame:
    """The `n` newest rows; among equal dates the smaller tiebreak comes first, rows without a date last.

    Without a date column the rows with the largest tiebreak (the arrival
    number) stay. Row counts per day are read at once and say which day is the
    last one needed: rows of later days all stay and need no sort, and only
    the rows of that day are ranked. No task gets more than about `range_rows`
    rows, however large `n` is.
    """
    if date is None or date not in df.columns:
        return first_rows(df, [f"{c} desc" for c in tiebreak], n, range_rows)
    order = [f"{date} desc", *tiebreak]
    at = F.col(quoted(date))
    # one row per day of the calendar reaches this window
    per_day = df.where(at.isNotNull()).groupBy(F.to_date(at).alias("day")).agg(F.count("*").alias("rows"))
    newest_first = Window.orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, -1)
    newer = F.coalesce(F.sum("rows").over(newest_first), F.lit(0)).alias("newer")
    needed = per_day.select("day", "rows", newer).where(F.col("newer") < n)
    last = needed.orderBy("day").first()
    if last is None or last["newer"] + last["rows"] < n:
        dated = last["newer"] + last["rows"] if last else 0
        rest = first_rows(df.where(at.isNull()), list(tiebreak), n - dated, range_rows)
        return df.where(at.isNotNull()).unionByName(rest)
    start = F.lit(last["day"])
    next_day = F.date_add(start, 1)
    same_day = first_rows(df.where((at >= start) & (at < next_day)), order, n - last["newer"], range_rows)
    return df.where(at >= next_day).unionByName(same_day)
