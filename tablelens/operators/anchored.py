"""Report periods around a table of anchor dates, without joining rows to date ranges.

Rows are aggregated per key and day once. Over the days of a key, prefix sums
give the sum and count of any range as a difference of two days, and a sparse
table (the extremes of 1, 2, 4, ... days from each day) gives its min and max
from two entries. Every bound of a period takes the state of the last day that
is not later, found in one sorted pass per key, so the work is linear in days
and anchors. What a task holds of a key is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.periods import all_periods
from ..functions.projection import fresh, quoted, with_values
from .aggregate import AggSpec, agg_list, measured

#: Powers of two of days in the sparse table: 2 ** 15 days are 89 years with rows on every day.
LEVELS = 16


def period_compare_anchors(
    df: DataFrame,
    date: str,
    anchors: DataFrame,
    anchor: str,
    spec: AggSpec,
    keys: Sequence[str],
    patterns: Sequence[str] | None = None,
) -> DataFrame:
    """Aggregates of every report period around each row (keys, anchor) of `anchors`.

    Rows are (keys, anchor, pattern, label, start, end, aggregates), once per
    distinct anchor, also where a period has no rows: sum and count are 0 then,
    mean, min and max null. Null keys and anchors are left out. Sums of doubles
    are differences of running sums; cast to decimal where that matters. The
    functions are sum, count, mean, min and max.
    """
    aggs = agg_list(spec, df.columns)
    for a in aggs:
        if a.func not in ("sum", "count", "mean", "min", "max"):
            raise ValueError(f"{a.func} of a range is no difference of two days")
    columns = list(dict.fromkeys(a.column for a in aggs))
    ranged = [i for i, c in enumerate(columns) if any(a.column == c and a.func in ("min", "max") for a in aggs)]
    names = [f"k{i}" for i in range(len(keys))]

    def keyed(rows: DataFrame, at: str) -> tuple[DataFrame, list[Column]]:
        rows = with_values(rows, [*keys, at])
        return rows, [rows[quoted(k)].alias(n) for k, n in zip(keys, names, strict=True)]

    rows, by = keyed(df, date)
    daily = rows.groupBy(*by, F.to_date(rows[quoted(date)]).alias("day")).agg(
        *[f(measured(rows, c)).alias(f"{kind}{i}") for i, c in enumerate(columns) for kind, f in _DAILY.items()]
    )
    days = _states(daily, names, len(columns), ranged)

    marks, by = keyed(anchors, anchor)
    marks = marks.select(*by, F.to_date(marks[quoted(anchor)]).alias("anchor")).distinct()
    wanted = [p for p in all_periods(F.col("anchor")) if patterns is None or p.pattern in patterns]
    periods = F.array(*[F.struct(F.lit(p.pattern).alias("pattern"), F.lit(p.label).alias("label"), p.start.alias("start"), p.end.alias("end")) for p in wanted])
    asked = marks.select(*names, "anchor", F.inline(periods))
    # both bounds of every period meet the days of their key, in order; a day comes before the bounds that lie on it
    sides = F.array(
        F.struct(F.date_sub("start", 1).alias("day"), F.lit("before").alias("side")), F.struct(F.col("end").alias("day"), F.lit("until").alias("side"))
    )
    bounds = asked.select("*", F.inline(sides)).withColumn("bound", F.lit(1))
    met = days.withColumn("bound", F.lit(0)).unionByName(bounds, allowMissingColumns=True)
    order = Window.partitionBy(*names).orderBy("day", "bound").rowsBetween(Window.unboundedPreceding, 0)
    met = met.withColumn("state", F.last("state", ignorenulls=True).over(order)).where("bound = 1")
    # still dealt by key: no further shuffle
    found = met.groupBy(*names, "anchor", "pattern", "label", "start", "end").agg(
        *[F.max(F.when(F.col("side") == s, F.col("state"))).alias(s) for s in ("before", "until")]
    )
    found = _with_extremes(found, days, names, ranged)
    out = {a.name: _of(a.func, columns.index(a.column)).alias(a.name) for a in aggs}
    label = [F.col(n).alias(k) for n, k in zip(names, keys, strict=True)]
    return found.select(*label, F.col("anchor").alias(fresh(anchor, df.select(*map(quoted, keys)))), "pattern", "label", "start", "end", *out.values())


_DAILY = {"sum": F.sum, "n": F.count, "min": F.min, "max": F.max}


def _states(daily: DataFrame, names: list[str], n_columns: int, ranged: list[int]) -> DataFrame:
    """`daily` with the number of the day, running sums and counts as `state`, and levels of extremes."""
    of_key = Window.partitionBy(*names).orderBy("day")
    running = of_key.rowsBetween(Window.unboundedPreceding, 0)
    sums = [F.sum(F.coalesce(f"{kind}{i}", F.lit(0))).over(running).alias(f"{kind}{i}") for i in range(n_columns) for kind in ("sum", "n")]
    days = daily.select("*", F.row_number().over(of_key).alias("number"), F.struct(*sums).alias("sums"))
    for i in ranged:
        for kind, wider in (("min", F.least), ("max", F.greatest)):
            days = days.withColumn(f"{kind}{i}_0", F.col(f"{kind}{i}"))
            for level in range(1, LEVELS):
                half = F.col(f"{kind}{i}_{level - 1}")
                days = days.withColumn(f"{kind}{i}_{level}", wider(half, F.lead(half, 2 ** (level - 1)).over(of_key)))
    levels = [F.array(*[F.col(f"{kind}{i}_{level}") for level in range(LEVELS)]).alias(f"{kind}{i}") for i in ranged for kind in ("min", "max")]
    return days.select(*names, "day", F.struct("number", "sums").alias("state"), *[level.alias(f"levels_{n}") for level, n in zip(levels, _level_names(ranged), strict=True)])


def _level_names(ranged: list[int]) -> list[str]:
    return [f"{kind}{i}" for i in ranged for kind in ("min", "max")]


def _with_extremes(found: DataFrame, days: DataFrame, names: list[str], ranged: list[int]) -> DataFrame:
    """`found` with the two entries of the sparse table that cover each period."""
    first, last = F.coalesce(F.col("before.number"), F.lit(0)) + 1, F.coalesce(F.col("until.number"), F.lit(0))
    if not ranged:
        return found
    found = found.withColumn("first", first).withColumn("length", last - F.col("first") + 1)
    found = found.withColumn("level", F.when(F.col("length") > 0, F.floor(F.log2(F.col("length"))).cast("int")))
    found = found.withColumn("second", F.when(F.col("length") > 0, F.col("first") + F.col("length") - F.pow(F.lit(2.0), F.col("level")).cast("int")))
    for side, place in (("one", "first"), ("two", "second")):
        table = days.select(*names, F.col("state.number").alias(place), F.struct(*[f"levels_{n}" for n in _level_names(ranged)]).alias(f"table_{side}"))
        found = found.join(table, [*names, place], "left")
    return found


def _of(func: str, i: int) -> Column:
    def between(kind: str) -> Column:
        until, before = (F.coalesce(F.col(f"{side}.sums.{kind}{i}"), F.lit(0)) for side in ("until", "before"))
        return until - before

    if func == "sum":
        return between("sum")
    if func == "count":
        return between("n")
    if func == "mean":
        return F.when(between("n") > 0, between("sum") / between("n"))
    entries = [F.get(F.col(f"table_{side}.levels_{func}{i}"), F.col("level")) for side in ("one", "two")]
    return F.when(F.col("length") > 0, (F.least if func == "min" else F.greatest)(*entries))
