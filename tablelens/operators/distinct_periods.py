"""Exact distinct counts of several calendar grains from one scan.

Distinct counts of days do not add up to that of their month, as a value may
come again. First appearances do: a value counts in a week, month or quarter on
the first of its days there. Rows are reduced to one per day and value once,
whatever the number of grains, and the day before of the same value says in
which of its periods it is new.

A task holds a few dozen bytes per day and value that it is dealt, so their
number, not the spread of the values, decides what it takes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.projection import fresh, quoted, with_values
from .calendar import PERIODS, period_end, period_start


def distinct_by_periods(
    df: DataFrame, date: str, column: str, periods: Sequence[str] = PERIODS, keys: Sequence[str] = ()
) -> DataFrame:
    """Distinct values of `column` per grain, bucket of it and the further keys, all grains from one scan.

    One row per grain, bucket with rows and keys: period, period_start,
    period_end, period_label, keys, `{column}_nunique`. Rows without a date or
    key count nowhere; null is no value. NaN counts as a value.
    """
    day, value, before = (fresh(n, df) for n in ("_day", "_value", "_before"))
    by = [quoted(k) for k in keys]
    kept = with_values(df, [date, *keys])
    # equal rows are one before they are shuffled, so a hot day or value sends one row per task
    days = kept.select(F.to_date(F.col(quoted(date))).alias(day), *by, F.col(quoted(column)).alias(value)).distinct()
    # one row per day of the calendar at most
    days = days.withColumn(before, F.lag(day).over(Window.partitionBy(*by, value).orderBy(day)))

    def new(period: str) -> Column:
        again = period_start(F.col(before), period) == period_start(F.col(day), period)
        return F.col(value).isNotNull() & ~F.coalesce(again, F.lit(False))

    firsts = days.groupBy(day, *by).agg(*[F.count_if(new(p)).alias(f"_new{i}") for i, p in enumerate(periods)])
    grains = F.array(
        *[
            F.struct(F.lit(p).alias("period"), start.alias("period_start"), period_end(start, p).alias("period_end"), F.col(f"_new{i}").alias("_new"))
            for i, p in enumerate(periods)
            for start in [period_start(F.col(day), p)]
        ]
    )
    spans = ["period", "period_start", "period_end", *by]
    counted = firsts.select(*by, F.inline(grains)).groupBy(*spans).agg(F.sum("_new").alias(f"{column}_nunique"))
    label = F.date_format("period_end", "yyyy-MM").alias("period_label")
    return counted.select("period", "period_start", "period_end", label, *by, quoted(f"{column}_nunique"))
