"""Time-series buckets and current-versus-previous comparison."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.periods import Period, all_periods
from ..functions.projection import quoted
from .aggregate import AggSpec, agg_list, group_agg

PERIODS = ("week", "month", "quarter")
STEP = {"week": "interval 7 days", "month": "interval 1 month", "quarter": "interval 3 months"}
BUCKET = ["period_start", "period_end", "period_label"]


def period_start(date: Column, period: str) -> Column:
    """First day of the bucket; weeks start on Monday."""
    if period not in PERIODS:
        raise ValueError(f"unknown period {period!r}, use one of {', '.join(PERIODS)}")
    if period == "week":
        return F.next_day(F.date_sub(F.to_date(date), 7), "Mon")
    return F.trunc(F.to_date(date), period)


def period_end(start: Column, period: str) -> Column:
    """Last day of the bucket that starts on `start`."""
    if period == "week":
        return F.date_add(start, 6)
    return F.last_day(F.add_months(start, 0 if period == "month" else 2))


def labelled(df: DataFrame, period: str) -> DataFrame:
    """Bucket columns from `period_start`; the label is the year and month of the end."""
    start = F.col("period_start")
    rest = [quoted(c) for c in df.columns if c != "period_start"]
    end = period_end(start, period)
    return df.select(
        start,
        end.alias("period_end"),
        F.date_format(end, "yyyy-MM").alias("period_label"),
        *rest,
    )


def bucketed(df: DataFrame, date: str, period: str) -> DataFrame:
    """`df` with the first day of the bucket of every row."""
    is_date = isinstance(
        df.schema[date].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)
    )
    if not is_date:
        raise ValueError(f"{date!r} must be a date or timestamp column")
    return df.withColumn("period_start", period_start(df[date], period))


def resample(
    df: DataFrame, date: str, period: str, spec: AggSpec, keys: Sequence[str] = ()
) -> DataFrame:
    """Aggregate per calendar bucket and the further keys; only buckets with rows appear."""
    buckets = bucketed(df, date, period)
    return labelled(group_agg(buckets, ["period_start", *keys], spec), period)


def resample_filled(df: DataFrame, date: str, period: str, spec: AggSpec) -> DataFrame:
    """As `resample` on the date alone, with a row for every bucket in between.

    An empty bucket has sum, count and nunique 0; its other values are null.
    """
    aggs = agg_list(spec, df.columns)
    found = group_agg(bucketed(df, date, period), ["period_start"], aggs)
    # the calendar is bounded by its days, whatever the size of the table
    calendar = found.agg(F.min("period_start").alias("first"), F.max("period_start").alias("last")).select(
        F.explode(F.sequence("first", "last", F.expr(STEP[period]))).alias("period_start")
    )
    zero = [a.name for a in aggs if a.func in ("sum", "count", "nunique")]
    filled = calendar.join(found, "period_start", "left")
    return labelled(filled.na.fill(0, subset=zero) if zero else filled, period)


def period_compare(
    df: DataFrame,
    date: str,
    anchor: str | dt.date,
    spec: AggSpec,
    keys: Sequence[str] = (),
    patterns: Sequence[str] | None = None,
) -> DataFrame:
    """Aggregates of every report period around `anchor`, one row per pattern and label.

    The bounds are constants, so the scan is limited to the days any period
    needs, and one pass fills all periods by conditional aggregation.
    """
    keys, aggs = list(keys), agg_list(spec, df.columns)
    periods = [p for p in all_periods(anchor) if patterns is None or p.pattern in patterns]
    held = df.where(
        (df[date] >= F.least(*[p.start for p in periods]))
        & (df[date] < F.date_add(F.greatest(*[p.end for p in periods]), 1))
    )
    held = held.dropna(subset=keys) if keys else held
    if any(a.func in ("median", "nunique") for a in aggs):
        return _compare_by_rows(held, date, periods, aggs, keys)

    wide = held.groupBy(*keys).agg(
        *[
            a.over(F.when(p.holds(F.col(date)), F.col(a.column))).alias(f"_{i}_{a.name}")
            for i, p in enumerate(periods)
            for a in aggs
        ]
    )
    rows = [
        F.struct(*_names(p), *[F.col(f"_{i}_{a.name}").alias(a.name) for a in aggs])
        for i, p in enumerate(periods)
    ]
    return wide.select(*keys, F.inline(F.array(*rows)))


def _names(p: Period) -> list[Column]:
    return [
        F.lit(p.pattern).alias("pattern"),
        F.lit(p.label).alias("label"),
        p.start.alias("start"),
        p.end.alias("end"),
    ]


def _compare_by_rows(
    held: DataFrame, date: str, periods: list[Period], aggs: list, keys: list[str]
) -> DataFrame:
    """Holistic functions: each row is repeated for the periods it falls into."""
    hits = F.array_compact(
        F.array(*[F.when(p.holds(F.col(date)), F.struct(*_names(p))) for p in periods])
    )
    used = list(dict.fromkeys([*keys, *[a.column for a in aggs]]))
    tagged = held.select(*used, F.inline(hits))
    found = group_agg(tagged, [*keys, "pattern", "label", "start", "end"], aggs)
    # every group has every period, as it has in one pass
    bounds = ["start", "end"]
    names = F.inline(F.array(*[F.struct(*_names(p)) for p in periods]))
    all_rows = held.groupBy(*keys).agg(F.count("*").alias("_rows")).select(*keys, names)
    on = [*keys, "pattern", "label"]
    zero = [a.name for a in aggs if a.func in ("sum", "count", "nunique")]
    filled = all_rows.join(found.drop(*bounds), on, "left")
    return (filled.na.fill(0, subset=zero) if zero else filled).select(*on, *bounds, *[a.name for a in aggs])
