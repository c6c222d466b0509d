"""Mergeable states per day: what sums, counts, means, extremes of any period are put together from."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.projection import quoted, with_values
from .aggregate import Agg, AggSpec, agg_list, measured
from .calendar import bucketed, labelled

#: Functions that merge over days; medians and distinct counts need values, see `distinct_periods` for the latter.
MERGED = ("sum", "count", "mean", "min", "max")
DAY, ROWS = "state_day", "state_rows"


@dataclass(frozen=True)
class DayStates:
    """Which columns have states, apart for which keys."""

    values: Sequence[str]
    keys: Sequence[str] = field(default=())

    def described(self) -> dict:
        """As a version file holds it."""
        return {"values": list(self.values), "keys": list(self.keys)}


def day_states(df: DataFrame, date: str, states: DayStates) -> DataFrame:
    """One row per day and keys: rows, and per column v1, v2, ... a struct (n, sum, min, max).

    Rows without a date have no state. Null keys are a group of their own here,
    and left out where states are read as groups.
    """
    parts = []
    for i, v in enumerate(states.values, 1):
        value = measured(df, v)
        total = F.sum(value) if _adds(df, v) else F.lit(None).cast("double")
        held = F.struct(F.count(value).alias("n"), total.alias("sum"), F.min(value).alias("min"), F.max(value).alias("max"))
        parts.append(held.alias(f"v{i}"))
    keys = [F.col(quoted(k)).alias(f"k{i}") for i, k in enumerate(states.keys, 1)]
    dated = df.where(F.col(quoted(date)).isNotNull())
    return dated.groupBy(F.to_date(F.col(quoted(date))).alias(DAY), *keys).agg(F.count("*").alias(ROWS), *parts)


def _adds(df: DataFrame, column: str) -> bool:
    kind = df.schema[column].dataType.simpleString()
    return kind.startswith("decimal") or kind in ("tinyint", "smallint", "int", "bigint", "float", "double")


def periods_of_states(held: DataFrame, states: DayStates, period: str, spec: AggSpec) -> DataFrame:
    """Buckets and keys with the aggregates of `spec`, as `resample` of all rows gives them.

    Reads one row per day and keys. Only functions that merge over days; the
    mean of decimals is a double.
    """
    aggs = agg_list(spec, list(states.values))
    for a in aggs:
        if a.func not in MERGED:
            raise ValueError(f"{a.func!r} does not merge over days, use one of {', '.join(MERGED)}")
    places = {v: f"v{i}" for i, v in enumerate(states.values, 1)}
    keys = [f"k{i}" for i in range(1, len(states.keys) + 1)]
    rows = bucketed(with_values(held, keys), DAY, period)
    merged = rows.groupBy("period_start", *keys).agg(*[_merged(a, places[a.column]) for a in aggs])
    names = [F.col(k).alias(name) for k, name in zip(keys, states.keys, strict=True)]
    return labelled(merged.select("period_start", *names, *[quoted(a.name) for a in aggs]), period)


def _merged(agg: Agg, place: str) -> Column:
    n, total = F.sum(f"{place}.n"), F.sum(f"{place}.sum")
    out = {
        "sum": F.coalesce(total, F.lit(0)),
        "count": n,
        "mean": F.when(n > 0, total.cast("double") / n),
        "min": F.min(f"{place}.min"),
        "max": F.max(f"{place}.max"),
    }[agg.func]
    return out.alias(agg.name)
