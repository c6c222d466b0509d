"""Exact quantiles that no single task has to hold.

The built-in exact percentile keeps every distinct value of a group in one
buffer, and its sketches all meet in one task. Here a group of many rows is
narrowed by histograms: its range is cut into BUCKETS of equal width, rows per
bucket are counted by partial aggregation, and only the buckets that hold a
wanted rank go on, each within the least and largest value that was found in it.
No value is shuffled before the last pass, in which every span is a single value
or holds few rows. A pass sends at most BUCKETS small rows per group and task.
All columns and all wanted quantiles share the passes.

A bucket number grows with the value, whatever the rounding, so a span holds
just the values between its bounds. Each pass divides the width of a span by
BUCKETS; a range of doubles is never more than a few passes wide.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.projection import fresh, quoted, with_values
from ..session import scratch_table

BUCKETS = 2_048
#: Rows of a span that one task sorts at most, about.
INTERVAL = 1_000_000
_LARGEST = 1.7976931348623157e308


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    probabilities: Mapping[str, float],
    interval: int = INTERVAL,
) -> DataFrame:
    """Per group and column one DOUBLE column per named probability, linearly interpolated.

    Rows are (keys, column, quantiles); without keys, whole columns. Nulls and
    NaN are skipped, and groups with a null key or without values are absent.
    The sizes of the groups are counted at once, which chooses the way; where
    no group is large, the rest is lazy.
    """
    kept = with_values(df, keys)
    names = [fresh(f"_key{i}", df) for i in range(len(keys))]
    of = [*names, "column"]
    by = [F.col(quoted(k)).alias(n) for k, n in zip(keys, names, strict=True)]
    number = {c: F.col(quoted(c)).cast("double") for c in columns}
    value = {c: F.when(~F.isnan(v), v) for c, v in number.items()}

    def rows_of(some: Sequence[str]) -> DataFrame:
        cells = [F.struct(F.lit(c).alias("column"), value[c].alias("v")) for c in some]
        return kept.select(*by, F.inline(F.array(*cells))).where("v is not null")

    # one wide row per group: no value leaves its task
    wide = kept.groupBy(*by).agg(*[f(value[c]).alias(f"_{n}{i}") for i, c in enumerate(columns) for n, f in _SIZES.items()])
    sizes = [F.struct(F.lit(c).alias("column"), *[F.col(f"_{n}{i}").alias(n) for n in _SIZES]) for i, c in enumerate(columns)]
    spans = wide.select(*names, F.inline(F.array(*sizes))).where("rows > 0")
    large = _held(spans.where(f"rows > {interval}"), bool(keys))
    big = [r[0] for r in large.select("column").distinct().collect()]  # columns of the caller
    if not big:
        found = _sorted(rows_of(columns), of, probabilities)
    else:
        rows = rows_of(big)
        found = _narrowed(rows, large, of, probabilities, interval, bool(keys))
        if keys:
            found = found.unionByName(_sorted(rows_of(columns).join(large.select(*of), of, "left_anti"), of, probabilities))
        elif len(big) < len(columns):
            found = found.unionByName(_sorted(rows_of([c for c in columns if c not in big]), of, probabilities))
    return found.select(*[F.col(n).alias(k) for n, k in zip(names, keys, strict=True)], "column", *probabilities)


_SIZES = {"rows": F.count, "low": F.min, "high": F.max}


def _held(rows: DataFrame, grouped: bool) -> DataFrame:
    """`rows`, computed once: without groups a few rows, which stay with the driver."""
    return scratch_table(rows) if grouped else rows.sparkSession.createDataFrame(rows.collect(), rows.schema)


def _within(rows: DataFrame, spans: DataFrame, of: list[str]) -> DataFrame:
    """The rows inside `spans`, beside their span. Without groups a few spans go to every task: a join by column would
    bring all rows of a column to one, and the planner cannot know the size of rows that were with the driver."""
    return rows.join(F.broadcast(spans) if of == ["column"] else spans, of).where("v >= low and v <= high")


def _sorted(rows: DataFrame, of: list[str], probabilities: Mapping[str, float]) -> DataFrame:
    """Quantiles of groups that one task may hold."""
    found = rows.groupBy(*of).agg(F.sort_array(F.collect_list("v")).alias("values"))
    found = found.withColumn("total", F.size("values"))
    for name, p in probabilities.items():
        for side, rank in zip(("lo", "hi"), _ranks(p), strict=True):
            found = found.withColumn(f"_{side}_{name}", F.get("values", rank.cast("int")))
    return found.select(*of, *[_interpolated(name, p).alias(name) for name, p in probabilities.items()])


def _narrowed(rows: DataFrame, large: DataFrame, of: list[str], probabilities: Mapping[str, float], interval: int, grouped: bool) -> DataFrame:
    """Quantiles of large groups (of, rows, low, high)."""
    open_ = large.withColumns({"before": F.lit(0).cast("long"), "total": F.col("rows"), "span": F.lit("")})
    # a span of one value, or of values that halve to the same finite number, cannot be cut further
    small = (F.col("rows") <= interval) | (_half("low") == _half("high"))
    done: list[DataFrame] = []
    while True:
        spans = _held(_smaller(rows, open_, of, probabilities), grouped)
        done.append(spans.where(small))
        open_ = spans.where(~small)
        if open_.isEmpty():
            break
    spans = done[0]
    for more in done[1:]:
        spans = spans.unionByName(more)
    ranked = _single(spans.where("low = high"), of)
    rest = spans.where("low < high")
    if not rest.isEmpty():
        ranked = ranked.unionByName(_inside_sorted(rows, rest, of))
    return _picked(ranked, of, probabilities)


def _smaller(rows: DataFrame, spans: DataFrame, of: list[str], probabilities: Mapping[str, float]) -> DataFrame:
    """The buckets of the spans that hold a wanted rank, as spans."""

    share = F.try_divide(_half("v") - _half("low"), _half("high") - _half("low"))
    bucket = F.coalesce(F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1)), F.lit(0))
    placed = _within(rows, spans, of)
    counted = placed.groupBy(*of, "span", "before", "total", bucket.cast("int").alias("bucket")).agg(
        F.count("*").alias("rows"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    # a span has BUCKETS rows at most
    earlier = Window.partitionBy(*of, "span").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("first", F.col("before") + F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    hit = F.lit(False)
    for p in probabilities.values():
        for rank in _ranks(p):
            hit = hit | ((F.col("first") <= rank) & (rank < F.col("first") + F.col("rows")))
    return counted.where(hit).select(
        *of, "rows", "low", "high", F.col("first").alias("before"), "total", F.concat_ws(".", "span", "bucket").alias("span")
    )


def _half(v: str) -> Column:
    """Half the value, infinite ones as the largest finite: no difference overflows."""
    return F.least(F.greatest(F.col(v), F.lit(-_LARGEST)), F.lit(_LARGEST)) / 2


def _single(spans: DataFrame, of: list[str]) -> DataFrame:
    return spans.select(*of, "total", "before", F.array("low").alias("values"), "rows")


def _inside_sorted(rows: DataFrame, spans: DataFrame, of: list[str]) -> DataFrame:
    held = _within(rows, spans, of)
    found = held.groupBy(*of, "span", "total", "before").agg(F.sort_array(F.collect_list("v")).alias("values"), F.count("*").alias("rows"))
    return found.select(*of, "total", "before", "values", "rows")


def _picked(ranked: DataFrame, of: list[str], probabilities: Mapping[str, float]) -> DataFrame:
    """Interpolate between the values at the ranks around each quantile; a span of one value stands for all its rows."""
    picks = [F.max("total").alias("total")]
    for name, p in probabilities.items():
        for side, rank in zip(("lo", "hi"), _ranks(p), strict=True):
            inside = (rank >= F.col("before")) & (rank < F.col("before") + F.col("rows"))
            at = F.when(F.size("values") == 1, 0).otherwise(rank - F.col("before")).cast("int")
            picks.append(F.max(F.when(inside, F.get("values", at))).alias(f"_{side}_{name}"))
    found = ranked.groupBy(*of).agg(*picks)
    return found.select(*of, *[_interpolated(name, p).alias(name) for name, p in probabilities.items()])


def _target(p: float) -> Column:
    return (F.col("total") - 1) * F.lit(float(p))


def _ranks(p: float) -> tuple[Column, Column]:
    """Zero-based ranks on both sides of the wanted position."""
    return F.floor(_target(p)), F.ceil(_target(p))


def _interpolated(name: str, p: float) -> Column:
    low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
    between = low + (high - low) * (_target(p) - F.floor(_target(p)))
    return F.when(low == high, low).otherwise(between)
