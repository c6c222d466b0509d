"""Summary statistics of a table, one output row per column."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import epoch_micros, from_epoch_micros
from ..functions.projection import quoted
from .aggregate import measured
from .quantiles import exact_quantiles

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def columns_of(df: DataFrame, *kinds: type) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def _per_column(
    df: DataFrame, names: Sequence[str], stats: Mapping[str, Callable[[Column], Column]]
) -> DataFrame:
    """One row per column of the given aggregates, all from one pass over `df`."""
    wide = df.agg(
        *[f(df[c]).alias(f"{s}{i}") for i, c in enumerate(names) for s, f in stats.items()]
    )
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{s}{i}").alias(s) for s in stats])
        for i, c in enumerate(names)
    ]
    return wide.select(F.inline(F.array(*rows)))


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std, min, exact quartiles and max per numeric column."""
    names = list(columns or columns_of(df, T.NumericType))
    plain = _per_column(
        df.select(*[measured(df, c).cast("double").alias(c) for c in names]),
        names,
        {
            "count": F.count,
            "mean": F.avg,
            "std": F.stddev_samp,
            "min": F.min,
            "max": F.max,
        },
    )
    stats = plain.join(exact_quantiles(df, [], names, QUARTILES), "column", "left")
    return stats.select("column", "count", "mean", "std", "min", *QUARTILES, "max")


#: Characters of a text that are compared with those of others as frequent, pass by pass; then whole texts.
HEADS = (16, 256, 65_536)


def _digest(value: Column) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(1), value), F.xxhash64(F.lit(2), value)


def _frequent(cells: DataFrame, head: int | None) -> DataFrame:
    """Per column: values, different values, rows of the most frequent ones and the first head among these.

    Values are told apart by two hashes of 64 bits, and only these, the head
    and a count are shuffled. `low` and `high` are the smallest and largest of
    both hashes among the values with that head; where they agree there is one.
    """
    start = F.col("value") if head is None else F.substring("value", 1, head)
    one, two = _digest(F.col("value"))
    counts = cells.groupBy("column", one.alias("a"), two.alias("b"), start.alias("head")).agg(F.count("*").alias("n"))
    low, high = (F.struct(F.col(f"{f}_a").alias("a"), F.col(f"{f}_b").alias("b")) for f in ("min", "max"))
    first = F.struct((-F.col("n")).alias("less"), F.col("head"))
    return (
        counts.groupBy("column", "n", "head")
        .agg(
            *[f(h).alias(f"{f.__name__}_{h}") for f in (F.min, F.max) for h in "ab"],
            F.count("*").alias("values"),
        )
        .groupBy("column")
        .agg(
            F.sum(F.col("n") * F.col("values")).alias("count"),
            F.sum("values").alias("unique"),
            F.max("n").alias("freq"),
            F.min_by(F.struct("head", low.alias("low"), high.alias("high")), first).alias("best"),
        )
        .select("column", "count", "unique", "freq", "best.*")
    )


def describe_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, unique, top and freq per text column; equal frequencies go to the smaller value.

    Runs a job that counts digests, so no whole text is shuffled, and a second
    one over the rows that start alike where the most frequent texts do. Where
    a text is longer than what was compared, it is looked up by its digest. One
    row per column is collected.
    """
    names = list(columns or columns_of(df, T.StringType))
    cells = df.select(*[df[quoted(n)] for n in names]).unpivot([], [quoted(n) for n in names], "column", "value").dropna()
    stats: dict[str, dict] = {}
    tops: dict[str, str] = {}
    by_digest: dict[str, tuple[int, int]] = {}
    heads: dict[str, str] = {}
    for size in (*HEADS, None):
        # rows that start with what the most frequent ones start with; all of them in the first pass
        alike = [(F.col("column") == n) & F.col("value").startswith(F.lit(h)) for n, h in heads.items()]
        some = cells.where(reduce(lambda a, b: a | b, alike)) if heads else cells
        found = {r["column"]: r for r in _frequent(some, size).collect()}
        stats = stats or found
        if heads:
            found = {n: r for n, r in found.items() if n in heads}
        heads = {}
        for name, row in found.items():
            if size is None or len(row["head"]) < size:
                tops[name] = row["head"]
            elif row["low"] == row["high"]:
                by_digest[name] = row["low"]
            else:
                heads[name] = row["head"]
        if not heads:
            break
    for name, wanted in by_digest.items():
        one, two = _digest(df[quoted(name)])
        same = df.where((one == wanted[0]) & (two == wanted[1]) & df[quoted(name)].isNotNull())
        tops[name] = same.select(quoted(name)).first()[0]
    filled = [stats.get(n) for n in names]
    return df.sparkSession.createDataFrame(
        pa.table(
            {
                "column": pa.array(names, pa.string()),
                "count": pa.array([r["count"] if r else 0 for r in filled], pa.int64()),
                "unique": pa.array([r["unique"] if r else 0 for r in filled], pa.int64()),
                "top": pa.array([tops.get(n) for n in names], pa.string()),
                "freq": pa.array([r["freq"] if r else None for r in filled], pa.int64()),
            }
        )
    )


def describe_timestamp(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, min, exact quartiles and max per date or timestamp column."""
    names = list(columns or columns_of(df, T.DateType, T.TimestampType, T.TimestampNTZType))
    values = df.select(*[epoch_micros(df[c].cast("timestamp_ntz")).alias(c) for c in names])
    plain = _per_column(
        values,
        names,
        {
            "count": F.count,
            "total": lambda v: F.sum(v.cast("decimal(20,0)")),
            "min": F.min,
            "max": F.max,
        },
    )
    stats = plain.join(exact_quantiles(values, [], names, QUARTILES), "column", "left")

    def clock(micros):
        return from_epoch_micros(F.floor(micros))

    return stats.select(
        "column",
        "count",
        clock(F.col("total") / F.col("count")).alias("mean"),
        clock(F.col("min")).alias("min"),
        *[clock(F.col(q)).alias(q) for q in QUARTILES],
        clock(F.col("max")).alias("max"),
    )
