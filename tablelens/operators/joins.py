"""Null-safe joins and lookups. How rows travel is left to adaptive execution."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.projection import fresh, quoted


def match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on null-safe equal keys; the right side's keys are left out of the result."""
    pairs = [F.col(f"l.{quoted(k)}").eqNullSafe(F.col(f"r.{quoted(k)}")) for k in keys]
    joined = left.alias("l").join(right.alias("r"), reduce(lambda a, b: a & b, pairs), how)
    if how in ("left_semi", "left_anti"):
        return joined
    added = [F.col(f"r.{quoted(c)}") for c in right.columns if c not in keys]
    return joined.select("l.*", *added)


def one_per_key(lookup: DataFrame, on: Sequence[str], seq: Sequence[str] = ()) -> DataFrame:
    """One row per key: the last by `seq`, or without it the largest when written as JSON."""
    rest = [c for c in lookup.columns if c not in on]
    if not rest:
        return lookup.distinct()
    row = F.struct(*[F.col(quoted(c)) for c in rest])
    order = F.struct(*[F.col(quoted(s)) for s in seq]) if seq else F.to_json(row)
    held = fresh("_row", lookup)
    return lookup.groupBy(*[quoted(k) for k in on]).agg(F.max_by(row, order).alias(held)).select(
        *[quoted(k) for k in on], *[F.col(held)[c].alias(c) for c in rest]
    )


def lookup_join(df: DataFrame, lookup: DataFrame, on: Sequence[str], seq: Sequence[str] = ()) -> DataFrame:
    """Left join to a lookup table, reduced to one row per key first, so no row of `df` multiplies."""
    names = [fresh(f"_on{i}", df, lookup) for i in range(len(on))]
    found = one_per_key(lookup, on, seq)
    found = found.select(*[F.col(quoted(k)).alias(n) for k, n in zip(on, names, strict=True)], *[quoted(c) for c in found.columns if c not in on])
    same = reduce(lambda a, b: a & b, [df[quoted(k)] == F.col(n) for k, n in zip(on, names, strict=True)])
    return df.join(found, same, "left").drop(*names)
