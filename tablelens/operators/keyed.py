"""Tables with one row per key: upsert, delete, dedup, diff and key sets.

Key columns are compared null-safe throughout, so a null key is a key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.projection import fresh, quoted
from .joins import match


def without_keys(df: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `df` whose key does not occur in `gone`."""
    return match(df, gone.select(*map(quoted, keys)).distinct(), keys, "left_anti")


def dedup_keep_last(df: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """The last-arrived row per key. Where a key column is missing, all rows stay.

    The rank limit also runs inside every task before the shuffle, so a key
    that was delivered a billion times sends one row per task.
    """
    if any(k not in df.columns for k in keys):
        return df
    rank = fresh("_rank", df)
    latest = Window.partitionBy(*map(quoted, keys)).orderBy(*[F.col(quoted(s)).desc_nulls_last() for s in seq])
    return df.withColumn(rank, F.row_number().over(latest)).where(F.col(rank) == 1).drop(rank)


def union_by_name(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both, columns matched by name, missing ones null."""
    return old.unionByName(new, allowMissingColumns=True)


def keyed_upsert(
    held: DataFrame, incoming: DataFrame, keys: Sequence[str], seq: Sequence[str]
) -> DataFrame:
    """Replace the rows whose key arrives again and add the new keys.

    `held` has one row per key. Of all rows of a key the last by `seq` wins, of
    equal ones the incoming. Where `held` lacks a column of `seq`, every
    incoming row counts as later. Only rows whose key arrives are ranked.
    """
    arriving, arrived = incoming.select(*map(quoted, keys)).distinct(), fresh("_new", held, incoming)
    new = incoming.withColumn(arrived, F.lit(1))
    if all(s in held.columns for s in seq):
        new = union_by_name(match(held, arriving, keys, "left_semi").withColumn(arrived, F.lit(0)), new)
    latest = dedup_keep_last(new, keys, [*seq, arrived]).drop(arrived)
    return union_by_name(match(held, arriving, keys, "left_anti"), latest)


def keyed_delete(
    df: DataFrame, gone: DataFrame, keys: Sequence[str], optional: str | None = None
) -> DataFrame:
    """Drop the rows named in `gone`.

    `optional` is a last key part that may be empty in `gone`: such an entry
    drops every row of the remaining key.
    """
    if optional is None:
        return without_keys(df, gone, keys)
    part = F.coalesce(gone[quoted(optional)], F.lit(""))
    exact = without_keys(df, gone.where(part != ""), [*keys, optional])
    return without_keys(exact, gone.where(part == ""), keys)


def insert_if_absent(held: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the rows of `new`, one per key, whose keys are not held yet; held rows stay."""
    return union_by_name(held, without_keys(new, held, keys))


def grouped_concat(
    store: DataFrame,
    keys: Sequence[str],
    kind: str,
    text: str,
    seq: Sequence[str],
    sep: str = "; ",
) -> DataFrame:
    """All texts of a key in one, ordered by `kind`, as column `text`.

    The store holds one text per (key, kind); of several the last by `seq`
    counts. So what is collected per key is bounded by the number of kinds.
    """
    by, said = [quoted(k) for k in keys], fresh("_text", store)
    entries = store.groupBy(*by, quoted(kind)).agg(
        F.max_by(quoted(text), F.struct(*map(quoted, seq))).alias(said)
    )
    parts = F.sort_array(F.collect_list(F.struct(F.col(quoted(kind)).alias("kind"), F.col(said).alias("text"))))
    return entries.groupBy(*by).agg(
        F.array_join(F.transform(parts, lambda p: p["text"]), sep).alias(text)
    )


def snapshot_diff(
    current: DataFrame, existing: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Status new, changed, unchanged or removed per key, with both sides' values.

    Both sides hold one row per key. Values are compared null-safe.
    """
    cur, old = (
        df.select(
            *[F.col(quoted(k)).alias(f"{side}_key{i}") for i, k in enumerate(keys)],
            F.lit(True).alias(f"_{side}"),
            *[F.col(quoted(v)).alias(f"{side}_{v}") for v in values],
        )
        for side, df in (("current", current), ("existing", existing))
    )

    def equal(names: Sequence[str]) -> Column:
        pairs = [F.col(quoted(f"current_{n}")).eqNullSafe(F.col(quoted(f"existing_{n}"))) for n in names]
        return reduce(lambda a, b: a & b, pairs, F.lit(True))

    numbers = [f"key{i}" for i in range(len(keys))]
    both = cur.join(old, equal(numbers), "full_outer")
    status = (
        F.when(F.col("_existing").isNull(), F.lit("new"))
        .when(F.col("_current").isNull(), F.lit("removed"))
        .when(equal(values), F.lit("unchanged"))
        .otherwise(F.lit("changed"))
    )
    return both.select(
        *[F.coalesce(f"current_{n}", f"existing_{n}").alias(k) for n, k in zip(numbers, keys, strict=True)],
        *[F.col(quoted(f"{side}_{v}")) for side in ("current", "existing") for v in values],
        status.alias("status"),
    )


def key_overlap(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every distinct key with the sides it occurs on (in_left, in_right), in one shuffle."""
    names = left.select(*map(quoted, keys))
    l, r = fresh("_l", names), fresh("_r", names)
    sides = [
        df.select(*map(quoted, keys), F.lit(i == 0).alias(l), F.lit(i == 1).alias(r))
        for i, df in enumerate((left, right))
    ]
    return (
        sides[0]
        .unionByName(sides[1])
        .groupBy(*map(quoted, keys))
        .agg(F.bool_or(l).alias("in_left"), F.bool_or(r).alias("in_right"))
    )


def key_intersect(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys both sides hold."""
    return left.select(*map(quoted, keys)).intersect(right.select(*map(quoted, keys)))


def overlap_counts(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many distinct keys are shared and how many each side leaves out."""
    sides = key_overlap(left, right, keys)
    return sides.agg(
        F.count_if(F.col("in_left") & F.col("in_right")).alias("shared"),
        F.count_if(~F.col("in_right")).alias("only_left"),
        F.count_if(~F.col("in_left")).alias("only_right"),
    )
