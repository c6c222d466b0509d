"""Rows by their place in a total order, without passing those before them through one task.

A range of the order is cut at some of its own rows, chosen from a bounded
sample; rows per part are counted by partial aggregation, and the part that
holds the wanted place is cut again until it is small. Each pass is one scan
that sends a count per part and task. Cuts balance the parts; whatever they
are, the counted part is also the one that is read, so they decide nothing.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.projection import names_of, quoted

#: Rows that are sorted at most (more only where they are equal in all sort columns), parts of a pass, rows sampled for them.
RANGE_ROWS, PARTS, SAMPLE = 100_000, 64, 4_000

Cut = tuple[str | None, ...]


def sort_clauses(spec: str | Iterable[str]) -> list[tuple[str, bool]]:
    """(column, descending) of "A asc,B desc"; no direction means asc."""
    out = []
    for clause in names_of(spec):
        name, _, direction = clause.rpartition(" ")
        if direction.lower() not in ("asc", "desc"):
            name, direction = clause, "asc"
        out.append((name.strip(), direction.lower() == "desc"))
    return out


def comes_after(df: DataFrame, clauses: list[tuple[str, bool]], values: Iterable[object]) -> Column:
    """Whether a row comes after the given sort values; NaN is the largest number, and null, None here, is last."""
    after, equal = F.lit(False), F.lit(True)
    for (name, down), value in zip(clauses, values, strict=True):
        col = df[quoted(name)]
        if value is None:  # nothing comes after null
            equal = equal & col.isNull()
            continue
        if isinstance(value, float) and value != value:  # statistics of files and caches know no NaN
            is_nan = F.coalesce(F.isnan(col), F.lit(False))
            beyond, same = (~is_nan if down else F.lit(False)), is_nan
        else:
            beyond, same = (col < value if down else col > value), col.eqNullSafe(value)
        after = after | (equal & (col.isNull() | beyond))
        equal = equal & same
    return after


@dataclass(frozen=True)
class Range:
    """The rows after `low` up to and with `high`: how many come before, and how many there are."""

    low: Cut | None
    high: Cut | None
    before: int
    rows: int


class RankIndex:
    """The order of `df` by a sort spec, with nulls last."""

    def __init__(self, df: DataFrame, spec: str | Iterable[str], range_rows: int = RANGE_ROWS) -> None:
        self.df, self.clauses, self.range_rows = df, sort_clauses(spec), range_rows
        self.total = df.count()

    def after(self, cut: Cut) -> Column:
        types = [self.df.schema[name].dataType for name, _ in self.clauses]

        def value(text: str | None, of: T.DataType) -> object:
            if text == "NaN" and isinstance(of, (T.DoubleType, T.FloatType)):
                return float("nan")
            return None if text is None else F.lit(text).cast(of)

        return comes_after(self.df, self.clauses, [value(v, t) for v, t in zip(cut, types, strict=True)])

    def within(self, low: Cut | None, high: Cut | None) -> DataFrame:
        rows = self.df if low is None else self.df.where(self.after(low))
        return rows if high is None else rows.where(~self.after(high))

    def range_of(self, place: int) -> Range:
        """A range of at most `range_rows` rows that holds the row at zero-based `place`."""
        at = Range(None, None, 0, self.total)
        while at.rows > self.range_rows:
            cuts = self._cuts(at)
            counts = dict(self.within(at.low, at.high).groupBy(self._part(cuts).alias("part")).count().collect())
            bounds, before = [at.low, *cuts, at.high], at.before
            for part in range(len(cuts) + 1):
                rows = counts.get(part, 0)
                if place < before + rows:
                    break
                before += rows
            if rows == at.rows:
                return at  # equal in all sort columns, or the sample had no other row
            at = Range(bounds[part], bounds[part + 1], before, rows)
        return at

    def _cuts(self, at: Range) -> list[Cut]:
        """Sort values of some rows of a range, in order and all different, as text."""
        names = [quoted(name) for name, _ in self.clauses]
        rows = self.within(at.low, at.high).select(*names)
        some = rows.sample(min(1.0, SAMPLE / at.rows), seed=at.rows).limit(2 * SAMPLE)
        order = [F.desc_nulls_last(c) if down else F.asc_nulls_last(c) for c, (_, down) in zip(names, self.clauses, strict=True)]
        found = [tuple(r) for r in some.distinct().orderBy(*order).select(*[F.col(c).cast("string") for c in names]).collect()]
        step = max(1, len(found) // PARTS)
        return [c for c in found[step - 1 :: step] if c != at.high][: 2 * PARTS]

    def _part(self, cuts: list[Cut]) -> Column:
        """How many of the cuts a row comes after, by halving."""

        def tree(first: int, last: int) -> Column:
            if first == last:
                return F.lit(first)
            middle = (first + last) // 2
            return F.when(self.after(cuts[middle]), tree(middle + 1, last)).otherwise(tree(first, middle))

        return tree(0, len(cuts))
