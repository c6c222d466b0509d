"""Calendar report periods as Column expressions over an anchor date.

The anchor may be a column or a literal. A literal makes every bound foldable,
so Catalyst turns period predicates into constants that reach the file scan.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Period:
    pattern: str
    label: str
    start: Column
    end: Column

    def holds(self, date: Column) -> Column:
        return within(date, self.start, self.end)


def as_date(anchor: Column | str | dt.date) -> Column:
    if isinstance(anchor, str):
        anchor = dt.date.fromisoformat(anchor)
    return anchor if isinstance(anchor, Column) else F.lit(anchor)


def within(date: Column, start: Column, end: Column) -> Column:
    """Day-grain closed range, written half-open so the date column stays bare."""
    return (date >= start) & (date < F.date_add(end, 1))


def period_predicate(date: Column, start: str | dt.date, end: str | dt.date) -> Column:
    return within(date, as_date(start), as_date(end))


def period_filter_text(field: Column | str, start: Column, end: Column) -> Column:
    """The predicate as text: one day uses eq, a longer period ge ... and ... le."""
    name = F.lit(field) if isinstance(field, str) else field
    first, last = start.cast("string"), end.cast("string")
    one = F.concat_ws(" ", name, F.lit("eq"), first)
    many = F.concat_ws(
        " ", name, F.lit("ge"), first, F.lit("and"), name, F.lit("le"), last
    )
    return F.when(start == end, one).otherwise(many)


def all_periods(anchor: Column | str | dt.date) -> list[Period]:
    """The 23 periods: 7 single ones and 8 patterns with a current and a previous range."""
    d = as_date(anchor)
    week = F.to_date(F.date_trunc("week", d))
    month, quarter, year = F.trunc(d, "month"), F.trunc(d, "quarter"), F.trunc(d, "year")
    last_month, last_quarter = F.add_months(month, -1), F.add_months(quarter, -3)
    day_before, year_ago = F.date_sub(d, 1), F.add_months(d, -12)

    singles = [
        ("daily", d, d),
        ("yesterday", day_before, day_before),
        ("wtd", week, d),
        ("mtd", month, d),
        ("full_month", month, F.last_day(d)),
        ("qtd", quarter, d),
        ("ytd", year, d),
    ]
    # add_months keeps the day of the month and stops at the month's end, which
    # is the capping rule; only the quarter offset runs on by days, uncapped
    pairs = [
        ("dod", (d, d), (day_before, day_before)),
        ("wow", (week, d), (F.date_sub(week, 7), F.date_sub(d, 7))),
        ("mom", (month, F.last_day(d)), (last_month, F.last_day(last_month))),
        ("cmtd_vs_pmtd", (month, d), (last_month, F.add_months(d, -1))),
        ("mtd_cy_vs_py", (month, d), (F.add_months(month, -12), year_ago)),
        ("ytd_cy_vs_py", (year, d), (F.add_months(year, -12), year_ago)),
        (
            "qtd_cq_vs_pq",
            (quarter, d),
            (last_quarter, F.date_add(last_quarter, F.date_diff(d, quarter))),
        ),
        ("qtd_cq_vs_pq_py", (quarter, d), (F.add_months(quarter, -12), year_ago)),
    ]
    out = [Period(name, "single", start, end) for name, start, end in singles]
    for name, current, previous in pairs:
        out.append(Period(name, "current", *current))
        out.append(Period(name, "previous", *previous))
    return out


def period_bounds(df: DataFrame, anchor: str) -> DataFrame:
    """23 rows (pattern, label, start, end) for every row of `df`, from its anchor date."""
    rows = [
        F.struct(
            F.lit(p.pattern).alias("pattern"),
            F.lit(p.label).alias("label"),
            p.start.alias("start"),
            p.end.alias("end"),
        )
        for p in all_periods(F.to_date(df[anchor]))
    ]
    return df.select("*", F.inline(F.array(*rows)))
