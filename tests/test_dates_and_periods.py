from __future__ import annotations

import calendar
import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablelens.functions.dates import (
    date_bounds,
    epoch_micros,
    from_epoch_micros,
    normalize_dates,
    parse_timestamp,
)
from tablelens.functions.periods import all_periods, period_bounds, period_filter_text
from tablelens.operators.calendar import period_compare

DAYS = st.dates(dt.date(1970, 1, 1), dt.date(2099, 12, 31))
#: Ways to write a day in a filter text; all mean that day.
SPELLINGS = [
    lambda d: d.isoformat(),
    lambda d: f"'{d}'",
    lambda d: f'"{d}T{d.month:02d}:{d.day:02d}"',
    lambda d: f"{d}T23:59:{d.day:02d}",
    lambda d: f"{d}T00:00:00.5{d.day}Z",
    lambda d: f"{d}T08:30:00-0{d.day % 9}:30",
    lambda d: f"{d.month}/{d.day}/{d.year}",
    lambda d: f"{d.month:02d}/{d.day:02d}/{d.year}",
    lambda d: f"'{d.month}/{d.day:02d}/{d.year}'",
    lambda d: f"{d.month}/{d.day}/{d.year} {d.day % 12}:07:09 PM",
    lambda d: f'"{d.month}/{d.day}/{d.year}  11:00:00"',
]
AROUND = ["", "x", " and ", "Town eq 'Rome' or ", " é ", "(", ") "]


def test_literals_are_normalised(spark):
    part = st.tuples(st.sampled_from(AROUND), DAYS, st.sampled_from(SPELLINGS))

    @settings(max_examples=3, deadline=None)
    @given(st.lists(st.tuples(st.lists(part, max_size=3), st.sampled_from(AROUND)), min_size=60, max_size=80))
    def check(cases):
        rows = []
        for parts, end in cases:
            raw = "".join(f"{text} Day ge {spell(d)}" for text, d, spell in parts) + " " + end
            want = "".join(f"{text} Day ge {d}" for text, d, _ in parts) + " " + end
            rows.append((raw, want))
        df = spark.createDataFrame([*rows, (None, None), ("", "")], "raw string, want string")
        for raw, got, want in df.select("raw", normalize_dates(F.col("raw")), "want").collect():
            assert got == want, raw

    check()


def test_bounds_of_a_filter(spark):
    """Comparisons of the field and of others in any order; the last one on a side counts."""
    part = st.tuples(st.sampled_from(["Due", '"Due"', "OverDue", "Due2"]), st.sampled_from(["ge", "gt", "le", "lt", "eq", "ne"]), DAYS)

    @settings(max_examples=3, deadline=None)
    @given(st.lists(st.lists(part, max_size=4), min_size=60, max_size=80))
    def check(cases):
        rows = []
        for i, parts in enumerate(cases):
            low = high = None
            for name, op, d in parts:
                if name.strip('"') == "Due":
                    low = d if op in ("ge", "gt", "eq") else low
                    high = d if op in ("le", "lt", "eq") else high
            rows.append((i, " and ".join(f"{n} {op} {d}" for n, op, d in parts), low, high))
        df = spark.createDataFrame(rows, "i int, f string, lo date, hi date")
        for r in df.select("f", date_bounds(F.col("f"), "Due").alias("b"), "lo", "hi").collect():
            assert (r.b.min, r.b.max) == (r.lo, r.hi), r.f

    check()


def test_bounds_of_a_name_with_spaces_and_signs(spark):
    df = spark.createDataFrame([('"Ship Day (UTC)" ge 2025-01-01',)], "f string")
    found = df.select(date_bounds(F.col("f"), "Ship Day (UTC)")["min"].alias("m")).first().m
    assert found == dt.date(2025, 1, 1)


def test_mixed_formats_parse(spark):
    texts = [
        ("2025-01-15", "2025-01-15 00:00:00"),
        ("2025-01-15T14:30:00", "2025-01-15 14:30:00"),
        ("2025-01-15T14:30:00.250", "2025-01-15 14:30:00.25"),
        ("2025-01-15T14:30:00Z", "2025-01-15 14:30:00"),
        ("2025-01-15T14:30:00+02:00", "2025-01-15 12:30:00"),
        ("2025-01-15 14:30:00", "2025-01-15 14:30:00"),
        ("1/5/2025", "2025-01-05 00:00:00"),
        ("1/5/2025 3:04:05 PM", "2025-01-05 15:04:05"),
        ("2025/01/05", "2025-01-05 00:00:00"),
        ("2025-01-05T10:15", "2025-01-05 10:15:00"),
        ("2025-01-05 10:15", "2025-01-05 10:15:00"),
        ("Jan 5, 2025", "2025-01-05 00:00:00"),
        ("5 Jan 2025", "2025-01-05 00:00:00"),
        ("20250105", "2025-01-05 00:00:00"),
        ("2025-01-05T10:15:00+0100", "2025-01-05 09:15:00"),
        ("1/5/2025 10:15", "2025-01-05 10:15:00"),
        ("1/5/25", "2025-01-05 00:00:00"),
        ("2025-01-05 10:15:00+00:00", "2025-01-05 10:15:00"),
        ("January 5, 2025", "2025-01-05 00:00:00"),
        ("May 5 2025", "2025-05-05 00:00:00"),
        ("May 5, 2025 1:05 PM", "2025-05-05 13:05:00"),
        ("Jan 5 2025", "2025-01-05 00:00:00"),
        ("5 January 2025", "2025-01-05 00:00:00"),
        ("05-Jan-2025", "2025-01-05 00:00:00"),
        ("5-JAN-2025", "2025-01-05 00:00:00"),
        ("1/5/25 10:15", "2025-01-05 10:15:00"),
        ("1/5/70 10:15", "1970-01-05 10:15:00"),
        ("1/5/2025 10:15 AM", "2025-01-05 10:15:00"),
        ("2025/01/05 10:15", "2025-01-05 10:15:00"),
        ("2025-1-5", "2025-01-05 00:00:00"),
        ("2025.01.05", "2025-01-05 00:00:00"),
        ("Jan 5, 2025 10:15", "2025-01-05 10:15:00"),
        ("2025-01-05T10:15:30.123456789", "2025-01-05 10:15:30.123456"),
        ("soon", None),
        ("Janus 5, 2025", None),
        ("2025-02-30", None),
        (None, None),
    ]
    df = spark.createDataFrame(texts, "t string, want string")
    for got, want in df.select(parse_timestamp(F.col("t")).cast("string"), "want").collect():
        assert got == want


def test_micros_round_trip(spark):
    times = ["1969-12-31 23:59:59.999999", "2024-02-29 12:34:56.000001", "2024-01-01 00:00:00"]
    df = spark.createDataFrame([(t,) for t in times], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("t")
    )
    same = df.select((from_epoch_micros(epoch_micros(F.col("t"))) == F.col("t")).alias("same"))
    assert all(r.same for r in same.collect())


def back_one_month(day: dt.date, months: int) -> dt.date:
    """The same day of an earlier month, or that month's last day."""
    index = day.year * 12 + day.month - 1 - months
    year, month = divmod(index, 12)
    last = calendar.monthrange(year, month + 1)[1]
    return dt.date(year, month + 1, min(day.day, last))


def test_bounds_for_every_day_of_four_years(spark):
    days = spark.sql(
        "select explode(sequence(date'2023-01-01', date'2026-12-31', interval 1 day)) as d"
    )
    got = {
        (r.d, r.pattern, r.label): (r.start, r.end) for r in period_bounds(days, "d").collect()
    }
    assert len(got) == 1461 * 23
    one = dt.timedelta(days=1)
    for d in {key[0] for key in got}:
        monday = d - one * d.weekday()
        month, year = d.replace(day=1), d.replace(month=1, day=1)
        quarter = dt.date(d.year, (d.month - 1) // 3 * 3 + 1, 1)
        last_quarter = back_one_month(quarter, 3)
        month_end = d.replace(day=calendar.monthrange(d.year, d.month)[1])
        year_ago = back_one_month(d, 12)
        for (pattern, label), want in {
            ("daily", "single"): (d, d),
            ("yesterday", "single"): (d - one, d - one),
            ("wtd", "single"): (monday, d),
            ("mtd", "single"): (month, d),
            ("full_month", "single"): (month, month_end),
            ("qtd", "single"): (quarter, d),
            ("ytd", "single"): (year, d),
            ("dod", "previous"): (d - one, d - one),
            ("wow", "previous"): (monday - 7 * one, d - 7 * one),
            ("mom", "previous"): (back_one_month(month, 1), month - one),
            ("cmtd_vs_pmtd", "previous"): (back_one_month(month, 1), back_one_month(d, 1)),
            ("mtd_cy_vs_py", "previous"): (back_one_month(month, 12), year_ago),
            ("ytd_cy_vs_py", "previous"): (back_one_month(year, 12), year_ago),
            ("qtd_cq_vs_pq", "previous"): (last_quarter, last_quarter + (d - quarter)),
            ("qtd_cq_vs_pq_py", "previous"): (back_one_month(quarter, 12), year_ago),
        }.items():
            assert got[d, pattern, label] == want, (d, pattern)


def test_filter_text(spark):
    df = spark.sql("select date'2026-02-01' s, date'2026-02-20' e union all select date'2026-02-20', date'2026-02-20'")
    got = df.select(period_filter_text("Day", F.col("s"), F.col("e"))).collect()
    assert [r[0] for r in got] == ["Day ge 2026-02-01 and Day le 2026-02-20", "Day eq 2026-02-20"]


@pytest.mark.parametrize("spec", ["sum:v,count:v,min:v,max:v,mean:v,std:v", "median:v,nunique:v,sum:v"])
def test_compare_equals_one_filter_per_period(spark, spec):
    df = spark.sql(
        "select timestamp_ntz'2024-12-01' + make_dt_interval(cast(id / 4 as int), cast(id % 24 as int)) as t,"
        " cast(id % 97 as double) as v, if(id % 3 = 0, 'x', 'y') as k from range(2200)"
    )
    got = {
        (r.k, r.pattern, r.label): r.asDict()
        for r in period_compare(df, "t", "2026-03-31", spec, ["k"]).collect()
    }
    pdf = df.toPandas()
    for p in all_periods("2026-03-31"):
        start, end = spark.range(1).select(p.start, p.end).first()
        inside = pdf[(pdf["t"].dt.date >= start) & (pdf["t"].dt.date <= end)]
        for key, group in inside.groupby("k"):
            row = got[key, p.pattern, p.label]
            for func in [s.split(":")[0] for s in spec.split(",")]:
                want = getattr(group["v"], func)()
                found = float("nan") if row[f"v_{func}"] is None else row[f"v_{func}"]
                assert found == pytest.approx(want, nan_ok=True), (p.pattern, p.label, func)


def test_compare_reads_only_the_days_it_needs(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    out = period_compare(orders, "o_orderdate", "2000-05-31", "sum:o_totalprice")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1999-01-01T00:00)" in plan
    assert "Join" not in plan


def test_every_period_has_a_row_for_any_function(spark):
    df = spark.sql("select timestamp'2025-03-10 10:00:00' as t, 4.0D as v")
    plain = period_compare(df, "t", "2025-03-10", "sum:v")
    both = period_compare(df, "t", "2025-03-10", "sum:v,nunique:v,median:v")
    rows = {(r.pattern, r.label): r for r in both.collect()}
    assert len(rows) == plain.count() == 23
    for r in plain.collect():
        other = rows[r.pattern, r.label]
        assert (other.start, other.end, other.v_sum) == (r.start, r.end, r.v_sum)
        assert other.v_nunique == (1 if r.v_sum else 0) and (other.v_median is None) == (r.v_sum == 0)
