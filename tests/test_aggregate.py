from __future__ import annotations

import pytest
from conftest import rows_of

from tablelens.operators.aggregate import (
    Agg,
    agg_list,
    count_records,
    group_agg,
    pivot,
    scalar_agg,
    value_counts,
    with_total,
)
from tablelens.operators.calendar import resample, resample_filled
from tablelens.plans import analyze, describe


def test_spec_text_is_trimmed_and_case_blind():
    found = agg_list(" SUM:Amount , count:Region, Max:Amount ", ["Amount", "Region"])
    assert found == [Agg("sum", "Amount"), Agg("max", "Amount"), Agg("count", "Region")]


@pytest.mark.parametrize("spec", ["mode:Amount", "sum:Nope", "Amount"])
def test_bad_spec_is_refused(spec):
    with pytest.raises(ValueError):
        agg_list(spec, ["Amount"])


def test_grouped(invoices):
    out = group_agg(invoices, ["Technician"], "sum:Amount,count:Amount,median:Amount,std:Amount")
    got = {r["Technician"]: r.asDict() for r in out.collect()}
    assert got["Smith"]["Amount_sum"] == 900 and got["Smith"]["Amount_count"] == 3
    assert got["Smith"]["Amount_median"] == 300.0 and got["Smith"]["Amount_std"] == 200.0
    assert got["Jones"]["Amount_median"] == 300.0


def test_scalar_aggregates_are_one_row(invoices):
    out = scalar_agg(invoices, "sum:Amount,mean:Amount,median:Amount,nunique:Region,min:Amount")
    assert rows_of(out) == [(1500, 300.0, 300.0, 100, 2)]


def test_null_keys_drop_and_null_sums_are_zero(spark):
    df = spark.createDataFrame(
        [("a", None), ("a", None), (None, 5.0), ("b", 1.0)], "k string, v double"
    )
    out = group_agg(df, ["k"], "sum:v,count:v,mean:v,median:v,nunique:v,std:v")
    assert rows_of(out) == [("a", 0.0, 0, None, None, 0, None), ("b", 1.0, 1, 1.0, 1.0, 1, None)]


def test_scalar_over_no_rows(spark):
    df = spark.createDataFrame([], "v double")
    assert rows_of(scalar_agg(df, "sum:v,count:v,median:v")) == [(0.0, 0, None)]


def test_counts(invoices):
    assert [tuple(r) for r in value_counts(invoices, ["Region"]).collect()] == [("A", 3), ("B", 2)]
    assert rows_of(count_records(invoices, "Amount > 10000")) == [(0,)]
    assert {r[-1] for r in with_total(invoices).collect()} == {5}


def test_month_and_week_buckets(invoices):
    month = resample(invoices, "ServiceDate", "month", "sum:Amount")
    assert [(str(r.period_end), r.period_label, r.Amount_sum) for r in month.orderBy("period_end").collect()] == [
        ("2025-01-31", "2025-01", 700),
        ("2025-02-28", "2025-02", 300),
        ("2025-03-31", "2025-03", 500),
    ]
    week = resample(invoices, "ServiceDate", "week", "count:Amount").orderBy("period_start")
    first = week.first()
    # weeks run from Monday to Sunday
    assert (str(first.period_start), str(first.period_end)) == ("2025-01-06", "2025-01-12")


def test_empty_buckets_are_filled(spark):
    df = spark.sql(
        "select timestamp_ntz'2025-01-15' d, 100L a union all select timestamp_ntz'2025-03-05', 500L"
    )
    out = resample_filled(df, "d", "month", "sum:a,mean:a,count:a").orderBy("period_start")
    assert [(r.a_sum, r.a_mean, r.a_count) for r in out.collect()] == [
        (100, 100.0, 1),
        (0, None, 0),
        (500, 500.0, 1),
    ]


def test_period_needs_a_time_column(invoices):
    with pytest.raises(ValueError):
        resample(invoices, "Region", "month", "sum:Amount")
    with pytest.raises(ValueError):
        resample(invoices, "ServiceDate", "day", "sum:Amount")


def test_pivot_cells(spark):
    df = spark.createDataFrame(
        [("AR1", "A", 100), ("AR1", "A", 200), ("AR1", "B", 300), ("GR1", "A", 400), ("GR1", "B", 500), ("GR2", "A", 1)],
        "Technician string, Region string, Amount bigint",
    )
    out = pivot(df, ["Technician"], "Region", "sum:Amount,count:Amount")
    assert out.columns == ["Technician", "A", "B"]
    assert rows_of(out) == [("AR1", 300, 300), ("GR1", 400, 500), ("GR2", 1, 0)]
    counted = pivot(df, ["Technician"], "Region", "count:Amount", ["B"])
    assert rows_of(counted) == [("AR1", 1), ("GR1", 1), ("GR2", 0)]


def test_pivot_leaves_out_values_without_a_mean(spark):
    df = spark.createDataFrame(
        [("x", "A", 1.0), ("x", "B", None), ("y", "B", None), (None, "A", 2.0)],
        "k string, p string, v double",
    )
    out = pivot(df, ["k"], "p", "mean:v")
    assert out.columns == ["k", "A"] and rows_of(out) == [("x", 1.0)]


def test_too_many_pivot_values_come_as_rows(spark):
    df = spark.range(20).selectExpr("id % 2 as k", "id as p", "1 as v")
    assert pivot(df, ["k"], "p", "sum:v").columns[:2] == ["k", "0"]
    long = pivot(df, ["k"], "p", "sum:v", most_values=10)
    assert long.columns == ["k", "p", "v_sum"] and long.count() == 20


def test_nan_is_no_value(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", float("nan")), ("x", 4.0)], "k string, `v.w` double")
    out = group_agg(df, ["k"], "sum:v.w,count:v.w,max:v.w,median:v.w")
    assert rows_of(out) == [("x", 5.0, 2, 4.0, 2.5)]


def test_analyze_says_how_many_groups_there_are(spark):
    df = spark.range(300).selectExpr("id as k", "1 as v")
    assert analyze(df, "k", "sum:v").count() == 300
    limited = analyze(df, "k", "sum:v", limit=5).collect()
    assert len(limited) == 5 and {r.total_groups for r in limited} == {300}


def test_analyze_modes(invoices):
    sums = analyze(invoices, "Technician", "sum:Amount", sort="Amount_sum desc", limit=1)
    assert rows_of(sums) == [("Smith", 900, 2)]
    counts = analyze(invoices, "Region", where="Amount >= 200")
    assert [tuple(r) for r in counts.collect()] == [("A", 2), ("B", 2)]
    # a period goes before a pivot
    both = analyze(invoices, "ServiceDate", "sum:Amount", period="quarter", pivot_column="Region")
    assert [r["Amount_sum"] for r in both.collect()] == [1500]
    wide = analyze(invoices, "Technician", "sum:Amount", pivot_column="Region", limit=None)
    assert rows_of(wide) == [("Jones", 0, 600), ("Smith", 900, 0)]
    with pytest.raises(Exception):
        analyze(invoices, "Technician", "sum:Amount", sort="nope").collect()


def test_analyze_normalises_after_the_filter(spark):
    df = spark.createDataFrame(
        [("Jake", "CIN", 100.0), ("Jake", "CIN", 200.0), ("Jacob Owens", "DAY", 150.0), ("Mike", "DAY", 300.0)],
        "Technician string, Region string, Amount double",
    )
    maps = {"Technician": {"Jake": "Jacob Owens"}, "Region": {"CIN": "", "DAY": ""}}
    out = analyze(df, "Technician", "sum:Amount", value_maps=maps)
    assert rows_of(out) == [("Jacob Owens", 450.0), ("Mike", 300.0)]
    kept = analyze(df, "Technician", "sum:Amount", where="Technician = 'Jake'", value_maps=maps)
    assert rows_of(kept) == [("Jacob Owens", 300.0)]


def test_describe_covers_all_column_kinds(invoices):
    got = {r["column"]: r.asDict() for r in describe(invoices).collect()}
    assert got["Amount"]["mean"] == "300.0" and got["Amount"]["p25"] == "200.0"
    assert got["Technician"]["top"] == "Smith" and got["Technician"]["freq"] == "3"
    assert got["ServiceDate"]["max"] == "2025-03-15 00:00:00"
    assert got["ServiceDate"]["std"] is None


def test_describe_keeps_columns_without_values(spark):
    df = spark.createDataFrame([(None, None)], "t string, n double")
    got = {r["column"]: r["count"] for r in describe(df).collect()}
    assert got == {"t": "0", "n": "0"}
