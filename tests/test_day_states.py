"""States of days kept with a stored table against the aggregation of all its rows."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tablelens.operators.calendar import resample
from tablelens.operators.day_states import DayStates, day_states, periods_of_states
from tablelens.operators.incremental import merge_stored, read_months, remove_old_versions, resample_stored

AGGS = "sum:v,count:v,mean:v,min:v,max:v,count:name,min:name"
STATES = DayStates(["v", "name"], ["g.h"])


def events(spark, n=4000):
    rows = spark.range(n).select(F.col("id").alias("pk"), F.expr("date_add(date'2024-01-01', int(id % 90))").alias("day"), F.lit(0).alias("seq"))
    value = F.expr("case when pk % 7 = 0 then null else int(pk % 1000) end")
    group = F.expr("case pk % 3 when 0 then 'a' when 1 then 'b' end")
    return rows.withColumns({"v": value, "name": F.concat(F.lit("n"), F.col("pk")), "g.h": group})


def check(spark, path, periods=("week", "month", "quarter")):
    rows = read_months(spark, path)
    for period in periods:
        assert rows_of(resample_stored(spark, path, period, AGGS)) == rows_of(resample(rows, "day", period, AGGS, ["g.h"]))


def merge(spark, path, rows, **more):
    return merge_stored(spark, path, rows, ["pk"], ["seq"], "day", **{"states": STATES} | more)


@pytest.mark.parametrize("indexed", [False, True])
def test_a_refresh_computes_touched_days_only(spark, tmp_path, indexed):
    path, first = str(tmp_path / "t"), events(spark)
    report = merge(spark, path, first, key_index=indexed)
    assert report["computed"] == {"months": ["2024-01", "2024-02", "2024-03"], "days": []}
    check(spark, path)
    # three keys of one day go to another day of a month that is there, a new row goes to a new month
    moved = first.where("pk in (5, 95, 185)").withColumns({"day": F.lit(dt.date(2024, 2, 20)), "v": F.lit(-1), "seq": F.lit(1)})
    new = moved.limit(1).withColumns({"pk": F.lit(10**9).cast("long"), "day": F.lit(dt.date(2024, 7, 1))})
    report = merge(spark, path, moved.unionByName(new), key_index=indexed)
    assert report["computed"] == {"months": ["2024-07"], "days": ["2024-01-06", "2024-02-20"]}
    check(spark, path)
    # the same again: the keys are held on the new days alone
    assert merge(spark, path, moved, key_index=indexed)["computed"] == {"months": [], "days": ["2024-02-20"]}
    assert merge(spark, path, moved.limit(0), key_index=indexed)["computed"] == {"months": [], "days": []}
    check(spark, path, ["month"])


def test_days_within_a_month_where_months_stay(spark, tmp_path):
    path, first = str(tmp_path / "t"), events(spark, 900)
    merge(spark, path, first)
    moved = first.where("pk = 3").withColumns({"day": F.lit(dt.date(2024, 1, 30)), "seq": F.lit(1)})
    report = merge(spark, path, moved, dates_move=False)
    assert report["searched"] == ["2024-01"] and report["computed"]["days"] == ["2024-01-04", "2024-01-30"]
    check(spark, path)


def test_merges_without_states_caps_other_states_and_old_versions(spark, tmp_path):
    path, first = str(tmp_path / "t"), events(spark, 900)
    with pytest.raises(ValueError, match="never merged with states"):
        resample_stored(spark, path, "month", "sum:v")
    merge(spark, path, first)
    late = first.where("pk = 40").withColumns({"v": F.lit(5000), "seq": F.lit(1)})
    merge(spark, path, late, states=None)  # its month has no states now and is read from its rows
    check(spark, path, ["month"])
    undated = late.withColumns({"pk": F.lit(-1).cast("long"), "day": F.lit(None).cast("date")})
    assert merge(spark, path, undated)["computed"] == {"months": ["2024-02"], "days": []}
    check(spark, path, ["month"])
    # the cap cuts January: its states are those of what is left
    assert merge(spark, path, late.withColumn("seq", F.lit(2)), most=650)["computed"] == {"months": ["2024-01"], "days": ["2024-02-10"]}
    assert read_months(spark, path).count() == 650
    check(spark, path)
    fewer = DayStates(["v"])
    assert merge(spark, path, late.limit(0), states=fewer)["computed"]["months"] == ["2024-01", "2024-02", "2024-03"]
    assert len(remove_old_versions(spark, path, keep=1, older_than=-60)) > 5
    want = resample(read_months(spark, path), "day", "quarter", "mean:v,sum:v")
    assert rows_of(resample_stored(spark, path, "quarter", "mean:v,sum:v")) == rows_of(want)


def test_defined_cases(spark):
    df = spark.createDataFrame([("x", dt.date(2025, 1, 1), float("nan")), ("x", None, 1.0), (None, dt.date(2025, 1, 1), 2.0)], "k string, day date, v double")
    got = periods_of_states(day_states(df, "day", DayStates(["v"], ["k"])), DayStates(["v"], ["k"]), "month", "sum:v,mean:v,max:v")
    assert rows_of(got) == rows_of(resample(df, "day", "month", "sum:v,mean:v,max:v", ["k"]))
    with pytest.raises(ValueError, match="does not merge over days"):
        periods_of_states(day_states(df, "day", DayStates(["v"])), DayStates(["v"]), "month", "median:v")
    empty = day_states(df.limit(0), "day", DayStates(["v"]))
    assert periods_of_states(empty, DayStates(["v"]), "week", "sum:v").collect() == []
