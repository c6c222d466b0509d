"""Pages at any depth, the newest rows of any number, and periods around a table of anchors, against plain code."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tablelens.functions.periods import period_bounds
from tablelens.operators.anchored import period_compare_anchors
from tablelens.operators.paging import first_rows, keep_most_recent, page_at
from tablelens.operators.rank_index import RankIndex

SPEC = "a desc,`b.x`,id".replace("`", "")


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(8)
    rows = [(rng.choice([None, 1.5, 2.0, float("nan"), rng.random()]), rng.choice([None, "", "é", "z", "Z"]), i) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "a double, `b.x` string, id long").repartition(5).cache()


def ordered(rows):
    def key(r):
        a = float("inf") if r[0] is not None and r[0] != r[0] else r[0]
        return (a is None, 0 if a is None else -a, r[1] is None, (r[1] or "").encode(), r[2])

    return [r[2] for r in sorted(rows, key=key)]


@pytest.mark.parametrize("skip, top", [(0, 5), (1499, 40), (2995, 40), (990, 700), (5000, 3)])
def test_page_at_any_depth(table, skip, top):
    rows, df = table
    page = page_at(df, SPEC, top, skip, range_rows=100)
    assert [r.id for r in page.collect()] == ordered(rows)[skip : skip + top]
    assert all(r.total == 3000 for r in page.collect())


def test_a_range_is_small_and_counted_right(table):
    rows, df = table
    index = RankIndex(df, SPEC, 100)
    order = ordered(rows)
    for place in (0, 1, 777, 1500, 2999):
        at = index.range_of(place)
        held = {r.id for r in index.within(at.low, at.high).collect()}
        assert len(held) == at.rows <= 100 and held == set(order[at.before : at.before + at.rows]) and order[place] in held


def test_the_sort_of_a_page_sees_only_its_range(table):
    _, df = table
    page = page_at(df, SPEC, 10, 1500, range_rows=100)
    found = page._jdf.queryExecution().optimizedPlan().toString()
    offset = int(found.split("Offset ")[1].split("\n")[0])
    assert offset < 100


def test_first_rows_of_any_number(table):
    rows, df = table
    order = ordered(rows)
    for n in (0, 50, 101, 1700, 2999, 3000, 9000):
        assert sorted(r.id for r in first_rows(df, SPEC, n, 100).collect()) == sorted(order[:n])
    # rows that are equal in all sort columns: any of them, but so many
    assert first_rows(df.withColumn("same", F.lit(1)), "same", 1234, 100).count() == 1234


def test_newest_rows_by_arrival_day_and_without_a_date(spark):
    rows = [(i, None if i % 7 == 0 else dt.datetime(2025, 1, 1 + i % 3, i % 24)) for i in range(600)]
    df = spark.createDataFrame(rows, "pk long, day timestamp_ntz")
    newest = sorted(rows, key=lambda r: (r[1] is None, -(r[1] - dt.datetime(2020, 1, 1)).total_seconds() if r[1] else 0, r[0]))
    for n in (1, 150, 400, 550, 600, 601):
        got = sorted(r.pk for r in keep_most_recent(df, n, "day", ["pk"], 20).collect())
        assert got == sorted(r[0] for r in newest[:n])
        assert sorted(r.pk for r in keep_most_recent(df, n, None, ["pk"], 20).collect()) == list(range(max(0, 600 - n), 600))
    assert keep_most_recent(df.limit(0), 5, "day", ["pk"]).collect() == []


def test_periods_around_anchors(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2]), dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(500)), rng.choice([None, 1, 2, 9, -4])) for _ in range(400)]
    df = spark.createDataFrame(rows, "`k.x` string, k2 int, day date, v int")
    marks = [("a", 1, dt.date(2025, 2, 28)), ("a", 1, dt.date(2025, 2, 28)), ("a", 1, dt.date(2024, 2, 29)), ("b", 2, dt.date(2025, 5, 31)), ("c", 1, dt.date(2025, 1, 1)), ("b", 2, None), (None, 1, dt.date(2025, 1, 1))]
    anchors = spark.createDataFrame(marks, "`k.x` string, k2 int, at date").withColumn("extra", F.lit(1))
    found = period_compare_anchors(df, "day", anchors, "at", "sum:v,count:v,mean:v,min:v,max:v", ["k.x", "k2"])
    bounds = period_bounds(anchors.where("`k.x` is not null and at is not null").distinct(), "at").collect()
    want = set()
    for b in bounds:
        inside = [r[3] for r in rows if r[0] == b["k.x"] and r[1] == b.k2 and b.start <= r[2] <= b.end and r[3] is not None]
        mean = sum(inside) / len(inside) if inside else None
        want.add((b["k.x"], b.k2, b["at"], b.pattern, b.label, b.start, b.end, sum(inside), len(inside), mean, min(inside, default=None), max(inside, default=None)))
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(want) == 4 * 23 and set(got) == want
    few = period_compare_anchors(df, "day", anchors, "at", "sum:v", ["k.x", "k2"], ["mtd", "mom"])
    assert few.count() == 4 * 3 and few.columns == ["k.x", "k2", "at", "pattern", "label", "start", "end", "v_sum"]
    assert period_compare_anchors(df.limit(0), "day", anchors, "at", "count:v,max:v", ["k.x", "k2"]).where("v_count <> 0 or v_max is not null").isEmpty()


def test_no_range_join(spark):
    df = spark.createDataFrame([("a", dt.date(2025, 1, 1), 1)], "k string, day date, v int")
    plan = period_compare_anchors(df, "day", df, "day", "sum:v,max:v", ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
    with pytest.raises(ValueError):
        period_compare_anchors(df, "day", df, "day", "median:v", ["k"])


def test_empty_tables(spark, table):
    _, df = table
    assert rows_of(page_at(df.limit(0), SPEC, 5, 0)) == []
    assert rows_of(page_at(df, SPEC, 0, 10, range_rows=100)) == []
