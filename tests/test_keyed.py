from __future__ import annotations

import datetime as dt

import pytest
from conftest import FOLDER, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablelens.operators import incremental, joins
from tablelens.operators.incremental import (
    covered_ranges,
    date_gaps,
    incremental_merge,
    merge_stored,
    read_months,
    refresh_day,
    refresh_range,
    replace_range,
    touches_day,
    widened,
)
from tablelens.operators.keyed import (
    dedup_keep_last,
    grouped_concat,
    insert_if_absent,
    key_intersect,
    keyed_delete,
    keyed_upsert,
    overlap_counts,
    snapshot_diff,
    union_by_name,
)

ROW = "pk bigint, day date, amount bigint, seq int"


def frame(spark, *rows, schema=ROW):
    return spark.createDataFrame(list(rows), schema)


def day(text):
    return dt.date.fromisoformat(text)


def test_upsert_replaces_adds_and_lets_the_last_win(spark):
    held = frame(spark, (1, day("2025-01-01"), 100, 0), (2, day("2025-02-01"), 200, 0), (None, None, 1, 0))
    new = frame(spark, (2, day("2025-02-01"), 250, 1), (2, day("2025-02-02"), 260, 2), (3, day("2025-03-31"), 300, 1), (None, None, 2, 1))
    out = keyed_upsert(held, new, ["pk"], ["seq"])
    assert sorted((r.pk or 0, r.amount) for r in out.collect()) == [(0, 2), (1, 100), (2, 260), (3, 300)]


def test_upsert_aligns_columns_by_name(spark):
    held = spark.createDataFrame([(1, "a")], "k int, t string")
    new = spark.createDataFrame([(7, 1, 0)], "extra int, k int, seq int")
    out = keyed_upsert(held, new, ["k"], ["seq"])
    assert out.columns == ["k", "t", "extra", "seq"] and rows_of(out) == [(1, None, 7, 0)]


def test_dedup_keeps_all_rows_without_the_key(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "a int, seq int")
    assert dedup_keep_last(df, ["pk"], ["seq"]).count() == 2
    assert rows_of(dedup_keep_last(df, ["a"], ["seq"])) == [(1, 2)]


def test_dedup_ranks_before_the_shuffle(spark):
    df = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    plan = dedup_keep_last(df, ["l_orderkey"], ["l_shipdate"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


STORE = "table_name string, field string, kind string, context string, seq int"


def test_delete_by_key_and_by_prefix(spark):
    store = frame(
        spark,
        ("T", "f", "values", "a", 1), ("T", "f", "map", "b", 1), ("T", "g", "values", "c", 1), ("T", "g", "map", "d", 1),
        schema=STORE,
    )
    gone = spark.createDataFrame([("T", "f", ""), ("T", "g", "map")], "table_name string, field string, kind string")
    left = keyed_delete(store, gone, ["table_name", "field"], optional="kind")
    assert [r.context for r in left.collect()] == ["c"]
    only = gone.where("field = 'g'").drop("kind")
    assert sorted(r.context for r in keyed_delete(store, only, ["table_name", "field"]).collect()) == ["a", "b"]


def test_lookups_take_one_row_per_key(spark):
    # zero and null each hold a third of the rows
    df = spark.range(300).selectExpr("case id % 3 when 0 then 0 when 1 then null else id end as k", "id as v")
    lookup = spark.range(200).selectExpr("id as k", "concat('n', id) as name", "map('a', id) as m", "1 as seq")
    twice = lookup.union(lookup.selectExpr("k", "'old'", "m", "0"))
    for many in (lookup, twice):
        out = joins.lookup_join(df, many, ["k"], ["seq"])
        got = {r.v: r.name for r in out.collect()}
        assert len(got) == out.count() == 300 and got[0] == got[3] == "n0" and got[1] is None and got[5] == "n5"


def test_concat_takes_the_last_text_of_each_kind(spark):
    store = frame(
        spark,
        ("T", "f", "values", "old", 1), ("T", "f", "values", "A, B", 2), ("T", "f", "hint", "dates only", 1), ("T", "g", "hint", "x", 1),
        schema=STORE,
    )
    out = grouped_concat(store, ["table_name", "field"], "kind", "context", ["seq"])
    assert rows_of(out) == [("T", "f", "dates only; A, B"), ("T", "g", "x")]


def test_sets(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int")
    assert rows_of(insert_if_absent(old, new, ["k"])) == [("a", 1), ("b", 2), ("c", 3)]
    assert rows_of(key_intersect(old, new, ["k"])) == [("b",)]
    assert rows_of(overlap_counts(old, new, ["k"])) == [(1, 1, 1)]
    assert union_by_name(old, new.drop("v")).where("v is null").count() == 2


def test_diff(spark):
    cur = spark.createDataFrame([("T", "a", "key"), ("T", "b", "stored"), ("T", "c", None), ("T", "e", None)], "t string, f string, class string")
    old = spark.createDataFrame([("T", "b", "key"), ("T", "c", None), ("T", "d", "key"), ("T", "e", "key")], "t string, f string, class string")
    got = {r.f: r.status for r in snapshot_diff(cur, old, ["t", "f"], ["class"]).collect()}
    assert got == {"a": "new", "b": "changed", "c": "unchanged", "d": "removed", "e": "changed"}


GAP_COLUMNS = "id int, held_min date, held_max date, wanted_min date, wanted_max date"


def gaps_of(spark, cases):
    to_day = lambda v: None if v is None else v if isinstance(v, dt.date) else day(v)
    df = spark.createDataFrame([(i, *map(to_day, case)) for i, case in enumerate(cases)], GAP_COLUMNS)
    found = {i: [] for i in range(len(cases))}
    for r in date_gaps(df).collect():
        found[r.id].append((r.gap_min, r.gap_max))
    return found


def test_gaps_complete_and_do_not_overlap_what_is_held(spark):
    """Over a short calendar that stands for all days: open ends reach its edges."""
    start = day("2030-06-01")
    offset = st.integers(3, 20)
    held = st.one_of(st.none(), st.tuples(offset, offset).map(sorted))
    wanted = st.tuples(st.one_of(st.none(), offset), st.one_of(st.none(), offset))

    def on(n):
        return None if n is None else start + dt.timedelta(n)

    def days(low, high):
        return {n for n in range(24) if (low is None or on(n) >= low) and (high is None or on(n) <= high)}

    @settings(max_examples=4, deadline=None)
    @given(st.lists(st.tuples(held, wanted), min_size=20, max_size=40))
    def check(cases):
        rows = []
        for h, (low, high) in cases:
            if low is not None and high is not None and low > high:
                low, high = high, low
            rows.append([on(n) for n in (*(h or (None, None)), low, high)])
        for i, gaps in gaps_of(spark, rows).items():
            lo, hi, want_lo, want_hi = rows[i]
            missing = [days(*g) for g in gaps]
            covered = set() if lo is None else days(lo, hi)
            together = set().union(*missing) if missing else set()
            assert together & covered == set() and sum(map(len, missing)) == len(together)
            assert days(want_lo, want_hi) <= together | covered

    check()


def test_merge_drops_rows_deleted_at_the_source(spark):
    held = frame(spark, (1, day("2025-01-31"), 1, 0), (2, day("2025-02-10"), 2, 0), (3, day("2025-02-20"), 3, 0), (4, None, 4, 0))
    fetched = frame(spark, (2, day("2025-02-11"), 20, 1), (5, day("2025-02-28"), 50, 1))
    merged = incremental_merge(held, fetched, ["pk"], ["seq"], "day", "2025-02-01", "2025-02-28")
    assert sorted(r.amount for r in merged.collect()) == [1, 4, 20, 50]
    kept = incremental_merge(held, fetched, ["pk"], ["seq"])
    assert sorted(r.amount for r in kept.collect()) == [1, 3, 4, 20, 50]
    swapped = replace_range(held, fetched, "day", "2025-02-01", None)
    assert sorted(r.amount for r in swapped.collect()) == [1, 4, 20, 50]


def test_refresh_of_one_day(spark):
    held = frame(spark, (1, day("2025-01-31"), 1, 0), (2, day("2025-02-01"), 2, 0))
    source = frame(spark, (1, day("2025-01-31"), 9, 0), (3, day("2025-02-01"), 3, 0))
    assert sorted(r.amount for r in refresh_day(held, source, "day", "2025-02-01").collect()) == [1, 3]
    latest = source.agg(F.max("day")).scalar()
    assert sorted(r.amount for r in refresh_day(held, source, "day", latest).collect()) == [1, 3]


def test_bounds_of_a_union(spark):
    df = spark.sql("select date'2025-02-01' a, date'2025-01-01' b, cast(null as date) n")
    row = df.select(
        widened(F.col("a"), F.col("b"), "min"), widened(F.col("a"), F.col("n"), "max"),
        touches_day(F.col("n"), F.col("a")), touches_day(F.col("b"), F.col("a")),
    ).first()
    assert tuple(row) == (day("2025-01-01"), day("2025-02-01"), True, False)


def stored_files(folder):
    return {f.relative_to(folder): f.stat().st_mtime_ns for f in folder.rglob("*.parquet")}


def test_stored_table_writes_only_touched_months(spark, tmp_path):
    path = str(tmp_path / "stored")
    first = frame(
        spark, (1, day("2025-01-05"), 1, 0), (2, day("2025-02-05"), 2, 0), (3, day("2025-03-05"), 3, 0), (4, None, 4, 0)
    )
    merge_stored(spark, path, first, ["pk"], ["seq"], "day", covered=("2025-01-01", "2025-03-31"))
    before = stored_files(tmp_path)
    # key 2 moves from February, which then is empty, to April; key 1 is changed twice; key 3 comes late
    second = frame(
        spark, (2, day("2025-04-01"), 20, 1), (1, day("2025-01-06"), 10, 1), (1, day("2025-01-07"), 11, 2), (3, day("2025-03-05"), 9, -1)
    )
    for _ in range(2):
        merge_stored(spark, path, second, ["pk"], ["seq"], "day", covered=("2025-04-01", None))
        got = sorted((r.pk, str(r.day), r.amount) for r in read_months(spark, path).collect())
        assert got == [(1, "2025-01-07", 11), (2, "2025-04-01", 20), (3, "2025-03-05", 3), (4, "None", 4)]
    assert rows_of(covered_ranges(spark, path)) == [(day("2025-01-01"), None)]
    after = stored_files(tmp_path)
    assert all(after[f] == t for f, t in before.items())


def test_a_merge_that_fails_loses_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "stored")
    merge_stored(spark, path, frame(spark, (1, day("2025-01-05"), 1, 0), (2, day("2025-01-06"), 2, 0)), ["pk"], ["seq"], "day")
    want = rows_of(read_months(spark, path))
    change = frame(spark, (1, day("2025-01-05"), 9, 1))
    # in the middle of writing the month
    broken = change.selectExpr("pk", "day", "if(amount = 9, cast(raise_error('lost') as bigint), amount) as amount", "seq")
    with pytest.raises(Exception):
        merge_stored(spark, path, broken, ["pk"], ["seq"], "day")
    assert rows_of(read_months(spark, path)) == want
    # after writing it, before the new version is in place
    with monkeypatch.context() as m:
        m.setattr(incremental, "_put_version", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            merge_stored(spark, path, change, ["pk"], ["seq"], "day")
    assert rows_of(read_months(spark, path)) == want
    merge_stored(spark, path, change, ["pk"], ["seq"], "day")
    assert sorted(r.amount for r in read_months(spark, path).collect()) == [2, 9]


def test_refresh_of_a_range(spark):
    source = frame(spark, *[(i, day("2025-01-01") + dt.timedelta(i), i, 1) for i in range(20)])
    held = source.where("pk between 5 and 9").withColumn("amount", F.lit(-1).cast("bigint"))
    covered = spark.sql("select date'2025-01-06' held_min, date'2025-01-10' held_max")
    out, now = refresh_range(held, covered, source, "day", "2025-01-03", None, "2025-01-15")
    assert sorted((r.pk, r.amount) for r in out.collect()) == [(i, -1 if 5 <= i <= 9 else i) for i in range(2, 20)]
    assert rows_of(now) == [(day("2025-01-03"), day("2025-01-15"))]
    same, _ = refresh_range(held, covered, source, "day", "2025-01-07", "2025-01-09")
    assert rows_of(same) == rows_of(held)


def test_diff_takes_a_null_key_for_a_key(spark):
    rows = spark.createDataFrame([(None, 1), (2, None)], "k int, v int")
    assert {r.status for r in snapshot_diff(rows, rows, ["k"], ["v"]).collect()} == {"unchanged"}


def test_an_old_delivery_does_not_win(spark):
    held = frame(spark, (1, day("2025-01-05"), 1, 5))
    assert [r.amount for r in keyed_upsert(held, frame(spark, (1, day("2025-01-05"), 2, 4)), ["pk"], ["seq"]).collect()] == [1]
    assert [r.amount for r in keyed_upsert(held, frame(spark, (1, day("2025-01-05"), 2, 5)), ["pk"], ["seq"]).collect()] == [2]
