"""Key filters of stored months, the cap of a stored table, and the removal of old versions."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tablelens.operators import key_index
from tablelens.operators.incremental import covered_ranges, merge_stored, read_months, remove_old_versions


def months(spark, n_months=12, per_month=2000):
    rows = spark.range(n_months * per_month).withColumn("m", (F.col("id") % n_months).cast("int"))
    return rows.select(F.col("id").alias("pk"), F.expr("add_months(date'2024-01-15', m)").alias("day"), F.lit(1).alias("v"), F.lit(0).alias("seq"))


def test_filters_miss_no_key_and_rarely_name_another_month(spark):
    df = months(spark).withColumn("month", F.date_format("day", "yyyy-MM"))
    index = key_index.build_key_index(df, "month", ["pk"])
    assert {r.n for r in index.groupBy("month").agg((F.count("*") * F.first("blocks")).alias("n")).collect()} <= {4, 1, 2}
    for wanted, month in (([0, 12, 24], "2024-01"), ([11], "2024-12"), ([5 + 12 * 1999], "2024-06")):
        asked = spark.createDataFrame([(k,) for k in wanted], "pk long")
        assert [r[0] for r in key_index.months_of(index, asked, ["pk"]).collect()] == [month]
    assert key_index.months_of(index, df, ["pk"]).count() == 12
    strangers = spark.range(10**9, 10**9 + 2000).toDF("pk")
    per_key = index.crossJoin(F.broadcast(strangers.limit(1))).count()
    assert per_key and key_index.months_of(index, strangers.limit(100), ["pk"]).count() <= 1


def test_filters_of_a_large_month_are_made_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(key_index, "TASK_KEYS", 5_000, raising=False)
    keys = spark.range(40_000).select(F.expr("date_format(date_add(date'2024-01-01', cast(id % 31 as int)), 'yyyy-MM')").alias("m.n"), F.col("id").alias("block"))
    index = key_index.build_key_index(keys, "m.n", ["block"])
    assert index.rdd.getNumPartitions() == 8
    # 40,000 keys of 24 bits take 32 blocks of 32,768
    assert [tuple(r) for r in index.groupBy("month", "blocks").count().collect()] == [("2024-01", 32, 32)]
    assert key_index.months_of(index, keys, ["block"]).collect() == [("2024-01",)]


def test_merge_reads_only_months_that_may_hold_its_keys(spark, tmp_path):
    first = months(spark)
    change = first.where("pk in (0, 12, 7)").withColumns({"day": F.lit(dt.date(2025, 3, 1)), "v": F.lit(9), "seq": F.lit(1)})
    for name, indexed in (("plain", False), ("indexed", True)):
        path = str(tmp_path / name)
        merge_stored(spark, path, first, ["pk"], ["seq"], "day", key_index=indexed)
        report = merge_stored(spark, path, change, ["pk"], ["seq"], "day", key_index=indexed)
        assert report["written"] == ["2024-01", "2024-08", "2025-03"]
        assert report["searched"] == (["2024-01", "2024-08"] if indexed else [f"2024-{m:02}" for m in range(1, 13)])
        again = merge_stored(spark, path, change, ["pk"], ["seq"], "day", key_index=indexed)
        assert again["written"] == ["2025-03"] and (not indexed or again["searched"] == ["2025-03"])
    plain, indexed = (rows_of(read_months(spark, str(tmp_path / n))) for n in ("plain", "indexed"))
    assert plain == indexed and len(plain) == 24_000


def test_months_without_a_usable_filter_are_read(spark, tmp_path):
    path = str(tmp_path / "stored")
    schema = "pk int, `other.key` string, day date, seq int"
    merge_stored(spark, path, spark.createDataFrame([(1, None, dt.date(2025, 1, 1), 0)], schema), ["pk", "other.key"], ["seq"], "day")
    more = spark.createDataFrame([(2, "a", dt.date(2025, 2, 1), 0), (None, None, None, 0)], schema)
    report = merge_stored(spark, path, more, ["pk", "other.key"], ["seq"], "day", key_index=True)
    assert report["searched"] == ["2025-01"]
    # keys of another type than the filters were made of
    wide = spark.createDataFrame([(2, "a", dt.date(2025, 3, 1), 1)], schema.replace("pk int", "pk bigint"))
    report = merge_stored(spark, path, wide, ["pk", "other.key"], ["seq"], "day", key_index=True)
    assert report["searched"] == ["", "2025-01", "2025-02"] and report["written"] == ["2025-02", "2025-03"]
    moved = spark.createDataFrame([(None, None, dt.date(2025, 5, 1), 1)], schema)
    report = merge_stored(spark, path, moved, ["pk", "other.key"], ["seq"], "day", key_index=True)
    assert "" in report["written"] and read_months(spark, path).count() == 3


def test_merge_of_nothing(spark, tmp_path):
    path, none = str(tmp_path / "stored"), months(spark).limit(0)
    assert merge_stored(spark, path, none, ["pk"], ["seq"], "day", key_index=True, most=5) == {"searched": [], "written": []}
    merge_stored(spark, path, months(spark, 2, 5), ["pk"], ["seq"], "day", key_index=True)
    assert merge_stored(spark, path, none, ["pk"], ["seq"], "day", key_index=True)["searched"] == []


@pytest.mark.parametrize("most, kept, covered", [(100, 14, "2025-01-01"), (13, 13, "2025-01-01"), (9, 9, "2025-01-05"), (6, 6, "2025-01-08"), (4, 4, "2025-02-02"), (0, 0, None)])
def test_cap_keeps_the_newest_and_what_is_covered(spark, tmp_path, most, kept, covered):
    path = str(tmp_path / "stored")
    # two rows on each of six days, the last ones in February; one row without a date comes last
    days = [dt.date(2025, 1, d) for d in (2, 4, 5, 7)] + [dt.date(2025, 2, d) for d in (1, 2)]
    rows = [(2 * k + j, d, 0) for k, d in enumerate(days) for j in (0, 1)] + [(50, None, 0), (51, dt.date(2025, 2, 3), 0)]
    df = spark.createDataFrame(rows, "pk long, day date, seq int")
    merge_stored(spark, path, df.where("pk % 2 = 0"), ["pk"], ["seq"], "day", covered=("2025-01-01", "2025-02-03"), most=10)
    merge_stored(spark, path, df, ["pk"], ["seq"], "day", covered=("2025-01-01", "2025-02-03"), key_index=True, most=most)
    order = sorted((r for r in rows if r[1]), key=lambda r: (-r[1].toordinal(), r[0])) + [r for r in rows if not r[1]]
    if kept:
        assert rows_of(read_months(spark, path)) == sorted(order[:kept], key=repr)
    ranges = [str(r[0]) for r in rows_of(covered_ranges(spark, path))]
    assert ranges == ([covered] if covered else [])


def test_old_versions_go_after_retention(spark, tmp_path):
    path = str(tmp_path / "stored")
    for k in range(3):
        merge_stored(spark, path, months(spark, 3, 5).withColumn("seq", F.lit(k)), ["pk"], ["seq"], "day", key_index=True)
    want = rows_of(read_months(spark, path))
    assert remove_old_versions(spark, path, keep=3) == []
    assert [n.partition("/")[0] for n in remove_old_versions(spark, path, keep=2)] == ["versions"]  # its files are too young
    gone = remove_old_versions(spark, path, keep=1, older_than=-10)
    assert sorted(n.partition("/")[0] for n in gone) == ["data", "data", "indexes", "indexes", "versions"]
    assert rows_of(read_months(spark, path)) == want
    merge_stored(spark, path, months(spark, 3, 5).withColumn("seq", F.lit(9)), ["pk"], ["seq"], "day", key_index=True)
    assert {r.seq for r in read_months(spark, path).collect()} == {9}
