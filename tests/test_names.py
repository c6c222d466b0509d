"""Column names with dots, and tables that hold the names of helper columns."""

from __future__ import annotations

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tablelens.operators import aggregate, classify, joins, keyed, normalize, paging

HELPERS = "_new _rank _old _o _row _text _flagged _disabled _override _column _rows _span disabled override l r".split()


@pytest.fixture
def dotted(spark):
    rows = [("a", 1, 10), ("a", 2, 20), ("b", 3, None), (None, 4, 40)]
    df = spark.createDataFrame(rows, "`k.x` string, seq int, `v.x` int")
    return df.withColumns({h: F.lit(f"<{h}>") for h in HELPERS})


def intact(df):
    return all(r[h] == f"<{h}>" for r in df.collect() for h in HELPERS)


def test_keyed(spark, dotted):
    last = keyed.dedup_keep_last(dotted, ["k.x"], ["seq"])
    assert intact(last) and sorted(r.seq for r in last.collect()) == [2, 3, 4]
    merged = keyed.keyed_upsert(last, dotted.withColumn("seq", F.col("seq") + 10), ["k.x"], ["seq"])
    assert intact(merged) and sorted(r.seq for r in merged.collect()) == [12, 13, 14]
    gone = dotted.where("seq = 3").select("`k.x`")
    assert sorted(r.seq for r in keyed.keyed_delete(last, gone, ["k.x"]).collect()) == [2, 4]
    assert sorted(r.seq for r in keyed.insert_if_absent(last.where("seq = 2"), last, ["k.x"]).collect()) == [2, 3, 4]
    assert keyed.key_intersect(last, gone, ["k.x"]).count() == 1
    assert tuple(keyed.overlap_counts(last, gone, ["k.x"]).first()) == (1, 2, 0)
    assert {r.status for r in keyed.snapshot_diff(last, last, ["k.x"], ["v.x", "_new"]).collect()} == {"unchanged"}
    texts = keyed.grouped_concat(dotted.withColumn("t.x", F.lit("t")), ["k.x"], "_new", "t.x", ["seq"])
    assert texts.columns == ["k.x", "t.x"] and texts.count() == 3


def test_aggregates(spark, dotted):
    got = rows_of(aggregate.group_agg(dotted, ["k.x"], "sum:v.x,median:v.x,nunique:_new"))
    assert got == [("a", 30, 15.0, 1), ("b", 0, None, 1)]
    assert rows_of(aggregate.scalar_agg(dotted, "median:v.x,count:_rows")) == [(20.0, 4)]
    assert [tuple(r) for r in aggregate.value_counts(dotted, ["k.x"]).collect()] == [("a", 2), ("b", 1)]
    assert aggregate.distribution(dotted, "k.x").count() == 2
    assert rows_of(aggregate.pivot(dotted, ["_column"], "k.x", "sum:v.x")) == [("<_column>", 30, 0)]
    assert rows_of(aggregate.pivot(dotted, ["k.x"], "_column", "max:v.x")) == [("a", 20)]
    assert paging.order_by(dotted, "v.x desc").first()["v.x"] == 40


def test_lookups_and_maps(spark, dotted):
    mapped = normalize.apply_value_map(dotted, "k.x", {"a": "A"})
    assert intact(mapped) and [r["k.x"] for r in mapped.orderBy("seq").collect()] == ["A", "A", "b", None]
    notes = normalize.normalization_notes(dotted, {"k.x": {"a": "A"}})
    assert rows_of(notes) == [("k.x", "a", "A", 2)]
    lookup = spark.createDataFrame([("a", "z", 1)], "`k.x` string, `w.x` string, s int")
    joined = joins.lookup_join(dotted, lookup, ["k.x"], ["s"])
    assert intact(joined) and sorted(r["w.x"] or "" for r in joined.collect()) == ["", "", "z", "z"]


def test_classes(spark):
    fields = spark.createDataFrame([("t", "Name")], "table_name string, field_name string").withColumns({h: F.lit(f"<{h}>") for h in HELPERS})
    store = spark.createDataFrame([("t", "Name", "field_class", "mine")], "table_name string, field_name string, context_type string, context string")
    out = classify.classify_with_overrides(fields, store)
    assert intact(out) and out.first()["class"] == "mine"
