"""Distinct counts by bitmaps, the most frequent texts by digests, fused checks and last deliveries."""

from __future__ import annotations

import datetime as dt
import random

from conftest import rows_of
from pyspark.sql import functions as F

from tablelens.operators import summary
from tablelens.operators.calendar import resample
from tablelens.operators.distinct_periods import distinct_by_periods
from tablelens.operators.keyed import dedup_keep_last
from tablelens.operators.quality import quality_report
from tablelens.operators.summary import describe_text
from tablelens.streaming import last_deliveries, run_into


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_distinct_counts_equal_a_resample_of_each_grain(spark):
    draw = random.Random(3)
    big = [0, -1, 1, 32767, 32768, 32769, -32768, 2**62, -(2**63), 2**63 - 1]
    rows = [
        (dt.date(2023, 11, 1) + dt.timedelta(draw.randrange(200)), draw.choice([None, *big, *range(40)]), draw.choice("ab"), draw.choice(["x", "y", None, "", "z z"]))
        for _ in range(900)
    ] + [(None, 7, "a", "x"), (dt.date(2024, 1, 1), 7, None, "x"), (dt.date(2030, 1, 1), None, "a", None)]
    df = spark.createDataFrame(rows, "day date, `v.n` bigint, k string, word string")
    for column in ("v.n", "word"):
        got = distinct_by_periods(df, "day", column, keys=["k"])
        for grain in ("week", "month", "quarter"):
            want = resample(df, "day", grain, [summary_agg(column)], ["k"])
            assert rows_of(got.where(F.col("period") == grain).drop("period")) == rows_of(want)
    assert distinct_by_periods(df.limit(0), "day", "v.n").collect() == []


def summary_agg(column):
    from tablelens.operators.aggregate import Agg

    return Agg("nunique", column)


def test_all_grains_come_from_one_scan(spark, tmp_path):
    spark.range(1000).selectExpr("date_add(date'2024-01-01', cast(id % 300 as int)) day", "id % 77 v").write.parquet(str(tmp_path / "t"))
    plan = executed(distinct_by_periods(spark.read.parquet(str(tmp_path / "t")), "day", "v"))
    assert plan.split("Initial Plan")[0].count("FileScan") == 1


def test_a_few_rows_a_day_over_many_values_make_no_large_states(spark):
    rows = spark.range(3000).selectExpr("date_add(date'2024-01-01', cast(id % 300 as int)) day", "id * 40000 v")
    counts = distinct_by_periods(rows, "day", "v")
    plan = executed(counts)
    assert {r["period"]: r["n"] for r in counts.groupBy("period").agg(F.sum("v_nunique").alias("n")).collect()} == {"week": 3000, "month": 3000, "quarter": 3000}
    # no sort by group with a state of kilobytes in every row
    assert "SortAggregate" not in plan and "bitmap" not in plan


def test_top_text_by_passes_over_longer_heads(spark, monkeypatch):
    monkeypatch.setattr(summary, "HEADS", (2, 5))
    long = "same start " * 3
    rows = [
        # most frequent one is long; ties that differ late; ties of which one is the start of the other; short values; none
        ("same start one", long + "b", "ab", "x", None),
        ("same start one", long + "a", "abc", "x", None),
        ("same start two", long + "c", "abcdefgh", "y", None),
        ("", long + "a!", "abcdefg", "", None),
        ("", long + "b!", None, "", None),
        ("same start one", None, None, "é", None),
    ]
    df = spark.createDataFrame(rows, "`a.b` string, late string, starts string, short string, nothing string")
    got = {r["column"]: (r["count"], r["unique"], r.top, r.freq) for r in describe_text(df).collect()}
    assert got == {
        "a.b": (6, 3, "same start one", 3),
        "late": (5, 5, long + "a", 1),
        "starts": (4, 4, "ab", 1),
        "short": (6, 4, "", 2),
        "nothing": (0, 0, None, None),
    }
    empty = describe_text(df.limit(0))
    assert {tuple(r) for r in empty.collect()} == {(n, 0, 0, None, None) for n in df.columns}


def test_no_exchange_carries_a_text(spark):
    df = spark.range(50).select(F.repeat(F.concat(F.lit("long text "), F.col("id").cast("string")), 9).alias("text"))
    cells = df.unpivot([], ["text"], "column", "value")
    plan = summary._frequent(cells, 16)._jdf.queryExecution().executedPlan()
    exchanges = [line for line in plan.toString().splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("value#" in line or "text#" in line for line in exchanges)


def test_fused_checks_read_each_table_once(spark, tmp_path):
    orders = [(1, 10, "5"), (1, 10, "x"), (2, 11, None), (None, 99, ""), (-5, None, "7")]
    customers = [(10, "a"), (11, "b"), (11, "c")]
    spark.createDataFrame(orders, "id bigint, customer int, amount string").write.parquet(str(tmp_path / "o"))
    spark.createDataFrame(customers, "id bigint, name string").write.parquet(str(tmp_path / "c"))
    o, cu = (spark.read.parquet(str(tmp_path / n)) for n in "oc")
    report = quality_report(
        {"o": o, "c": cu},
        {"o": ["id"], "c": ["id", "name"]},
        [("o", "customer", "c", "id"), ("c", "id", "o", "customer"), ("o", "amount", "c", "name")],
        {"o": {"amount": "number", "customer": "text"}},
    )
    want = {
        ("pk_filled", "o", "id", "FAIL", 1), ("pk_format", "o", "id", "FAIL", 1), ("pk_unique", "o", "id", "FAIL", 1),
        ("pk_filled", "c", "id,name", "PASS", 0), ("pk_format", "c", "id,name", "PASS", 0), ("pk_unique", "c", "id,name", "PASS", 0),
        ("fk_match", "o", "customer", "FAIL", 1), ("fk_match", "c", "id", "PASS", 0), ("fk_match", "o", "amount", "FAIL", 3),
        ("type", "o", "amount", "FAIL", 1), ("type", "o", "customer", "FAIL", 4),
    }
    assert {tuple(r) for r in report.collect()} == want
    assert executed(report).split("Initial Plan")[0].count("FileScan") == 2


def test_relations_of_other_types_are_joined(spark):
    one = spark.createDataFrame([("1",), ("2",), ("9",)], "k string")
    two = spark.createDataFrame([(1,), (2,)], "k int")
    got = quality_report({"one": one, "two": two}, {}, [("one", "k", "two", "k")])
    assert rows_of(got) == [("fk_match", "one", "k", "FAIL", 1)]


def test_nulls_of_a_composite_key_are_told_apart(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (None, None), (None, None)], "a int, b int")
    got = {r.check: r.n for r in quality_report({"t": df}, {"t": ["a", "b"]}).collect()}
    assert got["pk_unique"] == 1 and got["pk_filled"] == 4


def deliveries(seed):
    draw = random.Random(seed)
    rows = [
        (k, dt.datetime(2024, 1, 1, k % 24), draw.choice([None, 1, 2, 3, 4]), draw.randrange(9))
        for k in [*range(30), None]
        if k is not None
        for _ in range(4)
    ]
    draw.shuffle(rows)
    return rows


def test_last_delivery_over_several_batches_equals_the_batch_form(spark, tmp_path):
    schema = "id int, at timestamp, seq int, value int"
    rows = deliveries(5) + [(None, dt.datetime(2024, 1, 1), 2, 1), (None, dt.datetime(2024, 1, 1), 1, 2)]
    for i in range(0, len(rows), 31):
        spark.createDataFrame(rows[i : i + 31], schema).coalesce(1).write.parquet(str(tmp_path / f"batch={i}"))
    live = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "batch=*"))
    for time in ("at", None):
        got = run_into(last_deliveries(live, ["id"], ["seq"], time), "update", ["id"])
        want = dedup_keep_last(spark.createDataFrame(rows, schema), ["id"], ["seq", "at", "value"])
        assert got.columns == want.columns and rows_of(got) == rows_of(want)
