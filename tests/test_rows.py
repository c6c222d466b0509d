from __future__ import annotations

import datetime as dt
import json

import pytest
from conftest import FOLDER, rows_of
from pyspark.sql import functions as F

from tablelens.functions import predicates as p
from tablelens.functions.json_types import json_type_profile, json_value_type
from tablelens.functions.projection import names_of, pick_columns, visible_columns
from tablelens.functions.text import record_as_map, strip_suffix, truncate_text
from tablelens.operators.classify import label_name
from tablelens.operators.paging import keep_most_recent, order_by, page_after, page_records
from tablelens.sources import (
    coerce_dates,
    drop_columns_like,
    load_dataset,
    read_json_pages,
    read_table,
    resolve_dataset,
    write_result,
)

c = F.col


@pytest.fixture(scope="module")
def times(spark):
    rows = [
        (1, dt.datetime(2026, 2, 19, 23, 59, 59)),
        (2, dt.datetime(2026, 2, 20)),
        (3, dt.datetime(2026, 2, 20, 18)),
        (4, dt.datetime(2026, 2, 21)),
        (5, None),
    ]
    return spark.createDataFrame(rows, "id int, t timestamp_ntz")


@pytest.mark.parametrize(
    ("op", "ids"),
    [("eq", [2, 3]), ("ge", [2, 3, 4]), ("gt", [4]), ("le", [1, 2, 3]), ("lt", [1])],
)
def test_days_compare_as_whole_days(times, op, ids):
    assert [r.id for r in times.where(p.day(c("t"), op, "2026-02-20")).collect()] == ids
    dates = times.select("id", F.to_date("t").alias("t"))
    assert [r.id for r in dates.where(p.day(c("t"), op, dt.date(2026, 2, 20))).collect()] == ids


def test_open_ranges(times):
    def ids(where):
        return [r.id for r in times.where(where).collect()]

    assert ids(p.day_range(c("t"))) == [1, 2, 3, 4, 5]
    assert ids(p.day_range(c("t"), start="2026-02-20")) == [2, 3, 4]
    assert ids(p.day_range(c("t"), end="2026-02-20")) == [1, 2, 3]


def test_numbers_in_text(spark):
    df = spark.createDataFrame([("10",), ("9.5",), ("n/a",), (None,), ("500.0",)], "v string")
    got = df.where(p.number(c("v"), "ge", 10, is_text=True))
    assert rows_of(got) == [("10",), ("500.0",)]
    with pytest.raises(ValueError):
        p.number(c("v"), "eq", 1)


def test_ne_keeps_nulls_and_empty_is_not_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("",)], "v string")
    assert rows_of(df.where(p.ne(c("v"), "a"))) == [("",), ("b",), (None,)]
    assert rows_of(df.where(p.is_empty(c("v")))) == [("",)]
    assert rows_of(df.where(p.has_value(c("v")))) == [("a",), ("b",)]


def test_and_or_bind_as_written(invoices):
    got = invoices.where(
        p.any_of(
            p.all_of(p.eq(c("Region"), "A"), p.number(c("Amount"), "gt", 400)),
            p.eq(c("Amount"), 200),
        )
    )
    assert sorted(r.Amount for r in got.collect()) == [200, 500]


def test_record_lookup_by_key_type(spark, invoices):
    df = spark.createDataFrame([(7, "7"), (8, "x")], "n bigint, s string")
    assert rows_of(p.get_record(df, "n", "7")) == [(7, "7")]
    assert rows_of(p.get_record(df, "s", 7)) == [(7, "7")]
    assert rows_of(p.get_record(df, "n", "x")) == []


def test_filters_and_columns_reach_the_scan(spark):
    orders = read_table(spark, FOLDER, "orders")
    held = orders.where(
        p.all_of(p.day_range(c("o_orderdate"), "1998-01-01", "1998-12-31"), p.eq(c("o_orderstatus"), "F"))
    ).select("o_orderkey")
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)" in plan
    assert "LessThan(o_orderdate,1999-01-01T00:00)" in plan
    assert "EqualTo(o_orderstatus,F)" in plan
    schema = plan.split("ReadSchema:")[1].split("\n")[0]
    assert "o_totalprice" not in schema


def test_projection(invoices):
    assert names_of(" A, ,B ") == ["A", "B"] and names_of(None) == []
    assert pick_columns(invoices, "Amount, Region").columns == ["Amount", "Region"]
    assert pick_columns(invoices, "").columns == invoices.columns
    named = invoices.toDF("_kp_ID", "gName", "Amount", "zzDay")
    assert visible_columns(named, label_name).columns == ["_kp_ID", "Amount"]
    assert visible_columns(named, label_name, show_all=True).columns == named.columns


def test_names_with_spaces(spark):
    df = spark.createDataFrame([("a", 1)], "`Company Name` string, `Zip.Code` int")
    assert pick_columns(df, ["Company Name"]).columns == ["Company Name"]
    assert rows_of(order_by(df, "Company Name desc").select("Company Name")) == [("a",)]


def test_sort_puts_nulls_last_both_ways(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 1)], "id int, v int")
    assert [r.id for r in order_by(df, "v").collect()] == [3, 2, 1]
    assert [r.id for r in order_by(df, "v DESC, id").collect()] == [2, 3, 1]
    with pytest.raises(Exception):
        order_by(df, "nope").collect()


def test_pages_cover_the_table(spark):
    df = spark.range(25).withColumn("v", -c("id"))
    pages = [page_records(df, "v,id", 10, skip, where="id < 23") for skip in (0, 10, 20, 30)]
    ids = [[r.id for r in page.collect()] for page in pages]
    assert [len(i) for i in ids] == [10, 10, 3, 0] and sum(ids, []) == list(range(22, -1, -1))
    assert {r.total for r in pages[2].collect()} == {23}
    assert [r.id for r in page_after(df, "id", 20, 10).collect()] == [21, 22, 23, 24]


def most_recent(pdf, n, date, key):
    """Brute force for keep_most_recent."""
    return set(
        pdf.sort_values([date, key], ascending=[False, True], na_position="last").head(n)[key]
    )


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz"])
@pytest.mark.parametrize("n", [5, 2999, 8200, 8990, 20_000])
def test_most_recent_rows(spark, kind, n):
    # one day holds two thirds of the rows, one instant a third, a few rows have no date
    df = spark.range(9000).selectExpr(
        "id",
        f"cast(case when id % 9 in (0, 1, 2) then timestamp_ntz'2024-03-01 12:00:00'"
        f" when id % 9 in (3, 4, 5) then timestamp_ntz'2024-03-01' + make_dt_interval(0, 0, 0, id)"
        f" when id % 100 = 6 then null"
        f" else timestamp_ntz'2024-02-01' + make_dt_interval(cast(id % 60 as int)) end as {kind}) as t",
    ).repartition(6)
    got = keep_most_recent(df, n, "t", ["id"])
    assert {r.id for r in got.collect()} == most_recent(df.toPandas(), n, "t", "id")


def test_most_recent_without_a_date_keeps_the_last_arrived(spark):
    df = spark.range(5000).withColumnRenamed("id", "seq")
    assert {r.seq for r in keep_most_recent(df, 3, None, ["seq"]).collect()} == {4997, 4998, 4999}
    many = keep_most_recent(df, 2000, "missing", ["seq"]).collect()
    assert {r.seq for r in many} == set(range(3000, 5000))


def test_most_recent_keeps_rows_without_tiebreak(spark):
    df = spark.range(6000).selectExpr("if(id % 2 = 0, id, null) as k", "date'2024-01-01' as t")
    assert keep_most_recent(df, 5000, "t", ["k"]).count() == 5000
    assert keep_most_recent(df, 5000, None, ["k"]).count() == 5000


def test_pages_have_no_size_of_their_own(spark):
    df = spark.range(30_000)
    assert page_records(df, "id", top=20_000).count() == 20_000
    assert page_after(df, "id", 4_999, top=20_000).count() == 20_000
    with pytest.raises(ValueError):
        page_records(df.withColumnRenamed("id", "total"), "total")
    assert page_records(df.withColumnRenamed("id", "total"), "total", total="n").columns == ["total", "n"]


def test_pages_of_any_sort_cover_the_table(spark):
    rows = [(i, None if i % 5 == 0 else i % 3, None if i % 7 == 0 else i % 4) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, a int, `b.c` int")
    spec = "a desc,b.c asc,id"
    want = [r.id for r in order_by(df, spec).collect()]
    got, last = [r.id for r in order_by(df, spec).limit(7).collect()], None
    while True:
        last = df.where(c("id") == got[-1]).first().asDict()
        page = [r.id for r in page_after(df, spec, last, 7).collect()]
        if not page:
            break
        got += page
    assert got == want


def test_cells(spark):
    df = spark.createDataFrame([("x" * 500,), ("é" * 501,), (None,), ("",)], "t string")
    got = [r[0] for r in df.select(truncate_text(c("t"))).collect()]
    assert got == ["x" * 500, "é" * 500 + "... [truncated]", "", ""]
    row = spark.createDataFrame([(1, None, "", "z__")], "a int, b string, d string, e string")
    assert row.select(record_as_map(row)).first()[0] == {"a": "1", "e": "z__"}
    assert row.select(strip_suffix(c("e"))).first()[0] == "z"


def test_json_types(spark):
    cases = [
        ("null", "unknown"), ('"hello"', "text"), ('""', "text"), ("42", "number"), ("0", "number"),
        ("3.14", "decimal"), ("900.0", "decimal"), ("1e5", "decimal"), ("true", "boolean"),
        ("false", "boolean"), ('"2025-01-15T14:30:00Z"', "datetime"), ('"2025-01-15"', "date"),
        ('"1900-01-01"', "date"), ('"2025-01-15 extra"', "text"), ("[1]", "unknown"), ('{"a":1}', "unknown"),
    ]
    df = spark.createDataFrame(cases, "j string, want string")
    got = df.select("j", json_value_type(F.parse_json("j")).alias("got"), "want").collect()
    assert [(r.j, r.got) for r in got] == [(r.j, r.want) for r in got]


def test_dominant_type_ignores_nulls(spark):
    docs = ['{"a": null, "b": null}', '{"a": null}', '{"a": 1}', '{"a": "x"}', "[1, 2]", "bad", None]
    df = spark.createDataFrame([(d,) for d in docs], "j string")
    got = {(r.key, r.type): (r.n, r.dominant, r["values"]) for r in json_type_profile(df, "j").collect()}
    assert got == {
        ("a", "unknown"): (2, "number", 4),
        ("a", "number"): (1, "number", 4),
        ("a", "text"): (1, "number", 4),
        ("b", "unknown"): (1, "unknown", 1),
    }


def test_datasets_are_replaced_and_empty_ones_not_made(spark, invoices):
    assert load_dataset(invoices, "inv", where="Region = 'A'", select="Amount,Region").count() == 3
    assert load_dataset(invoices, "inv", where=c("Region") == "B").count() == 2
    assert resolve_dataset(spark, "inv").count() == 2
    assert load_dataset(invoices, "inv_none", where="Amount < 0") is None
    with pytest.raises(KeyError):
        resolve_dataset(spark, "inv_none")
    assert resolve_dataset(spark, "region", FOLDER).count() == 5


def test_json_pages_in_and_results_out(spark, tmp_path):
    for i in range(2):
        page = {"@count": 4, "value": [{"@id": f"r{i}{k}", "Key": 10 * i + k, "On": "1/5/2025"} for k in range(2)]}
        (tmp_path / f"page{i}.json").write_text(json.dumps(page))
    schema = "`@id` string, Key bigint, On string"
    for given in (None, schema):
        df = read_json_pages(spark, str(tmp_path), given)
        assert df.columns == ["Key", "On"]
        assert sorted(r.Key for r in df.collect()) == [0, 1, 10, 11]
    dated = coerce_dates(df, ["On", "Missing"])
    assert {str(r.On) for r in dated.collect()} == {"2025-01-05 00:00:00"}
    out = tmp_path / "out"
    for fmt in ("json", "parquet"):
        write_result(dated, f"{out}.{fmt}", fmt)
        assert spark.read.format(fmt).load(f"{out}.{fmt}").count() == 4
    assert drop_columns_like(spark.range(1).toDF("@x"), "@").columns == []
