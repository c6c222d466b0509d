"""Exact quantiles against numpy, with hot groups and coarse sketches."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablelens.operators.quantiles import exact_quantiles

WANTED = {"a": 0.0, "b": 0.1, "c": 0.25, "d": 0.5, "e": 0.99, "f": 1.0}


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    hot = rng.normal(0, 1000, 20_000)
    copies = np.concatenate([np.full(9_000, 5.0), rng.integers(0, 10, 3_000)])
    small = rng.random(7)
    pdf = pd.DataFrame(
        {
            "k": ["hot"] * len(hot) + ["copies"] * len(copies) + ["small"] * len(small) + ["one"],
            "g": 1,
            "v": np.concatenate([hot, copies, small, [42.0]]),
        }
    ).sample(frac=1, random_state=1)
    extra = pd.DataFrame({"k": ["empty", None], "g": [1, 1], "v": [None, 3.0]})
    both = pd.concat([pdf, extra], ignore_index=True)
    df = spark.createDataFrame(both, "k string, g int, v double").repartition(5)
    return df.replace(float("nan"), None), pdf


# small intervals make several passes, a large one none
@pytest.mark.parametrize("interval", [5, 300, 1_000_000])
def test_equals_numpy(skewed, interval):
    df, pdf = skewed
    out = exact_quantiles(df, ["k", "g"], ["v"], WANTED, interval).toPandas()
    assert sorted(out["k"]) == ["copies", "hot", "one", "small"]
    for _, row in out.iterrows():
        values = pdf.loc[pdf["k"] == row["k"], "v"].to_numpy()
        want = np.quantile(values, list(WANTED.values()))
        np.testing.assert_allclose(row[list(WANTED)].astype(float), want, rtol=1e-12, atol=1e-12)


def test_without_keys(skewed):
    df, pdf = skewed
    rows = df.where("k is not null").withColumns(
        {"w": -F.col("v"), "none": F.lit(None).cast("int"), "k.2": F.hash("v")}
    )
    for interval in (50, 1_000_000):
        out = exact_quantiles(rows, [], ["v", "w", "none", "k.2"], WANTED, interval).toPandas()
        assert sorted(out["column"]) == ["k.2", "v", "w"]
        out = out.set_index("column")
        np.testing.assert_allclose(out.loc["v"].astype(float), np.quantile(pdf["v"], list(WANTED.values())))
        np.testing.assert_allclose(out.loc["w"].astype(float), np.quantile(-pdf["v"], list(WANTED.values())))
        hashes = [r[0] for r in rows.select("`k.2`").collect()]
        np.testing.assert_allclose(out.loc["k.2"].astype(float), np.quantile(hashes, list(WANTED.values())))


def test_infinite_values_and_many_groups(spark):
    df = spark.range(30_000).selectExpr("id % 3000 as k", "cast(id * 7 % 1013 as int) as v")
    want = df.toPandas().groupby("k")["v"].median()
    got = exact_quantiles(df, ["k"], ["v"], {"m": 0.5}).toPandas().set_index("k")["m"]
    assert (got.sort_index() == want.sort_index()).all() and len(got) == 3000
    ends = spark.createDataFrame([(float("inf"),), (float("-inf"),), (float("nan"),), (1.0,)] + [(float(i),) for i in range(20)], "v double")
    row = exact_quantiles(ends, [], ["v"], {"low": 0.0, "m": 0.5, "high": 1.0}, 3).first()
    assert row.low == float("-inf") and row.high == float("inf") and row.m == 9.0


def test_no_rows(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert exact_quantiles(df, ["k"], ["v"], {"m": 0.5}).collect() == []
    assert exact_quantiles(df, [], ["v"], {"m": 0.5}).collect() == []


def test_values_that_are_all_but_equal(spark):
    tiny, huge = 5e-324, 1.7976931348623157e308
    for values in ([0.0] * 9 + [tiny] * 9, [huge] * 5 + [float("inf")] * 6, [-huge, huge] * 7 + [0.0], [1.0, 1.0 + 2**-52] * 8 + [1e300]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        row = exact_quantiles(df, [], ["v"], {"a": 0.0, "m": 0.5, "b": 1.0}, 3).first()
        order = sorted(values)
        n = len(order) - 1
        assert (row.a, row.b) == (order[0], order[-1])
        if n % 2 == 0:
            assert row.m == order[n // 2]


def test_a_pass_shuffles_no_values(spark):
    from tablelens.operators import quantiles

    rows = spark.range(1000).selectExpr("id % 3 as _key0", "'c' as column", "cast(id as double) as v")
    spans = rows.groupBy("_key0", "column").agg(F.count("*").alias("rows"), F.min("v").alias("low"), F.max("v").alias("high"))
    spans = spans.withColumns({"before": F.lit(0).cast("long"), "total": F.col("rows"), "span": F.lit("")})
    found = quantiles._smaller(rows, F.broadcast(spans), ["_key0", "column"], {"m": 0.5})
    plan = found._jdf.queryExecution().executedPlan().toString()
    keys = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "hashpartitioning(" in line]
    assert keys and all(" v#" not in k and not k.startswith("v#") for k in keys)


def test_rows_of_a_column_are_not_brought_to_one_task(spark):
    """No side of the join looks small to the planner, as with rows from large files."""
    rows = spark.range(5_000).selectExpr("cast(id as double) as v", "cast(id % 4000 as double) as w").repartition(5)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = exact_quantiles(rows, [], ["v", "w"], WANTED, 300)
        got = {r["column"]: [r[name] for name in WANTED] for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    np.testing.assert_allclose(got["w"], np.quantile(np.arange(5_000) % 4_000, list(WANTED.values())))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
