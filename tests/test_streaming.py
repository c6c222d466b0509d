"""The streaming forms on file streams that end when all files are read."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from conftest import FOLDER
from pyspark.sql import functions as F

from tablelens.operators.calendar import resample
from tablelens.operators.incremental import read_months
from tablelens.session import checkpoint_root
from tablelens.streaming import first_deliveries, month_totals, refresh_stored, week_totals

SCHEMA = "event_id bigint, ts timestamp, value bigint, arrived int"


def write_files(spark, folder, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/batch={i}")


def stream(spark, folder):
    return (
        spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/batch=*")
    )


def at(month, day, hour=0):
    return dt.datetime(2024, month, day, hour)


def run(df, name, mode):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination(120)
    return df.sparkSession.table(name)


def test_refresh_keeps_the_last_delivery_and_restarts(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "stored")
    name = f"refresh-{uuid.uuid4()}"
    write_files(spark, source, [
        [(1, at(1, 5), 10, 1), (2, at(1, 6), 20, 1), (3, at(2, 1), 30, 1)],
        [(2, at(1, 6), 21, 2), (3, at(3, 1), 31, 2), (4, at(2, 2), 40, 2)],
    ])
    for value in (None, 50):
        if value:
            extra = spark.createDataFrame([(5, at(1, 7), value, 3), (1, at(1, 5), 11, 3)], SCHEMA)
            extra.coalesce(1).write.parquet(f"{source}/batch=2")
        refresh_stored(
            stream(spark, source), path, ["event_id"], ["arrived"], "ts", name
        ).start().awaitTermination(240)
        held = {r.event_id: r.value for r in read_months(spark, path).collect()}
        want = {1: 10, 2: 21, 3: 31, 4: 40}
        assert held == (want if value is None else {**want, 1: 11, 5: 50})


def test_first_delivery_stays(spark, tmp_path):
    write_files(spark, str(tmp_path), [
        [(1, at(1, 5), 10, 1), (2, at(1, 5, 2), 20, 1)],
        [(1, at(1, 5, 3), 11, 2), (3, at(1, 5, 4), 30, 2)],
    ])
    got = run(first_deliveries(stream(spark, str(tmp_path)), ["event_id"], "ts"), "firsts", "append")
    assert sorted((r.event_id, r.value) for r in got.collect()) == [(1, 10), (2, 20), (3, 30)]


def test_stream_totals_equal_the_batch(spark):
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    stamped = events.select(F.col("ts").cast("timestamp").alias("ts"), "event_type", F.col("value").cast("decimal(12,2)").alias("value"))
    live = (
        spark.readStream.schema(events.schema).parquet(f"{FOLDER}/events.parquet*")
        .select(F.col("ts").cast("timestamp").alias("ts"), "event_type", F.col("value").cast("decimal(12,2)").alias("value"))
    )
    spec, keys = "sum:value,count:value", ["event_type"]
    weeks = run(week_totals(live, "ts", spec, keys), "weeks", "complete")
    batch = resample(stamped, "ts", "week", spec, keys).drop("period_label")
    assert sorted(map(tuple, weeks.collect())) == sorted(
        map(tuple, batch.select(*weeks.columns).collect())
    )
    months = run(month_totals(live, "ts", spec, keys), "months", "complete")
    with pytest.raises(ValueError):
        week_totals(live, "ts", "median:value")
    batch = resample(stamped, "ts", "month", spec, keys).select(*months.columns)
    assert sorted(map(tuple, months.collect())) == sorted(map(tuple, batch.collect()))


def test_checkpoint_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert checkpoint_root(spark) == named if named else "tablelens" in checkpoint_root(spark)
    assert checkpoint_root(spark) == checkpoint_root(spark)
