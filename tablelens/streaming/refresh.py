"""The incremental operators on a stream."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..functions.projection import fresh, quoted
from ..operators.aggregate import AggSpec, agg_list, measured
from ..operators.incremental import merge_stored
from ..operators.keyed import dedup_keep_last
from ..session import checkpoint_root, scratch_table


def refresh_stored(
    stream: DataFrame,
    path: str,
    keys: Sequence[str],
    seq: Sequence[str],
    date: str,
    name: str,
    key_index: bool = False,
) -> DataStreamWriter:
    """Upsert every micro-batch into the table stored by month at `path`.

    Progress is kept under `name` in the shared checkpoint folder of the session.
    Takes what is available and stops. A batch that is delivered twice leaves
    the same table, so a restart after a failure loses and doubles nothing. With
    `key_index` a batch reads the key columns only of months that may hold its keys.
    """

    def merge(batch: DataFrame, _: int) -> None:
        # read several times, so it is written down where every executor finds it
        merge_stored(batch.sparkSession, path, scratch_table(batch), keys, seq, date, key_index=key_index)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", f"{checkpoint_root(stream.sparkSession)}/{name}")
        .trigger(availableNow=True)
    )


def first_deliveries(
    stream: DataFrame, keys: Sequence[str], time: str, late: str = "1 day"
) -> DataFrame:
    """Drop re-deliveries of a key that arrive within `late`; the first one stays."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def last_deliveries(
    stream: DataFrame, keys: Sequence[str], seq: Sequence[str], time: str | None = None, late: str = "1 day"
) -> DataFrame:
    """The last row per key by `seq` so far, in whatever order the deliveries come; run it in mode update.

    The state of a key is its last row, held by a built-in aggregate. With
    `time`, the time of the record that all its deliveries share, keys are
    forgotten once `late` has passed it, and later deliveries are dropped;
    without it every key is kept. A null key is a key, a null in `seq` comes
    before all values, and of rows equal in `seq` the one with the larger
    other columns, from left to right, stays.
    """
    rest = [F.col(quoted(c)) for c in stream.columns if c not in (*keys, time)]
    if not rest:
        raise ValueError("nothing but keys to keep")
    if time is not None:
        stream = stream.withWatermark(time, late)
    by = [quoted(k) for k in [*keys, *([time] if time is not None else [])]]
    last = fresh("_last", stream)
    kept = stream.groupBy(*by).agg(F.max(F.struct(*[F.col(quoted(s)).alias(f"_{i}") for i, s in enumerate(seq)], F.struct(*rest).alias("row"))).alias(last))
    return kept.select(*by, f"{last}.row.*").select(*map(quoted, stream.columns))


def _exprs(stream: DataFrame, spec: AggSpec) -> list[Column]:
    aggs = agg_list(spec, stream.columns)
    for a in aggs:
        if a.func in ("median", "nunique"):
            raise ValueError(f"{a.func} needs all values at once and cannot be kept on a stream")
    return [a.over(measured(stream, a.column)) for a in aggs]


def week_totals(
    stream: DataFrame, time: str, spec: AggSpec, keys: Sequence[str] = (), late: str = "1 day"
) -> DataFrame:
    """Totals per week from Monday on; a week is final once `late` has passed."""
    # day 0 of the epoch is a Thursday, the first Monday is four days later
    week = F.window(time, "7 days", startTime="4 days")
    return (
        stream.withWatermark(time, late)
        .groupBy(week.alias("week"), *keys)
        .agg(*_exprs(stream, spec))
        .select(
            F.to_date("week.start").alias("period_start"),
            F.date_sub(F.to_date("week.end"), 1).alias("period_end"),
            *keys,
            *[a.name for a in agg_list(spec, stream.columns)],
        )
    )


def month_totals(
    stream: DataFrame, time: str, spec: AggSpec, keys: Sequence[str] = (), late: str = "31 days"
) -> DataFrame:
    """Totals per month; a month is final once `late` has passed, and its state goes.

    The month is grouped by its last instant, which the watermark can pass.
    """
    end = F.date_trunc("month", F.col(time)) + F.expr("interval 1 month")
    return (
        stream.withColumn("_month_end", end)
        .withWatermark("_month_end", late)
        .groupBy("_month_end", *keys)
        .agg(*_exprs(stream, spec))
        .select(F.date_sub(F.to_date("_month_end"), 1).alias("period_end"), *keys, *[a.name for a in agg_list(spec, stream.columns)])
    )


def run_into(stream: DataFrame, mode: str, keys: Sequence[str] = ()) -> DataFrame:
    """Run a stream over what is available into a table in the shared folder, and read that.

    Mode append keeps the rows of all batches, complete those of the last one,
    and update those of the last batch that holds their `keys`.
    """
    spark = stream.sparkSession
    path = f"{checkpoint_root(spark)}/tablelens-{uuid.uuid4().hex}"
    number_of = fresh("_batch", stream)

    def put(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn(number_of, F.lit(number).cast("long"))
        rows.write.mode("overwrite").parquet(f"{path}/{'rows' if mode == 'complete' else number}")

    query = stream.writeStream.foreachBatch(put).outputMode(mode).trigger(availableNow=True)
    query.option("checkpointLocation", f"{path}-progress").start().awaitTermination()
    schema = T.StructType([*stream.schema.fields, T.StructField(number_of, T.LongType())])
    rows = spark.read.schema(schema).parquet(f"{path}/*")
    if mode == "update":
        rows = dedup_keep_last(rows, keys, [number_of])
    return rows.drop(number_of)
