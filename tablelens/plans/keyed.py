"""Queries that keep one row per key: upsert, delete, merge, diff, key sets."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.day_states import DayStates
from ..operators.incremental import (
    covered_ranges,
    incremental_merge,
    merge_stored,
    read_months,
    refresh_day,
    refresh_range,
    resample_stored,
)
from ..operators.keyed import (
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
from ..session import checkpoint_root
from ..sources import write_result
from ..streaming import first_deliveries, last_deliveries, month_totals, refresh_stored, run_into, week_totals
from .registry import Tables, query

c = F.col


def _orders(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        F.to_date("o_orderdate").alias("day"),
    )


@query(
    "keyed_upsert",
    """
    SELECT o_orderkey, o_custkey, CASE o_orderstatus WHEN 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
           o_totalprice, o_orderdate::DATE AS day, CASE o_orderstatus WHEN 'P' THEN 2 ELSE 0 END AS seq
    FROM orders
    UNION ALL
    SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate::DATE, 1
    FROM orders WHERE o_totalprice > 400000
    """,
)
def _(t: Tables) -> DataFrame:
    held = _orders(t).withColumn("seq", F.lit(0))
    late = held.where(c("o_orderstatus") == "P").withColumn("seq", F.lit(1))
    again = late.withColumns({"o_orderstatus": F.lit("F"), "seq": F.lit(2)})
    added = held.where(c("o_totalprice") > 400000).withColumns(
        {"o_orderkey": -1 - c("o_orderkey"), "seq": F.lit(1)}
    )
    incoming = late.unionByName(again).unionByName(added)
    return keyed_upsert(held, incoming, ["o_orderkey"], ["seq"])


@query(
    "keyed_delete",
    """
    SELECT user_id, event_type, count(*) AS n FROM events e
    WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id AND c_mktsegment = 'BUILDING')
      AND NOT EXISTS (SELECT 1 FROM customer
                      WHERE c_custkey = user_id AND c_mktsegment = 'MACHINERY' AND event_type = 'error')
    GROUP BY user_id, event_type
    """,
)
def _(t: Tables) -> DataFrame:
    # a whole user goes, or only one event type of a user
    named = F.when(c("c_mktsegment") == "MACHINERY", F.lit("error")).otherwise(F.lit(""))
    gone = t.customer.where(c("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
        c("c_custkey").alias("user_id"), named.alias("event_type")
    )
    kept = keyed_delete(t.events, gone, ["user_id"], optional="event_type")
    return kept.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query(
    "grouped_concat",
    """
    WITH latest AS (
      SELECT user_id, event_type, arg_max(props, (ts, event_id)) AS props
      FROM events GROUP BY user_id, event_type)
    SELECT user_id, string_agg(props, '; ' ORDER BY event_type) AS props
    FROM latest GROUP BY user_id
    """,
)
def _(t: Tables) -> DataFrame:
    return grouped_concat(t.events, ["user_id"], "event_type", "props", ["ts", "event_id"])


@query(
    "dedup_keep_last",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
           l_shipdate::DATE AS l_shipdate
    FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY lineitem.l_shipdate DESC, l_extendedprice DESC, l_partkey DESC, l_suppkey DESC) = 1
    """,
)
def _(t: Tables) -> DataFrame:
    last = dedup_keep_last(
        t.lineitem,
        ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey"],
    )
    return last.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.to_date("l_shipdate").alias("l_shipdate"),
    )


@query(
    "union_by_name",
    """
    SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
    """,
)
def _(t: Tables) -> DataFrame:
    buyers = t.customer.select(
        c("c_custkey").alias("key"), c("c_name").alias("name"), c("c_mktsegment").alias("segment")
    )
    sellers = t.supplier.select(
        c("s_acctbal").alias("balance"), c("s_name").alias("name"), c("s_suppkey").alias("key")
    )
    return union_by_name(buyers, sellers)


@query(
    "insert_if_absent",
    """
    SELECT doc_id, quality, 'label' AS origin FROM labels
    UNION ALL
    SELECT doc_id, -1, 'new' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    """,
)
def _(t: Tables) -> DataFrame:
    held = t.labels.select("doc_id", "quality", F.lit("label").alias("origin"))
    new = t.documents.select("doc_id", F.lit(-1).alias("quality"), F.lit("new").alias("origin"))
    return insert_if_absent(held, new, ["doc_id"])


@query(
    "key_intersect",
    """
    SELECT o_custkey AS custkey FROM orders INTERSECT SELECT c_custkey + 50 FROM customer
    """,
)
def _(t: Tables) -> DataFrame:
    buyers = t.orders.select(c("o_custkey").alias("custkey"))
    shifted = t.customer.select((c("c_custkey") + 50).alias("custkey"))
    return key_intersect(buyers, shifted, ["custkey"])


@query(
    "key_overlap",
    """
    WITH b AS (SELECT DISTINCT o_custkey AS k FROM orders),
    s AS (SELECT DISTINCT c_custkey + 50 AS k FROM customer)
    SELECT (SELECT count(*) FROM b WHERE k IN (FROM s)) AS shared,
           (SELECT count(*) FROM b WHERE k NOT IN (FROM s)) AS only_left,
           (SELECT count(*) FROM s WHERE k NOT IN (FROM b)) AS only_right
    """,
)
def _(t: Tables) -> DataFrame:
    buyers = t.orders.select(c("o_custkey").alias("custkey"))
    shifted = t.customer.select((c("c_custkey") + 50).alias("custkey"))
    return overlap_counts(buyers, shifted, ["custkey"])


@query(
    "snapshot_diff",
    """
    WITH cur AS (SELECT nullif(o_orderkey, 7) AS k, o_orderstatus AS s, o_totalprice AS p FROM orders),
    old AS (SELECT nullif(CASE WHEN o_orderpriority = '5-LOW' AND o_orderkey <> 7 THEN -1 - o_orderkey
                               ELSE o_orderkey END, 7) AS k,
                   CASE o_orderstatus WHEN 'P' THEN 'O' ELSE o_orderstatus END AS s, o_totalprice AS p FROM orders)
    SELECT coalesce(cur.k, old.k) AS o_orderkey, cur.s AS current_o_orderstatus, cur.p AS current_o_totalprice,
           old.s AS existing_o_orderstatus, old.p AS existing_o_totalprice,
           CASE WHEN old.s IS NULL THEN 'new' WHEN cur.s IS NULL THEN 'removed'
                WHEN cur.s = old.s AND cur.p = old.p THEN 'unchanged' ELSE 'changed' END AS status
    FROM cur FULL JOIN old ON cur.k IS NOT DISTINCT FROM old.k
    """,
)
def _(t: Tables) -> DataFrame:
    orders = t.orders
    key, seven = c("o_orderkey"), F.lit(7)
    other = F.when((c("o_orderpriority") == "5-LOW") & (key != seven), -1 - key).otherwise(key)
    current = orders.withColumn("o_orderkey", F.nullif(key, seven))
    existing = orders.withColumn("o_orderkey", F.nullif(other, seven)).replace({"P": "O"}, subset=["o_orderstatus"])
    return snapshot_diff(current, existing, ["o_orderkey"], ["o_orderstatus", "o_totalprice"])


@query(
    "incremental_merge",
    """
    SELECT event_id, user_id, event_type, value, ts::DATE AS day, 0 AS seq FROM events
    WHERE ts < TIMESTAMP '2024-01-10' OR ts >= TIMESTAMP '2024-01-21'
    UNION ALL
    SELECT event_id, user_id, event_type, -value, ts::DATE, 1 FROM events
    WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-21' AND event_type <> 'error'
    """,
)
def _(t: Tables) -> DataFrame:
    events = t.events.select(
        "event_id", "user_id", "event_type", "value", F.to_date("ts").alias("day")
    )
    held = events.withColumn("seq", F.lit(0))
    # the range comes back without its errors, which the merge then drops
    fetched = events.where(c("event_type") != "error").withColumns({"value": -c("value"), "seq": F.lit(1)})
    return incremental_merge(
        held, fetched, ["event_id"], ["seq"], "day", "2024-01-10", "2024-01-20"
    )


@query(
    "refresh_latest_day",
    """
    SELECT event_id, user_id, ts::DATE AS day,
           CASE WHEN ts::DATE = (SELECT max(ts)::DATE FROM events) THEN value ELSE 0 END AS value
    FROM events
    """,
)
def _(t: Tables) -> DataFrame:
    source = t.events.select("event_id", "user_id", F.to_date("ts").alias("day"), "value")
    held = source.withColumn("value", F.lit(0.0))
    latest = source.agg(F.max("day")).scalar()
    return refresh_day(held, source, "day", latest)


def _scratch(t: Tables) -> str:
    """A new folder for what a query stores and reads back."""
    return f"{checkpoint_root(t.spark)}/tablelens-{uuid.uuid4().hex}"


def _events(t: Tables) -> DataFrame:
    return t.events.select("event_id", "user_id", "event_type", "value", F.to_date("ts").alias("day"))


@query(
    "refresh_range",
    """
    SELECT event_id, user_id, event_type, ts::DATE AS day,
           CASE WHEN ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-15' THEN 0 ELSE value END AS value
    FROM events WHERE ts < TIMESTAMP '2024-01-26'
    UNION ALL
    SELECT event_id, user_id, event_type, ts::DATE, 0 FROM events WHERE ts >= TIMESTAMP '2024-01-26'
    """,
)
def _(t: Tables) -> DataFrame:
    # held values are 0, so those of the ranges that were read again show
    source = _events(t)
    held = source.withColumn("value", F.lit(0.0))
    covered = t.spark.sql("select date'2024-01-05' as held_min, date'2024-01-15' as held_max")
    return refresh_range(held, covered, source, "day", None, "2024-01-25", "2024-01-25")[0]


@query(
    "merge_stored",
    """
    SELECT event_id, user_id, event_type, ts::DATE + CASE event_type WHEN 'click' THEN 40 ELSE 0 END AS day,
           CASE event_type WHEN 'click' THEN -value ELSE value END AS value,
           CASE event_type WHEN 'click' THEN 1 ELSE 0 END AS seq
    FROM events
    """,
)
def _(t: Tables) -> DataFrame:
    path, first = _scratch(t), _events(t).withColumn("seq", F.lit(0))
    # clicks come again with another date and value; views come again late, with an old number
    clicks = first.withColumns({"day": F.date_add("day", 40), "value": -c("value"), "seq": F.lit(1)})
    views = first.withColumns({"value": c("value") + 1000, "seq": F.lit(-1)})
    again = clicks.where(c("event_type") == "click").unionByName(views.where(c("event_type") == "view"))
    merge_stored(t.spark, path, first, ["event_id"], ["seq"], "day")
    merge_stored(t.spark, path, again, ["event_id"], ["seq"], "day")
    return read_months(t.spark, path)


@query(
    "merge_with_key_index",
    """
    SELECT event_id, user_id, event_type, ts::DATE + CASE WHEN event_id % 50 = 0 THEN 40 ELSE 0 END AS day,
           CASE WHEN event_id % 50 = 0 THEN -value ELSE value END AS value,
           CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END AS seq
    FROM events
    """,
)
def _(t: Tables) -> DataFrame:
    # some events come again with another date; filters of the stored months say where they were
    path, first = _scratch(t), _events(t).withColumn("seq", F.lit(0))
    again = first.withColumns({"day": F.date_add("day", 40), "value": -c("value"), "seq": F.lit(1)})
    merge_stored(t.spark, path, first, ["event_id"], ["seq"], "day", key_index=True)
    merge_stored(t.spark, path, again.where(c("event_id") % 50 == 0), ["event_id"], ["seq"], "day", key_index=True)
    return read_months(t.spark, path)


@query(
    "resample_stored_states",
    """
    WITH e AS (
      SELECT event_type, ts::DATE + CASE WHEN event_id % 50 = 0 THEN 40 ELSE 0 END AS day,
             CASE WHEN event_id % 50 = 0 THEN -value ELSE value END AS value FROM events)
    SELECT date_trunc('month', day)::DATE AS period_start, last_day(day) AS period_end, strftime(day, '%Y-%m') AS period_label,
           event_type, round(sum(value), 6) AS value_sum, count(value) AS value_count, round(avg(value), 6) AS value_mean,
           min(value) AS value_min, max(value) AS value_max
    FROM e GROUP BY ALL
    """,
)
def _(t: Tables) -> DataFrame:
    # some events come again with another date and value; the states of the days they leave and reach are computed again
    path, first = _scratch(t), _events(t).withColumn("seq", F.lit(0))
    again = first.withColumns({"day": F.date_add("day", 40), "value": -c("value"), "seq": F.lit(1)})
    states = DayStates(["value"], ["event_type"])
    merge_stored(t.spark, path, first, ["event_id"], ["seq"], "day", states=states)
    merge_stored(t.spark, path, again.where(c("event_id") % 50 == 0), ["event_id"], ["seq"], "day", states=states)
    aggs = "sum:value,count:value,mean:value,min:value,max:value"
    out = resample_stored(t.spark, path, "month", aggs)
    return out.withColumns({n: F.round(n, 6) for n in ("value_sum", "value_mean")})


@query(
    "merge_capped",
    """
    SELECT event_id, ts::DATE AS day FROM events ORDER BY ts::DATE DESC, event_id
    LIMIT 3 * (SELECT count(*) // 5 FROM events)
    """,
)
def _(t: Tables) -> DataFrame:
    # the cap of a stored table: three fifths of the rows, the newest
    path, events = _scratch(t), _events(t).select("event_id", "day").withColumn("seq", F.lit(0))
    most = 3 * (events.count() // 5)
    merge_stored(t.spark, path, events.where("event_id % 2 = 0"), ["event_id"], ["seq"], "day", most=most)
    merge_stored(t.spark, path, events.where("event_id % 2 = 1"), ["event_id"], ["seq"], "day", most=most)
    return read_months(t.spark, path).select("event_id", "day")


@query(
    "coverage_after_merge",
    """
    SELECT DATE '2023-12-01' AS held_min, max(ts)::DATE AS held_max FROM events
    UNION ALL SELECT DATE '2024-06-01', DATE '2024-06-30'
    """,
)
def _(t: Tables) -> DataFrame:
    path, events = _scratch(t), _events(t).withColumn("seq", F.lit(0))
    low, high = events.agg(F.min("day"), F.max("day")).first()
    merge_stored(t.spark, path, events, ["event_id"], ["seq"], "day", covered=(low, high))
    # two ranges that held no rows: one adjoins what is covered, one does not
    none = events.limit(0)
    merge_stored(t.spark, path, none, ["event_id"], ["seq"], "day", covered=("2023-12-01", "2023-12-31"))
    merge_stored(t.spark, path, none, ["event_id"], ["seq"], "day", covered=("2024-06-01", "2024-06-30"))
    return covered_ranges(t.spark, path)


@query("write_result", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def _(t: Tables) -> DataFrame:
    path = _scratch(t)
    write_result(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), path, "json", partition_by=["o_orderstatus"])
    return t.spark.read.schema("o_orderkey long, o_totalprice double, o_orderstatus string").json(path)


def _live(t: Tables) -> DataFrame:
    """The events as a stream of their files."""
    rows = t.spark.readStream.schema(t.events.schema).parquet(f"{t.folder}/events.parquet*")
    return rows.withColumns({"ts": c("ts").cast("timestamp"), "value": c("value").cast("decimal(12,2)")})


@query("stream_refresh", "SELECT event_id, user_id, event_type, ts::DATE AS day, value FROM events")
def _(t: Tables) -> DataFrame:
    path, live = _scratch(t), _live(t).withColumn("value", c("value").cast("double"))
    refresh_stored(live, path, ["event_id"], ["ts"], "ts", uuid.uuid4().hex, key_index=True).start().awaitTermination()
    return read_months(t.spark, path).select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"), "value")


@query("stream_first_deliveries", "SELECT event_id, user_id, event_type FROM events")
def _(t: Tables) -> DataFrame:
    # every event arrives twice in one batch, and once it stays
    twice = _live(t).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return run_into(first_deliveries(twice, ["event_id"], "ts"), "append").select("event_id", "user_id", "event_type")


@query(
    "stream_last_deliveries",
    """
    SELECT event_id, user_id, CASE WHEN event_type = 'click' THEN 'click again' ELSE event_type END AS event_type
    FROM events
    """,
)
def _(t: Tables) -> DataFrame:
    # every event arrives three times, the last version of it not last
    versions = F.array(F.lit(1), F.lit(3), F.lit(2))
    kind = F.when((c("event_type") == "click") & (c("version") == 3), "click again")
    kind = kind.when(c("version") < 3, "early").otherwise(c("event_type"))
    live = _live(t).withColumn("version", F.explode(versions)).withColumn("event_type", kind)
    last = run_into(last_deliveries(live, ["event_id"], ["version"], "ts"), "update", ["event_id"])
    return last.select("event_id", "user_id", "event_type")


@query(
    "stream_week_totals",
    """
    SELECT date_trunc('week', ts)::DATE AS period_start, date_trunc('week', ts)::DATE + 6 AS period_end, event_type,
           round(sum(value::DECIMAL(12, 2))::DOUBLE, 2) AS value_sum, count(value) AS value_count
    FROM events GROUP BY ALL
    """,
)
def _(t: Tables) -> DataFrame:
    totals = run_into(week_totals(_live(t), "ts", "sum:value,count:value", ["event_type"]), "complete")
    return totals.withColumn("value_sum", F.round(c("value_sum").cast("double"), 2))


@query(
    "stream_month_totals",
    """
    SELECT last_day(ts::DATE) AS period_end, event_type,
           round(sum(value::DECIMAL(12, 2))::DOUBLE, 2) AS value_sum, count(value) AS value_count
    FROM events GROUP BY ALL
    """,
)
def _(t: Tables) -> DataFrame:
    totals = run_into(month_totals(_live(t), "ts", "sum:value,count:value", ["event_type"]), "complete")
    return totals.withColumn("value_sum", F.round(c("value_sum").cast("double"), 2))
