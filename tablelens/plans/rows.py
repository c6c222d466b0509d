"""Queries that read, filter, project, sort, page and render rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as p
from ..functions.dates import date_bounds, normalize_dates
from ..functions.projection import pick_columns, visible_columns
from ..functions.text import record_as_map, strip_suffix, truncate_text
from ..operators.aggregate import count_records
from ..operators.classify import label_name
from ..operators.paging import keep_most_recent, order_by, page_after, page_at, page_records
from ..operators.quality import type_consistency
from ..sources import coerce_dates, drop_columns_like, load_dataset, resolve_dataset
from .analyze import analyze
from .registry import Tables, query

c = F.col


def day_of(name: str) -> Column:
    return F.to_date(name).alias(name)


@query(
    "load_dataset",
    """
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate::DATE AS o_orderdate
    FROM orders WHERE o_orderstatus = 'O'
    """,
)
def _(t: Tables) -> DataFrame:
    load_dataset(
        t.orders,
        "open_orders",
        where=p.eq(c("o_orderstatus"), "O"),
        select="o_orderkey, o_custkey, o_totalprice, o_orderdate",
    )
    named = resolve_dataset(t.spark, "open_orders")
    return named.select("o_orderkey", "o_custkey", "o_totalprice", day_of("o_orderdate"))


@query(
    "drop_metadata_columns",
    "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
)
def _(t: Tables) -> DataFrame:
    marked = t.supplier.withColumns(
        {"@id": F.concat(F.lit("supplier/"), "s_suppkey"), "@editLink": c("s_name")}
    )
    return drop_columns_like(marked, "@")


@query(
    "date_coercion",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate::DATE END AS written_on
    FROM orders
    """,
)
def _(t: Tables) -> DataFrame:
    day = c("o_orderdate")
    written = (
        F.when(c("o_orderpriority") == "1-URGENT", F.date_format(day, "yyyy-MM-dd"))
        .when(c("o_orderpriority") == "2-HIGH", F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(c("o_orderpriority") == "3-MEDIUM", F.date_format(day, "M/d/yyyy"))
        .when(c("o_orderpriority") == "4-NOT SPECIFIED", F.date_format(day, "M/d/yyyy h:mm:ss a"))
        .otherwise(F.lit("not a date"))
    )
    texts = t.orders.select("o_orderkey", written.alias("written_on"))
    return coerce_dates(texts, ["written_on"]).select("o_orderkey", day_of("written_on"))


#: How a day is written, by the last digit of the order key; the last one is no date.
SPELLINGS = (
    "yyyy/MM/dd", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd HH:mm", "MMM d, yyyy", "d MMM yyyy", "yyyyMMdd",
    "yyyy-MM-dd'T'HH:mm:ss'+0000'", "M/d/yyyy H:mm", "M/d/yy", "yyyy-MM-dd HH:mm:ss'+00:00'",
    "MMMM d, yyyy",
    "MMM d yyyy",
    "d MMMM yyyy",
    "dd-MMM-yyyy",
    "M/d/yy HH:mm",
    "M/d/yyyy hh:mm a",
    "yyyy/MM/dd HH:mm",
    "yyyy-M-d",
    "yyyy.MM.dd",
    "MMM d, yyyy HH:mm",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSSSSS",
)


def _spelled(t: Tables) -> DataFrame:
    kind = c("o_orderkey") % (len(SPELLINGS) + 1)
    text = F.lit("soon")
    for i, layout in enumerate(SPELLINGS):
        text = F.when(kind == i, F.date_format("o_orderdate", layout)).otherwise(text)
    return t.orders.select("o_orderkey", text.alias("written_on"))


@query(
    "date_coercion_mixed",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 22 < 21 THEN o_orderdate::DATE END AS written_on FROM orders",
)
def _(t: Tables) -> DataFrame:
    return coerce_dates(_spelled(t), ["written_on"]).select("o_orderkey", day_of("written_on"))


@query(
    "date_unreadable",
    "SELECT 'written_on' AS field, 'date' AS declared, count(*) AS checked, "
    "count(*) FILTER (o_orderkey % 22 = 21) AS mismatches FROM orders",
)
def _(t: Tables) -> DataFrame:
    return type_consistency(_spelled(t), {"written_on": "date"})


@query(
    "project_columns",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem",
)
def _(t: Tables) -> DataFrame:
    return pick_columns(t.lineitem, " l_orderkey, l_linenumber ,,l_quantity,l_returnflag ")


@query(
    "project_visible_columns",
    """
    SELECT o_orderkey AS "_kp_order", o_custkey AS "_kf_customer", o_orderpriority AS "Priority"
    FROM orders
    """,
)
def _(t: Tables) -> DataFrame:
    named = t.orders.select(
        c("o_orderkey").alias("_kp_order"),
        c("o_custkey").alias("_kf_customer"),
        c("o_orderpriority").alias("Priority"),
        c("o_orderstatus").alias("gStatus"),
        c("o_totalprice").alias("_sp_total"),
        c("o_orderdate").alias("zzDate"),
    )
    return visible_columns(named, label_name)


@query(
    "filter_eq",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
)
def _(t: Tables) -> DataFrame:
    held = t.orders.where(p.eq(c("o_orderstatus"), "F"))
    return held.select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "filter_ne",
    """
    SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders
    WHERE nullif(o_orderstatus, 'P') IS DISTINCT FROM 'F'
    """,
)
def _(t: Tables) -> DataFrame:
    statuses = t.orders.select(
        "o_orderkey", F.nullif(c("o_orderstatus"), F.lit("P")).alias("status")
    )
    return statuses.where(p.ne(c("status"), "F"))


@query(
    "filter_range_numeric",
    """
    SELECT event_id, value, event_type FROM events
    WHERE event_type <> 'error' AND value >= 10 AND value < 200.5
    """,
)
def _(t: Tables) -> DataFrame:
    # a text column that holds a number in most rows and a word in the others
    cell = F.when(c("event_type") == "error", F.lit("n/a")).otherwise(c("value").cast("string"))
    cells = t.events.select("event_id", "value", "event_type", cell.alias("cell"))
    return cells.where(
        p.all_of(p.number(c("cell"), "ge", 10, is_text=True), p.number(c("value"), "lt", 200.5))
    ).drop("cell")


@query(
    "filter_date_range",
    """
    SELECT event_id, user_id, ts::DATE AS day FROM events
    WHERE ts >= TIMESTAMP '2024-01-06' AND ts < TIMESTAMP '2024-01-21'
    """,
)
def _(t: Tables) -> DataFrame:
    held = t.events.where(
        p.all_of(p.day(c("ts"), "gt", "2024-01-05"), p.day(c("ts"), "le", "2024-01-20"))
    )
    return held.select("event_id", "user_id", F.to_date("ts").alias("day"))


@query(
    "filter_date_eq",
    "SELECT event_id, user_id, event_type FROM events WHERE ts::DATE = DATE '2024-01-15'",
)
def _(t: Tables) -> DataFrame:
    held = t.events.where(p.day(c("ts"), "eq", "2024-01-15"))
    return held.select("event_id", "user_id", "event_type")


@query(
    "filter_and",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
    WHERE l_returnflag = 'R' AND l_quantity >= 25 AND l_shipdate < DATE '1998-01-01'
    """,
)
def _(t: Tables) -> DataFrame:
    held = t.lineitem.where(
        p.all_of(
            p.eq(c("l_returnflag"), "R"),
            p.number(c("l_quantity"), "ge", 25),
            p.day(c("l_shipdate"), "lt", "1998-01-01"),
        )
    )
    return held.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query(
    "filter_or",
    """
    SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
    WHERE c_mktsegment = 'BUILDING' OR c_acctbal < 0 OR c_acctbal > 9000
    """,
)
def _(t: Tables) -> DataFrame:
    held = t.customer.where(
        p.any_of(
            p.eq(c("c_mktsegment"), "BUILDING"),
            p.number(c("c_acctbal"), "lt", 0),
            p.number(c("c_acctbal"), "gt", 9000),
        )
    )
    return held.select("c_custkey", "c_mktsegment", "c_acctbal")


@query(
    "filter_string_match",
    """
    SELECT doc_id, lang, source FROM documents
    WHERE contains(text, 'tion') AND (starts_with(source, 'src1') OR ends_with(text, '.'))
    """,
)
def _(t: Tables) -> DataFrame:
    held = t.documents.where(
        p.all_of(
            c("text").contains("tion"),
            p.any_of(c("source").startswith("src1"), c("text").endswith(".")),
        )
    )
    return held.select("doc_id", "lang", "source")


@query(
    "filter_null",
    """
    SELECT event_id, value FROM events
    WHERE nullif(event_type, 'error') IS NOT NULL AND nullif(event_type, 'view') IS NOT NULL
       OR nullif(event_type, 'click') IS NULL
    """,
)
def _(t: Tables) -> DataFrame:
    kind = c("event_type")
    filled = p.all_of(
        p.not_null(F.nullif(kind, F.lit("error"))), p.not_null(F.nullif(kind, F.lit("view")))
    )
    held = t.events.where(p.any_of(filled, p.is_null(F.nullif(kind, F.lit("click")))))
    return held.select("event_id", "value")


@query(
    "filter_empty_string",
    "SELECT p_partkey, p_brand FROM part WHERE length(replace(p_type, 'PROMO', '')) = 0",
)
def _(t: Tables) -> DataFrame:
    held = t.part.where(p.is_empty(F.replace(c("p_type"), F.lit("PROMO"), F.lit(""))))
    return held.select("p_partkey", "p_brand")


@query(
    "analyze_filter",
    """
    SELECT o_orderpriority, o_orderstatus, round(sum(o_totalprice), 2) AS o_totalprice_sum,
           count(o_orderkey) AS o_orderkey_count
    FROM orders
    WHERE o_totalprice > 100000 AND (o_orderstatus = 'F' OR o_orderpriority IN ('1-URGENT', '2-HIGH'))
    GROUP BY o_orderpriority, o_orderstatus
    """,
)
def _(t: Tables) -> DataFrame:
    return analyze(
        t.orders,
        groupby="o_orderpriority,o_orderstatus",
        aggregate="sum:o_totalprice,count:o_orderkey",
        where="o_totalprice > 100000 and "
        "(o_orderstatus == 'F' or o_orderpriority in ('1-URGENT', '2-HIGH'))",
    ).withColumn("o_totalprice_sum", F.round("o_totalprice_sum", 2))


@query(
    "count_records",
    "SELECT count(*) AS count FROM lineitem WHERE l_shipdate >= DATE '1999-01-01'",
)
def _(t: Tables) -> DataFrame:
    return count_records(t.lineitem, p.day(c("l_shipdate"), "ge", "1999-01-01"))


@query(
    "get_record",
    "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey = 77",
)
def _(t: Tables) -> DataFrame:
    return p.get_record(t.customer, "c_custkey", "77").select(
        "c_custkey", "c_name", "c_mktsegment"
    )


@query(
    "normalize_dates",
    """
    SELECT o_orderkey,
           'placed ge ' || strftime(o_orderdate, '%Y-%m-%d') || ' and status eq '''
             || o_orderstatus || '''' AS filter
    FROM orders
    """,
)
def _(t: Tables) -> DataFrame:
    day = c("o_orderdate")
    literal = (
        F.when(c("o_orderpriority") == "1-URGENT", F.date_format(day, "''yyyy-MM-dd''"))
        .when(c("o_orderpriority") == "2-HIGH", F.date_format(day, "yyyy-MM-dd'T00:00:00.000Z'"))
        .when(c("o_orderpriority") == "3-MEDIUM", F.date_format(day, "M/d/yyyy"))
        .when(
            c("o_orderpriority") == "4-NOT SPECIFIED",
            F.date_format(day, "''MM/dd/yyyy' 12:30:00 PM'''"),
        )
        .otherwise(F.date_format(day, "'\"'yyyy-MM-dd'T10:15:00-05:00\"'"))
    )
    written = F.concat(
        F.lit("placed ge "), literal, F.lit(" and status eq '"), c("o_orderstatus"), F.lit("'")
    )
    return t.orders.select("o_orderkey", normalize_dates(written).alias("filter"))


@query(
    "extract_date_bounds",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END AS lower_day,
           CASE o_orderstatus WHEN 'F' THEN o_orderdate::DATE + 30
                WHEN 'P' THEN o_orderdate::DATE ELSE o_orderdate::DATE END AS upper_day
    FROM orders
    """,
)
def _(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    first, later = day.cast("string"), F.date_add(day, 30).cast("string")
    both = F.concat(
        F.lit("Order Day ge "), first, F.lit(" and Total gt 5 and Order Day le "), later
    )
    upper = F.concat(F.lit("\"Order Day\" lt "), first, F.lit(" and Ship Day ge "), later)
    exact = F.concat(F.lit("Status eq 'O' and Order Day eq "), first)
    logged = (
        F.when(c("o_orderstatus") == "F", both)
        .when(c("o_orderstatus") == "P", upper)
        .otherwise(exact)
    )
    found = t.orders.select("o_orderkey", date_bounds(logged, "Order Day").alias("b"))
    return found.select("o_orderkey", c("b.min").alias("lower_day"), c("b.max").alias("upper_day"))


@query(
    "order_by_multi",
    """
    SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority, o_totalprice FROM orders
    ORDER BY priority NULLS LAST, o_totalprice DESC, o_orderkey
    """,
)
def _(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_orderkey",
        F.nullif(c("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
        "o_totalprice",
    )
    return order_by(rows, "priority asc, o_totalprice DESC, o_orderkey")


@query(
    "page_records",
    """
    SELECT o_orderkey, o_totalprice, count(*) OVER () AS total FROM orders
    WHERE o_orderstatus = 'O' ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100
    """,
)
def _(t: Tables) -> DataFrame:
    return page_records(
        t.orders,
        "o_totalprice desc,o_orderkey",
        top=50,
        skip=100,
        where=p.eq(c("o_orderstatus"), "O"),
        select="o_orderkey,o_totalprice",
    )


@query(
    "page_after",
    """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderkey > 9000 ORDER BY o_orderkey LIMIT 50
    """,
)
def _(t: Tables) -> DataFrame:
    return page_after(t.orders, "o_orderkey", 9000, 50).select("o_orderkey", "o_totalprice")


@query(
    "page_after_sorted",
    """
    SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority, o_totalprice, count(*) OVER () AS total FROM orders
    WHERE o_orderstatus = 'O'
    QUALIFY priority IS NULL OR priority = '2-HIGH' AND o_totalprice < 250000 OR priority > '2-HIGH'
    ORDER BY priority NULLS LAST, o_totalprice DESC, o_orderkey LIMIT 50
    """,
)
def _(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("priority", F.nullif(c("o_orderpriority"), F.lit("5-LOW")))
    last = {"priority": "2-HIGH", "o_totalprice": 250000.0, "o_orderkey": -1}
    return page_after(
        rows,
        "priority asc,o_totalprice desc,o_orderkey",
        last,
        top=50,
        where=p.eq(c("o_orderstatus"), "O"),
        select="o_orderkey,priority,o_totalprice",
        total="total",
    )


@query(
    "keep_most_recent",
    """
    SELECT o_orderkey, o_orderdate::DATE AS o_orderdate, o_totalprice FROM orders
    ORDER BY orders.o_orderdate DESC, o_orderkey LIMIT 5000
    """,
)
def _(t: Tables) -> DataFrame:
    recent = keep_most_recent(t.orders, 5000, "o_orderdate", ["o_orderkey"])
    return recent.select("o_orderkey", day_of("o_orderdate"), "o_totalprice")


@query(
    "page_at_depth",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice, (SELECT count(*) FROM lineitem) AS total FROM lineitem
    ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 50 OFFSET (SELECT count(*) // 2 FROM lineitem)
    """,
)
def _(t: Tables) -> DataFrame:
    half, wanted = t.lineitem.count() // 2, ["l_orderkey", "l_linenumber", "l_extendedprice"]
    return page_at(t.lineitem, "l_extendedprice desc,l_orderkey,l_linenumber", 50, half, select=wanted, range_rows=5_000)


@query(
    "keep_half_most_recent",
    """
    WITH dated AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN o_orderdate::DATE END AS day FROM orders), n AS (SELECT count(*) AS n FROM orders)
    (SELECT 'day' AS kept, o_orderkey, day FROM dated ORDER BY day DESC NULLS LAST, o_orderkey LIMIT (SELECT n // 2 FROM n))
    UNION ALL
    (SELECT 'nulls', o_orderkey, day FROM dated ORDER BY day DESC NULLS LAST, o_orderkey LIMIT (SELECT n * 9 // 10 FROM n))
    UNION ALL
    (SELECT 'arrival', o_orderkey, day FROM dated ORDER BY o_orderkey DESC LIMIT (SELECT n // 3 FROM n))
    UNION ALL
    (SELECT 'one day', o_orderkey, DATE '2024-01-01' FROM orders ORDER BY o_orderkey LIMIT (SELECT n // 4 FROM n))
    """,
)
def _(t: Tables) -> DataFrame:
    # most of a table stays: by day, with rows that have none, by arrival, and out of a single day
    dated = t.orders.select("o_orderkey", F.when(c("o_orderkey") % 5 > 0, F.to_date("o_orderdate")).alias("day"))
    n, small = dated.count(), 1_000
    parts = {
        "day": keep_most_recent(dated, n // 2, "day", ["o_orderkey"], small),
        "nulls": keep_most_recent(dated, n * 9 // 10, "day", ["o_orderkey"], small),
        "arrival": keep_most_recent(dated, n // 3, None, ["o_orderkey"], small),
        "one day": keep_most_recent(dated.withColumn("day", F.lit("2024-01-01").cast("date")), n // 4, "day", ["o_orderkey"], small),
    }
    return reduce(DataFrame.unionByName, [rows.select(F.lit(name).alias("kept"), "o_orderkey", "day") for name, rows in parts.items()])


@query(
    "truncate_text",
    """
    SELECT doc_id, CASE WHEN text IS NULL THEN '' WHEN length(text) > 500
           THEN substr(text, 1, 500) || '... [truncated]' ELSE text END AS shown
    FROM (SELECT doc_id, nullif(text, '') AS text FROM documents)
    """,
)
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", truncate_text(c("text")).alias("shown"))


@query(
    "record_as_map",
    """
    SELECT * FROM (
      SELECT c_custkey, 'c_custkey' AS field, c_custkey::VARCHAR AS value FROM customer
      UNION ALL SELECT c_custkey, 'c_name', c_name FROM customer
      UNION ALL SELECT c_custkey, 'segment', replace(nullif(c_mktsegment, 'BUILDING'), 'MACHINERY', '')
      FROM customer)
    WHERE value IS NOT NULL AND value <> ''
    """,
)
def _(t: Tables) -> DataFrame:
    segment = F.nullif(c("c_mktsegment"), F.lit("BUILDING"))
    rows = t.customer.select(
        "c_custkey",
        "c_name",
        F.replace(segment, F.lit("MACHINERY"), F.lit("")).alias("segment"),
    )
    return rows.select("c_custkey", F.explode(record_as_map(rows)).alias("field", "value"))


@query(
    "strip_suffix",
    "SELECT p_partkey, p_name AS label FROM part",
)
def _(t: Tables) -> DataFrame:
    padded = F.concat(c("p_name"), F.repeat(F.lit("_"), c("p_size")))
    return t.part.select("p_partkey", strip_suffix(padded).alias("label"))
