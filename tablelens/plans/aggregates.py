"""Queries that aggregate, count, describe, resample and pivot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregate import (
    distribution,
    group_agg,
    pivot,
    scalar_agg,
    value_counts,
    with_total,
)
from ..operators.calendar import resample, resample_filled
from ..operators.distinct_periods import distinct_by_periods
from ..operators.normalize import normalization_notes
from ..operators.paging import order_by, top_rows
from ..operators.summary import describe_numeric, describe_text, describe_timestamp
from .analyze import analyze, analyze_from_store
from .registry import Tables, query

c = F.col


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({name: F.round(name, d) for name, d in digits.items()})


@query(
    "agg_sum",
    """
    SELECT o_custkey,
           coalesce(round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 2), 0) AS amount_sum
    FROM orders GROUP BY o_custkey
    """,
)
def _(t: Tables) -> DataFrame:
    amount = F.when(c("o_orderstatus") == "F", c("o_totalprice"))
    out = group_agg(t.orders.select("o_custkey", amount.alias("amount")), ["o_custkey"], "sum:amount")
    return rounded(out, amount_sum=2)


@query(
    "agg_count",
    """
    SELECT o_custkey, count(nullif(o_orderstatus, 'P')) AS status_count
    FROM orders GROUP BY o_custkey
    """,
)
def _(t: Tables) -> DataFrame:
    status = F.nullif(c("o_orderstatus"), F.lit("P")).alias("status")
    return group_agg(t.orders.select("o_custkey", status), ["o_custkey"], "count:status")


@query(
    "agg_mean",
    """
    SELECT l_returnflag, l_linestatus, round(avg(l_extendedprice), 6) AS l_extendedprice_mean
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """,
)
def _(t: Tables) -> DataFrame:
    out = group_agg(t.lineitem, ["l_returnflag", "l_linestatus"], "mean:l_extendedprice")
    return rounded(out, l_extendedprice_mean=6)


@query(
    "agg_min_max",
    """
    SELECT o_custkey, min(o_totalprice) AS o_totalprice_min, max(o_totalprice) AS o_totalprice_max,
           min(o_orderdate)::DATE AS first_day, max(o_orderdate)::DATE AS last_day
    FROM orders GROUP BY o_custkey
    """,
)
def _(t: Tables) -> DataFrame:
    out = group_agg(
        t.orders,
        ["o_custkey"],
        "min:o_totalprice,max:o_totalprice,min:o_orderdate,max:o_orderdate",
    )
    return out.select(
        "o_custkey",
        "o_totalprice_min",
        "o_totalprice_max",
        F.to_date("o_orderdate_min").alias("first_day"),
        F.to_date("o_orderdate_max").alias("last_day"),
    )


@query(
    "agg_median",
    """
    SELECT l_returnflag, l_linestatus, round(median(l_extendedprice), 4) AS l_extendedprice_median
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """,
)
def _(t: Tables) -> DataFrame:
    out = group_agg(t.lineitem, ["l_returnflag", "l_linestatus"], "median:l_extendedprice")
    return rounded(out, l_extendedprice_median=4)


@query(
    "agg_nunique",
    """
    SELECT o_orderpriority, count(DISTINCT o_custkey) AS o_custkey_nunique,
           count(DISTINCT nullif(o_orderstatus, 'P')) AS status_nunique
    FROM orders GROUP BY o_orderpriority
    """,
)
def _(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("status", F.nullif(c("o_orderstatus"), F.lit("P")))
    return group_agg(rows, ["o_orderpriority"], "nunique:o_custkey,nunique:status")


@query(
    "agg_std",
    """
    SELECT o_custkey, round(stddev_samp(o_totalprice), 4) AS o_totalprice_std
    FROM orders GROUP BY o_custkey
    """,
)
def _(t: Tables) -> DataFrame:
    out = group_agg(t.orders, ["o_custkey"], "std:o_totalprice")
    return rounded(out, o_totalprice_std=4)


@query(
    "group_agg",
    """
    SELECT l_returnflag, nullif(l_linestatus, 'F') AS linestatus,
           round(sum(l_quantity), 2) AS l_quantity_sum,
           count(l_quantity) AS l_quantity_count,
           min(l_extendedprice) AS l_extendedprice_min,
           max(l_extendedprice) AS l_extendedprice_max,
           count(DISTINCT l_suppkey) AS l_suppkey_nunique
    FROM lineitem WHERE l_linestatus <> 'F' GROUP BY ALL
    """,
)
def _(t: Tables) -> DataFrame:
    # rows whose key is null form no group
    rows = t.lineitem.withColumn("linestatus", F.nullif(c("l_linestatus"), F.lit("F")))
    out = group_agg(
        rows,
        ["l_returnflag", "linestatus"],
        "sum:l_quantity,count:l_quantity,min:l_extendedprice,max:l_extendedprice,nunique:l_suppkey",
    )
    return rounded(out, l_quantity_sum=2)


@query(
    "scalar_agg",
    """
    SELECT round(median(o_totalprice), 4) AS o_totalprice_median,
           round(stddev_samp(o_totalprice), 4) AS o_totalprice_std,
           count(DISTINCT o_custkey) AS o_custkey_nunique,
           round(sum(o_totalprice), 2) AS o_totalprice_sum
    FROM orders
    """,
)
def _(t: Tables) -> DataFrame:
    out = scalar_agg(
        t.orders, "median:o_totalprice,std:o_totalprice,nunique:o_custkey,sum:o_totalprice"
    )
    return rounded(out, o_totalprice_median=4, o_totalprice_std=4, o_totalprice_sum=2)


@query(
    "value_counts",
    "SELECT l_suppkey, count(*) AS count FROM lineitem GROUP BY l_suppkey",
)
def _(t: Tables) -> DataFrame:
    return value_counts(t.lineitem, ["l_suppkey"])


@query(
    "value_counts_multi",
    """
    SELECT user_id, event_type, count(*) AS count FROM events
    WHERE event_type <> 'error' GROUP BY user_id, event_type
    """,
)
def _(t: Tables) -> DataFrame:
    rows = t.events.withColumn("event_type", F.nullif(c("event_type"), F.lit("error")))
    return value_counts(rows, ["user_id", "event_type"])


@query(
    "group_agg_sorted",
    """
    SELECT l_suppkey, round(sum(l_quantity), 2) AS l_quantity_sum,
           count(l_orderkey) AS l_orderkey_count
    FROM lineitem GROUP BY l_suppkey ORDER BY l_quantity_sum DESC, l_suppkey
    """,
)
def _(t: Tables) -> DataFrame:
    out = group_agg(t.lineitem, ["l_suppkey"], "sum:l_quantity,count:l_orderkey")
    return order_by(rounded(out, l_quantity_sum=2), "l_quantity_sum desc,l_suppkey")


@query(
    "group_agg_topn",
    """
    SELECT o_custkey, round(sum(o_totalprice), 2) AS o_totalprice_sum,
           count(o_orderkey) AS o_orderkey_count
    FROM orders GROUP BY o_custkey ORDER BY o_totalprice_sum DESC, o_custkey LIMIT 10
    """,
)
def _(t: Tables) -> DataFrame:
    out = group_agg(t.orders, ["o_custkey"], "sum:o_totalprice,count:o_orderkey")
    return top_rows(rounded(out, o_totalprice_sum=2), "o_totalprice_sum desc,o_custkey", 10)


@query(
    "group_agg_total",
    """
    SELECT o_custkey, count(o_orderkey) AS o_orderkey_count, count(*) OVER () AS total_groups
    FROM orders GROUP BY o_custkey ORDER BY o_orderkey_count DESC, o_custkey LIMIT 50
    """,
)
def _(t: Tables) -> DataFrame:
    groups = with_total(group_agg(t.orders, ["o_custkey"], "count:o_orderkey"))
    return top_rows(groups, "o_orderkey_count desc,o_custkey", 50)


@query(
    "distribution_share",
    """
    SELECT p_brand, count(*) AS count,
           round(count(*) * 100.0 / (SELECT count(*) FROM part), 6)::DOUBLE AS percent
    FROM part GROUP BY p_brand
    """,
)
def _(t: Tables) -> DataFrame:
    shares = distribution(t.part, "p_brand")
    return shares.withColumn("percent", F.round("percent", 6).cast("double"))


@query(
    "describe_numeric",
    """
    WITH v AS (
      SELECT 'l_quantity' AS "column", l_quantity AS x FROM lineitem
      UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem
      UNION ALL SELECT 'l_discount', nullif(l_discount, 0) FROM lineitem
      UNION ALL SELECT 'l_linenumber', l_linenumber FROM lineitem)
    SELECT "column", count(x) AS count, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std,
           min(x) AS min, round(quantile_cont(x, 0.25), 4) AS p25,
           round(quantile_cont(x, 0.5), 4) AS p50, round(quantile_cont(x, 0.75), 4) AS p75,
           max(x) AS max
    FROM v GROUP BY "column"
    """,
)
def _(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("l_discount", F.nullif(c("l_discount"), F.lit(0.0)))
    out = describe_numeric(rows, ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"])
    return rounded(out, mean=4, std=4, p25=4, p50=4, p75=4)


@query(
    "describe_text",
    """
    WITH v AS (
      SELECT 'lang' AS "column", lang AS x FROM documents
      UNION ALL SELECT 'source', source FROM documents
      UNION ALL SELECT 'text', text FROM documents),
    n AS (SELECT "column", x, count(*) AS n FROM v WHERE x IS NOT NULL GROUP BY "column", x),
    r AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, x) AS rn FROM n)
    SELECT "column", sum(n)::BIGINT AS count, count(*) AS "unique",
           max(CASE WHEN rn = 1 THEN x END) AS top, max(n) AS freq
    FROM r GROUP BY "column"
    """,
)
def _(t: Tables) -> DataFrame:
    return describe_text(t.documents, ["lang", "source", "text"])


@query(
    "describe_timestamp",
    """
    WITH v AS (SELECT epoch_us(ts) AS us FROM events)
    SELECT 'ts' AS "column", count(us) AS count,
           strftime(make_timestamp((sum(us::HUGEINT) // count(us))::BIGINT), '%Y-%m-%d %H:%M:%S.%f') AS mean,
           strftime(make_timestamp(min(us)), '%Y-%m-%d %H:%M:%S.%f') AS min,
           strftime(make_timestamp(floor(quantile_cont(us::DOUBLE, 0.25))::BIGINT), '%Y-%m-%d %H:%M:%S.%f') AS p25,
           strftime(make_timestamp(floor(quantile_cont(us::DOUBLE, 0.5))::BIGINT), '%Y-%m-%d %H:%M:%S.%f') AS p50,
           strftime(make_timestamp(floor(quantile_cont(us::DOUBLE, 0.75))::BIGINT), '%Y-%m-%d %H:%M:%S.%f') AS p75,
           strftime(make_timestamp(max(us)), '%Y-%m-%d %H:%M:%S.%f') AS max
    FROM v
    """,
)
def _(t: Tables) -> DataFrame:
    out = describe_timestamp(t.events, ["ts"])
    clocks = ("mean", "min", "p25", "p50", "p75", "max")
    return out.withColumns({s: F.date_format(s, "yyyy-MM-dd HH:mm:ss.SSSSSS") for s in clocks})


def _distinct_sql(table: str, date: str, column: str, key: str) -> str:
    """Distinct values per week, month and quarter of a table, one scan per grain."""
    steps = {"week": "6 DAYS", "month": "1 MONTH - INTERVAL 1 DAY", "quarter": "3 MONTHS - INTERVAL 1 DAY"}
    return " UNION ALL ".join(
        f"""
    SELECT '{grain}' AS period, date_trunc('{grain}', {date})::DATE AS period_start,
           (date_trunc('{grain}', {date}) + INTERVAL {step})::DATE AS period_end,
           strftime(date_trunc('{grain}', {date}) + INTERVAL {step}, '%Y-%m') AS period_label,
           {key}, count(DISTINCT {column}) AS {column}_nunique
    FROM {table} GROUP BY ALL
    """
        for grain, step in steps.items()
    )


@query("distinct_by_periods", _distinct_sql("orders", "o_orderdate", "o_custkey", "o_orderstatus"))
def _(t: Tables) -> DataFrame:
    return distinct_by_periods(t.orders, "o_orderdate", "o_custkey", keys=["o_orderstatus"])


@query("distinct_by_periods_text", _distinct_sql("orders", "o_orderdate", "o_orderpriority", "o_orderstatus"))
def _(t: Tables) -> DataFrame:
    return distinct_by_periods(t.orders, "o_orderdate", "o_orderpriority", keys=["o_orderstatus"])


def _resample_sql(start: str, end: str) -> str:
    return f"""
    SELECT period_start, {end} AS period_end, strftime({end}, '%Y-%m') AS period_label,
           round(sum(o_totalprice), 2) AS o_totalprice_sum,
           count(o_totalprice) AS o_totalprice_count
    FROM (SELECT {start} AS period_start, o_totalprice FROM orders)
    GROUP BY period_start
    """


def _resample(t: Tables, period: str) -> DataFrame:
    out = resample(t.orders, "o_orderdate", period, "sum:o_totalprice,count:o_totalprice")
    return rounded(out, o_totalprice_sum=2)


@query(
    "resample_week",
    _resample_sql("date_trunc('week', o_orderdate)::DATE", "(period_start + 6)::DATE"),
)
def _(t: Tables) -> DataFrame:
    return _resample(t, "week")


@query(
    "resample_month",
    _resample_sql("date_trunc('month', o_orderdate)::DATE", "last_day(period_start)"),
)
def _(t: Tables) -> DataFrame:
    return _resample(t, "month")


@query(
    "resample_quarter",
    _resample_sql(
        "date_trunc('quarter', o_orderdate)::DATE", "last_day(period_start + INTERVAL 2 MONTH)"
    ),
)
def _(t: Tables) -> DataFrame:
    return _resample(t, "quarter")


@query(
    "resample_multi_key",
    """
    SELECT date_trunc('month', l_shipdate)::DATE AS period_start,
           last_day(l_shipdate) AS period_end, strftime(last_day(l_shipdate), '%Y-%m') AS period_label,
           l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS l_quantity_sum,
           round(median(l_quantity), 2) AS l_quantity_median
    FROM lineitem GROUP BY ALL
    """,
)
def _(t: Tables) -> DataFrame:
    out = resample(
        t.lineitem,
        "l_shipdate",
        "month",
        "sum:l_quantity,median:l_quantity",
        ["l_returnflag", "l_linestatus"],
    )
    return rounded(out, l_quantity_sum=2, l_quantity_median=2)


@query(
    "resample_gap_fill",
    """
    WITH held AS (SELECT date_trunc('week', o_orderdate::DATE + 60 * (year(o_orderdate) - 1995)::INTEGER)::DATE AS w,
                         o_totalprice, o_custkey FROM orders),
    weeks AS (SELECT unnest(generate_series((SELECT min(w) FROM held)::TIMESTAMP,
                                            (SELECT max(w) FROM held)::TIMESTAMP,
                                            INTERVAL 7 DAY))::DATE AS w)
    SELECT weeks.w AS period_start, (weeks.w + 6)::DATE AS period_end,
           strftime((weeks.w + 6)::DATE, '%Y-%m') AS period_label,
           coalesce(round(sum(o_totalprice), 2), 0) AS o_totalprice_sum,
           max(o_totalprice) AS o_totalprice_max,
           count(DISTINCT o_custkey) AS o_custkey_nunique
    FROM weeks LEFT JOIN held ON held.w = weeks.w GROUP BY weeks.w
    """,
)
def _(t: Tables) -> DataFrame:
    # years are moved apart, so weeks between them are empty
    apart = F.date_add(F.to_date("o_orderdate"), 60 * (F.year("o_orderdate") - 1995))
    out = resample_filled(
        t.orders.withColumn("day", apart), "day", "week", "sum:o_totalprice,max:o_totalprice,nunique:o_custkey"
    )
    return rounded(out, o_totalprice_sum=2)


def _pivot_sql(cell: str) -> str:
    cells = ", ".join(
        f"coalesce({cell.format(v)}, 0) AS \"{v}\"" for v in ("F", "O", "P")
    )
    return f"SELECT o_orderpriority, {cells} FROM orders GROUP BY o_orderpriority"


@query(
    "pivot_sum",
    _pivot_sql("round(sum(CASE WHEN o_orderstatus = '{}' THEN o_totalprice END), 2)"),
)
def _(t: Tables) -> DataFrame:
    out = pivot(t.orders, ["o_orderpriority"], "o_orderstatus", "sum:o_totalprice")
    return rounded(out, F=2, O=2, P=2)


@query(
    "pivot_count",
    """
    SELECT user_id,
           count(CASE WHEN event_type = 'click' THEN value END) AS click,
           count(CASE WHEN event_type = 'purchase' THEN value END) AS purchase,
           count(CASE WHEN event_type = 'signup' THEN value END) AS signup,
           count(CASE WHEN event_type = 'view' THEN value END) AS "view"
    FROM events WHERE event_type <> 'error' GROUP BY user_id
    """,
)
def _(t: Tables) -> DataFrame:
    # a null pivot value makes no column
    rows = t.events.withColumn("event_type", F.nullif(c("event_type"), F.lit("error")))
    return pivot(rows, ["user_id"], "event_type", "count:value,sum:value")


@query(
    "pivot_mean",
    _pivot_sql("round(avg(CASE WHEN o_orderstatus = '{}' THEN o_totalprice END), 6)"),
)
def _(t: Tables) -> DataFrame:
    out = pivot(
        t.orders, ["o_orderpriority"], "o_orderstatus", "mean:o_totalprice", ["F", "O", "P"]
    )
    return rounded(out, F=6, O=6, P=6)


@query(
    "analyze_total",
    """
    SELECT user_id, count(value) AS value_count, (SELECT count(DISTINCT user_id) FROM events) AS total_groups
    FROM events GROUP BY user_id ORDER BY value_count DESC, user_id LIMIT 20
    """,
)
def _(t: Tables) -> DataFrame:
    return analyze(t.events, "user_id", "count:value", sort="value_count desc", limit=20)


STATUS_NAMES = {"F": "final", "O": "open", "P": "open"}
PRIORITY_NAMES = {"1-URGENT": "high", "2-HIGH": "high", "5-LOW": "4-NOT SPECIFIED"}


@query(
    "analyze_normalized",
    """
    SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high'
                WHEN o_orderpriority = '5-LOW' THEN '4-NOT SPECIFIED'
                ELSE o_orderpriority END AS o_orderpriority,
           CASE o_orderstatus WHEN 'F' THEN 'final' ELSE 'open' END AS o_orderstatus,
           round(sum(o_totalprice), 2) AS o_totalprice_sum, count(o_totalprice) AS o_totalprice_count
    FROM orders WHERE o_orderpriority <> '2-HIGH' OR o_orderstatus <> 'F' GROUP BY ALL
    """,
)
def _(t: Tables) -> DataFrame:
    out = analyze(
        t.orders,
        groupby="o_orderpriority,o_orderstatus",
        aggregate="sum:o_totalprice,count:o_totalprice",
        where="o_orderpriority <> '2-HIGH' or o_orderstatus <> 'F'",
        value_maps={"o_orderpriority": PRIORITY_NAMES, "o_orderstatus": STATUS_NAMES},
    )
    return rounded(out, o_totalprice_sum=2)


def _from_store(t: Tables) -> tuple[DataFrame, DataFrame]:
    # an entry per order status, of which that of finished orders is one of this table
    entry = F.concat(F.lit('{"'), F.min("o_orderpriority"), F.lit('": "least of '), c("o_orderstatus"), F.lit('"}'))
    store = t.orders.groupBy("o_orderstatus").agg(entry.alias("context")).select(
        F.when(c("o_orderstatus") == "F", "orders").otherwise("other table").alias("table_name"),
        F.lit("o_orderpriority").alias("field_name"),
        F.lit("value_map").alias("context_type"),
        "context",
    )
    return analyze_from_store(
        t.orders, "orders", store, "o_orderpriority", aggregate="count:o_orderkey", where="o_totalprice > 1000"
    )


_LEAST = "(SELECT min(o_orderpriority) FROM orders WHERE o_orderstatus = 'F')"


@query(
    "analyze_from_store",
    f"""
    SELECT CASE WHEN o_orderpriority = {_LEAST} THEN 'least of F' ELSE o_orderpriority END AS o_orderpriority,
           count(o_orderkey) AS o_orderkey_count
    FROM orders WHERE o_totalprice > 1000 GROUP BY 1
    """,
)
def _(t: Tables) -> DataFrame:
    return _from_store(t)[0]


@query(
    "analyze_from_store_notes",
    f"""
    SELECT 'o_orderpriority' AS field, o_orderpriority AS old, 'least of F' AS new, count(*) AS count
    FROM orders WHERE o_totalprice > 1000 AND o_orderpriority = {_LEAST} GROUP BY ALL
    """,
)
def _(t: Tables) -> DataFrame:
    return _from_store(t)[1]


@query(
    "normalization_notes",
    """
    SELECT 'o_orderpriority' AS field, o_orderpriority AS old, m.new, count(*) AS count
    FROM orders JOIN (VALUES ('1-URGENT', 'high'), ('2-HIGH', 'high'), ('5-LOW', '4-NOT SPECIFIED'),
                             ('6-NONE', 'none')) AS m(old, new) ON o_orderpriority = m.old
    GROUP BY o_orderpriority, m.new
    UNION ALL
    SELECT 'o_orderstatus', o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'final' ELSE 'open' END, count(*)
    FROM orders GROUP BY o_orderstatus
    """,
)
def _(t: Tables) -> DataFrame:
    maps = {
        "o_orderpriority": {**PRIORITY_NAMES, "6-NONE": "none"},
        "o_orderstatus": STATUS_NAMES,
    }
    return normalization_notes(t.orders, maps)


@query(
    "pivot_normalized",
    """
    WITH o AS (SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high'
                           WHEN o_orderpriority = '5-LOW' THEN '4-NOT SPECIFIED'
                           ELSE o_orderpriority END AS o_orderpriority,
                      CASE o_orderstatus WHEN 'F' THEN 'final' ELSE 'open' END AS status, o_totalprice
               FROM orders WHERE o_orderstatus <> 'O' OR o_totalprice > 50000)
    SELECT o_orderpriority, count(CASE WHEN status = 'final' THEN o_totalprice END) AS "final",
           count(CASE WHEN status = 'open' THEN o_totalprice END) AS "open"
    FROM o GROUP BY o_orderpriority
    """,
)
def _(t: Tables) -> DataFrame:
    return analyze(
        t.orders,
        groupby="o_orderpriority",
        pivot_column="o_orderstatus",
        aggregate="count:o_totalprice",
        where="o_orderstatus <> 'O' or o_totalprice > 50000",
        value_maps={"o_orderpriority": PRIORITY_NAMES, "o_orderstatus": STATUS_NAMES},
        limit=None,
    )


@query(
    "analyze_period",
    """
    SELECT date_trunc('quarter', o_orderdate)::DATE AS period_start,
           last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH) AS period_end,
           strftime(last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH), '%Y-%m') AS period_label,
           CASE o_orderstatus WHEN 'F' THEN 'final' ELSE 'open' END AS o_orderstatus,
           round(median(o_totalprice), 4) AS o_totalprice_median,
           count(DISTINCT o_custkey) AS o_custkey_nunique
    FROM orders GROUP BY ALL
    """,
)
def _(t: Tables) -> DataFrame:
    out = analyze(
        t.orders,
        groupby="o_orderdate,o_orderstatus",
        period="quarter",
        aggregate="median:o_totalprice,nunique:o_custkey",
        value_maps={"o_orderstatus": STATUS_NAMES},
        limit=None,
    )
    return rounded(out, o_totalprice_median=4)
