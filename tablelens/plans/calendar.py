"""Queries over report periods and missing date ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.periods import period_bounds, period_filter_text, period_predicate
from ..operators.anchored import period_compare_anchors
from ..operators.calendar import period_compare
from ..operators.incremental import date_gaps
from .registry import Tables, query

c = F.col

ANCHOR = "2000-05-31"


def _periods_sql(day: str) -> str:
    """Rows (pattern, label, start, end) for one DATE expression, as DuckDB SQL."""
    d = day
    week = f"date_trunc('week', {d})::DATE"
    month = f"date_trunc('month', {d})::DATE"
    quarter = f"date_trunc('quarter', {d})::DATE"
    year = f"date_trunc('year', {d})::DATE"
    last_month = f"({month} - INTERVAL 1 MONTH)::DATE"
    last_quarter = f"({quarter} - INTERVAL 3 MONTH)::DATE"
    year_ago = f"({d} - INTERVAL 1 YEAR)::DATE"
    rows = [
        ("daily", "single", d, d),
        ("yesterday", "single", f"({d} - 1)", f"({d} - 1)"),
        ("wtd", "single", week, d),
        ("mtd", "single", month, d),
        ("full_month", "single", month, f"last_day({d})"),
        ("qtd", "single", quarter, d),
        ("ytd", "single", year, d),
        ("dod", "current", d, d),
        ("dod", "previous", f"({d} - 1)", f"({d} - 1)"),
        ("wow", "current", week, d),
        ("wow", "previous", f"({week} - 7)", f"({d} - 7)"),
        ("mom", "current", month, f"last_day({d})"),
        ("mom", "previous", last_month, f"last_day({last_month})"),
        ("cmtd_vs_pmtd", "current", month, d),
        ("cmtd_vs_pmtd", "previous", last_month, f"({d} - INTERVAL 1 MONTH)::DATE"),
        ("mtd_cy_vs_py", "current", month, d),
        ("mtd_cy_vs_py", "previous", f"({month} - INTERVAL 1 YEAR)::DATE", year_ago),
        ("ytd_cy_vs_py", "current", year, d),
        ("ytd_cy_vs_py", "previous", f"({year} - INTERVAL 1 YEAR)::DATE", year_ago),
        ("qtd_cq_vs_pq", "current", quarter, d),
        ("qtd_cq_vs_pq", "previous", last_quarter, f"({last_quarter} + ({d} - {quarter})::INTEGER)"),
        ("qtd_cq_vs_pq_py", "current", quarter, d),
        ("qtd_cq_vs_pq_py", "previous", f"({quarter} - INTERVAL 1 YEAR)::DATE", year_ago),
    ]
    structs = ", ".join(
        f"{{'pattern': '{p}', 'label': '{lab}', 'start': {s}, 'end': {e}}}" for p, lab, s, e in rows
    )
    return f"unnest([{structs}])"


@query(
    "period_bounds",
    f"""
    SELECT anchor, r.pattern, r.label, r.start, r."end" FROM (
      SELECT anchor, {_periods_sql("anchor")} AS r
      FROM (SELECT DISTINCT o_orderdate::DATE AS anchor FROM orders))
    """,
)
def _(t: Tables) -> DataFrame:
    anchors = t.orders.select(F.to_date("o_orderdate").alias("anchor")).distinct()
    return period_bounds(anchors, "anchor")


@query(
    "period_filter",
    f"""
    SELECT anchor, r.pattern, r.label,
           CASE WHEN r.start = r."end" THEN 'o_orderdate eq ' || r.start
                ELSE 'o_orderdate ge ' || r.start || ' and o_orderdate le ' || r."end" END AS filter
    FROM (SELECT anchor, {_periods_sql("anchor")} AS r
          FROM (SELECT DISTINCT o_orderdate::DATE AS anchor FROM orders))
    """,
)
def _(t: Tables) -> DataFrame:
    anchors = t.orders.select(F.to_date("o_orderdate").alias("anchor")).distinct()
    text = period_filter_text("o_orderdate", c("start"), c("end"))
    return period_bounds(anchors, "anchor").select(
        "anchor", "pattern", "label", text.alias("filter")
    )


@query(
    "period_rows",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate::DATE AS l_shipdate
    FROM lineitem WHERE l_shipdate >= DATE '2000-04-01' AND l_shipdate < DATE '2000-06-01'
    """,
)
def _(t: Tables) -> DataFrame:
    held = t.lineitem.where(period_predicate(c("l_shipdate"), "2000-04-01", "2000-05-31"))
    return held.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.to_date("l_shipdate").alias("l_shipdate"),
    )


def _compare_sql(aggs: str) -> str:
    return f"""
    SELECT k.o_orderpriority, p.r.pattern AS pattern, p.r.label AS label, p.r.start AS start,
           p.r."end" AS "end", {aggs}
    FROM (SELECT {_periods_sql(f"DATE '{ANCHOR}'")} AS r) p
    CROSS JOIN (SELECT DISTINCT o_orderpriority FROM orders
                WHERE o_orderdate >= DATE '1999-01-01' AND o_orderdate < DATE '2000-06-01') k
    LEFT JOIN orders o ON o.o_orderpriority = k.o_orderpriority
      AND o.o_orderdate >= p.r.start AND o.o_orderdate < p.r."end" + 1
    GROUP BY ALL
    """


@query(
    "period_compare",
    _compare_sql(
        """coalesce(round(sum(o_totalprice), 2), 0) AS o_totalprice_sum,
           count(o_totalprice) AS o_totalprice_count, max(o_totalprice) AS o_totalprice_max"""
    ),
)
def _(t: Tables) -> DataFrame:
    out = period_compare(
        t.orders,
        "o_orderdate",
        ANCHOR,
        "sum:o_totalprice,count:o_totalprice,max:o_totalprice",
        ["o_orderpriority"],
    )
    return out.withColumn("o_totalprice_sum", F.round("o_totalprice_sum", 2))


@query(
    "period_compare_distinct",
    f"""
    SELECT p.r.pattern AS pattern, p.r.label AS label, p.r.start AS start, p.r."end" AS "end",
           count(DISTINCT o_custkey) AS o_custkey_nunique,
           round(median(o_totalprice), 4) AS o_totalprice_median
    FROM (SELECT {_periods_sql(f"DATE '{ANCHOR}'")} AS r) p
    LEFT JOIN orders o ON o.o_orderdate >= p.r.start AND o.o_orderdate < p.r."end" + 1
    WHERE p.r.label <> 'single'
    GROUP BY ALL
    """,
)
def _(t: Tables) -> DataFrame:
    out = period_compare(
        t.orders, "o_orderdate", ANCHOR, "nunique:o_custkey,median:o_totalprice"
    )
    pairs = out.where(c("label") != "single")
    return pairs.withColumn("o_totalprice_median", F.round("o_totalprice_median", 4))


@query(
    "date_gaps",
    """
    WITH held AS (SELECT o_custkey, min(o_orderdate)::DATE AS lo, max(o_orderdate)::DATE AS hi
                  FROM orders GROUP BY o_custkey),
    ask AS (SELECT c_custkey, lo AS held_min, hi AS held_max,
                   CASE WHEN c_mktsegment <> 'BUILDING' THEN DATE '1996-01-01' END AS wanted_min,
                   CASE WHEN c_mktsegment <> 'MACHINERY' THEN DATE '2001-06-30' END AS wanted_max
            FROM customer LEFT JOIN held ON o_custkey = c_custkey)
    SELECT c_custkey, wanted_min AS gap_min, wanted_max AS gap_max FROM ask WHERE held_min IS NULL
    UNION ALL
    SELECT c_custkey, wanted_min, held_min - 1 FROM ask
    WHERE held_min IS NOT NULL AND (wanted_min IS NULL OR wanted_min < held_min)
    UNION ALL
    SELECT c_custkey, held_max + 1, wanted_max FROM ask
    WHERE held_min IS NOT NULL AND (wanted_max IS NULL OR wanted_max > held_max)
    """,
)
def _(t: Tables) -> DataFrame:
    held = t.orders.groupBy(c("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").alias("held_min"), F.max("o_orderdate").alias("held_max")
    )
    segment = c("c_mktsegment")
    wanted = t.customer.select(
        "c_custkey",
        F.when(segment != "BUILDING", F.lit("1996-01-01")).cast("date").alias("wanted_min"),
        F.when(segment != "MACHINERY", F.lit("2001-06-30")).cast("date").alias("wanted_max"),
    )
    # held is one row per customer, so no key of this join is hot
    return date_gaps(wanted.join(held, "c_custkey", "left")).select(
        "c_custkey", "gap_min", "gap_max"
    )


@query(
    "period_compare_per_customer",
    f"""
    WITH anchors AS (SELECT o_custkey, max(o_orderdate)::DATE AS anchor FROM orders GROUP BY o_custkey),
    periods AS (SELECT o_custkey, anchor, {_periods_sql("anchor")} AS p FROM anchors)
    SELECT periods.o_custkey, anchor, p.pattern AS pattern, p.label AS label, p.start AS start, p.end AS "end",
           coalesce(sum(o_totalprice::DECIMAL(15, 2)), 0)::DOUBLE AS o_totalprice_sum, count(o_totalprice) AS o_totalprice_count,
           min(o_totalprice) AS o_totalprice_min, max(o_totalprice) AS o_totalprice_max
    FROM periods LEFT JOIN orders ON orders.o_custkey = periods.o_custkey AND o_orderdate::DATE BETWEEN p.start AND p.end
    GROUP BY ALL
    """,
)
def _(t: Tables) -> DataFrame:
    # every customer has an anchor of its own: the day of its last order
    orders = t.orders.select("o_custkey", "o_orderdate", c("o_totalprice").cast("decimal(15,2)").alias("o_totalprice"))
    anchors = orders.groupBy("o_custkey").agg(F.max(F.to_date("o_orderdate")).alias("anchor"))
    found = period_compare_anchors(orders, "o_orderdate", anchors, "anchor", "sum:o_totalprice,count:o_totalprice,min:o_totalprice,max:o_totalprice", ["o_custkey"])
    return found.withColumns({f"o_totalprice_{f}": c(f"o_totalprice_{f}").cast("double") for f in ("sum", "min", "max")})
