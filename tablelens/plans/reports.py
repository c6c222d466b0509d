"""Reports as a user asks for them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as p
from ..operators.aggregate import group_agg
from ..operators.paging import order_by, top_rows
from .registry import Tables, query


@query(
    "report_by_category",
    """
    SELECT o_orderpriority,
           round(sum(o_totalprice), 2) AS o_totalprice_sum,
           count(o_totalprice) AS o_totalprice_count,
           round(avg(o_totalprice), 6) AS o_totalprice_mean
    FROM orders
    WHERE o_orderdate >= DATE '1998-01-01' AND o_orderdate < DATE '2000-01-01'
    GROUP BY o_orderpriority
    """,
)
def report_by_category(t: Tables) -> DataFrame:
    held = t.orders.where(p.day_range(F.col("o_orderdate"), "1998-01-01", "1999-12-31"))
    out = group_agg(
        held,
        ["o_orderpriority"],
        "sum:o_totalprice,count:o_totalprice,mean:o_totalprice",
    ).select(
        "o_orderpriority",
        F.round("o_totalprice_sum", 2).alias("o_totalprice_sum"),
        "o_totalprice_count",
        F.round("o_totalprice_mean", 6).alias("o_totalprice_mean"),
    )
    return order_by(out, "o_totalprice_sum desc,o_orderpriority")


@query(
    "report_recent_records",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate::DATE AS o_orderdate
    FROM orders
    WHERE o_orderdate >= DATE '2000-01-01' AND o_orderdate < DATE '2001-01-01'
    ORDER BY orders.o_orderdate DESC, o_orderkey LIMIT 5
    """,
)
def report_recent_records(t: Tables) -> DataFrame:
    held = t.orders.where(p.day_range(F.col("o_orderdate"), "2000-01-01", "2000-12-31"))
    return top_rows(held, "o_orderdate desc,o_orderkey", 5).select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        F.to_date("o_orderdate").alias("o_orderdate"),
    )


@query(
    "report_filtered_range",
    """
    SELECT o_orderkey, o_orderpriority, o_totalprice, o_orderdate::DATE AS o_orderdate
    FROM orders
    WHERE o_orderdate >= DATE '1997-03-01' AND o_orderdate < DATE '1997-06-01'
      AND o_orderpriority = '1-URGENT'
    """,
)
def report_filtered_range(t: Tables) -> DataFrame:
    held = t.orders.where(
        p.all_of(
            p.day_range(F.col("o_orderdate"), "1997-03-01", "1997-05-31"),
            p.eq(F.col("o_orderpriority"), "1-URGENT"),
        )
    )
    return held.select(
        "o_orderkey",
        "o_orderpriority",
        "o_totalprice",
        F.to_date("o_orderdate").alias("o_orderdate"),
    )
