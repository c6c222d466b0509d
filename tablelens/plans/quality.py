"""Data-quality and profiling queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json_paths import json_path_profile, json_schema
from ..functions.json_types import json_type_profile
from ..operators.quality import (
    date_column_profile,
    fk_match_rate,
    fk_orphans,
    key_completeness,
    pk_duplicates,
    pk_integrity,
    quality_report,
    quality_summary,
    type_consistency,
)
from .registry import Tables, query

c = F.col


def _moved(key: str, when: Column) -> Column:
    """The key, or where `when` holds a negative number that no row refers to."""
    return F.when(when, -1 - c(key)).otherwise(c(key))


@query(
    "fk_orphans",
    """
    SELECT o_custkey, count(*) AS rows FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment <> 'BUILDING')
    GROUP BY o_custkey
    """,
)
def _(t: Tables) -> DataFrame:
    # the keys of one segment are other ones, so its orders have no parent
    parents = t.customer.withColumn("c_custkey", _moved("c_custkey", c("c_mktsegment") == "BUILDING"))
    return fk_orphans(t.orders, "o_custkey", parents, "c_custkey")


@query(
    "fk_match_rate",
    """
    SELECT relation, count(*) AS checked, count(*) FILTER (hit) AS matches,
           count(*) FILTER (NOT hit) AS misses, round(count(*) FILTER (hit) / count(*), 6) AS match_rate
    FROM (
      SELECT 'lineitem.l_orderkey' AS relation,
             l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') AS hit FROM lineitem
      UNION ALL SELECT 'lineitem.l_partkey', l_partkey IN (SELECT p_partkey FROM part) FROM lineitem
      UNION ALL SELECT 'labels.doc_id',
             doc_id IN (SELECT doc_id FROM documents WHERE lang = 'en') FROM labels)
    GROUP BY relation
    """,
)
def _(t: Tables) -> DataFrame:
    lines = t.lineitem
    settled = t.orders.withColumn("o_orderkey", _moved("o_orderkey", c("o_orderstatus") == "P"))
    english = t.documents.withColumn("doc_id", _moved("doc_id", c("lang") != "en"))
    rates = (
        fk_match_rate(lines, "l_orderkey", settled, "o_orderkey", "lineitem.l_orderkey")
        .unionByName(fk_match_rate(lines, "l_partkey", t.part, "p_partkey", "lineitem.l_partkey"))
        .unionByName(fk_match_rate(t.labels, "doc_id", english, "doc_id", "labels.doc_id"))
    )
    return rates.withColumn("match_rate", F.round("match_rate", 6))


@query(
    "pk_duplicates",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    """,
)
def _(t: Tables) -> DataFrame:
    return pk_duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "dq_pk_integrity",
    """
    WITH k AS (SELECT CASE p_type WHEN 'PROMO' THEN '' WHEN 'SMALL' THEN '-' || p_partkey
                      WHEN 'LARGE' THEN NULL ELSE 'R-' || p_partkey END AS pk FROM part)
    SELECT count(*) AS rows, count(*) FILTER (coalesce(pk, '') = '') AS empty,
           count(*) FILTER (regexp_matches(pk, '^-[0-9]+$')) AS truncated
    FROM k
    """,
)
def _(t: Tables) -> DataFrame:
    kind, number = c("p_type"), c("p_partkey").cast("string")
    key = (
        F.when(kind == "PROMO", F.lit(""))
        .when(kind == "SMALL", F.concat(F.lit("-"), number))
        .when(kind != "LARGE", F.concat(F.lit("R-"), number))
    )
    return pk_integrity(t.part.select(key.alias("pk")), "pk")


@query(
    "dq_type_consistency",
    """
    WITH r AS (SELECT CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE 'n' END AS amount_kind,
                      o_orderpriority, o_orderstatus FROM orders)
    SELECT 'o_orderkey' AS field, 'number' AS declared, count(*) AS checked, 0 AS mismatches FROM r
    UNION ALL
    SELECT 'amount', 'number', count(*) FILTER (o_orderpriority <> '5-LOW'),
           count(*) FILTER (o_orderpriority <> '5-LOW' AND amount_kind = 'unknown') FROM r
    UNION ALL
    SELECT 'placed', 'date', count(*), count(*) FILTER (o_orderpriority = '2-HIGH') FROM r
    UNION ALL SELECT 'o_orderdate', 'datetime', count(*), 0 FROM r
    UNION ALL SELECT 'o_orderstatus', 'text', count(*), 0 FROM r
    UNION ALL SELECT 'o_custkey', 'text', count(*), count(*) FROM r
    """,
)
def _(t: Tables) -> DataFrame:
    amount = (
        F.when(c("o_orderpriority") == "5-LOW", F.lit(""))
        .when(c("o_orderstatus") == "P", F.lit("unknown"))
        .otherwise(c("o_totalprice").cast("string"))
    )
    placed = F.when(c("o_orderpriority") == "2-HIGH", F.lit("soon")).otherwise(
        F.date_format("o_orderdate", "M/d/yyyy")
    )
    rows = t.orders.withColumns({"amount": amount, "placed": placed})
    declared = {
        "o_orderkey": "number",
        "amount": "number",
        "placed": "date",
        "o_orderdate": "datetime",
        "o_orderstatus": "text",
        "o_custkey": "text",
    }
    return type_consistency(rows, declared)


def _documents(t: Tables) -> DataFrame:
    """Every order as a JSON document whose keys and value types vary by row."""
    paid = F.when(c("o_orderstatus") != "P", c("o_orderstatus") == "F")
    fields = F.struct(
        c("o_orderkey").alias("id"),
        c("o_totalprice").alias("total"),
        F.when(c("o_orderpriority") != "5-LOW", F.date_format("o_orderdate", "yyyy-MM-dd")).alias(
            "placed"
        ),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("logged"),
        paid.alias("paid"),
        c("o_orderpriority").alias("note"),
    )
    doc = F.when(c("o_orderpriority") == "3-MEDIUM", F.lit("not json")).otherwise(
        F.to_json(fields, {"ignoreNullFields": "false"})
    )
    short = F.when(c("o_orderstatus") == "O", F.to_json(F.struct(c("o_orderkey").cast("string").alias("id"))))
    return t.orders.select(F.coalesce(F.when(c("o_totalprice") > 400000, short), doc).alias("doc"))


_DOCS_SQL = """
    src AS (SELECT *, o_totalprice > 400000 AND o_orderstatus = 'O' AS short FROM orders),
    full_doc AS (SELECT * FROM src WHERE NOT short AND o_orderpriority <> '3-MEDIUM'),
    entries AS (
      SELECT 'id' AS key, 'number' AS type FROM full_doc
      UNION ALL SELECT 'id', 'text' FROM src WHERE short
      UNION ALL SELECT 'total', 'decimal' FROM full_doc
      UNION ALL SELECT 'placed', CASE WHEN o_orderpriority = '5-LOW' THEN 'unknown' ELSE 'date' END FROM full_doc
      UNION ALL SELECT 'logged', 'datetime' FROM full_doc
      UNION ALL SELECT 'paid', CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE 'boolean' END FROM full_doc
      UNION ALL SELECT 'note', 'text' FROM full_doc)
"""


@query(
    "json_type_profile",
    f"""
    WITH {_DOCS_SQL},
    n AS (SELECT key, type, count(*) AS n FROM entries GROUP BY key, type),
    d AS (SELECT key, first(type ORDER BY (type = 'unknown'), n DESC, type) AS dominant,
                 sum(n)::BIGINT AS "values" FROM n GROUP BY key)
    SELECT key, type, n, dominant, "values" FROM n JOIN d USING (key)
    """,
)
def _(t: Tables) -> DataFrame:
    return json_type_profile(_documents(t), "doc")


@query(
    "key_completeness",
    f"""
    WITH {_DOCS_SQL},
    p AS (SELECT key, count(*) AS present, count(*) FILTER (type <> 'unknown') AS filled
          FROM entries GROUP BY key),
    declared AS (SELECT unnest(['id', 'total', 'placed', 'paid', 'customer']) AS key)
    SELECT key, CASE WHEN p.key IS NULL THEN 'missing' WHEN declared.key IS NULL THEN 'extra'
                     ELSE 'ok' END AS status,
           coalesce(present, 0) AS present,
           round(coalesce(filled, 0) / (SELECT count(*) FROM orders), 6) AS fill_rate
    FROM p FULL JOIN declared USING (key)
    """,
)
def _(t: Tables) -> DataFrame:
    out = key_completeness(_documents(t), "doc", ["id", "total", "placed", "paid", "customer"])
    return out.withColumn("fill_rate", F.round("fill_rate", 6))


def _nested(t: Tables) -> DataFrame:
    """Orders with their lines as JSON texts; the customer is an object, or a bare number in closed orders."""
    line = F.struct(
        c("l_partkey").alias("part"),
        F.when(c("l_returnflag") != "R", F.date_format("l_shipdate", "yyyy-MM-dd")).alias("shipped"),
        F.array("l_returnflag", "l_linestatus").alias("marks"),
    )
    lines = t.lineitem.groupBy(c("l_orderkey").alias("o_orderkey")).agg(F.collect_list(line).alias("lines"))
    keep = {"ignoreNullFields": "false"}
    status = F.when(c("o_orderstatus") != "P", c("o_orderstatus")).alias("status")
    customer = F.to_json(F.struct(c("o_custkey").alias("key"), status), keep)
    customer = F.when(c("o_orderstatus") == "F", c("o_custkey").cast("string")).otherwise(customer)
    held = F.coalesce(F.to_json("lines", keep), F.lit("[]"))
    doc = F.format_string('{"id": %d, "customer": %s, "all lines": %s}', "o_orderkey", customer, held)
    return t.orders.join(lines, "o_orderkey", "left").select("o_orderpriority", doc.alias("doc"))


@query(
    "json_path_profile",
    """
    WITH l AS (SELECT lineitem.* FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    e AS (
      SELECT NULL AS parent, '$' AS path, 'object' AS type, count(*) AS n FROM orders
      UNION ALL SELECT '$', '$.id', 'number', count(*) FROM orders
      UNION ALL SELECT '$', '$.customer', if(o_orderstatus = 'F', 'number', 'object'), count(*) FROM orders GROUP BY ALL
      UNION ALL SELECT '$.customer', '$.customer.key', 'number', count(*) FROM orders WHERE o_orderstatus <> 'F'
      UNION ALL SELECT '$.customer', '$.customer.status', if(o_orderstatus = 'P', 'unknown', 'text'), count(*)
        FROM orders WHERE o_orderstatus <> 'F' GROUP BY ALL
      UNION ALL SELECT '$', '$[''all lines'']', 'array', count(*) FROM orders
      UNION ALL SELECT '$[''all lines'']', '$[''all lines''][]', 'object', count(*) FROM l
      UNION ALL SELECT '$[''all lines''][]', '$[''all lines''][].part', 'number', count(*) FROM l
      UNION ALL SELECT '$[''all lines''][]', '$[''all lines''][].shipped', if(l_returnflag = 'R', 'unknown', 'date'), count(*)
        FROM l GROUP BY ALL
      UNION ALL SELECT '$[''all lines''][]', '$[''all lines''][].marks', 'array', count(*) FROM l
      UNION ALL SELECT '$[''all lines''][].marks', '$[''all lines''][].marks[]', 'text', 2 * count(*) FROM l),
    p AS (SELECT parent, path, first(type ORDER BY (type = 'unknown'), n DESC, type) AS dominant,
                 sum(n)::BIGINT AS "values", coalesce(sum(n) FILTER (type <> 'unknown'), 0)::BIGINT AS filled FROM e GROUP BY ALL)
    SELECT e.path, e.type, e.n, p.dominant, p."values",
           if(e.parent IS NULL OR e.path = e.parent || '[]', p."values", o.n) AS within,
           round(filled / if(e.parent IS NULL OR e.path = e.parent || '[]', p."values", o.n), 6) AS fill_rate
    FROM e JOIN p ON e.path = p.path LEFT JOIN e o ON o.path = e.parent AND o.type = 'object'
    WHERE e.n > 0
    """,
)
def _(t: Tables) -> DataFrame:
    return json_path_profile(_nested(t), "doc").withColumn("fill_rate", F.round("fill_rate", 6))


@query(
    "json_schema_tree",
    """
    SELECT o_orderpriority, 'OBJECT<`all lines`: ARRAY<OBJECT<marks: ARRAY<STRING>, part: BIGINT, shipped: STRING>>, '
      || CASE WHEN bool_or(o_orderstatus = 'F') AND bool_or(o_orderstatus <> 'F') THEN 'customer: VARIANT'
              WHEN bool_or(o_orderstatus = 'F') THEN 'customer: BIGINT'
              ELSE 'customer: OBJECT<key: BIGINT, status: STRING>' END || ', id: BIGINT>' AS schema
    FROM orders GROUP BY o_orderpriority
    """,
)
def _(t: Tables) -> DataFrame:
    return json_schema(_nested(t), "doc", ["o_orderpriority"])


@query(
    "event_property_types",
    """
    SELECT e.key, 'number' AS type, count(*) AS n, 'number' AS dominant, count(*) AS "values"
    FROM (SELECT unnest(json_keys(props)) AS key FROM events) e GROUP BY e.key
    """,
)
def _(t: Tables) -> DataFrame:
    return json_type_profile(t.events, "props")


@query(
    "date_column_profile",
    """
    SELECT 'l_shipdate' AS field, min(l_shipdate)::DATE AS first_day, max(l_shipdate)::DATE AS last_day,
           0.0::DOUBLE AS null_rate, count(DISTINCT l_shipdate::DATE) AS days,
           round(count(*) / count(DISTINCT l_shipdate::DATE), 6) AS rows_per_day
    FROM lineitem
    UNION ALL
    SELECT 'returned_on', min(d), max(d), round(1 - count(d) / count(*), 6), count(DISTINCT d),
           round(count(d) / count(DISTINCT d), 6)
    FROM (SELECT CASE WHEN l_returnflag = 'R' THEN l_shipdate::DATE + 14 END AS d FROM lineitem)
    """,
)
def _(t: Tables) -> DataFrame:
    back = F.when(c("l_returnflag") == "R", F.date_add(F.to_date("l_shipdate"), 14))
    out = date_column_profile(t.lineitem.withColumn("returned_on", back))
    return out.withColumns(
        {n: F.round(n, 6) for n in ("null_rate", "rows_per_day")}
    )


def _report(t: Tables) -> DataFrame:
    tables = {
        "orders": t.orders.withColumn("o_orderkey", _moved("o_orderkey", c("o_orderstatus") == "P")),
        "lineitem": t.lineitem,
        "customer": t.customer,
        "part": t.part.withColumn("p_partkey", F.when(c("p_type") != "PROMO", c("p_partkey"))),
    }
    keys = {
        "orders": ["o_orderkey"],
        "lineitem": ["l_orderkey", "l_linenumber"],
        "part": ["p_partkey"],
    }
    relations = [
        ("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("orders", "o_custkey", "customer", "c_custkey"),
    ]
    types = {"customer": {"c_custkey": "number", "c_name": "text", "c_acctbal": "datetime"}}
    return quality_report(tables, keys, relations, types)


@query(
    "dq_report",
    """
    WITH dup AS (SELECT count(*) AS n FROM (SELECT 1 FROM lineitem
                 GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)),
    miss AS (SELECT count(*) AS n FROM lineitem
             WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'))
    SELECT * FROM (VALUES
      ('pk_filled', 'orders', 'o_orderkey', 'PASS', 0),
      ('pk_unique', 'orders', 'o_orderkey', 'PASS', 0),
      ('pk_filled', 'lineitem', 'l_orderkey,l_linenumber', 'PASS', 0),
      ('pk_format', 'lineitem', 'l_orderkey,l_linenumber', 'PASS', 0),
      ('pk_format', 'part', 'p_partkey', 'PASS', 0),
      ('fk_match', 'orders', 'o_custkey', 'PASS', 0),
      ('type', 'customer', 'c_custkey', 'PASS', 0), ('type', 'customer', 'c_name', 'PASS', 0))
      AS v("check", "table", field, status, n)
    UNION ALL SELECT 'pk_unique', 'lineitem', 'l_orderkey,l_linenumber',
                     CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END, n FROM dup
    UNION ALL SELECT 'fk_match', 'lineitem', 'l_orderkey',
                     CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END, n FROM miss
    UNION ALL SELECT 'type', 'customer', 'c_acctbal', 'FAIL', count(*) FROM customer
    UNION ALL SELECT 'pk_format', 'orders', 'o_orderkey', 'FAIL', count(*) FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'pk_filled', 'part', 'p_partkey', 'FAIL', count(*) FROM part WHERE p_type = 'PROMO'
    UNION ALL SELECT 'pk_unique', 'part', 'p_partkey', 'FAIL', 1
    """,
)
def _(t: Tables) -> DataFrame:
    return _report(t)


@query(
    "dq_summary",
    """
    WITH dup AS (SELECT count(*) AS n FROM (SELECT 1 FROM lineitem
                 GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)),
    miss AS (SELECT count(*) AS n FROM lineitem
             WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')),
    s AS (SELECT CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status, 1 AS k FROM dup
          UNION ALL SELECT CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END, 1 FROM miss
          UNION ALL VALUES ('FAIL', 4), ('PASS', 8))
    SELECT status, sum(k)::BIGINT AS checks FROM s GROUP BY status
    """,
)
def _(t: Tables) -> DataFrame:
    return quality_summary(_report(t))
