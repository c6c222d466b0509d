"""Queries that label, look up and enrich."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.classify import (
    classify_by_rules,
    classify_tier,
    classify_with_overrides,
    conditional_enrich,
)
from ..operators.joins import lookup_join
from ..operators.normalize import apply_value_map, value_map_rows
from ..operators.rule_tables import classify_by_rule_table
from .registry import Tables, query

c = F.col

_FIELD_SQL = """
    SELECT p_partkey, p_brand AS table_name, p_size,
           CASE p_type WHEN 'MEDIUM' THEN '_kp_' WHEN 'STANDARD' THEN '_kf_' WHEN 'LARGE' THEN '_sp_'
                WHEN 'PROMO' THEN 'g' WHEN 'SMALL' THEN 'zz' ELSE '' END
           || upper(p_name) AS field_name
    FROM part
"""
_RULES_SQL = """
    CASE WHEN field_name LIKE '\\_kp\\_%' ESCAPE '\\' THEN 'pk_prefix'
         WHEN field_name LIKE '\\_kf\\_%' ESCAPE '\\' THEN 'fk_prefix'
         WHEN field_name LIKE '\\_sp\\_%' ESCAPE '\\' THEN 'speed_calc'
         WHEN regexp_matches(field_name, '^g[A-Z]') THEN 'global_g'
         WHEN regexp_matches(field_name, '^G_') THEN 'global_G'
         WHEN regexp_matches(field_name, '^zz?[A-Z]') THEN 'utility_z'
         WHEN regexp_matches(field_name, '^[a-z][A-Z_]') THEN 'lc_upper'
         ELSE 'default' END
"""
_CLASS_SQL = """
    CASE WHEN rule IN ('pk_prefix', 'fk_prefix') THEN 'key' WHEN rule = 'default' THEN 'stored'
         ELSE 'internal' END
"""
_CONFIDENCE_SQL = """
    CASE WHEN rule IN ('pk_prefix', 'fk_prefix', 'speed_calc') THEN 'high'
         WHEN rule = 'default' THEN 'low' ELSE 'medium' END
"""


def _fields(t: Tables) -> DataFrame:
    """Every part as a field of the table named by its brand."""
    kind = c("p_type")
    prefix = (
        F.when(kind == "MEDIUM", F.lit("_kp_"))
        .when(kind == "STANDARD", F.lit("_kf_"))
        .when(kind == "LARGE", F.lit("_sp_"))
        .when(kind == "PROMO", F.lit("g"))
        .when(kind == "SMALL", F.lit("zz"))
        .otherwise(F.lit(""))
    )
    return t.part.select(
        "p_partkey",
        c("p_brand").alias("table_name"),
        "p_size",
        F.concat(prefix, F.upper("p_name")).alias("field_name"),
    )


@query(
    "classify_by_rules",
    f"""
    SELECT p_partkey, field_name, {_CLASS_SQL} AS "class", rule, {_CONFIDENCE_SQL} AS confidence
    FROM (SELECT *, {_RULES_SQL} AS rule FROM ({_FIELD_SQL}))
    """,
)
def _(t: Tables) -> DataFrame:
    return classify_by_rules(_fields(t).select("p_partkey", "field_name"), "field_name")


@query(
    "classify_tier",
    f"""
    SELECT p_partkey, field_name,
           CASE WHEN regexp_matches(field_name, '^_k[pf]_') THEN 'key'
                WHEN p_size > 40 THEN 'internal'
                WHEN regexp_matches(field_name, '^_sp_|^g[A-Z]|^G_') THEN 'internal'
                ELSE 'standard' END AS tier
    FROM ({_FIELD_SQL})
    """,
)
def _(t: Tables) -> DataFrame:
    size = c("p_size")
    flags = t.part.select(
        "p_partkey",
        (size > 45).alias("calculation"),
        ((size > 42) & (size <= 45)).alias("summary"),
        F.when(size > 40, size <= 42).alias("global_"),
    )
    fields = _fields(t).select("p_partkey", "field_name")
    return classify_tier(fields, "field_name", flags, ["p_partkey"])


@query(
    "classify_with_overrides",
    f"""
    WITH f AS ({_FIELD_SQL}),
    r AS (SELECT p_partkey, table_name, field_name,
            CASE WHEN table_name LIKE 'Brand#1%' AND field_name LIKE '\\_kp\\_%' ESCAPE '\\' THEN 'default'
                 WHEN regexp_matches(field_name, '^zz?[A-Z]') THEN 'default'
                 ELSE {_RULES_SQL} END AS rule
          FROM f)
    SELECT p_partkey, table_name, field_name,
           CASE WHEN field_name = 'RED WIDGET' AND table_name LIKE 'Brand#2%' THEN 'summary'
                ELSE {_CLASS_SQL} END AS "class",
           CASE WHEN field_name = 'RED WIDGET' AND table_name LIKE 'Brand#2%' THEN 'override'
                ELSE rule END AS rule,
           CASE WHEN field_name = 'RED WIDGET' AND table_name LIKE 'Brand#2%' THEN 'high'
                ELSE {_CONFIDENCE_SQL} END AS confidence
    FROM r
    """,
)
def _(t: Tables) -> DataFrame:
    fields = _fields(t).select("p_partkey", "table_name", "field_name")
    brands = t.part.select(c("p_brand").alias("table_name")).distinct()
    name = c("table_name")

    def entry(when, field: str, kind: str, context: str):
        names = ("field_name", "context_type", "context")
        cells = [F.lit(v).alias(n) for n, v in zip(names, (field, kind, context))]
        return F.when(when, F.struct(*cells))

    ones, twos = name.startswith("Brand#1"), name.startswith("Brand#2")
    rules = '{"pk_prefix": "disabled", "fk_prefix": "enabled"}'
    per_brand = F.array(
        entry(ones, "*", "rule_override", rules),
        entry(twos, "*", "rule_override", "no json"),
        entry(F.lit(True), "RED WIDGET", "field_class", "summary"),
        entry(~twos, "RED WIDGET", "classification_source", "default"),
    )
    store = brands.select(name, F.inline(F.array_compact(per_brand)))
    off = '{"utility_z": "disabled", "lc_upper": "disabled"}'
    everywhere = [["*"], ["*"], ["rule_override"], [off]]
    store = store.unionByName(
        t.spark.createDataFrame(pa.table(everywhere, names=store.columns))
    )
    return classify_with_overrides(fields, store)


@query(
    "conditional_enrich",
    f"""
    WITH r AS (SELECT p_partkey, field_name, p_size, {_RULES_SQL} AS rule FROM ({_FIELD_SQL})),
    k AS (SELECT *, CASE WHEN rule = 'default' AND p_size > 45 THEN 'calculated'
                         WHEN rule = 'default' AND p_size > 30 THEN 'summary'
                         WHEN rule = 'default' AND p_size > 20 THEN 'global' END AS better FROM r)
    SELECT p_partkey, field_name, coalesce(better, {_CLASS_SQL}) AS "class",
           CASE WHEN better IS NULL THEN rule ELSE 'metadata' END AS rule,
           CASE WHEN better IS NULL THEN {_CONFIDENCE_SQL} ELSE 'high' END AS confidence
    FROM k
    """,
)
def _(t: Tables) -> DataFrame:
    size = c("p_size")
    flags = t.part.select(
        "p_partkey",
        (size > 45).alias("calculation"),
        (size > 30).alias("summary"),
        F.when(size > 20, F.lit(True)).alias("global_"),
    )
    classified = classify_by_rules(_fields(t).select("p_partkey", "field_name"), "field_name")
    return conditional_enrich(classified, flags, ["p_partkey"])


@query(
    "value_map_parse",
    """
    SELECT event_id, 'k' AS old, props->>'$.k' AS new FROM events
    WHERE event_type <> 'error' AND event_type <> 'view'
    """,
)
def _(t: Tables) -> DataFrame:
    text = (
        F.when(c("event_type") == "error", F.lit("not json"))
        .when(c("event_type") == "view", F.concat(F.lit("["), "props", F.lit("]")))
        .otherwise(c("props"))
    )
    return value_map_rows(t.events.select("event_id", text.alias("map")), "map")


@query(
    "value_map_normalize",
    """
    SELECT doc_id, lang, CASE WHEN source IN (SELECT source FROM documents GROUP BY source
                                               HAVING count(*) < 50) THEN 'rare' ELSE source END AS source
    FROM documents
    """,
)
def _(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "lang", "source")
    rare = (
        docs.groupBy(c("source").alias("old"))
        .agg(F.count("*").alias("n"))
        .where(c("n") < 50)
        .select("old", F.lit("rare").alias("new"))
    )
    return apply_value_map(docs, "source", rare)


@query(
    "lookup_enrich",
    """
    SELECT e.event_id, e.user_id, c_name AS hint FROM events e LEFT JOIN customer ON c_custkey + 50 = user_id
    """,
)
def _(t: Tables) -> DataFrame:
    # some users have no hint, and every hint is there twice
    hints = t.customer.select((c("c_custkey") + 50).alias("user_id"), c("c_name").alias("hint"))
    hints = hints.union(hints)
    return lookup_join(t.events.select("event_id", "user_id"), hints, ["user_id"])


@query(
    "value_map_from_store",
    """
    SELECT p_partkey, CASE WHEN p_type LIKE 'S%' THEN p_type ELSE lower(p_type) END AS p_type FROM part
    """,
)
def _(t: Tables) -> DataFrame:
    # the store keeps one JSON map per kind; those of kinds in S are damaged
    kind = c("p_type")
    whole = F.to_json(F.create_map(kind, F.lower(kind)))
    text = F.when(kind.startswith("S"), F.lit("{broken")).otherwise(whole)
    store = t.part.select("p_type").distinct().select(text.alias("context"))
    return apply_value_map(
        t.part.select("p_partkey", "p_type"), "p_type", value_map_rows(store, "context")
    )


@query(
    "rules_from_table",
    """
    WITH rules AS (
      SELECT 'supplier ' || s_suppkey AS rule, '^' || s_suppkey || '[0-5]' AS pattern,
             'nation ' || s_nationkey AS class, s_suppkey AS priority FROM supplier
      UNION ALL SELECT 'tens', '[05]$', 'round', 1000000000 UNION ALL SELECT 'rest', NULL, 'other', 1000000001),
    found AS (
      SELECT o_orderkey, min_by({'class': class, 'rule': rule}, priority) AS hit FROM orders
      JOIN rules ON pattern IS NULL OR regexp_matches(o_orderkey::VARCHAR, pattern)
      WHERE NOT (o_orderstatus = 'F' AND rule = 'tens') GROUP BY o_orderkey)
    SELECT o_orderkey, hit.class AS class, hit.rule AS rule FROM found
    """,
)
def _(t: Tables) -> DataFrame:
    key = F.col("s_suppkey").cast("string")
    rules = t.supplier.select(
        F.concat(F.lit("supplier "), key).alias("rule"),
        F.concat(F.lit("^"), key, F.lit("[0-5]")).alias("pattern"),
        F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("class"),
        F.lit("high").alias("confidence"),
        F.col("s_suppkey").cast("long").alias("priority"),
    )
    general = t.spark.createDataFrame(
        [("tens", "[05]$", "round", "low", 1_000_000_000), ("rest", None, "other", "low", 1_000_000_001)], rules.schema
    )
    settled = t.orders.where("o_orderstatus = 'F'").select("o_orderstatus", F.lit("tens").alias("rule")).distinct()
    orders = t.orders.select("o_orderkey", "o_orderstatus", F.col("o_orderkey").cast("string").alias("number"))
    out = classify_by_rule_table(orders, "number", rules.unionByName(general), ["o_orderstatus"], settled)
    return out.select("o_orderkey", "class", "rule")
