"""Labelling strings by ordered rules, with scoped overrides and enrichment."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.projection import fresh, quoted
from .joins import lookup_join
from .normalize import parse_value_map


@dataclass(frozen=True)
class Rule:
    """A string matching `pattern` gets the label; no pattern matches everything."""

    name: str
    pattern: str | None
    label: str
    confidence: str = "high"


# The shipped rules for field names, first match wins.
NAME_RULES = (
    Rule("pk_prefix", r"^_k[pP]_|^_pk_", "key", "high"),
    Rule("fk_prefix", r"^_k[fF]_|^_fk_", "key", "high"),
    Rule("speed_calc", r"^_sp_", "internal", "high"),
    Rule("global_g", r"^g[A-Z]", "internal", "medium"),
    Rule("global_G", r"^G_", "internal", "medium"),
    Rule("utility_z", r"^zz?[A-Z]", "internal", "medium"),
    Rule("lc_upper", r"^[a-z][A-Z_]", "internal", "medium"),
    Rule("default", None, "stored", "low"),
)
# The narrower rules for the display tier of a field.
TIER_KEY = Rule("key_prefix", r"^_k[pf]_", "key")
TIER_RULES = (
    Rule("speed_prefix", r"^_sp_", "internal"),
    Rule("global_camel", r"^g\p{Lu}", "internal"),
    Rule("global_prefix", r"^G_", "internal"),
    Rule("other", None, "standard"),
)
# Annotation flags in order of strength and the class each one gives.
FLAG_CLASSES = (("calculation", "calculated"), ("summary", "summary"), ("global_", "global"))


def _outcome(label: Column | str, rule: str, confidence: str) -> Column:
    return F.struct(
        (label if isinstance(label, Column) else F.lit(label)).alias("class"),
        F.lit(rule).alias("rule"),
        F.lit(confidence).alias("confidence"),
    )


def rule_outcome(
    col: Column, rules: Sequence[Rule] = NAME_RULES, disabled: Column | None = None
) -> Column:
    """struct(class, rule, confidence) of the first rule that applies.

    `disabled` is an array column of rule names to pass over. The last rule
    has no pattern and always applies.
    """
    chain = None
    for rule in rules:
        if rule.pattern is None:
            continue
        hit = col.rlike(rule.pattern)
        if disabled is not None:
            hit = hit & ~F.array_contains(disabled, rule.name)
        outcome = _outcome(rule.label, rule.name, rule.confidence)
        chain = F.when(hit, outcome) if chain is None else chain.when(hit, outcome)
    last = rules[-1]
    fallback = _outcome(last.label, last.name, last.confidence)
    return fallback if chain is None else chain.otherwise(fallback)


def classify_by_rules(
    df: DataFrame, column: str, rules: Sequence[Rule] = NAME_RULES
) -> DataFrame:
    """Add class, rule and confidence for the strings of `column`."""
    return df.withColumn("_o", rule_outcome(df[column], rules)).select(
        *df.columns, "_o.class", "_o.rule", "_o.confidence"
    )


def tier_of(name: Column, flagged: Column | None = None) -> Column:
    """Display tier of a field name: key, internal or standard.

    Key names stay keys; `flagged` (any annotation flag is set) makes other
    fields internal before the name rules apply.
    """
    by_name = rule_outcome(name, TIER_RULES)["class"]
    if flagged is not None:
        by_name = F.when(F.coalesce(flagged, F.lit(False)), F.lit("internal")).otherwise(by_name)
    return F.when(name.rlike(TIER_KEY.pattern), F.lit(TIER_KEY.label)).otherwise(by_name)


def classify_tier(
    df: DataFrame, column: str, annotations: DataFrame | None = None, on: Sequence[str] = ()
) -> DataFrame:
    """Add `tier`; `annotations` holds the flag columns of FLAG_CLASSES, one row per `on` key."""
    if annotations is None:
        return df.withColumn("tier", tier_of(df[column]))
    flags = [name for name, _ in FLAG_CLASSES]
    any_flag = F.greatest(*[F.coalesce(F.col(f), F.lit(False)) for f in flags])
    name = fresh("_flagged", df)
    flagged = lookup_join(df, annotations.select(*map(quoted, on), any_flag.alias(name)), on)
    return flagged.withColumn("tier", tier_of(F.col(quoted(column)), F.col(name))).drop(name)


def disabled_rules(store: DataFrame) -> DataFrame:
    """(table_name, disabled): the rules switched off for a table; "*" stands for all tables.

    At most one entry per rule name is collected for a table.
    """
    entries = store.where(F.col("context_type") == "rule_override").select(
        "table_name", F.explode(parse_value_map(F.col("context"))).alias("rule", "state")
    )
    return (
        entries.where(F.col("state") == "disabled")
        .where(F.col("rule").isin(*[r.name for r in NAME_RULES]))
        .groupBy("table_name")
        .agg(F.collect_set("rule").alias("disabled"))
    )


def field_overrides(store: DataFrame) -> DataFrame:
    """(table_name, field_name, override): classes set by people.

    A class with a classification_source entry was written by a machine and
    is no override.
    """
    keys = ["table_name", "field_name"]
    machine = store.where(F.col("context_type") == "classification_source").select(*keys)
    named = ~F.coalesce(F.col("field_name"), F.lit("")).isin("", "*")
    human = store.where((F.col("context_type") == "field_class") & named)
    return (
        human.join(machine.distinct(), keys, "left_anti")
        .where(F.col("context") != "")
        .select(*keys, F.col("context").alias("override"))
    )


def classify_with_overrides(fields: DataFrame, store: DataFrame) -> DataFrame:
    """Classify (table_name, field_name) rows under the overrides of a context store.

    The store has columns (table_name, field_name, context_type, context) with
    one row per key. A person's class wins; else the first rule applies that
    is switched off neither for the table nor for all tables.
    """
    off = disabled_rules(store)
    everywhere = off.where(F.col("table_name") == "*").agg(F.max("disabled")).scalar()
    per_table = off.where(F.col("table_name") != "*")
    switched, chosen, found = fresh("_disabled", fields), fresh("_override", fields), fresh("_o", fields)
    joined = lookup_join(fields, per_table.withColumnRenamed("disabled", switched), ["table_name"])
    overrides = field_overrides(store).withColumnRenamed("override", chosen)
    joined = lookup_join(joined, overrides, ["table_name", "field_name"])
    none = F.array().cast("array<string>")
    disabled = F.concat(F.coalesce(F.col(switched), none), F.coalesce(everywhere, none))
    outcome = F.when(
        F.col(chosen).isNotNull(), _outcome(F.col(chosen), "override", "high")
    ).otherwise(rule_outcome(F.col("field_name"), NAME_RULES, disabled))
    return joined.withColumn(found, outcome).select(
        *map(quoted, fields.columns), f"{found}.class", f"{found}.rule", f"{found}.confidence"
    )


def conditional_enrich(classified: DataFrame, annotations: DataFrame, on: Sequence[str]) -> DataFrame:
    """Give low-confidence rows the class of their strongest annotation flag."""
    flags = [name for name, _ in FLAG_CLASSES]
    joined = lookup_join(classified, annotations.select(*on, *flags), on)
    chain = None
    for flag, label in FLAG_CLASSES:
        hit = F.coalesce(F.col(flag), F.lit(False)) & (F.col("confidence") == "low")
        outcome = _outcome(label, "metadata", "high")
        chain = F.when(hit, outcome) if chain is None else chain.when(hit, outcome)
    outcome = chain.otherwise(F.struct("class", "rule", "confidence"))
    rest = [c for c in classified.columns if c not in ("class", "rule", "confidence")]
    found = fresh("_o", joined)
    return joined.withColumn(found, outcome).select(
        *map(quoted, rest), f"{found}.class", f"{found}.rule", f"{found}.confidence"
    )


def label_name(name: str, rules: Sequence[Rule] = NAME_RULES) -> str:
    """The label of one column name, for choosing columns of a schema."""
    return next(r.label for r in rules if r.pattern is None or re.search(r.pattern, name))
