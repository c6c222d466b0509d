"""Labels by rules that are rows of a table, however many.

A chain of conditions tries every pattern on every value. Here the literal
start of a pattern is a key: a value looks its own starts up among those of the
rules, of each length that a rule has, as a walk down a trie would, and only
the rules found are tried as patterns. Different values are labelled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.projection import fresh, quoted

# a literal character or an escaped sign that no quantifier makes optional
_LITERALS = r"^\^((?:(?:[A-Za-z0-9_#@%&=:;,<>/' -]|\\[^A-Za-z0-9])(?![*?{]))*)"


def literal_start(pattern: Column) -> Column:
    """What every match of the pattern has to start with; empty where that is not plain to see.

    Only patterns bound to the start by `^` have one, and none with an
    alternative, as that may be another start.
    """
    start = F.regexp_replace(F.regexp_extract(pattern, _LITERALS, 1), r"\\(.)", "$1")
    return F.when(pattern.isNull() | pattern.contains("|"), F.lit("")).otherwise(start)


def classify_by_rule_table(
    df: DataFrame, column: str, rules: DataFrame, on: Sequence[str] = (), disabled: DataFrame | None = None
) -> DataFrame:
    """Add class, rule and confidence of the first rule that applies to the value of `column`.

    `rules` has rows (rule, pattern, class, confidence, priority); the smallest
    priority is first, then the smaller name, and a null pattern applies to
    every value, null too. `disabled` has rows (`on`, rule): rules passed over
    where these columns of `df` have these values. Where no rule applies, the
    three columns are null. The lengths of literal starts are collected, a
    few dozen numbers. Rules without a literal start are tried on every value.
    """
    value, hit, start = fresh("_value", df), fresh("_hit", df), "_start"
    by = [fresh(f"_on{i}", df) for i in range(len(on))]
    names = [*by, value]
    known = rules.select(
        "rule", "pattern", "class", "confidence", "priority", literal_start(F.col("pattern")).alias(start)
    )
    lengths = sorted(r[0] for r in known.select(F.length(start)).distinct().collect())
    values = df.select(
        *[F.col(quoted(k)).alias(n) for k, n in zip(on, by, strict=True)], F.col(quoted(column)).alias(value)
    ).distinct()
    # a start that is longer than the value is no start of it
    starts = F.array(*[F.when(F.coalesce(F.length(value), F.lit(0)) >= n, F.coalesce(F.substring(value, 1, n), F.lit(""))) for n in lengths])
    asked = values.withColumn(start, F.explode(starts.cast("array<string>"))).where(F.col(start).isNotNull())
    found = asked.join(known, start).where(F.coalesce(F.expr(f"{value} rlike pattern"), F.col("pattern").isNull()))
    if disabled is not None:
        off = disabled.select(*[F.col(quoted(k)).alias(f"{n}_off") for k, n in zip(on, by, strict=True)], F.col("rule").alias("_rule_off"))
        same = [F.col(n).eqNullSafe(F.col(f"{n}_off")) for n in by]
        found = found.join(off, [*same, F.col("rule") == F.col("_rule_off")], "left_anti")
    outcome = F.struct("class", "rule", "confidence")
    first = found.groupBy(*names).agg(F.min_by(outcome, F.struct("priority", "rule")).alias(hit))
    pairs = [F.col(quoted(k)).eqNullSafe(F.col(n)) for k, n in zip([*on, column], names, strict=True)]
    return df.join(first, pairs, "left").select(
        *map(quoted, df.columns), *[F.col(hit)[part].alias(part) for part in ("class", "rule", "confidence")]
    )
