"""Rules that are rows of a table against the chain of conditions and against plain code."""

from __future__ import annotations

import random
import re

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tablelens.operators.classify import NAME_RULES, classify_by_rules
from tablelens.operators.rule_tables import classify_by_rule_table, literal_start

RULES = "rule string, pattern string, class string, confidence string, priority int"


@pytest.mark.parametrize(
    "pattern, start",
    [
        ("^abc", "abc"), ("^abc+", "abc"), ("^abc*", "ab"), ("^abc?d", "ab"), ("^a{2}", ""), ("^a\\.b", "a.b"), ("^a\\.?b", "a"),
        ("^a\\d", "a"), ("^a|b", ""), ("abc", ""), ("(?i)^abc", ""), ("^", ""), ("^a[bc]", "a"), ("^_k[pP]_", "_k"), (None, ""), ("", ""),
    ],
)
def test_literal_start(spark, pattern, start):
    df = spark.createDataFrame([(pattern,)], "p string")
    assert df.select(literal_start(F.col("p"))).first()[0] == start


def test_table_of_the_name_rules_equals_the_chain(spark):
    parts = ["_kp_", "_kf", "_sp_", "g", "z", "zz", "c", "s_", "Name", "name", "_ID", "X", "", "1"]
    draw = random.Random(1)
    names = [("".join(draw.choices(parts, k=draw.randrange(4))),) for _ in range(300)] + [(None,)]
    df = spark.createDataFrame(names, "`the.name` string")
    rules = spark.createDataFrame([(r.name, r.pattern, r.label, r.confidence, i) for i, r in enumerate(NAME_RULES)], RULES)
    want = classify_by_rules(df.withColumnRenamed("the.name", "name"), "name")
    assert rows_of(classify_by_rule_table(df, "the.name", rules)) == rows_of(want)
    assert classify_by_rule_table(df.limit(0), "the.name", rules).collect() == []


def test_ten_thousand_rules_and_disabled_ones(spark):
    rules = [(f"r{i}", f"^{i}[a-c]", f"c{i % 7}", "high", 10_000 - i) for i in range(10_000)]
    rules += [("ends", "z$", "end", "low", 20_000), ("ends too", "z$", "same priority", "low", 20_000)]
    draw = random.Random(2)
    rows = [(draw.choice("st"), f"{draw.randrange(12_000)}{draw.choice('abdz')}{draw.choice(['', 'z'])}") for _ in range(400)]
    rows += [("s", None), (None, "7a"), (None, "7a"), ("t", "77a"), ("s", "77a")]
    off = [("s", "r77"), (None, "r7"), ("t", "no such rule"), ("t", "ends")]
    df, table = spark.createDataFrame(rows, "place string, v string"), spark.createDataFrame(rules, RULES)
    got = classify_by_rule_table(df, "v", table, ["place"], spark.createDataFrame(off, "place string, rule string"))
    by_number = {r[0]: r for r in rules}
    want = []
    for place, v in rows:
        number = re.match(r"\d+", v or "")
        near = [by_number[f"r{number[0][:n]}"] for n in range(1, len(number[0]) + 1) if f"r{number[0][:n]}" in by_number] if number else []
        hits = [r for r in [*near, *rules[-2:]] if v is not None and re.search(r[1], v) and (place, r[0]) not in off]
        best = min(hits, key=lambda r: (r[4], r[0]), default=None)
        want.append((place, v, *((best[2], best[0], best[3]) if best else (None, None, None))))
    assert rows_of(got) == sorted(want, key=repr)
