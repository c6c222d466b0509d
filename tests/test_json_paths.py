"""Paths, types and fill rates of nested JSON against a walk of the parsed texts."""

from __future__ import annotations

import json
import random
from collections import Counter

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tablelens.functions import json_paths
from tablelens.functions.json_paths import json_depth, json_path_profile, json_schema


def kind(value):
    if value is None:
        return "unknown"
    for types, name in ((bool, "boolean"), (int, "number"), (float, "decimal"), (dict, "object"), (list, "array")):
        if isinstance(value, types):
            return name
    return "date" if value[:2] == "20" else "text"


def walk(value, path, seen):
    seen[path, kind(value)] += 1
    if isinstance(value, dict):
        for key, inner in value.items():
            walk(inner, f"{path}.{key}" if key.isalpha() else f"{path}['{key}']", seen)
    elif isinstance(value, list):
        for inner in value:
            walk(inner, f"{path}[]", seen)


def grown(rng, depth):
    leaf = rng.choice([None, True, 7, 2.5, "2024-01-01", "a [text] with {brackets", 'quotes " and \\ signs ['])
    if depth == 0 or rng.random() < 0.3:
        return leaf
    if rng.random() < 0.4:
        return [grown(rng, depth - 1) for _ in range(rng.randrange(4))]
    return {k: grown(rng, depth - 1) for k in rng.sample(["a", "b", "c d", "e.f"], rng.randrange(4))}


def test_profile_equals_a_walk_of_every_text(spark):
    rng = random.Random(5)
    values = [grown(rng, 5) for _ in range(300)]
    seen = Counter()
    for value in values:
        walk(value, "$", seen)
    df = spark.createDataFrame([(json.dumps(v),) for v in values], "doc string").repartition(5)
    got = {(r.path, r.type): r for r in json_path_profile(df, "doc").collect()}
    assert {k: r.n for k, r in got.items()} == dict(seen)
    totals = Counter()
    for (path, _), n in seen.items():
        totals[path] += n
    for (path, _), r in got.items():
        assert r["values"] == totals[path]
        filled = r["values"] - seen[path, "unknown"]
        assert r.fill_rate == pytest.approx(filled / r.within)
        known = {t: n for (p, t), n in seen.items() if p == path and t != "unknown"}
        assert r.dominant == (min(known, key=lambda t: (-known[t], t)) if known else "unknown")
        if path.endswith("[]") or path == "$":
            assert r.within == r["values"]
    assert max(r[0] for r in df.select(json_depth(F.col("doc"))).collect()) <= 5


def test_defined_cases(spark):
    rows = [(None,), ("",), ("no json",), ("null",), ("{}",), ('{"a": 1, "a": 2}',), ("[" * 40 + "]" * 40,), ('{"k": "' + "[" * 100_000 + '"}',)]
    df = spark.createDataFrame(rows, "`t.x` string")
    got = {(r.path, r.type): (r.n, r.within, r.fill_rate) for r in json_path_profile(df, "t.x", depth=2).collect()}
    assert got == {
        ("$", "unknown"): (2, 8, 0.375),
        ("$", "invalid"): (3, 8, 0.375),
        ("$", "object"): (2, 8, 0.375),
        ("$", "array"): (1, 8, 0.375),
        ("$.k", "text"): (1, 2, 0.5),
        ("$[]", "array"): (1, 1, 1.0),
        ("$[][]", "array"): (1, 1, 1.0),
    }
    assert json_path_profile(df.limit(0), "t.x").collect() == []
    assert {c for c, in df.select(json_depth(F.col("`t.x`"))).collect()} == {None, 0, 1, 40}


def test_schemas_merge_per_group(spark):
    df = spark.createDataFrame([("x", '{"a": 1}'), ("x", '{"b": ["t"]}'), ("y", '{"a": 1}'), ("y", '{"a": "t"}'), ("z", "bad")], "`g.h` string, doc string")
    assert rows_of(json_schema(df, "doc", ["g.h"])) == [("x", "OBJECT<a: BIGINT, b: ARRAY<STRING>>"), ("y", "OBJECT<a: VARIANT>"), ("z", "VOID")]
    assert len(json_schema(df, "doc").collect()) == 1


def test_texts_are_opened_once(spark, tmp_path, monkeypatch):
    rows = [('{"a": [], "b": {}, "c": [[1, 2], [], [null]]}',), ('{"c": [3, {"d": {}}]}',), ("[{}, {}]",), ("5",)]
    spark.createDataFrame(rows, "doc string").write.parquet(str(tmp_path / "t"))
    out = json_path_profile(spark.read.parquet(str(tmp_path / "t")), "doc", depth=4)
    got = {(r.path, r.type): (r.n, r["values"], r.within) for r in out.collect()}
    assert got == {
        ("$", "object"): (2, 4, 4), ("$", "array"): (1, 4, 4), ("$", "number"): (1, 4, 4), ("$[]", "object"): (2, 2, 2),
        ("$.a", "array"): (1, 1, 2), ("$.b", "object"): (1, 1, 2), ("$.c", "array"): (2, 2, 2),
        ("$.c[]", "array"): (3, 5, 5), ("$.c[]", "number"): (1, 5, 5), ("$.c[]", "object"): (1, 5, 5),
        ("$.c[][]", "number"): (2, 3, 3), ("$.c[][]", "unknown"): (1, 3, 3), ("$.c[].d", "object"): (1, 1, 1),
    }
    # with fewer levels than it has the rest is measured and opened; [null], {} and [] are told apart
    monkeypatch.setattr(json_paths, "LEVELS", 2, raising=False)
    again = json_path_profile(spark.read.parquet(str(tmp_path / "t")), "doc")
    assert rows_of(again) == rows_of(out)
    counts = json_paths.json_node_counts(spark.createDataFrame([("[null]",), ("{}",), ("[]",), ('{"a": 1}',)], "doc string"), "doc", 0)
    assert rows_of(counts.select("type", "more", "n")) == [("array", True, 2), ("object", True, 2)]
    # what is read twice are counts, not texts
    assert "variant" not in out._jdf.queryExecution().executedPlan().toString()
