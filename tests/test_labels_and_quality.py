from __future__ import annotations

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tablelens.operators.aggregate import distribution
from tablelens.operators.classify import (
    NAME_RULES,
    Rule,
    classify_by_rules,
    classify_tier,
    classify_with_overrides,
    conditional_enrich,
    label_name,
)
from tablelens.operators.normalize import (
    apply_value_map,
    apply_value_maps,
    normalization_notes,
    parse_value_map,
    value_map_rows,
)
from tablelens.operators.quality import (
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

NAMES = [
    ("_kp_CustomerID", "key", "pk_prefix", "high"),
    ("_kP_CustomerID", "key", "pk_prefix", "high"),
    ("_pk_ID", "key", "pk_prefix", "high"),
    ("_kf_LocationID", "key", "fk_prefix", "high"),
    ("_fk_Parent", "key", "fk_prefix", "high"),
    ("_sp_CachedTotal", "internal", "speed_calc", "high"),
    ("gCurrentDate", "internal", "global_g", "medium"),
    ("G_Flag", "internal", "global_G", "medium"),
    ("zCalcField", "internal", "utility_z", "medium"),
    ("zzDeveloperOnly", "internal", "utility_z", "medium"),
    ("cCustomer_name", "internal", "lc_upper", "medium"),
    ("s_amount", "internal", "lc_upper", "medium"),
    ("g_nameFind", "internal", "lc_upper", "medium"),
    ("green", "stored", "default", "low"),
    ("g", "stored", "default", "low"),
    ("ServiceDate", "stored", "default", "low"),
    ("My_kp_ID", "stored", "default", "low"),
    ("", "stored", "default", "low"),
]


def test_names_are_classified(spark):
    df = spark.createDataFrame([(n,) for n, *_ in NAMES], "name string")
    got = {r.name: (r["class"], r.rule, r.confidence) for r in classify_by_rules(df, "name").collect()}
    assert got == {n: tuple(rest) for n, *rest in NAMES}
    assert [label_name(n) for n, *_ in NAMES] == [label for _, label, *_ in NAMES]


def test_own_rules_for_any_column(spark):
    rules = (Rule("promo", "^PROMO", "offer"), Rule("rest", None, "plain", "low"))
    df = spark.createDataFrame([("PROMO X",), ("BIG PROMO",)], "kind string")
    got = classify_by_rules(df, "kind", rules)
    assert [r["class"] for r in got.collect()] == ["offer", "plain"]


def test_tiers(spark):
    names = ["_kp_ID", "_kf_Parent", "_sp_cache", "gGlobal", "G_Flag", "Name", "cCalcField", "sSum", "gÄrger"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    tiers = [r.tier for r in classify_tier(df, "name").collect()]
    assert tiers == ["key", "key", "internal", "internal", "internal", "standard", "standard", "standard", "internal"]
    flags = spark.createDataFrame(
        [("_kp_ID", True, None, None), ("cCalcField", True, None, None), ("sSum", False, True, False), ("Name", None, None, False)],
        "name string, calculation boolean, summary boolean, global_ boolean",
    )
    got = {r.name: r.tier for r in classify_tier(df, "name", flags, ["name"]).collect()}
    assert (got["_kp_ID"], got["cCalcField"], got["sSum"], got["Name"]) == ("key", "internal", "internal", "standard")


STORE = "table_name string, field_name string, context_type string, context string"


def classified(spark, store):
    fields = spark.createDataFrame(
        [("Orders", "zTotal"), ("Orders", "gDay"), ("Lines", "zTotal"), ("Lines", "Name")],
        "table_name string, field_name string",
    )
    out = classify_with_overrides(fields, spark.createDataFrame(store, STORE))
    return {(r.table_name, r.field_name): (r["class"], r.rule, r.confidence) for r in out.collect()}


def test_rules_are_disabled_per_table_and_everywhere(spark):
    got = classified(spark, [
        ("*", "*", "rule_override", '{"global_g": "disabled", "lc_upper": "disabled", "default": "disabled"}'),
        ("Orders", "*", "rule_override", '{"utility_z": "disabled", "pk_prefix": "enabled"}'),
        ("Lines", "*", "rule_override", "not json"),
    ])
    assert got["Orders", "zTotal"] == ("stored", "default", "low")
    assert got["Orders", "gDay"] == ("stored", "default", "low")
    assert got["Lines", "zTotal"] == ("internal", "utility_z", "medium")


def test_a_persons_class_wins_and_a_machines_does_not(spark):
    got = classified(spark, [
        ("Orders", "zTotal", "field_class", "summary"),
        ("Lines", "zTotal", "field_class", "summary"),
        ("Lines", "zTotal", "classification_source", "default"),
        ("Lines", "*", "field_class", "key"),
        ("Lines", "Name", "field_class", ""),
    ])
    assert got["Orders", "zTotal"] == ("summary", "override", "high")
    assert got["Lines", "zTotal"] == ("internal", "utility_z", "medium")
    assert got["Lines", "Name"] == ("stored", "default", "low")


def test_only_low_confidence_is_enriched(spark):
    df = spark.createDataFrame(
        [("a", "stored", "default", "low"), ("b", "stored", "default", "low"), ("c", "key", "pk_prefix", "high"), ("d", "stored", "default", "low")],
        "f string, class string, rule string, confidence string",
    )
    flags = spark.createDataFrame(
        [("a", None, True, True), ("b", True, True, True), ("c", True, None, None)],
        "f string, calculation boolean, summary boolean, global_ boolean",
    )
    assert rows_of(conditional_enrich(df, flags, ["f"])) == [
        ("a", "summary", "metadata", "high"),
        ("b", "calculated", "metadata", "high"),
        ("c", "key", "pk_prefix", "high"),
        ("d", "stored", "default", "low"),
    ]


def test_value_maps_parse(spark):
    texts = ['{"Jake": "Jacob Owens"}', "", None, "not json", "[1, 2, 3]", '{"1": "Active", "2": 5}']
    df = spark.createDataFrame([(t,) for t in texts], "m string")
    got = [r[0] for r in df.select(parse_value_map(F.col("m"))).collect()]
    assert got == [{"Jake": "Jacob Owens"}, {}, {}, {}, {}, {"1": "Active", "2": "5"}]
    assert rows_of(value_map_rows(df, "m")) == [("1", "Active"), ("2", "5"), ("Jake", "Jacob Owens")]


@pytest.mark.parametrize("as_table", [False, True])
def test_replacement_is_simultaneous(spark, as_table):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "v string, n int")
    mapping = {"a": "b", "b": "c", "x": "y"}
    if as_table:
        mapping = spark.createDataFrame(list(mapping.items()), "old string, new string")
    assert rows_of(apply_value_map(df, "v", mapping)) == [("b", 1), ("c", 2), ("c", 3), (None, 4)]
    assert rows_of(apply_value_map(df, "n", mapping)) == rows_of(df)
    assert rows_of(apply_value_maps(df, {"v": mapping, "missing": mapping})) == [("b", 1), ("c", 2), ("c", 3), (None, 4)]


def test_long_maps_go_through_the_lookup(spark):
    df = spark.range(1000).selectExpr("cast(id as string) as v")
    mapping = {str(i): f"n{i}" for i in range(500)}
    got = {r.v for r in apply_value_map(df, "v", mapping).collect()}
    assert got == {f"n{i}" for i in range(500)} | {str(i) for i in range(500, 1000)}


def test_notes_count_changed_rows(spark):
    df = spark.createDataFrame([("Jake", "CIN"), ("Mike", "CIN"), ("Jake", None)], "d string, z string")
    got = normalization_notes(df, {"d": {"Jake": "Jacob", "Al": "Alan"}, "z": {"CIN": ""}})
    assert rows_of(got) == [("d", "Jake", "Jacob", 2), ("z", "CIN", "", 2)]


def test_distribution_ignores_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("a",), (None,)], "k string")
    assert rows_of(distribution(df, "k")) == [("a", 3, 75.0), ("b", 1, 25.0)]


def test_key_checks(spark):
    df = spark.createDataFrame([("R-1",), ("-12",), ("",), (None,), ("-1a",), ("R-1",)], "pk string")
    assert rows_of(pk_integrity(df, "pk")) == [(6, 2, 1)]
    assert rows_of(pk_duplicates(df, ["pk"])) == [("R-1", 2)]


def test_foreign_keys(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), ("x",), ("x",), ("",), (None,)], "fk string")
    parent = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "pk string")
    assert rows_of(fk_orphans(child, "fk", parent, "pk")) == [("x", 2)]
    assert rows_of(fk_match_rate(child, "fk", parent, "pk")) == [("fk", 5, 3, 2, 0.6)]
    none = child.where("fk = 'none'")
    assert rows_of(fk_match_rate(none, "fk", parent, "pk")) == [("fk", 0, 0, 0, None)]


def test_types(spark):
    df = spark.createDataFrame(
        [("1.5", "2025-01-02", 3, "x"), ("", "1/2/2025", 4, None), ("abc", "later", None, "y")],
        "a string, d string, n int, t string",
    )
    declared = {"a": "number", "d": "date", "n": "text", "t": "text"}
    assert rows_of(type_consistency(df, declared)) == [
        ("a", "number", 2, 1), ("d", "date", 3, 1), ("n", "text", 2, 2), ("t", "text", 2, 0)
    ]
    with pytest.raises(ValueError):
        type_consistency(df, {"a": "shape"})


def test_completeness(spark):
    df = spark.createDataFrame([('{"a": 1, "b": null}',), ('{"a": null, "c": 1}',), ("bad",), (None,)], "j string")
    assert rows_of(key_completeness(df, "j", ["a", "z"])) == [
        ("a", "ok", 2, 0.25), ("b", "extra", 1, 0.0), ("c", "extra", 1, 0.25), ("z", "missing", 0, 0.0)
    ]


def test_date_profile(spark):
    df = spark.sql(
        "select * from values (timestamp_ntz'2025-01-01 10:00:00', date'2025-05-05'),"
        " (timestamp_ntz'2025-01-01 11:00:00', null), (null, null) as t(a, b)"
    )
    got = {r.field: (str(r.first_day), round(r.null_rate, 3), r.days, r.rows_per_day) for r in date_column_profile(df).collect()}
    assert got == {"a": ("2025-01-01", 0.333, 1, 2.0), "b": ("2025-05-05", 0.667, 1, 1.0)}


def test_report_and_summary(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "z"), ("", "2")], "k string, n string")
    empty = df.limit(0)
    report = quality_report(
        {"t": df, "e": empty}, {"t": ["k"], "e": ["k"]}, [("t", "n", "t", "k")], {"t": {"n": "number"}}
    )
    assert {(r.check, r.table, r.status, r.n) for r in report.collect()} == {
        ("pk_filled", "t", "FAIL", 1), ("pk_format", "t", "PASS", 0), ("pk_unique", "t", "FAIL", 1),
        ("records", "e", "WARN", 0), ("pk_filled", "e", "PASS", 0), ("pk_format", "e", "PASS", 0),
        ("pk_unique", "e", "PASS", 0), ("fk_match", "t", "FAIL", 3), ("type", "t", "FAIL", 1),
    }
    assert rows_of(quality_summary(report)) == [("FAIL", 4), ("PASS", 4), ("WARN", 1)]


def test_last_rule_catches_everything():
    assert NAME_RULES[-1].pattern is None
