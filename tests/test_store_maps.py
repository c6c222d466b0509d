"""Value maps taken from a context store by table and field, and the notes on what they changed."""

from __future__ import annotations

from conftest import rows_of

from tablelens.plans.analyze import analyze_from_store

STORE = "table_name string, field_name string, context_type string, context string"


def test_maps_and_notes_from_a_store(spark):
    rows = [("a", "x", 1), ("b", "x", 2), ("A", "y", 3), (None, "z", 4), ("gone", "x", 5)]
    df = spark.createDataFrame(rows, "name string, kind string, n int")
    store = spark.createDataFrame(
        [
            ("t", "name", "value_map", '{"A": "a", "b": "A"}'),
            ("t", "kind", "value_map", "not json"),
            ("t", "n", "value_map", '{"1": "one"}'),
            ("t", "name", "syntax_rule", '{"a": "wrong"}'),
            ("other", "name", "value_map", '{"a": "wrong"}'),
            ("t", None, "value_map", '{"a": "wrong"}'),
            ("t", "kind", None, None),
        ],
        STORE,
    )
    out, notes = analyze_from_store(df, "t", store, "name,kind,n", aggregate="sum:n", where="n < 5")
    assert rows_of(out) == sorted([("a", "x", 1, 1), ("A", "x", 2, 2), ("a", "y", 3, 3)], key=repr)
    assert rows_of(notes) == [("name", "A", "a", 1), ("name", "b", "A", 1)]
    out, notes = analyze_from_store(df, "t", store, "kind", aggregate="sum:n", pivot_column="name")
    assert set(out.columns) == {"kind", "a", "A", "gone"} and notes.count() == 2
    out, notes = analyze_from_store(df, "t", store, aggregate="sum:n")
    assert rows_of(out) == [(15,)] and notes.collect() == []
