"""Run a registered query and its SQL over the same tables and compare all values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def kind(value: object) -> str:
    for name, types in (
        ("bool", bool),
        ("int", int),
        ("decimal", decimal.Decimal),
        ("float", float),
        ("text", str),
        ("timestamp", dt.datetime),
        ("date", dt.date),
    ):
        if isinstance(value, types):
            return name
    return type(value).__name__


def canonical(columns: list[str], rows: list) -> tuple[list[str], list, list]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    kinds = [set() for _ in order]
    out = []
    for row in rows:
        cells = []
        for j, i in enumerate(order):
            v = row[i]
            if isinstance(v, float) and math.isnan(v):
                v = None
            if v is not None:
                kinds[j].add(kind(v))
            cells.append(v)
        out.append(tuple(cells))
    out.sort(key=repr)
    return [columns[i] for i in order], kinds, out


def differences(spark: SparkSession, con, build, sql: str, folder: str) -> tuple[int, str | None]:
    """Row count and a description of the first difference, or None."""
    df = build(spark, folder)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    want = canonical([d[0] for d in res.description], res.fetchall())
    if got[0] != want[0]:
        return len(got[2]), f"columns {got[0]} != {want[0]}"
    if len(got[2]) != len(want[2]):
        return len(got[2]), f"rows {len(got[2])} != {len(want[2])}"
    if got[2] != want[2]:
        first = next((a, b) for a, b in zip(got[2], want[2]) if a != b)
        return len(got[2]), f"values {first[0]!r} != {first[1]!r}"
    if got[1] != want[1]:
        return len(got[2]), f"types {got[1]} != {want[1]}"
    return len(got[2]), None
