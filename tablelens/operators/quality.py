"""Data-quality checks over whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_timestamp
from ..functions.json_types import json_entries
from ..functions.predicates import has_value
from ..functions.projection import quoted

# Fixed value: a key that lost its letter prefix.
CUT_KEY = r"^-[0-9]+$"


def _filled(df: DataFrame, column: str) -> Column:
    """Neither null nor, for text, empty."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return has_value(df[column])
    return df[column].isNotNull()


def pk_integrity(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, empty keys and keys that look like a cut-off serial number."""
    text = df[key].cast("string")
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(~_filled(df, key)).alias("empty"),
        F.count_if(text.rlike(CUT_KEY)).alias("truncated"),
    )


def pk_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def _fk_counts(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Distinct foreign keys with their rows and whether a parent exists.

    Keys are counted before the join, so a hot key joins as one row.
    """
    used = (
        child.where(_filled(child, fk))
        .groupBy(F.col(fk).alias("_key"))
        .agg(F.count("*").alias("rows"))
    )
    known = parent.select(F.col(pk).alias("_key")).distinct().withColumn("_known", F.lit(True))
    return used.join(known, "_key", "left")


def fk_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign keys without a parent and the number of rows that use them."""
    return (
        _fk_counts(child, fk, parent, pk)
        .where(F.col("_known").isNull())
        .select(F.col("_key").alias(fk), "rows")
    )


def fk_match_rate(
    child: DataFrame, fk: str, parent: DataFrame, pk: str, name: str | None = None
) -> DataFrame:
    """One row: rows with a foreign key, those with and without a parent, and the share."""
    n, known = F.col("rows"), F.col("_known")
    total = F.coalesce(F.sum(n), F.lit(0))
    hits = F.coalesce(F.sum(F.when(known, n)), F.lit(0))
    return _fk_counts(child, fk, parent, pk).agg(
        F.lit(name or fk).alias("relation"),
        total.alias("checked"),
        hits.alias("matches"),
        (total - hits).alias("misses"),
        F.try_divide(hits, total).alias("match_rate"),
    )


def _mismatch(df: DataFrame, column: str, declared: str) -> Column:
    """Whether a non-empty cell contradicts the declared type."""
    kind = df.schema[column].dataType
    is_text = isinstance(kind, T.StringType)
    if declared == "text":
        return F.lit(not is_text)
    if declared in ("number", "decimal"):
        numeric = isinstance(kind, T.NumericType)
        return df[column].try_cast("double").isNull() if is_text else F.lit(not numeric)
    if declared in ("date", "datetime"):
        dated = isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))
        return parse_timestamp(df[column]).isNull() if is_text else F.lit(not dated)
    if declared == "boolean":
        return F.lit(not isinstance(kind, T.BooleanType))
    raise ValueError(f"unknown declared type {declared!r}")


def type_consistency(df: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """Per declared column the non-empty cells checked and those of another type.

    All columns are counted in one pass.
    """
    stats = []
    for i, (column, kind) in enumerate(declared.items()):
        filled = _filled(df, column)
        stats += [
            F.count_if(filled).alias(f"c{i}"),
            F.count_if(filled & _mismatch(df, column, kind)).alias(f"m{i}"),
        ]
    rows = [
        F.struct(
            F.lit(column).alias("field"),
            F.lit(kind).alias("declared"),
            F.col(f"c{i}").alias("checked"),
            F.col(f"m{i}").alias("mismatches"),
        )
        for i, (column, kind) in enumerate(declared.items())
    ]
    return df.agg(*stats).select(F.inline(F.array(*rows)))


def key_completeness(df: DataFrame, column: str, declared: Sequence[str]) -> DataFrame:
    """Declared keys against the keys found in a JSON column, over all rows.

    Status is ok, missing (declared, never present) or extra (present, not
    declared). `fill_rate` is the share of rows with a non-null value.
    """
    present = (
        json_entries(df, column)
        .groupBy("key")
        .agg(
            F.count("*").alias("present"),
            F.count_if(~F.is_variant_null("value")).alias("filled"),
        )
    )
    listed = df.sparkSession.createDataFrame(pa.table({"key": list(declared)})).withColumn(
        "declared", F.lit(True)
    )
    rows = df.agg(F.count("*")).scalar()
    status = (
        F.when(F.col("present").isNull(), F.lit("missing"))
        .when(F.col("declared").isNull(), F.lit("extra"))
        .otherwise(F.lit("ok"))
    )
    filled = F.coalesce(F.col("filled"), F.lit(0))
    return listed.join(present, "key", "full_outer").select(
        "key",
        status.alias("status"),
        F.coalesce(F.col("present"), F.lit(0)).alias("present"),
        F.try_divide(filled, rows).alias("fill_rate"),
    )


def date_column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per date column: min, max, null rate, days with rows and rows per such day, in one pass."""
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    names = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)])
    stats = [F.count("*").alias("rows")]
    for i, name in enumerate(names):
        day = F.to_date(df[name])
        stats += [
            F.min(day).alias(f"min{i}"),
            F.max(day).alias(f"max{i}"),
            F.count(day).alias(f"n{i}"),
            F.count_distinct(day).alias(f"d{i}"),
        ]
    rows = [
        F.struct(
            F.lit(name).alias("field"),
            F.col(f"min{i}").alias("first_day"),
            F.col(f"max{i}").alias("last_day"),
            F.try_divide(F.col("rows") - F.col(f"n{i}"), F.col("rows")).alias("null_rate"),
            F.col(f"d{i}").alias("days"),
            F.try_divide(F.col(f"n{i}"), F.col(f"d{i}")).alias("rows_per_day"),
        )
        for i, name in enumerate(names)
    ]
    return df.agg(*stats).select(F.inline(F.array(*rows)))


def _identity(df: DataFrame, columns: Sequence[str]) -> tuple[Column, Column]:
    """128 bits that stand for the values and nulls of `columns`; integers of any width count as equal.

    Among a billion different keys any two share them with a chance of about 1e-21.
    """
    parts = []
    for name in columns:
        value, kind = df[quoted(name)], df.schema[name].dataType
        if isinstance(kind, T.IntegralType):
            value = value.cast("long")
        elif isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
            value = value.cast("double") + F.lit(0.0)  # -0.0 is 0.0
        parts += [value, value.isNull()]
    return F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)


def _same_hash(one: T.DataType, two: T.DataType) -> bool:
    """Whether equal values of the two types have equal `_identity`."""
    return one == two or all(isinstance(t, T.IntegralType) for t in (one, two))


@dataclass(frozen=True)
class _Check:
    """One line of a report and how its number comes about.

    rows: failing rows; unique: keys with more than one row; match: rows whose key has no parent;
    records: all rows, as counted by the check before it.
    """

    check: str
    table: str
    field: str
    counts: str = "rows"


class _Checks:
    """Collects what each table has to emit, so that every table is read once for all its checks."""

    def __init__(self, tables: Mapping[str, DataFrame]) -> None:
        self.tables = tables
        self.checks: list[_Check] = []
        self.events: dict[str, list[Column]] = {}

    def _emit(self, table: str, no: int, when: Column, key: tuple | None, child: int, parent: int) -> None:
        one, two = key or (F.lit(0), F.lit(0))
        event = F.struct(
            F.lit(no).alias("no"),
            one.cast("long").alias("a"),
            two.cast("long").alias("b"),
            F.lit(child).cast("long").alias("child"),
            F.lit(parent).alias("parent"),
        )
        self.events.setdefault(table, []).append(F.when(when, event))

    def _new(self, check: _Check) -> int:
        self.checks.append(check)
        return len(self.checks) - 1

    def rows(self, check: str, table: str, field: str, fails: Column) -> None:
        self._emit(table, self._new(_Check(check, table, field)), fails, None, 1, 0)

    def unique(self, check: str, table: str, columns: Sequence[str]) -> None:
        """Two lines: keys that occur more than once, and, where there are none at all, a table without rows."""
        no = self._new(_Check(check, table, ",".join(columns), "unique"))
        self._emit(table, no, F.lit(True), _identity(self.tables[table], columns), 1, 0)
        self._new(_Check("records", table, "*", "records"))

    def match(self, check: str, child: str, fk: str, parent: str, pk: str) -> None:
        no = self._new(_Check(check, child, fk, "match"))
        df = self.tables[child]
        self._emit(child, no, _filled(df, fk), _identity(df, [fk]), 1, 0)
        known = self.tables[parent]
        self._emit(parent, no, known[quoted(pk)].isNotNull(), _identity(known, [pk]), 0, 1)

    def report(self) -> DataFrame:
        """Events are added up per check and key within each task, so a hot key or a check without a key is one row per task."""
        spark = next(iter(self.tables.values())).sparkSession
        # every check has an event of no rows, so tables without rows report too
        nought = F.lit(0).cast("long")
        seeds = spark.range(len(self.checks)).select(
            F.col("id").cast("int").alias("no"), nought.alias("a"), nought.alias("b"), nought.alias("child"), F.lit(0).alias("parent")
        )
        parts = [
            self.tables[name].select(F.inline(F.array(*events))).where("no is not null")
            for name, events in self.events.items()
        ]
        keyed = (
            reduce(DataFrame.unionByName, [seeds, *parts])
            .groupBy("no", "a", "b")
            .agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
        )
        totals = keyed.groupBy("no").agg(
            F.sum("child").alias("rows"),
            F.count_if(F.col("child") > 1).alias("unique"),
            F.sum(F.when(F.col("parent") == 0, F.col("child")).otherwise(0)).alias("match"),
        )
        # the lines a total stands for: its own and, of a check for doubled keys, the one of its rows
        lines = F.array(
            *[
                F.struct(F.lit(i).alias("line"), F.lit(other.counts).alias("counts"))
                for i, other in enumerate(self.checks)
            ]
        )
        own = F.filter(lines, lambda x: (x["line"] == F.col("no")) & (x["counts"] != "records"))
        rows = F.filter(lines, lambda x: (x["line"] == F.col("no") + 1) & (x["counts"] == "records"))
        n = F.when(F.col("counts") == "unique", F.col("unique")).when(F.col("counts") == "match", F.col("match"))
        totals = totals.select("*", F.inline(F.concat(own, rows)))

        def named(part: str) -> Column:
            names = F.array(*[F.lit(getattr(check, part)) for check in self.checks])
            return F.get(names, F.col("line")).alias(part)

        found = totals.select(named("check"), named("table"), named("field"), n.otherwise(F.col("rows")).alias("n"))
        found = found.where("check <> 'records' or n = 0")
        status = F.when(F.col("check") == "records", "WARN").otherwise(_verdict(F.col("n")))
        return found.select("check", "table", "field", status.alias("status"), "n")


def _verdict(n: Column) -> Column:
    return F.when(n > 0, F.lit("FAIL")).otherwise(F.lit("PASS"))


def quality_report(
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
    relations: Sequence[tuple[str, str, str, str]] = (),
    types: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    """All checks as one long table (check, table, field, status, n).

    `relations` are (child, foreign key, parent, key). Each table is read once,
    whatever the number of its checks: a row emits one event per failing row
    check and per key it has to compare, and one aggregation by check and key
    serves them all. Keys travel as 128-bit hashes. A relation between columns
    of different types is compared by a join of its own.
    """
    checks, joined = _Checks(tables), []
    for name, cols in keys.items():
        df, label = tables[name], ",".join(cols)
        empty = reduce(lambda a, b: a | b, [~has_value(df[quoted(k)]) for k in cols])
        cut = reduce(lambda a, b: a | b, [df[quoted(k)].cast("string").rlike(CUT_KEY) for k in cols])
        checks.rows("pk_filled", name, label, empty)
        checks.rows("pk_format", name, label, cut)
        checks.unique("pk_unique", name, cols)
    for child, fk, parent, pk in relations:
        if _same_hash(tables[child].schema[fk].dataType, tables[parent].schema[pk].dataType):
            checks.match("fk_match", child, fk, parent, pk)
            continue
        misses = fk_match_rate(tables[child], fk, tables[parent], pk)
        joined.append(
            misses.select(
                F.lit("fk_match").alias("check"),
                F.lit(child).alias("table"),
                F.lit(fk).alias("field"),
                _verdict(F.col("misses")).alias("status"),
                F.col("misses").alias("n"),
            )
        )
    for name, declared in (types or {}).items():
        df = tables[name]
        for column, kind in declared.items():
            checks.rows("type", name, column, _filled(df, column) & _mismatch(df, column, kind))
    parts = [checks.report()] if checks.checks else []
    return reduce(DataFrame.unionByName, [*parts, *joined])


def quality_summary(report: DataFrame) -> DataFrame:
    """Number of checks per status."""
    return report.groupBy("status").agg(F.count("*").alias("checks"))
