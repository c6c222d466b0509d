"""Replacing recorded values by their preferred form through lookup maps."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.projection import fresh, quoted
from .joins import one_per_key


def parse_value_map(col: Column) -> Column:
    """MAP(text -> text) from a JSON object; any other content gives an empty map.

    Of a repeated JSON key the last entry counts.
    """
    parsed = F.from_json(col, "map<string,string>")
    keys, values = F.map_keys(parsed), F.map_values(parsed)
    distinct = F.array_distinct(keys)
    last = F.transform(distinct, lambda k: F.element_at(values, (F.size(keys) - F.array_position(F.reverse(keys), k) + 1).cast("int")))
    single = F.when(F.size(distinct) < F.size(keys), F.map_from_arrays(distinct, last)).otherwise(parsed)
    return F.coalesce(single, F.from_json(F.lit("{}"), "map<string,string>"))


def value_map_rows(df: DataFrame, column: str) -> DataFrame:
    """Lookup rows (old, new) of every JSON map in `column`, with the other columns."""
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.explode(parse_value_map(df[column])).alias("old", "new"))


def stored_value_maps(store: DataFrame, table: str, fields: Iterable[str]) -> dict[str, DataFrame]:
    """Lookup rows (old, new) per field from a context store, for `apply_value_maps`; nothing is read yet.

    The store has columns (table_name, field_name, context_type, context); an
    entry of type value_map holds a JSON object. A field without one, or with
    other content, has no lookup rows.
    """
    maps = store.where((F.col("context_type") == "value_map") & (F.col("table_name") == table))
    return {f: value_map_rows(maps.where(F.col("field_name") == f).select("context"), "context") for f in fields}


def map_table(spark: SparkSession, mapping: Mapping[str, str]) -> DataFrame:
    """A mapping as lookup rows (old, new)."""
    pairs = {"old": list(mapping.keys()), "new": list(mapping.values())}
    return spark.createDataFrame(pa.table(pairs))


def _is_text(df: DataFrame, column: str) -> bool:
    return column in df.columns and isinstance(df.schema[column].dataType, T.StringType)


def apply_value_map(
    df: DataFrame, column: str, mapping: Mapping[str, str] | DataFrame
) -> DataFrame:
    """Replace values of a text column, all entries at once (never one after the other).

    A mapping DataFrame has columns (old, new), and of several rows of an old
    value one counts. Map keys are text, so other column types stay as they are.
    """
    if not _is_text(df, column):
        return df
    if not isinstance(mapping, DataFrame):
        if not mapping:
            return df
        # as large as a dict of the caller
        lookup = F.broadcast(map_table(df.sparkSession, mapping))
    else:
        lookup = one_per_key(mapping.select("old", "new"), ["old"])
    old, new = fresh("_old", df), fresh("_new", df)
    lookup = lookup.select(F.col("old").alias(old), F.col("new").alias(new))
    replaced = F.when(F.col(old).isNotNull(), F.col(new)).otherwise(F.col(quoted(column))).alias(column)
    joined = df.join(lookup, F.col(quoted(column)) == F.col(old), "left")
    return joined.select(*[replaced if c == column else F.col(quoted(c)) for c in df.columns])


def apply_value_maps(
    df: DataFrame, maps: Mapping[str, Mapping[str, str] | DataFrame]
) -> DataFrame:
    for column, mapping in maps.items():
        df = apply_value_map(df, column, mapping)
    return df


def normalization_notes(
    df: DataFrame, maps: Mapping[str, Mapping[str, str] | DataFrame]
) -> DataFrame:
    """How many rows each mapping entry changes: (field, old, new, count), zero counts left out.

    Values are counted per task before they meet the map, so a hot value
    travels as one row.
    """
    parts = []
    for column, mapping in maps.items():
        if not _is_text(df, column):
            continue
        if not isinstance(mapping, DataFrame):
            mapping = map_table(df.sparkSession, mapping)
        counts = df.groupBy(F.col(quoted(column)).alias("old")).agg(F.count("*").alias("count"))
        hits = counts.join(one_per_key(mapping.select("old", "new"), ["old"]), "old")
        parts.append(hits.select(F.lit(column).alias("field"), "old", "new", "count"))
    if not parts:
        raise ValueError("none of the maps names a text column")
    return reduce(DataFrame.unionByName, parts)
