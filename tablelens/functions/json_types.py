"""Types of the values inside a JSON text column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# How text that is a date or a timestamp looks.
DATETIME_TEXT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"
DATE_TEXT = r"^\d{4}-\d{2}-\d{2}$"


def json_value_type(value: Column) -> Column:
    """Simple type name of a VARIANT value."""
    return simple_type(F.schema_of_variant(value), F.try_variant_get(value, "$", "string"))


def simple_type(kind: Column, text: Column) -> Column:
    """Simple type name from a VARIANT's schema and its text."""
    return (
        F.when(kind.isNull() | (kind == "VOID"), F.lit("unknown"))
        .when(kind == "BOOLEAN", F.lit("boolean"))
        .when(kind == "BIGINT", F.lit("number"))
        .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), F.lit("decimal"))
        .when((kind == "STRING") & text.rlike(DATETIME_TEXT), F.lit("datetime"))
        .when((kind == "STRING") & text.rlike(DATE_TEXT), F.lit("date"))
        .when(kind == "STRING", F.lit("text"))
        .otherwise(F.lit("unknown"))
    )


def json_entries(df: DataFrame, column: str) -> DataFrame:
    """One row (key, value VARIANT) per entry of every JSON object of a text column.

    Text that is no JSON object yields no row.
    """
    parsed = df.select(F.try_parse_json(df[column]).alias("doc"))
    entries = parsed.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("doc").outer()))
    # elements of arrays have a position and no key
    return entries.where(F.col("key").isNotNull()).select("key", "value")


def json_type_profile(df: DataFrame, column: str) -> DataFrame:
    """Per key and type the number of values, and the key's dominant type.

    `dominant` is the most frequent known type, ties going to the smaller
    name; a key with only nulls stays unknown. Every row is read.
    """
    value = F.col("value")
    counts = (
        json_entries(df, column)
        .select(
            "key",
            F.schema_of_variant(value).alias("kind"),
            F.try_variant_get(value, "$", "string").alias("text"),
        )
        .groupBy("key", simple_type(F.col("kind"), F.col("text")).alias("type"))
        .agg(F.count("*").alias("n"))
    )
    known = F.when(F.col("type") != "unknown", F.struct(-F.col("n"), F.col("type")))
    # one row per type of a key reaches this window
    per_key = Window.partitionBy("key")
    return counts.select(
        "key",
        "type",
        "n",
        F.coalesce(F.min_by("type", known).over(per_key), F.lit("unknown")).alias("dominant"),
        F.sum("n").over(per_key).alias("values"),
    )
