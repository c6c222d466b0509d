"""Reading tables, naming datasets and writing results."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import DATE_FORMATS, parse_timestamp
from ..functions.projection import pick_columns

__all__ = [
    "DATE_FORMATS",
    "coerce_dates",
    "drop_columns_like",
    "load_dataset",
    "read_json_pages",
    "read_table",
    "resolve_dataset",
    "write_result",
]


def read_table(spark: SparkSession, folder: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Table `name` under `folder`, whose path ends in the format's extension."""
    return spark.read.format(fmt).load(f"{folder}/{name}.{fmt}")


def read_json_pages(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Records of JSON page files of the form {"value": [{...}, ...]}.

    `schema` describes one record; without it Spark infers it in a pass of its
    own. Keys that start with "@" are transport metadata and are dropped.
    """
    reader = spark.read.option("multiLine", True)
    if schema:
        reader = reader.schema(f"value array<struct<{schema}>>")
    return drop_columns_like(reader.json(path).select(F.inline("value")), "@")


def drop_columns_like(df: DataFrame, prefix: str) -> DataFrame:
    """Drop the columns whose name starts with `prefix`."""
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def coerce_dates(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Parse text columns of mixed date formats to timestamps; unreadable text becomes null."""
    return df.withColumns({c: parse_timestamp(df[c]) for c in columns if c in df.columns})


def load_dataset(
    df: DataFrame,
    name: str,
    where: Column | str | None = None,
    select: str | Iterable[str] | None = None,
    date_columns: Iterable[str] = (),
) -> DataFrame | None:
    """Filter and project `df` and register it as temp view `name`.

    A view of the same name is replaced. Where no row matches, nothing is
    registered and None is returned.
    """
    if where is not None:
        df = df.where(where)
    df = coerce_dates(drop_columns_like(pick_columns(df, select), "@"), date_columns)
    if df.isEmpty():
        return None
    df.createOrReplaceTempView(name)
    return df


def resolve_dataset(spark: SparkSession, name: str, folder: str | None = None) -> DataFrame:
    """The named dataset if one is registered, else the stored table."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    if folder is None:
        raise KeyError(f"dataset {name!r} is not loaded")
    return read_table(spark, folder, name)


def write_result(
    df: DataFrame,
    path: str,
    fmt: str = "json",
    mode: str = "overwrite",
    partition_by: Iterable[str] = (),
) -> None:
    """Write a result table; every executor writes its own part files."""
    df.write.format(fmt).mode(mode).partitionBy(*partition_by).save(path)
