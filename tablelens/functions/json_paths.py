"""Paths, types and fill rates of JSON text of any depth, arrays included."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_table
from .json_types import simple_type
from .projection import quoted

ROOT = "$"
#: Types a path has beside the simple ones.
OBJECT, ARRAY, INVALID = "object", "array", "invalid"
#: Levels that are opened before the depth of the texts is measured.
LEVELS = 8
_PLAIN_KEY = r"^[A-Za-z_][A-Za-z0-9_]*$"


def json_depth(text: Column) -> Column:
    """How many brackets are open at once at most, brackets inside strings left out."""
    bare = F.regexp_replace(F.regexp_replace(text, r"(?s)\\.", ""), r'"[^"]*+"|[^\[\]{}"]++', "")
    step = "case when b in ('{{', '[') then {0}.now + 1 else {0}.now - 1 end".format
    most = F.call_function(
        "aggregate",
        F.split(bare, ""),
        F.expr("named_struct('now', 0, 'most', 0)"),
        F.expr(f"(a, b) -> if(b = '', a, named_struct('now', {step('a')}, 'most', greatest(a.most, {step('a')})))"),
    )
    return most["most"]


def _member(path: Column, key: Column) -> Column:
    """The path of a key; keys that are no plain names stand in brackets and quotes."""
    marked = F.concat(F.lit("['"), F.replace(F.replace(key, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("']"))
    return F.concat(path, F.when(key.rlike(_PLAIN_KEY), F.concat(F.lit("."), key)).otherwise(marked))


def json_node_counts(df: DataFrame, column: str, depth: int) -> DataFrame:
    """(parent, path, type, filled, more, n): how many values occur at any depth of the rows of a JSON text column.

    The root is `$`, a key of an object `$.key`, all elements of an array
    `$.list[]`, whatever their position. `type` is one of the simple types,
    object or array; a text that is no JSON (or repeats a key in one object) is
    invalid, a null text or value unknown and not filled. Levels below `depth`
    stay closed: they are object or array and nothing below them is reported;
    `more` says which of them hold something.

    Rows are the innermost values only. Of those in one container the first
    stands for it as well, so a container counts once and is never copied;
    paths are written after the rows are counted.
    """
    # taken out under a fixed name, as a name may hold dots
    texts = df.select(df[quoted(column)].alias("text"))
    parsed = texts.select("text", F.try_parse_json("text").alias("held"))
    # first: the innermost level at which the value is not the first of its container
    rows = parsed.select((F.col("held").isNull() & F.col("text").isNotNull()).alias("invalid"), F.lit(0).alias("first"), "held")
    steps: list[str] = []
    for i in range(1, depth + 1):
        rows = rows.lateralJoin(df.sparkSession.tvf.variant_explode_outer(F.col("held").outer()))
        inside = F.when(F.col("pos").isNotNull(), F.when(F.col("key").isNull(), ARRAY).otherwise(OBJECT))
        first = F.when(F.col("pos") > 0, i).otherwise(F.col("first"))
        rows = rows.select("invalid", *steps, inside.alias(f"in{i}"), F.col("key").alias(f"key{i}"), first.alias("first"), F.coalesce("value", "held").alias("held"))
        steps += [f"in{i}", f"key{i}"]
    rows = rows.select("invalid", *steps, "first", "held", F.schema_of_variant("held").alias("kind"), F.try_variant_get("held", "$", "string").alias("text"))
    kind = F.col("kind")
    shut = F.when(kind.startswith("OBJECT"), F.lit(OBJECT)).when(kind.startswith("ARRAY"), F.lit(ARRAY))
    leaf = F.when(F.col("invalid"), F.lit(INVALID)).otherwise(F.coalesce(shut, simple_type(kind, F.col("text"))))
    more = shut.isNotNull() & ~F.to_json("held").isin("{}", "[]")
    counts = rows.groupBy(*steps, "first", leaf.alias("leaf"), more.alias("more")).agg(F.count("*").alias("n")).withColumn("path0", F.lit(ROOT))
    # from here on one row per path, type and level at which it is not the first
    nodes = [F.when(F.col("first") == 0, _node(F.lit(None).cast("string"), 0, depth))]
    for i in range(1, depth + 1):
        above, inside = F.col(f"path{i - 1}"), F.col(f"in{i}")
        path = F.when(inside == ARRAY, F.concat(above, F.lit("[]"))).when(inside == OBJECT, _member(above, F.col(f"key{i}")))
        counts = counts.withColumn(f"path{i}", path)
        nodes.append(F.when(inside.isNotNull() & (F.col("first") <= i), _node(above, i, depth)))
    found = counts.select("n", "more", F.inline(F.array_compact(F.array(*nodes))))
    found = found.groupBy("parent", "path", "type").agg(F.bool_or("more").alias("more"), F.sum("n").alias("n"))
    return found.select("parent", "path", "type", (~F.col("type").isin("unknown", INVALID)).alias("filled"), F.coalesce("more", F.lit(False)).alias("more"), "n")


def _node(parent: Column, level: int, depth: int) -> Column:
    """The value at a level of a row: a container where the row goes on below it."""
    kind = F.coalesce(f"in{level + 1}", "leaf") if level < depth else F.col("leaf")
    return F.struct(parent.alias("parent"), F.col(f"path{level}").alias("path"), kind.alias("type"))


def json_path_profile(df: DataFrame, column: str, depth: int | None = None) -> DataFrame:
    """(path, type, n, dominant, values, within, fill_rate): one row per path and type that occurs at it.

    `values` counts what occurs at the path, nulls included; `within` the
    places where it could: rows for the root, objects of the parent path for a
    key, the elements themselves for `[]`. `fill_rate` is the share of these
    with a value that is not null. `dominant` is the most frequent type of
    filled values, ties going to the smaller name. Counts are added up before
    the one shuffle by path, so a path that all rows have is no hot key; they
    are stored, as they are read twice. Without `depth` all levels are opened:
    LEVELS first and, where something is left below them, as many as one more
    job finds.
    """
    # one row per path and type
    counts = scratch_table(json_node_counts(df, column, LEVELS if depth is None else depth))
    if depth is None and not counts.where("more").isEmpty():
        text = df[quoted(column)]
        deepest = df.where(F.try_parse_json(text).isNotNull()).agg(F.max(json_depth(text))).first()[0]
        counts = scratch_table(json_node_counts(df, column, deepest))
    known = F.when(F.col("filled"), F.struct(-F.col("n"), F.col("type")))
    types = F.collect_list(F.struct("type", "n"))
    paths = counts.groupBy("parent", "path").agg(
        types.alias("types"),
        F.coalesce(F.min_by("type", known), F.lit("unknown")).alias("dominant"),
        F.sum("n").alias("values"),
        F.sum(F.when(F.col("filled"), F.col("n")).otherwise(0)).alias("full"),
    )
    objects = counts.where(F.col("type") == OBJECT).select(F.col("path").alias("parent"), F.col("n").alias("objects"))
    element = F.col("parent").isNull() | (F.col("path") == F.concat("parent", F.lit("[]")))
    within = F.when(element, F.col("values")).otherwise(F.col("objects"))
    out = paths.join(objects, "parent", "left").withColumn("within", within)
    return out.select("path", F.inline("types"), "dominant", "values", "within", (F.col("full") / F.col("within")).alias("fill_rate"))


def json_schema(df: DataFrame, column: str, keys: list[str] | None = None) -> DataFrame:
    """The merged schema of all JSON texts, per group of `keys` if there are any, as one DDL text `schema`.

    Schemas merge in the aggregation, before and after the shuffle; where types
    differ in one place the schema says VARIANT there, and `json_path_profile`
    says which types these are. Texts that are no JSON count for nothing.
    """
    value = F.try_parse_json(df[quoted(column)])
    return df.groupBy(*map(quoted, keys or [])).agg(F.schema_of_variant_agg(value).alias("schema"))
