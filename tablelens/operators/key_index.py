"""Which stored months may hold a key: one blocked Bloom filter per month.

A filter is a row per block of BLOCK_BITS bits, made by `bitmap_construct_agg`:
a key lies in one block and sets PROBES bits of it, so one join by block tests
all bits of a key. A month has a power of two of blocks, enough for BITS bits a
key; a key that is not there seems to be with a chance of about 1 in 25,000. The
filter of a month is three bytes a key, and a search reads nothing else.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.projection import quoted

BITS, PROBES = 24, 8
BLOCK_BITS = 32_768  # a bitmap of 4 KB
#: Keys whose filters one task makes, about: it sorts PROBES rows for each.
TASK_KEYS = 250_000


def _hash(keys: Sequence[str], seed: int) -> Column:
    return F.xxhash64(*[F.col(quoted(k)).cast("string") for k in keys], F.lit(seed))


def build_key_index(rows: DataFrame, month: str, keys: Sequence[str]) -> DataFrame:
    """(month, blocks, block, bits) over all rows; a null month has the empty name.

    Runs a job that counts the rows of each month. The blocks are dealt to as
    many tasks as the keys ask for, however small the keys are when shuffled.
    """
    names = [f"k{i}" for i in range(len(keys))]
    named = rows.select(F.coalesce(F.col(quoted(month)), F.lit("")).alias("month"), *[F.col(quoted(k)).cast("string").alias(n) for k, n in zip(keys, names, strict=True)])
    blocks = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("n") * BITS / BLOCK_BITS)))).cast("long")
    # one row per month of the calendar
    months = named.groupBy("month").agg(F.count("*").alias("n")).select("month", blocks.alias("blocks"), "n").collect()
    sizes = rows.sparkSession.createDataFrame([(r["month"], r["blocks"]) for r in months], "month string, blocks long")
    tasks = max(1, -(-sum(r["n"] for r in months) // TASK_KEYS))
    placed = named.join(F.broadcast(sizes), "month").withColumn("block", F.pmod(_hash(names, 0), "blocks"))
    probes = F.array(*[F.pmod(_hash(names, i + 1), F.lit(BLOCK_BITS)) for i in range(PROBES)])
    bits = placed.repartition(tasks, "month", "block").select("month", "blocks", "block", F.explode(probes).alias("bit"))
    return bits.groupBy("month", "blocks", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(place / 8) + 1).cast("int"), 1)), 16, 10).cast("int")
    return F.call_function("bit_get", byte, (place % 8).cast("int")) == 1


def months_of(index: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(month) of every month of `index` that may hold a key of `wanted`."""
    sizes = [r[0] for r in index.select("blocks").distinct().collect()]  # powers of two: a few dozen at most
    probes = [_hash(keys, i + 1).alias(f"p{i}") for i in range(PROBES)]
    asked = wanted.select(_hash(keys, 0).alias("h"), *probes).distinct()
    asked = asked.withColumn("blocks", F.explode(F.array(*[F.lit(n).cast("long") for n in sizes]).cast("array<long>")))
    asked = asked.withColumn("block", F.pmod("h", "blocks"))
    met = index.join(asked, ["blocks", "block"])
    all_set = [_is_set(F.col("bits"), F.pmod(F.col(f"p{i}"), F.lit(BLOCK_BITS))) for i in range(PROBES)]
    return met.where(reduce(lambda a, b: a & b, all_set)).select("month").distinct()
