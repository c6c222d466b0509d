"""Mixing sources to target weights: pivotal dependent rounding.

Sources in code point order (null last) weigh 5, 2, 1, repeating, and share all
words by weight; a target stops at `most` times its source's words, and the
excess is shared again among the others. A document is wanted target / source
words times: the whole part is taken, the rest is a fractional copy.

Fractional copies are rounded in pairs. Words move at random from one member
of a pair to the other, either way with the odds that keep both expectations,
until one of them is a whole copy or none; the other goes on to the next pair.
So a source's taken words change by nothing until its last document is drawn.
Within a bucket of a source the longest document is paired with the pool of all
shorter ones, which have one share, then the next longest with what is left:
were documents paired one by one, the longest would be left over, as the
shorter one of a pair is mostly done first. Each bucket leaves one short
residual; residuals are paired one by one in buckets of the next level of a
reduction tree until one is left and is drawn.

Only (doc_id, source, size) are shuffled. Random numbers depend on the seed,
the source, the level and the bucket, so reruns agree.

Defined cases: null or empty text has size 0 and is never taken; a source of no
words has target 0; the null source is a source; rows that repeat are
documents of their own; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import groups, stored

WEIGHTS = (5, 2, 1)
#: Documents of a bucket, about; fewer buckets are made where one would hold fewer than POOL times the words
#: of its source's longest document, but none of more than MOST documents.
BUCKET, POOL, MOST = 4096, 8, 1_000_000


def size_of(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """(source, source_size, target, buckets) of `sizes` (source, size); one row per source from here on."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"), F.max("size").alias("longest"))
    pools = F.floor(F.col("source_size") / F.greatest(POOL * F.col("longest"), F.lit(1)))
    buckets = F.greatest(F.ceil(F.col("n") / MOST), F.least(F.ceil(F.col("n") / BUCKET), pools))
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    # sources that reach their limit come first; the rest share what is left by weight
    limit = most * F.col("source_size").cast("double")
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    per = per.withColumn("weight", weight).withColumn("limit", limit)
    left = F.sum(F.col("source_size").cast("double")).over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    # while sources fill up the level to share by rises; past the last full one it falls
    per = per.withColumn("_left", left / F.sum("weight").over(after)).withColumn("level", F.max("_left").over(whole))
    per = per.withColumn("target", F.least(F.col("limit"), F.col("level") * F.col("weight")))
    return per.select("source", "source_size", "target", buckets.alias("buckets"))


def _pooled(size: np.ndarray, share: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Equal shares of documents, longest first, rounded to 0 or 1; one may stay fractional."""
    out = share.copy()
    live = np.flatnonzero((share > 0) & (share < 1))
    if not len(live):
        return out
    rest = np.cumsum(size[live][::-1])[::-1] - size[live]
    f, draws = float(share[live[0]]), rng.random(len(live))
    for n, (k, pool) in enumerate(zip(live.tolist(), rest.tolist(), strict=True)):
        s = size[k]
        up, down = min((1 - f) * s, f * pool), min(f * s, (1 - f) * pool)
        if up + down <= 0:  # nothing is left to pair with
            out[k] = f
            break
        if draws[n] * (up + down) < down:
            whole, value, f = (1 - f) * s <= f * pool, f + up / s, f - up / pool
        else:
            whole, value, f = f * s <= (1 - f) * pool, f - down / s, f + down / pool
        out[k] = round(value) if whole else value
        if not 1e-12 < f < 1 - 1e-12:  # the pool is whole
            out[live[n + 1 :]] = round(f)
            break
    return out


def _paired(size: np.ndarray, share: np.ndarray, rng: np.random.Generator, last: bool) -> np.ndarray:
    """Shares in [0, 1] rounded to 0 or 1 pair by pair; one may stay fractional unless `last`."""
    out = share.copy()
    draws = rng.random(len(out) + 1)
    held = -1
    for k in range(len(out)):
        if not 0.0 < out[k] < 1.0:
            continue
        if held < 0:
            held = k
            continue
        p, q, s, t = out[held], out[k], size[held], size[k]
        up = min((1 - p) * s, q * t)  # words that can move to the held one
        down = min(p * s, (1 - q) * t)
        if draws[k] * (up + down) < down:
            full = (1 - p) * s <= q * t
            p, q = (1.0, q - up / t) if full else (p + up / s, 0.0)
        else:
            empty = p * s <= (1 - q) * t
            p, q = (0.0, q + down / t) if empty else (p - down / s, 1.0)
        out[held], out[k] = p, q
        if 1e-12 < q < 1 - 1e-12:
            held = k
        else:
            out[k] = round(q)
            if not 1e-12 < p < 1 - 1e-12:
                out[held] = round(p)
                held = -1
    if last and held >= 0:
        out[held] = float(draws[-1] < out[held])
    return out


def _level(rows: DataFrame, seed: int, level: int, last: bool) -> DataFrame:
    """One level of the tree: `rows` (doc_id, source, size, whole, share, bucket) with shares rounded."""
    rows = rows.withColumn("key", F.struct(F.col("source").isNull().alias("no"), F.coalesce("source", F.lit("")).alias("name")))
    rows = rows.select("doc_id", "source", "size", "whole", "share", "bucket", "key.no", "key.name")
    rows = rows.repartition("no", "name", "bucket")
    rows = rows.sortWithinPartitions("no", "name", "bucket", F.desc("size"), F.col("doc_id"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (no, name, bucket), own in groups(batches, ["no", "name", "bucket"]):
            size, share = own.column("size").to_numpy().astype(float), own.column("share").to_numpy()
            rng = np.random.default_rng([seed, level, int(no), zlib.crc32(name.encode()), int(bucket)])
            share = _paired(size, share, rng, last) if level else _pooled(size, share, rng)
            share = _paired(size, share, rng, last) if last else share
            out = own.drop_columns(["no", "name", "share"]).append_column("share", pa.array(share))
            yield from out.select(["doc_id", "source", "size", "whole", "share", "bucket"]).combine_chunks().to_batches()

    return rows.mapInArrow(run, "doc_id long, source string, size long, whole long, share double, bucket long")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3, seed: int = 1) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) of every row of `docs`."""
    sizes = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", size_of(F.col("text")).alias("size")))
    per = stored(targets(sizes, weights, most))
    wanted = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    factor = per.select(F.col("source").alias("of"), wanted.alias("wanted"), "buckets")
    rows = sizes.join(factor, sizes["source"].eqNullSafe(factor["of"]))
    whole = F.floor("wanted")
    rows = rows.select(
        "doc_id",
        "source",
        "size",
        whole.alias("whole"),
        F.when(F.col("size") > 0, F.col("wanted") - whole).otherwise(0.0).alias("share"),
        F.pmod(F.xxhash64("doc_id", "size"), F.col("buckets")).alias("bucket"),
    )
    left = per.agg(F.max("buckets")).first()[0] or 1
    done, level = [], 0
    while True:
        rows = stored(_level(rows, seed, level, left == 1))
        open_share = F.expr("share > 0 and share < 1")
        done.append(rows.where(~open_share))
        if left == 1:
            break
        left, level = -(-left // BUCKET), level + 1
        rows = rows.where(open_share).withColumn("bucket", F.floor(F.col("bucket") / BUCKET))
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    out = out.withColumn("copies", (F.col("whole") + F.col("share")).cast("long"))
    known = per.select(F.col("source").alias("of"), "source_size", "target")
    out = out.join(known, out["source"].eqNullSafe(known["of"]))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3, seed: int = 1) -> DataFrame:
    """Rows of `docs`, each as often as the mix takes it, with columns size, source_size, target, taken and copy from 1."""
    picked = mix(docs, weights, most, seed)
    own = ["doc_id", "source", "size"]
    same = Window.partitionBy(*own).orderBy(F.desc("copies"))
    picked = picked.where("copies > 0").withColumn("_nth", F.row_number().over(same))
    picked = picked.select(*[F.col(c).alias(f"_{c}") for c in own], "_nth", "source_size", "target", "taken", "copies")
    extra = ("size", "source_size", "target", "taken", "copies", "copy")
    rows = docs.select(*[c for c in docs.columns if c not in extra], size_of(F.col("text")).alias("size"))
    rows = rows.withColumn("_row", F.row_number().over(Window.partitionBy(*own).orderBy(F.xxhash64("text"))))
    match = [rows["doc_id"].cast("long").eqNullSafe(picked["_doc_id"]), rows["source"].eqNullSafe(picked["_source"])]
    match += [rows["size"] == picked["_size"], rows["_row"] == picked["_nth"]]
    rows = rows.join(picked, match).withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
    return rows.drop("_doc_id", "_source", "_size", "_nth", "_row", "copies")
