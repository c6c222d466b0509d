"""Exact top-k search: norm-bucketed retrieval.

Vectors are put in order of length and cut into buckets. A bucket's longest
vector bounds every product with it, so with a lower bound of a query's k-th
best product the whole bucket is left out for queries it cannot serve. The
bound comes from the first bucket, which holds the longest vectors. For the
others the bound divided by both lengths is a cosine threshold of this query in
this bucket: where it is high, the coordinates in which the query is largest
must lie in narrow ranges (coordinate pruning); where it is low, only shorter
vectors of the bucket can be left out (length pruning). What stays is verified
by exact integer products.

Queries are packed into blocks, and a block meets a bucket as one row meets
one row; pairs that length pruning leaves out are never formed. Each pair gives
at most k rows per query.

Rows are numbered and stored first, so rows that share an id are rows of their
own, as queries and as candidates, and only the query's own row is left out.
Matrices travel in the narrowest of 16, 32 or 64 bits that holds them.

Defined cases: vectors that are null or hold a null or non-finite component
take no part, nor do rows without an id; an empty vector has product 0 with
every other; vectors of different lengths are compared as if the shorter ended
in zeros; equal products go to the smaller id; fewer than k others give fewer
rows; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Vectors of a bucket; queries of a block.
BUCKET, BLOCK = 2048, 512
#: Components are kept in the first of these that holds them.
WIDTHS = (np.int16, np.int32, np.int64)
#: Cosine threshold from which coordinates prune, and how many are looked at.
NARROW, FOCUS = 0.5, 4
_PACKED = "part long, high double, low double, n int, dims int, width int, rows binary, ids binary, data binary, norms binary"


def scaled(embedding: Column, factor: int = 256) -> Column:
    """floor(factor * x) of every component, null where the vector takes no part."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(embedding, lambda x: F.floor(x.cast("double") * factor))
    return F.when(embedding.isNotNull() & ~bad, whole)


def _packed(vectors: DataFrame, rows: int) -> DataFrame:
    """Runs of at most `rows` vectors (row, vec_id, v, norm) in falling order of length, a matrix per run."""
    ordered = vectors.repartitionByRange(F.desc("norm"), F.col("vec_id")).sortWithinPartitions(F.desc("norm"), "vec_id")

    def pack(numbers: np.ndarray, ids: np.ndarray, norms: np.ndarray, v: pa.Array, part: int) -> tuple:
        size = v.value_lengths().to_numpy()
        data = np.zeros((len(ids), int(size.max())), np.int64)
        data[np.repeat(np.arange(len(ids)), size), np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)] = v.flatten().to_numpy()
        data = data.astype(next(t for t in WIDTHS if t is np.int64 or np.array_equal(data.astype(t), data)))
        return (part, norms[0], norms[-1], len(ids), data.shape[1], data.itemsize, numbers.tobytes(), ids.tobytes(), data.tobytes(), norms.tobytes())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        types = [pa.int64(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 4]

        def out(table: pa.Table) -> pa.RecordBatch:
            nonlocal part
            columns = [table.column(c).combine_chunks() for c in ("row", "vec_id", "norm", "v")]
            row = pack(*[c.to_numpy() for c in columns[:3]], columns[3], part)
            part += 1
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], [f.split()[0] for f in _PACKED.split(", ")])

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= rows:
                table = pa.Table.from_batches(held)
                yield out(table.slice(0, rows))
                held = table.slice(rows).to_batches()
        if sum(b.num_rows for b in held):
            yield out(pa.Table.from_batches(held))

    return ordered.select("row", "vec_id", "v", "norm").mapInArrow(run, _PACKED)


def _matrix(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, ids, components and lengths of a run."""
    if row["dims"]:
        data = np.frombuffer(row["data"], f"i{row['width']}").reshape(row["n"], row["dims"]).astype(np.int64)
    else:
        data = np.zeros((row["n"], 0), np.int64)
    return np.frombuffer(row["rows"], np.int64), np.frombuffer(row["ids"], np.int64), data, np.frombuffer(row["norms"], np.float64)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of integer rows; by doubles where no partial sum can leave their exact range."""
    n = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, n - x.shape[1]))) if x.shape[1] < n else x for x in (a, b))
    one, two = (np.abs(x).max(initial=0) for x in (a, b))
    if float(one) * float(two) * n < 2**52:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def top_in_bucket(queries: dict, bucket: dict, bounds: np.ndarray, k: int) -> list[tuple[int, int, int, int]]:
    """(row of the query, query, vec_id, score) of the up to k best of a bucket that can reach each query's bound."""
    q_rows, q_ids, q, q_norms = _matrix(queries)
    rows, ids, data, norms = _matrix(bucket)
    unit = data / np.maximum(norms, 1e-300)[:, None]
    out = []
    for row in range(len(q_ids)):
        bound, norm = bounds[row], q_norms[row]
        slack = 1e-9 * (1 + abs(bound)) if np.isfinite(bound) else 0.0
        if norm * norms[0] + slack < bound:
            continue
        near = np.arange(len(ids))
        if np.isfinite(bound) and bound > 0 and norm > 0:
            threshold = (bound - slack) / (norm * norms[0])
            if threshold >= NARROW:
                ahead = q[row] / norm
                rest = max(0.0, 1 - threshold * threshold)
                for d in np.argsort(-np.abs(ahead))[:FOCUS]:
                    if d >= unit.shape[1]:
                        continue
                    wide = np.sqrt(rest * max(0.0, 1 - ahead[d] ** 2)) + 1e-9
                    inside = np.abs(unit[near, d] - ahead[d] * threshold) <= wide
                    # beyond the range on the query's side only where the cosine is above the threshold
                    inside |= (ahead[d] > 0) & (unit[near, d] >= ahead[d] * threshold) | (ahead[d] < 0) & (unit[near, d] <= ahead[d] * threshold)
                    near = near[inside]
            else:
                near = near[: int(np.searchsorted(-norms, -(bound - slack) / norm, "right"))]
        near = near[rows[near] != q_rows[row]]
        if not len(near):
            continue
        scores = _products(q[row : row + 1], data[near])[0]
        fits = scores >= bound if np.isfinite(bound) else np.ones(len(scores), bool)
        near, scores = near[fits], scores[fits]
        for at in _best(scores, ids[near], k):
            out.append((int(q_rows[row]), int(q_ids[row]), int(ids[near[at]]), int(scores[at])))
    return out


def _bounded(blocks: DataFrame, first: DataFrame, k: int) -> DataFrame:
    """Blocks with the k-th best product of each query in the bucket of the longest vectors (bounds)."""
    longest = first.select(*[F.col(c).alias(f"b_{c}") for c in first.columns])
    pairs = blocks.withColumn("_one", F.lit(1)).join(F.broadcast(longest.withColumn("_one", F.lit(1))), "_one").drop("_one")  # one row of BUCKET vectors

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, need = [], []
            for row in batch.to_pylist():
                q_rows, _, q, q_norms = _matrix(row)
                rows, _, data, _ = _matrix({c[2:]: x for c, x in row.items() if c.startswith("b_")})
                own = np.full(len(q_rows), -np.inf)
                for i in range(len(q_rows)):
                    scores = _products(q[i : i + 1], data[rows != q_rows[i]])[0]
                    if len(scores) >= k:
                        own[i] = np.partition(scores, len(scores) - k)[len(scores) - k]
                bounds.append(own.tobytes())
                need.append(float(np.min(np.where(own > 0, own / np.maximum(q_norms, 1e-300), 0.0))) * (1 - 1e-9))
            kept = batch.select([f.split()[0] for f in _PACKED.split(", ")])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(bounds, pa.binary()), pa.array(need)], [*kept.schema.names, "bounds", "need"])

    return pairs.mapInArrow(run, f"{_PACKED}, bounds binary, need double")


def top_products(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k largest integer products of each query row of `vectors` (vec_id, v)."""
    squares = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    known = vectors.where("vec_id is not null and v is not null").select("vec_id", "v", F.sqrt(squares).alias("norm"), is_query.alias("query"))
    # stored, so that a row has one number in buckets and blocks, also where a task runs again
    known = stored(known.withColumn("row", F.monotonically_increasing_id()))
    buckets = stored(_packed(known, BUCKET))
    blocks = stored(_packed(known.where("query"), BLOCK))
    first = buckets.orderBy(F.desc("high"), "part").limit(1)
    blocks = stored(_bounded(blocks, first, k))
    # which buckets can serve which blocks: numbers only, the matrices follow
    meet = F.broadcast(blocks.agg(F.collect_list(F.struct("part", "need")).alias("of")))  # one row, 16 bytes per BLOCK queries
    pairs = buckets.select("part", "high", F.lit(1).alias("_one")).join(meet.withColumn("_one", F.lit(1)), "_one")
    pairs = pairs.select(F.col("part").alias("bucket"), F.explode(F.expr("filter(of, x -> high >= x.need)")).alias("x"))
    pairs = pairs.select("bucket", F.col("x.part").alias("block"))
    pairs = pairs.join(buckets.select(*[F.col(c).alias(f"b_{c}") for c in buckets.columns]), F.col("bucket") == F.col("b_part"))
    pairs = pairs.join(blocks, F.col("block") == F.col("part")).repartition("bucket", "block")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                bucket = {c[2:]: x for c, x in row.items() if c.startswith("b_")}
                found = top_in_bucket(row, bucket, np.frombuffer(row["bounds"], np.float64), k)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["query_row", "query_id", "vec_id", "score"])

    found = pairs.mapInArrow(run, "query_row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
         CASE WHEN len(q.v) = 0 OR len(c.v) = 0 THEN 0 ELSE CAST(list_inner_product(q.v, c.v) AS BIGINT) END AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.r <> q.r)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
