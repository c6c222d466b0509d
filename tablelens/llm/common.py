"""Helpers the operators share: scratch tables, byte and word arrays of Arrow texts, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that are turned into arrays at a time (a longer text is taken alone).
CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; only a local master may do without the setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="tablelens-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def stored(df: DataFrame) -> DataFrame:
    """`df` written once as a table in the shared scratch folder and read back.

    Cuts the lineage, so a lost executor costs tasks and not the whole job, and
    lets several readers share one computation.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/tablelens-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------- texts as arrays


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of the hash base and of its inverse modulo 2**64, kept as long as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), CHUNK + 1)
            inverse = pow(_BASE, -1, 1 << 64)
            self.up = np.multiply.accumulate(np.r_[_U(1), np.full(size - 1, _BASE, np.uint64)])
            self.down = np.multiply.accumulate(np.r_[_U(1), np.full(size - 1, inverse, np.uint64)])
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H with H[i] the polynomial hash of data[:i]; see span_hash."""
    up, _ = _POWERS.get(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * up[:-1], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end) of the data that `prefix` was made of."""
    _, down = _POWERS.get(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def chunks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of a text column, about CHUNK bytes at a time.

    Null texts are empty. Row first + k has bytes[offsets[k]:offsets[k + 1]].
    """
    texts = batch.column(batch.schema.get_field_index(column))
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK, "right")) - 1
        last = min(n, max(last, first + 1))
        own = offsets[first : last + 1]
        yield first, last, data[own[0] : own[-1]], own - own[0]
        first = last


#: ASCII capitals to small letters, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes that separate words: space and the controls 9 to 13.
SPACES = np.zeros(256, bool)
SPACES[[32, *range(9, 14)]] = True


def words(
    data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the words of concatenated texts; none reaches over two texts."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~separators[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    row = np.searchsorted(offsets, start, "right") - 1
    return start, end, row


# ---------------------------------------------------------------- groups of sorted rows


def groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """(key, rows) of batches sorted by `keys`; one group is held at a time."""
    held: list[pa.RecordBatch] = []
    current: tuple | None = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(n, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), n]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = tuple(c[a] for c in columns)
            if current is not None and key != current:
                yield current, pa.Table.from_batches(held)
                held = []
            current = key
            held.append(batch.slice(a, b - a))
    if held:
        yield current, pa.Table.from_batches(held)


# ---------------------------------------------------------------- components


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of `edges` (columns a, b, long): the smallest reachable node.

    Alternating star contraction: each round hangs every neighbour of a node on
    the smallest one, by one aggregation and one join per half-round. The
    number of rounds grows with the logarithm of the longest path. Rounds are
    stored in the shared folder; only a count and a checksum reach the driver.
    """
    now = stored(edges.select("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        # large star: larger neighbours go to the smallest of the node and its neighbours
        both = now.select("a", "b").union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = stored(large.where("a <> b").distinct())
        # small star: smaller neighbours and the node itself go to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        now = stored(small.union(least.select("a", F.col("least").alias("b"))).where("a <> b").distinct())
        found = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == state:
            break
        state = found
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
