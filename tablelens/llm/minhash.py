"""MinHash near-dedup: circulant MinHash.

Two permutations of the 64-bit shingle hashes make the whole signature: sigma
scatters a set once, and pi, shifted circularly by k, gives coordinate k as the
least pi(sigma(v) + k mod 2**64). Coordinates are cut into bands of `rows`; sets
that agree in a band meet, and a link is confirmed on the full sets.

How many rows a band has follows from the similarity: as many as keep the
chance to miss a pair of just that similarity below MISS (7e-9 at 0.85, with 32
bands of 5). A pair that meets goes on only if its signatures agree in at least
the similarity less 0.2, which is seven standard deviations.

No group is held whole or expanded into its pairs. In a round, each key that
still joins several components takes one of its sets, of its largest component,
as pivot; the pivot meets the sets of other components, and then leaves the key
for good, as all its pairs there are decided. Near copies come together in a few
such rounds, each linear in the rows; the components are kept from round to round,
and only edges between different ones are followed. What is left of a key is decided in blocks:
the sets outside its largest component, in chunks, against all of them, first by
signatures and then, where these come near, by an index of the shingles of a
chunk. That last step grows with the product of the two sides, as sets that are
near but not linked have to be told apart one by one; its memory is bounded.

Equal sets are one node from the start, named by 64 bits of the hash of the set.

Defined cases: null or empty text and text without a word has an empty set and
links with nothing; fewer words than a shingle count as one shingle; repeated
rows and equal texts link; different sets of one doc_id are nodes of their own;
a row without doc_id connects others as any row does, and its component is null
if no row of it has a doc_id; kept is true where doc_id and component_id are
equal or both null; extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, groups, mix, stored
from .jaccard_join import Forest, shingle_sets

#: Coordinates of a signature, and the chance to miss a pair of just the similarity asked for.
COORDINATES = 160
MISS = 1e-8
#: Rounds of pivots before what is left is decided in blocks.
ROUNDS = 3
#: Signatures, then shingles, of a chunk and of a block.
CHUNK, BLOCK = 4_096, 65_536
CHUNK_SHINGLES, BLOCK_SHINGLES = 400_000, 4_000_000
#: Sets that one task compares with a pivot, about.
PER_PIVOT = 5_000
#: Numbers that are compared at a time.
AT_ONCE = 1 << 22
_U = np.uint64
_SIGMA, _PI, _BAND, _SET = _U(0x632BE59BD9B4E019), _U(0x9E6C63D0876A9A47), _U(0xD2B74407B1CE6E93), _U(0xA0761D6478BD642F)


def rows_per_band(percent: int) -> int:
    """The most rows of a band that keep the chance of a miss below MISS."""
    similarity = percent / 100
    fitting = [r for r in range(1, 17) if (1 - similarity**r) ** (COORDINATES // r) <= MISS]
    return max(fitting, default=1)


def least_agreement(percent: int) -> int:
    """Coordinates in which the signatures of a pair agree at least."""
    return max(1, COORDINATES * (percent - 20) // 100)


def signature(own: np.ndarray) -> np.ndarray:
    """All coordinates of a set that is not empty."""
    scattered = mix(own ^ _SIGMA)
    shift = np.arange(COORDINATES, dtype=np.uint64)[:, None]
    out = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    step = AT_ONCE // 8 // COORDINATES
    for k in range(0, len(scattered), step):
        np.minimum(out, mix((scattered[k : k + step] + shift) ^ _PI).min(axis=1), out=out)
    return out


def band_keys(coordinates: np.ndarray, rows: int) -> np.ndarray:
    """One key for each band."""
    bands = coordinates[: len(coordinates) // rows * rows].reshape(-1, rows)
    factors = mix(np.arange(1, rows + 1, dtype=np.uint64)) | _U(1)
    return mix((bands * factors).sum(axis=1, dtype=np.uint64) + np.arange(len(bands), dtype=np.uint64) * _BAND)


def sketches(docs: DataFrame, percent: int, width: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, s1, s2, keys, low) of each row: a 128-bit hash of its set, the keys of the bands,
    and the lowest byte of each coordinate."""
    rows = rows_per_band(percent)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, one, two, keys, low = [], [], [], [], []
            for own in shingle_sets(batch, width):
                size.append(len(own))
                one.append(mix(own).sum(dtype=np.uint64))
                two.append(mix(own ^ _SET).sum(dtype=np.uint64))
                if len(own):
                    coordinates = signature(own)
                    keys.append(band_keys(coordinates, rows).view(np.int64))
                    low.append(coordinates.astype(np.uint8).tobytes())
                else:
                    keys.append([])
                    low.append(b"")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(size, pa.int64()),
                    *(pa.array(np.asarray(x, np.uint64).view(np.int64)) for x in (one, two)),
                    pa.array(keys, pa.list_(pa.int64())), pa.array(low, pa.binary()),
                ],
                ["doc_id", "text_hash", "n_shingles", "s1", "s2", "keys", "low"],
            )

    given = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return given.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, s1 long, s2 long, keys array<long>, low binary")


def distinct_sets(known: DataFrame) -> DataFrame:
    """(node, s1, s2, doc_id, text_hash, size, keys, low) of every set that is not empty; doc_id and text_hash name a row that holds it."""
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", F.col("n_shingles").alias("size"))
    found = known.where("n_shingles > 0").groupBy("s1", "s2").agg(F.min(row).alias("of"), F.first("keys").alias("keys"), F.first("low").alias("low"))
    return found.select(F.xxhash64("s1", "s2").alias("node"), "s1", "s2", "of.doc_id", "of.text_hash", "of.size", "keys", "low")


# ---------------------------------------------------------------- pairs with a pivot


def likely(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows of `pairs` (pivot, node) whose sizes and signatures leave the similarity open."""
    least = least_agreement(percent)
    one = sets.select(F.col("node").alias("pivot"), F.col("size").alias("size_a"), F.col("low").alias("low_a"))
    two = sets.select("node", F.col("size").alias("size_b"), F.col("low").alias("low_b"))
    both = pairs.join(one, "pivot").join(two, "node")
    both = both.where((100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b")) & (F.col("pivot") != F.col("node")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, COORDINATES) for k in (2, 3))
            fits = pa.array((a == b).sum(axis=1) >= least)
            yield batch.select([0, 1]).filter(fits)

    return both.select("pivot", "node", "low_a", "low_b").mapInArrow(run, "pivot long, node long")


def texts_of(nodes: DataFrame, docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, text): one text for each of `nodes`."""
    wanted = sets.join(nodes.select("node").distinct(), "node", "left_semi").select("node", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    same = docs["doc_id"].eqNullSafe(wanted["_id"]) & (F.xxhash64(docs["text"]) == wanted["_hash"])
    return docs.join(wanted, same).select("node", "text").dropDuplicates(["node"])


def linked(roles: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Edges (a, b) of `roles` (g, i, j, member, node, comp): of each group (g, i, j), its pivots against its members.

    Pivots come first and are held, as an index of their shingles; members
    stream past. A pair whose components the group has joined already gives no
    edge.
    """
    rows = roles.join(texts, "node").select("g", "i", "j", "member", "node", "comp", "text")
    rows = rows.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "member", "node")
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, pivots, index, forest = None, [], None, {}

        def root(x: int) -> int:
            while (up := forest.get(x, x)) != x:
                forest[x] = forest.get(up, up)
                x = up
            return x

        for batch in batches:
            keys = zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True)
            found: list[tuple[int, int]] = []
            for (g, i, j, member, node, comp), own in zip(keys, shingle_sets(batch, width), strict=True):
                if (g, i, j) != current:
                    current, pivots, index, forest = (g, i, j), [], None, {}
                if not member:
                    pivots.append((node, comp, own))
                    continue
                if index is None:
                    index = ChunkIndex([own for _, _, own in pivots])
                for k in index.similar(own, percent).tolist():
                    a, b = root(pivots[k][1]), root(comp)
                    if a != b:
                        forest[max(a, b)] = min(a, b)
                        found.append((pivots[k][0], node))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], schema=out)

    return rows.mapInArrow(run, "a long, b long")


class ChunkIndex:
    """The sets of a chunk by shingle."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(s) for s in sets], np.int64)
        tokens = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        order = np.argsort(tokens, kind="stable")
        self.owner = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.tokens, self.start, self.count = np.unique(tokens[order], return_index=True, return_counts=True)

    def similar(self, own: np.ndarray, percent: int) -> np.ndarray:
        """Which sets have the similarity with `own`, exactly."""
        if not len(self.tokens):
            return np.empty(0, np.int64)
        at = np.searchsorted(self.tokens, own)
        at[at == len(self.tokens)] = 0
        at = at[self.tokens[at] == own]
        start, count = self.start[at], self.count[at]
        places = np.repeat(start - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum()) if len(at) else np.empty(0, np.int64)
        shared = np.bincount(self.owner[places], minlength=len(self.sizes))
        return np.flatnonzero((100 * shared >= percent * (self.sizes + len(own) - shared)) & (shared > 0))


def pivot_links(pairs: DataFrame, docs: DataFrame, sets: DataFrame, n_nodes: int, percent: int, width: int) -> DataFrame:
    """Edges (a, b): the `pairs` (pivot, node) that are links. A pivot of many sets is dealt to several tasks."""
    pairs = stored(likely(pairs, sets, percent))
    parts = max(16, n_nodes // PER_PIVOT)
    dealt = pairs.select("pivot", "node", F.pmod(F.xxhash64("node"), F.lit(parts)).cast("int").alias("i"))
    none = F.lit(0).alias("j")
    pivots = dealt.select(F.col("pivot").alias("g"), "i").distinct().select("g", "i", none, F.lit(0).alias("member"), F.col("g").alias("node"), F.col("g").alias("comp"))
    members = dealt.select(F.col("pivot").alias("g"), "i", none, F.lit(1).alias("member"), "node", F.col("node").alias("comp"))
    nodes = pairs.select("node").union(pairs.select(F.col("pivot").alias("node")))
    return linked(pivots.union(members), texts_of(nodes, docs, sets), percent, width)


# ---------------------------------------------------------------- rounds


def extended(known: DataFrame, edges: DataFrame) -> DataFrame:
    """The components (node, component) of `known`, which is stored, once the edges (a, b) join some of them.

    Only edges between different components are followed, as edges of these.
    """
    ends = [known.select(F.col("node").alias(e), F.col("component").alias(f"of_{e}")) for e in "ab"]
    placed = edges.join(ends[0], "a", "left").join(ends[1], "b", "left").select(*[F.coalesce(f"of_{e}", e).alias(e) for e in "ab"])
    joins = stored(placed.where("a <> b").distinct())
    if joins.isEmpty():
        return known
    joined = stored(components(joins))
    top = joined.select(F.col("node").alias("component"), F.col("component").alias("top"))
    moved = known.join(top, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    return stored(moved.union(joined.join(known, "node", "left_anti").select("node", "component")))


def with_components(rows: DataFrame, known: DataFrame) -> DataFrame:
    """`rows` (key, node) with comp, the component that `known` gives the node."""
    return rows.join(known.withColumnRenamed("component", "comp"), "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))


def open_keys(rows: DataFrame, turn: int) -> DataFrame:
    """(key, pivot, largest, inside, total) of the keys of `rows` (key, node, comp) that still hold several components.

    `largest` is the component with the most rows of the key, pivot one of its nodes, another one each turn.
    """
    some = F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node")).alias("some")
    each = rows.groupBy("key", "comp").agg(F.count("*").alias("n"), some)
    of = each.groupBy("key").agg(
        F.max(F.struct("n", F.col("some.node").alias("pivot"), "comp")).alias("top"), F.count("*").alias("comps"), F.sum("n").alias("total")
    )
    return of.where("comps > 1").select("key", "top.pivot", F.col("top.comp").alias("largest"), F.col("top.n").alias("inside"), "total")


def blocks(rows: DataFrame, chunk: int, block: int) -> DataFrame:
    """(g, i, j, member, node, comp) of `rows` (key, node, comp, weight): of every open key, the nodes outside its
    largest component, in chunks i of about `chunk` weight, against all its nodes, in blocks j of about `block`."""
    each = rows.groupBy("key", "comp").agg(F.count("*").alias("n"), F.sum("weight").alias("weight"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("mark"))
    of = each.groupBy("key").agg(
        F.max(F.struct("n", "comp", "weight")).alias("top"), F.count("*").alias("comps"), F.sum("n").alias("total"),
        F.sum("weight").alias("weight"), F.sum("mark").alias("mark"),
    ).where("comps > 1")
    # keys with the same rows are one
    of = of.groupBy("total", "mark").agg(F.min(F.struct("key", "top", "weight")).alias("of")).select("of.*")
    of = of.select(
        "key", F.col("top.comp").alias("largest"),
        F.ceil((F.col("weight") - F.col("top.weight")) / chunk).cast("int").alias("chunks"), F.ceil(F.col("weight") / block).cast("int").alias("blocks"),
    )
    placed = rows.join(of, "key").withColumn("h", F.xxhash64("node", F.lit(7)))

    def dealt(member: int, own: str, others: str, mine: str, theirs: str) -> DataFrame:
        place, every = F.pmod("h", own).cast("int").alias(mine), F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias(theirs)
        return placed.where("true" if member else "comp <> largest").select(F.col("key").alias("g"), place, every, F.lit(member).alias("member"), "node", "comp").select(
            "g", "i", "j", "member", "node", "comp"
        )

    return dealt(0, "chunks", "blocks", "i", "j").union(dealt(1, "blocks", "chunks", "j", "i"))


def near_by_signature(roles: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(key, node): nodes of different components whose signatures come near, key being the smallest node they lead to."""
    least = least_agreement(percent)
    rows = roles.join(sets.select("node", "size", "low"), "node").select("g", "i", "j", "member", "node", "comp", "size", "low")
    rows = rows.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "member", "node")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groups(batches, ["g", "i", "j"]):
            member, node, comp, size = (rows.column(c).to_numpy() for c in ("member", "node", "comp", "size"))
            low = np.frombuffer(b"".join(rows.column("low").to_pylist()), np.uint8).reshape(-1, COORDINATES)
            names, at = np.unique(node, return_inverse=True)
            forest, pivots = Forest(len(names)), np.flatnonzero(member == 0)
            others = np.flatnonzero(member == 1)
            step = max(1, AT_ONCE // COORDINATES // max(1, len(pivots)))
            for k in range(0, len(others), step):
                these = others[k : k + step]
                fits = comp[these][:, None] != comp[pivots]
                fits &= 100 * np.minimum(size[these][:, None], size[pivots]) >= percent * np.maximum(size[these][:, None], size[pivots])
                x, y = np.nonzero(fits)
                for s in range(0, len(x), AT_ONCE // COORDINATES):
                    one, two = these[x[s : s + AT_ONCE // COORDINATES]], pivots[y[s : s + AT_ONCE // COORDINATES]]
                    near = (low[one] == low[two]).sum(axis=1) >= least
                    for p, q in zip(at[one[near]].tolist(), at[two[near]].tolist(), strict=True):
                        a, b = forest.root(p), forest.root(q)
                        if a != b:
                            forest.join(a, b)
            root = np.array([forest.root(x) for x in range(len(names))])
            many = np.bincount(root, minlength=len(names))[root] > 1
            yield pa.RecordBatch.from_arrays([pa.array(names[root[many]]), pa.array(names[many])], ["key", "node"])

    return rows.mapInArrow(run, "key long, node long").distinct()


def linked_components(docs: DataFrame, sets: DataFrame, percent: int, width: int) -> DataFrame:
    """(node, component) of the ones of `sets`, which is stored, that are linked; others may be absent."""
    n_nodes = sets.count()
    left = sets.select(F.explode("keys").alias("key"), "node")
    many = left.groupBy("key").agg(F.count("*").alias("n"), F.max("node").alias("pivot")).where("n > 1").select("key", "pivot")
    rows = stored(left.join(many, "key"))
    known = stored(components(stored(pivot_links(rows.select("pivot", "node").distinct(), docs, sets, n_nodes, percent, width))))
    for turn in range(ROUNDS):
        rows = stored(with_components(rows.where("node <> pivot").select("key", "node"), known))
        keys = stored(open_keys(rows, turn))
        if keys.isEmpty():
            return known
        if turn == ROUNDS - 1:
            break
        rows = stored(rows.join(keys.select("key", "pivot", "largest"), "key"))
        pairs = rows.where("comp <> largest").select("pivot", "node").distinct()
        known = extended(known, stored(pivot_links(pairs, docs, sets, n_nodes, percent, width)))
    near = stored(near_by_signature(blocks(rows.withColumn("weight", F.lit(1)), CHUNK, BLOCK), sets, percent))
    if near.isEmpty():
        return known
    near = with_components(near, known).join(sets.select("node", F.col("size").alias("weight")), "node")
    roles = stored(blocks(stored(near.select("key", "node", "comp", "weight")), CHUNK_SHINGLES, BLOCK_SHINGLES))
    return extended(known, stored(linked(roles, texts_of(roles.select("node"), docs, sets), percent, width)))


def near_duplicates(docs: DataFrame, percent: int = 85, width: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of `docs`.

    component_id is the smallest doc_id that links of at least `percent` / 100
    reach; one document of each component is kept.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = stored(sketches(docs, percent, width))
    sets = stored(distinct_sets(known))
    found = linked_components(docs, sets, percent, width)
    named = sets.join(found, "node", "left").select("s1", "s2", "doc_id", F.coalesce("component", "node").alias("component"))
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = stored(named.join(smallest, "component").select("s1", "s2", "component_id"))
    result = known.drop("keys", "low").join(named, ["s1", "s2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
