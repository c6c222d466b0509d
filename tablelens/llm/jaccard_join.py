"""N-gram Jaccard join: count-vector R-tree.

A document's set holds its distinct word shingles as 64-bit hashes. Shingles
are hashed into GROUPS groups; the counts per group make a point. Two sets
share at most the sum of the coordinate minima of their points, and a node of
an R-tree over points bounds that sum by its largest coordinates, so whole
nodes that cannot reach the overlap a similarity asks for are left out. What
remains is verified on the sets themselves.

Spark brings together what may be similar at all: under any fixed order of all
shingles, two sets of similarity t share a shingle among their first
n - ceil(t n) + 1. The order puts shingles that are frequent in a bounded
sample last; it moves work, never results. The sets that share such a shingle,
in order of size and cut where sizes are too far apart, form a cell named after
its first set, so the same sets meet once and not once per shingle. Each cell
is an R-tree join of points; the sets it cannot tell apart are joined again as
sets, and the output is a forest: a pair that is already connected needs no
edge. A cell that is too large is cut into blocks, and each pair of blocks is
a cell of its own. Equal sets are one node from the start, named by 64 bits of
the hash of the set; a text is fetched by the doc_id and the hash of the text of
one row that holds the set.

Defined cases: null or empty text and text without a word has an empty set and
links with nothing; fewer words than a shingle count as one shingle; repeated
rows and equal texts link; different sets of one doc_id are nodes of their own;
a row without doc_id connects others as any row does, and its component is null
if no row of it has a doc_id; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SPACES, chunks, components, groups, mix, prefix_hash, span_hash, stored, words

#: Shingles per group of a point, on average; the number of groups is a power of two.
PER_GROUP = 4
#: Rows of the sample whose frequent shingles come last in the order, and how many of these are known.
SAMPLE_ROWS = 20_000
FREQUENT = 100_000
#: Shingles of all sets in one block of a large cell.
BLOCK = 400_000
#: Points of an R-tree leaf, children of an inner node; numbers compared at a time.
LEAF = 16
AT_ONCE = 1 << 22
_U = np.uint64
_ODD = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def shingle_sets(batch: pa.RecordBatch, width: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a batch, row by row."""
    factors = mix(_ODD[0] * np.arange(1, width + 1, dtype=np.uint64)) | _U(1)
    for first, last, data, offsets in chunks(batch, "text"):
        data = LOWER[data]
        start, end, row = words(data, offsets)
        hashed = span_hash(prefix_hash(data), start, end)
        count = np.bincount(row, minlength=last - first) if len(row) else np.zeros(last - first, np.int64)
        begin = np.r_[0, np.cumsum(count)]
        whole = max(len(hashed) - width + 1, 0)
        rolled = np.zeros(whole, np.uint64)
        for j in range(width):
            rolled += hashed[j : j + whole] * factors[j]
        rolled = mix(rolled)
        for k in range(last - first):
            a, n = int(begin[k]), int(count[k])
            if n >= width:
                own = np.sort(rolled[a : a + n - width + 1])
                yield own[np.r_[True, own[1:] != own[:-1]]]
            elif n:
                yield mix(np.array([np.sum(hashed[a : a + n] * factors[:n]) + _U(n)], np.uint64))
            else:
                yield np.empty(0, np.uint64)


def profiles(docs: DataFrame, width: int = 5) -> DataFrame:
    """(doc_id, text_hash, n_shingles, s1, s2, point): the set's size, a 128-bit hash of it and its group counts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, one, two, points = [], [], [], []
            for own in shingle_sets(batch, width):
                size.append(len(own))
                one.append(mix(own).sum(dtype=np.uint64))
                two.append(mix(own ^ _ODD[1]).sum(dtype=np.uint64))
                points.append(point(own).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size, pa.int64()), _longs(one), _longs(two), pa.array(points, pa.binary())],
                ["doc_id", "text_hash", "n_shingles", "s1", "s2", "point"],
            )

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, s1 long, s2 long, point binary")


def distinct_sets(known: DataFrame) -> DataFrame:
    """(s1, s2, node, doc_id, text_hash, size, point) of every set of `known` that is not empty.

    doc_id and text_hash are those of its first row, null ids last.
    """
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", F.col("n_shingles").alias("size"), "point")
    found = known.where("n_shingles > 0").groupBy("s1", "s2").agg(F.min(first).alias("of"))
    return found.select("s1", "s2", F.xxhash64("s1", "s2").alias("node"), "of.doc_id", "of.text_hash", "of.size", "of.point")


def point(own: np.ndarray) -> np.ndarray:
    """Counts of a set's shingles by group; a set of twice the size has twice the groups."""
    n = 1 << max(3, (max(len(own), 1) // PER_GROUP).bit_length())
    return np.bincount((own & _U(n - 1)).astype(np.int64), minlength=n).astype(np.uint16)


def _longs(values) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def prefix_length(size: int, percent: int) -> int:
    """How many first shingles of a set must hold one of any set of the similarity."""
    return size - -(-percent * size // 100) + 1


def prefixes(docs: DataFrame, frequent: np.ndarray, percent: int, width: int = 5) -> DataFrame:
    """(key, size, s1) for the first shingles of each set; `frequent` in falling order of frequency comes last."""
    order = np.argsort(frequent)
    known, place = frequent[order], (len(frequent) - order).astype(np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, nodes = [], [], []
            for own in shingle_sets(batch, width):
                if not len(own):
                    continue
                n = prefix_length(len(own), percent)
                if n < len(own) and len(known):
                    at = np.searchsorted(known, own)
                    at[at == len(known)] = 0
                    late = np.where(known[at] == own, place[at], 0)
                    own_first = own[np.argsort(late, kind="stable")[:n]] if late.any() else own[:n]
                else:
                    own_first = own[:n]
                keys.append(own_first)
                sizes.append(np.full(len(own_first), len(own), np.int32))
                nodes.append(np.full(len(own_first), mix(own).sum(dtype=np.uint64), np.uint64))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [_longs(np.concatenate(keys)), pa.array(np.concatenate(sizes)), _longs(np.concatenate(nodes))], ["key", "size", "s1"]
                )

    return docs.select("doc_id", "text").mapInArrow(run, "key long, size int, s1 long")


def cells(first: DataFrame, percent: int) -> DataFrame:
    """(head, s1): which sets share a key and may have sizes that fit, named after the first of them.

    Rows stream past in order of key and size, so a key of any number of rows
    takes no memory; a key has one row per distinct set at most.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = size = node = None  # the last row seen
        head, open_row = None, False  # the head of its cell; whether it is still to be written
        for batch in batches:
            if not batch.num_rows:
                continue
            k, n, s = (batch.column(c).to_numpy() for c in range(3))
            joins = np.zeros(len(k), bool)  # to the row before
            joins[1:] = (k[1:] == k[:-1]) & (100 * n[:-1].astype(np.int64) >= percent * n[1:].astype(np.int64))
            joins[0] = key is not None and k[0] == key and 100 * int(size) >= percent * int(n[0])
            begin = np.maximum.accumulate(np.where(joins, -1, np.arange(len(k))))
            heads = np.where(begin >= 0, s[np.maximum(begin, 0)], head if head is not None else 0)
            many = joins.copy()
            many[:-1] |= joins[1:]
            out_head, out_node = heads[many], s[many]
            if joins[0] and open_row:
                out_head, out_node = np.r_[head, out_head], np.r_[node, out_node]
            if len(out_head):
                yield pa.RecordBatch.from_arrays([pa.array(out_head), pa.array(out_node)], ["head", "s1"])
            key, size, node, head, open_row = k[-1], n[-1], s[-1], heads[-1], not many[-1]

    rows = first.repartition("key").sortWithinPartitions("key", "size", "s1")
    return rows.mapInArrow(run, "head long, s1 long").distinct()




def frequent_shingles(docs: DataFrame, n_rows: int, width: int = 5) -> np.ndarray:
    """The shingles held by the most sets of a sample of about SAMPLE_ROWS rows, FREQUENT at most.

    Only the order of shingles rests on it, so any sample gives the same result.
    """
    step = max(1, n_rows // SAMPLE_ROWS)
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in shingle_sets(batch, width):
                if len(own):
                    yield pa.RecordBatch.from_arrays([_longs(own)], ["key"])

    counted = sample.select("doc_id", "text").mapInArrow(run, "key long").groupBy("key").count().where("count > 2")
    rows = counted.orderBy(F.desc("count"), "key").limit(FREQUENT).select("key").toArrow()
    return rows.column("key").to_numpy().view(np.uint64)


# ---------------------------------------------------------------- the R-tree


class CountTree:
    """A packed R-tree over count vectors; nodes keep the largest coordinates and the size range."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray) -> None:
        self.points, self.sizes = points, sizes
        spread = np.argsort(-points.var(axis=0), kind="stable")[:3]
        scale = (8.0 * np.log2(np.maximum(sizes, 1))).astype(np.int64)
        self.order = np.lexsort([points[:, d] for d in spread[::-1]] + [scale])
        top, low, high = points[self.order], sizes[self.order], sizes[self.order]
        self.levels = []
        while True:
            cuts = np.arange(0, len(low), LEAF)
            top, low, high = np.maximum.reduceat(top, cuts), np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            self.levels.append((top, low, high))
            if len(low) == 1:
                break

    def pairs(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(i, j, bound) of the pairs of points whose bound reaches the similarity, in blocks."""
        step = max(64, AT_ONCE // self.points.shape[1])
        at = np.array([[0, 0]])
        for level in range(len(self.levels) - 1, -1, -1):
            top, low, high = self.levels[level]
            if level < len(self.levels) - 1:
                at = self._children(at, len(low))
            kept = []
            for k in range(0, len(at), step):
                a, b = at[k : k + step].T
                bound = np.minimum(top[a], top[b]).sum(axis=1)
                fits = (100 + percent) * bound >= percent * (low[a] + low[b])
                fits &= (100 * high[a] >= percent * low[b]) & (100 * high[b] >= percent * low[a])
                kept.append(at[k : k + step][fits])
            at = np.concatenate(kept)
            if not len(at):
                return
        step = max(1, step // LEAF**2)
        for k in range(0, len(at), step):
            a, b = self._children(at[k : k + step], len(self.order)).T
            a, b = a[a != b], b[a != b]
            i, j = self.order[a], self.order[b]
            small, large = np.minimum(self.sizes[i], self.sizes[j]), np.maximum(self.sizes[i], self.sizes[j])
            near = 100 * small >= percent * large
            i, j, both = i[near], j[near], (small + large)[near]
            bound = np.minimum(self.points[i], self.points[j]).sum(axis=1)
            fits = (100 + percent) * bound >= percent * both
            yield i[fits], j[fits], bound[fits]

    @staticmethod
    def _children(at: np.ndarray, n: int) -> np.ndarray:
        """The pairs of children a <= b of node pairs, of n children in all."""
        step = np.arange(LEAF)
        a = (at[:, 0, None, None] * LEAF + step[:, None]) + 0 * step
        b = (at[:, 1, None, None] * LEAF + step) + 0 * step[:, None]
        out = np.stack([a.ravel(), b.ravel()], axis=1)
        return out[(out[:, 0] <= out[:, 1]) & (out[:, 1] < n)]


def bounded_pairs(points: list[np.ndarray], sizes: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) of the pairs whose bound reaches the similarity, the likeliest of a block first.

    Points are compared at the smaller number of groups of the two; as sizes
    that fit differ by less than a factor of two, so do numbers of groups by
    one doubling at most. Each number of groups has its tree.
    """
    groups_of = np.array([len(p) for p in points])
    for n in np.unique(groups_of).tolist():
        own = np.flatnonzero((groups_of == n) | (groups_of == 2 * n))
        folded = np.stack([points[i].reshape(-1, n).sum(axis=0, dtype=np.int32) for i in own])
        for i, j, bound in CountTree(folded, sizes[own]).pairs(percent):
            i, j = own[i], own[j]
            now = (groups_of[i] == n) | (groups_of[j] == n)
            i, j, bound = i[now], j[now], bound[now]
            first = np.argsort(-(bound / (sizes[i] + sizes[j])), kind="stable")
            yield i[first], j[first]


class Forest:
    """Union-find over 0 .. n - 1."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, a: int, b: int) -> None:
        self.parent[max(a, b)] = min(a, b)


def similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have the similarity."""
    if len(one) > len(two):
        one, two = two, one
    at = np.searchsorted(two, one)
    at[at == len(two)] = 0
    shared = int((two[at] == one).sum())
    return 100 * shared >= percent * (len(one) + len(two) - shared)


def link_forest(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Edges (i, j) that connect the sets as all links of the similarity do."""
    sizes = np.array([len(s) for s in sets], np.int64)
    forest, edges = Forest(len(sets)), []
    for i, j in bounded_pairs([point(s) for s in sets], sizes, percent):
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            a, b = forest.root(x), forest.root(y)
            if a != b and similar(sets[x], sets[y], percent):
                forest.join(a, b)
                edges.append((x, y))
    return edges


def _in_blocks(members: DataFrame, cell: str) -> DataFrame:
    """`members` (cell, node, size, ...) with columns one, two: the pairs of blocks of a cell a row takes part in."""
    total = members.groupBy(cell).agg(F.sum("size").alias("total"))
    blocks = F.when(F.col("total") <= 2 * BLOCK, 1).otherwise(F.ceil(F.col("total") / BLOCK)).cast("int")
    placed = members.join(total.select(cell, blocks.alias("blocks")), cell)
    placed = placed.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("with", F.explode(F.expr("sequence(0, blocks - 1)")))
    placed = placed.withColumns({"one": F.least("own", "with"), "two": F.greatest("own", "with")})
    return placed.drop("own", "with", "blocks")


def candidates(members: DataFrame, percent: int) -> DataFrame:
    """(cell, node, size): sets that a bound connects, of `members` (head, node, size, point)."""
    rows = _in_blocks(members, "head").repartition("head", "one", "two").sortWithinPartitions("head", "one", "two", "node")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groups(batches, ["head", "one", "two"]):
            ids, sizes = rows.column("node").to_numpy(), rows.column("size").to_numpy().astype(np.int64)
            points = [np.frombuffer(p, np.uint16) for p in rows.column("point").to_pylist()]
            forest = Forest(len(ids))
            for i, j in bounded_pairs(points, sizes, percent):
                for x, y in zip(i.tolist(), j.tolist(), strict=True):
                    a, b = forest.root(x), forest.root(y)
                    if a != b:
                        forest.join(a, b)
            root = np.array([forest.root(x) for x in range(len(ids))])
            many = np.bincount(root, minlength=len(ids))[root] > 1
            yield pa.RecordBatch.from_arrays([pa.array(ids[root[many]]), pa.array(ids[many]), pa.array(sizes[many])], ["cell", "node", "size"])

    return rows.mapInArrow(run, "cell long, node long, size long").distinct()


def texts_of(nodes: DataFrame, docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, text): one text for each of `nodes`; rows that repeat it stay out."""
    wanted = nodes.distinct().join(sets.select("node", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")), "node")
    same = docs["doc_id"].eqNullSafe(wanted["_id"]) & (F.xxhash64(docs["text"]) == wanted["_hash"])
    return docs.join(wanted, same).select("node", "text").dropDuplicates(["node"])


def links(docs: DataFrame, sets: DataFrame, n_rows: int, percent: int = 75, width: int = 5) -> DataFrame:
    """Edges (a, b) between the nodes of different sets that connect all similar ones.

    `sets` holds the distinct sets of the `n_rows` rows of `docs`, stored.
    """
    frequent = frequent_shingles(docs, n_rows, width)
    members = cells(prefixes(docs, frequent, percent, width), percent)
    members = stored(members.join(sets.select("s1", "node", "size", "point"), "s1").drop("s1"))
    close = stored(candidates(members, percent))
    texts = texts_of(close.select("node"), docs, sets)
    rows = _in_blocks(close, "cell").join(texts, "node").select("cell", "one", "two", "node", "text")
    rows = rows.repartition("cell", "one", "two").sortWithinPartitions("cell", "one", "two", "node")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for _, rows in groups(batches, ["cell", "one", "two"]):
            ids, sets = [], []
            for batch in rows.to_batches():
                ids += batch.column(3).to_pylist()
                sets += shingle_sets(batch, width)
            found = link_forest(sets, percent)
            if found:
                yield pa.RecordBatch.from_pydict({"a": [ids[i] for i, _ in found], "b": [ids[j] for _, j in found]}, out)

    return rows.mapInArrow(run, "a long, b long")


def grouped_sets(docs: DataFrame, known: DataFrame, percent: int = 75, width: int = 5) -> DataFrame:
    """(s1, s2, doc_id, component) of every set of `known` that is not empty; component is the smallest node that links reach."""
    sets = stored(distinct_sets(known))
    found = stored(components(links(docs, sets, known.count(), percent, width)))
    return sets.join(found, "node", "left").select("s1", "s2", "doc_id", F.coalesce("component", "node").alias("component"))


def jaccard_components(docs: DataFrame, percent: int = 75, width: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of `docs`.

    component_id is the smallest doc_id that links of at least `percent` / 100
    reach.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = stored(profiles(docs, width))
    sets = stored(grouped_sets(docs, known, percent, width))
    smallest = stored(sets.groupBy("component").agg(F.min("doc_id").alias("component_id")))
    named = sets.join(smallest, "component").select("s1", "s2", "component_id")
    return known.join(named, ["s1", "s2"], "left").select(
        "doc_id", "n_shingles", F.coalesce(F.expr("if(n_shingles > 0, component_id, null)"), "doc_id").alias("component_id")
    )


def drop_near_copies(docs: DataFrame, percent: int = 75, width: int = 5) -> DataFrame:
    """`docs` with one row of each component: that of the smallest doc_id, then of the smallest hash of the text.

    A row without doc_id stays only in a component that has none with one. Of rows equal in doc_id and text the
    one stays whose columns, written as JSON, come first. Rows with an empty set stay.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = stored(profiles(texts, width))
    sets = grouped_sets(texts, known, percent, width).select("s1", "s2", "component")
    rows = known.where("n_shingles > 0").join(sets, ["s1", "s2"]).withColumn("no_id", F.col("doc_id").isNull())
    rows = stored(rows.groupBy("component", "no_id", "doc_id", "text_hash").agg(F.count("*").alias("n")))
    first = rows.groupBy("component").agg(F.min(F.struct("no_id", "doc_id", "text_hash")).alias("of"))
    first = stored(first.select(F.col("of.doc_id").alias("_id"), F.col("of.text_hash").alias("_hash")))
    stays = rows["doc_id"].eqNullSafe(first["_id"]) & (rows["text_hash"] == first["_hash"])
    names = (F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    later = rows.join(first, stays, "left_anti").select(*names)
    # rows that are equal to the one that stays: one of them
    many = stored(rows.where("n > 1").join(first, stays, "left_semi").select(*names))

    def same(other: DataFrame) -> Column:
        return docs["doc_id"].cast("long").eqNullSafe(other["_id"]) & (F.xxhash64(docs["text"]) == other["_hash"])

    if many.isEmpty():
        return docs.join(later, same(later), "left_anti")
    others = later.union(many)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    equal = docs.join(many, same(many), "left_semi").select(F.xxhash64("text").alias("hash"), F.col("doc_id").alias("id"), whole.alias("row"))
    once = equal.groupBy("id", "hash").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return docs.join(others, same(others), "left_anti").union(once.select("row.*"))
