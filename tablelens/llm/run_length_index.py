"""Suffix-array dedup: run-length index.

Every byte covered by a string of `width` bytes that also starts anywhere else,
in the same text or another, is removed; strings are judged on the input.

A run-compressed Burrows-Wheeler transform holds the suffixes of a collection.
Where two neighbours in suffix order are preceded by the same byte, the match
of the later one goes on one byte to the left, so matches need to be measured
at the ends of runs only: the suffix positions sampled there give, streamed
over the collection, the matching statistics of every position against all
others. A sample whose match is at least `width` long marks its own span and
its partner's; longer matches in repetitive text share one sample.

Spark first brings together what can match. The smallest hash of short strings
within every window of `width` bytes is an anchor, the same one wherever these
bytes occur. Around an anchor the window must agree on a long inner stretch,
of which there are PARTS variants by the anchor's place in the window; the
hash of that stretch is a key. Only stretches of text whose key occurs at two
places go on: to the cell of the smallest text that has the key. Each cell
builds one index. A cell too large for one index is cut into blocks, and each
pair of blocks is indexed. Equal texts are one text with a number of copies,
and such a text matches its own copies as a whole.

Defined cases: null text is empty; empty text stays empty; texts shorter than
`width` lose nothing; equal texts of at least `width` bytes are removed whole,
the first too; a null or repeated doc_id keeps its rows; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, groups, mix, prefix_hash, span_hash, stored

#: Bytes of the strings whose smallest hash is an anchor.
GRAM = 32
#: Places of an anchor within its window that are told apart.
PARTS = 4
#: Bytes of an index at most (positions and two ranks share 64 bits when sorted), and of a block.
INDEX = 1 << 21
BLOCK = 1 << 20
#: Bytes of one piece of a long stretch; pieces overlap by the width.
PIECE = 1 << 18
_U = np.uint64


# ---------------------------------------------------------------- the index


def suffix_order(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The suffix array of concatenated texts that end at `ends`, each with an end mark of its own.

    Prefix doubling; ranks and position are sorted as one number, and only
    suffixes that are still tied are sorted again.
    """
    n = len(data)
    stop = np.repeat(ends, np.diff(np.r_[0, ends]))
    at = np.arange(n)
    ahead = np.where(at + 1 < stop, np.r_[data[1:], 0].astype(np.int64) + 1, 0)
    second = (data.astype(np.int64) + 1) * 257 + ahead
    order = np.empty(n, np.int64)
    place = np.zeros(n, np.int64)  # where the tied group of each suffix begins in the order
    depth = 2
    while True:
        if n < INDEX:
            packed = ((place[at] << 42) | (second << 21) | at).view(np.uint64)
            packed.sort()
            packed = packed.view(np.int64)
            group, second, at = packed >> 42, (packed >> 21) & 0x1FFFFF, packed & 0x1FFFFF
        else:
            sort = np.lexsort((at, second, place[at]))
            group, second, at = place[at][sort], second[sort], at[sort]
        newgroup = np.r_[True, group[1:] != group[:-1]]
        first = newgroup | np.r_[True, second[1:] != second[:-1]]
        index = np.arange(len(at))
        inside = index - np.maximum.accumulate(np.where(newgroup, index, 0))
        begin = np.maximum.accumulate(np.where(first, index, 0))
        order[group + inside] = at
        place[at] = group + inside - (index - begin)
        # settled: alone, or tied to the end, where the end marks decide in order of position
        at = at[~(first & np.r_[first[1:], True]) & (at + depth <= stop[at])]
        if not len(at):
            return order
        ahead = at + depth
        second = np.where(ahead < stop[at], place[np.minimum(ahead, n - 1)] + 1, 0)
        depth *= 2


def run_samples(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix, its predecessor in suffix order) at the heads of the runs of the transform."""
    order = suffix_order(data, ends)
    before = data[order - 1].astype(np.int16)
    starts = np.r_[0, ends[:-1]]
    opens = np.zeros(len(data), bool)
    opens[starts] = True
    before[opens[order]] = -1
    head = before[1:] != before[:-1]
    head |= before[1:] < 0
    at = np.flatnonzero(head) + 1
    return order[at], order[at - 1]


def match_spans(data: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """Spans [start, end) of the concatenated texts that matches of at least `width` bytes cover."""
    if len(data) < 2:
        return np.empty((0, 2), np.int64)
    p, q = run_samples(data, ends)
    stop = np.repeat(ends, np.diff(np.r_[0, ends]))
    room = np.minimum(stop[p] - p, stop[q] - q)
    p, q, room = p[room >= width], q[room >= width], room[room >= width]
    hashed = prefix_hash(data)
    same = span_hash(hashed, p, p + width) == span_hash(hashed, q, q + width)
    p, q, room = p[same], q[same], room[same]
    low, high = np.full(len(p), width), room
    while len(p) and (low < high).any():
        middle = (low + high + 1) // 2
        same = span_hash(hashed, p, p + middle) == span_hash(hashed, q, q + middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    # the bytes themselves decide, not their hashes: equal bytes always have equal hashes, so a length may only be too large
    low = np.array([_equal_bytes(data, i, j, m) for i, j, m in zip(p.tolist(), q.tolist(), low.tolist(), strict=True)], np.int64)
    p, q, low = p[low >= width], q[low >= width], low[low >= width]
    return merged(np.concatenate([np.stack([p, p + low], 1), np.stack([q, q + low], 1)]))


def _equal_bytes(data: np.ndarray, i: int, j: int, most: int) -> int:
    """How many of `most` bytes from i and from j are equal."""
    if np.array_equal(data[i : i + most], data[j : j + most]):
        return most
    return int(np.argmax(data[i : i + most] != data[j : j + most]))


def merged(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of the bytes in any of the spans; adjoining spans are one run."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.r_[True, spans[1:, 0] > reach[:-1]]
    return np.stack([spans[first, 0], reach[np.r_[first[1:], True]]], 1)


# ---------------------------------------------------------------- candidates


def anchors(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, start, end) of the stretches around the anchors of all windows of `width` bytes."""
    gram = min(GRAM, width)
    none = np.empty(0, np.int64)
    n = len(data) - width + 1
    if n <= 0:
        return none.view(np.uint64), none, none, none
    hashed = prefix_hash(data)
    at = np.arange(len(data) - gram + 1)
    least = span_hash(hashed, at, at + gram) >> _U(28) << _U(28) | at.astype(np.uint64)
    size, wanted = 1, width - gram + 1
    while size * 2 <= wanted:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[: len(least) - (wanted - size)], least[wanted - size :])
    start = np.arange(n)
    row = np.searchsorted(offsets, start, "right") - 1
    valid = start + width <= offsets[row + 1]
    start, row = start[valid], row[valid]
    if not len(start):
        return none.view(np.uint64), none, none, none
    place = (least[start] & _U((1 << 28) - 1)).astype(np.int64)
    new = np.r_[True, (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)]
    first, last = start[new], start[np.r_[new[1:], True]]
    anchor, row = place[new], row[new]
    bounds = np.linspace(0, wanted, PARTS + 1).astype(np.int64)
    out = []
    for low, over in zip(bounds[:-1], bounds[1:], strict=True):
        high = over - 1
        here = (anchor - last <= high) & (anchor - first >= low)
        a = anchor[here]
        key = span_hash(hashed, a - low, a + width - high) ^ _U(low)
        out.append((key, row[here], np.maximum(a - high, first[here]), np.minimum(a - low, last[here]) + width))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _stretches(texts: DataFrame, width: int) -> DataFrame:
    """(key, text_hash, start, end, several) of every anchor stretch; `texts` has text_hash and text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(0).to_numpy()
            for top, _, data, offsets in chunks(batch, "text"):
                key, row, start, end = anchors(data, offsets, width)
                if len(key):
                    # a key that a text repeats over and over is one stretch that matches itself
                    order = np.lexsort((start, key, row))
                    key, row, start, end = key[order], row[order], start[order], end[order]
                    first = np.r_[True, (key[1:] != key[:-1]) | (row[1:] != row[:-1]) | (start[1:] > end[:-1])]
                    cuts = np.flatnonzero(first)
                    several = np.diff(np.r_[cuts, len(key)]) > 1
                    key, row, start, end = key[cuts], row[cuts], start[cuts], np.maximum.reduceat(end, cuts)
                    begin = offsets[row]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(mix(key).view(np.int64)),
                            pa.array(hashes[top + row]),
                            pa.array((start - begin).astype(np.int32)),
                            pa.array((end - begin).astype(np.int32)),
                            pa.array(several),
                        ],
                        ["key", "text_hash", "start", "end", "several"],
                    )

    return texts.select("text_hash", "text").mapInArrow(run, "key long, text_hash long, start int, end int, several boolean")


def _shared(found: DataFrame) -> DataFrame:
    """(text_hash, head, start, end) of the stretches whose key occurs at two places; head: its first text.

    Rows stream past in order of key and place, so a key of any number of rows
    takes no memory. Equal rows come from equal texts and count once.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # key, text_hash, start, end, head of the last row, and whether it is still to be written
        for batch in batches:
            if not batch.num_rows:
                continue
            key, text, start, end, several = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(5))
            before = last[:3] if last else (~key[0], 0, 0)
            new = (key != np.r_[before[0], key[:-1]]) | (text != np.r_[before[1], text[:-1]]) | (start != np.r_[before[2], start[:-1]])
            key, text, start, end, several = key[new], text[new], start[new], end[new], several[new]
            if not len(key):
                continue
            joins = key == np.r_[before[0], key[:-1]]
            begin = np.maximum.accumulate(np.where(joins, -1, np.arange(len(key))))
            head = np.where(begin >= 0, text[np.maximum(begin, 0)], last[4] if last else 0)
            many = joins | several
            many[:-1] |= joins[1:]
            out = [text[many], head[many], start[many], end[many]]
            if joins[0] and last[5]:
                out = [np.r_[x, y] for x, y in zip((last[1], last[4], last[2], last[3]), out, strict=True)]
            if len(out[0]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0]), pa.array(out[1]), pa.array(out[2].astype(np.int32)), pa.array(out[3].astype(np.int32))],
                    ["text_hash", "head", "start", "end"],
                )
            last = (key[-1], text[-1], start[-1], end[-1], head[-1], not many[-1])

    rows = found.repartition("key").sortWithinPartitions("key", "text_hash", "start")
    return rows.mapInArrow(run, "text_hash long, head long, start int, end int")


_SPANS = pa.schema([("text_hash", pa.int64()), ("check", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])
_PIECES = pa.schema([("head", pa.int64()), *[_SPANS.field(i) for i in range(3)], ("piece", pa.binary())])


def _pieces(rows: DataFrame, width: int) -> DataFrame:
    """(head, text_hash, check, start, piece) of the joined stretches of each text, per cell."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one, two, text, found = (batch.column(c)[row].as_py() for c in range(4))
                data = text.encode()
                heads = np.array([x["head"] for x in found], np.int64)
                spans = np.array([(x["start"], x["end"]) for x in found], np.int64)
                out = []
                for head in np.unique(heads).tolist():
                    for a, b in merged(spans[heads == head]).tolist():
                        out += [(head, one, two, c, data[c : min(b, c + PIECE + width - 1)]) for c in range(a, b - width + 1, PIECE)]
                yield _batch(out, _PIECES)

    return rows.select("text_hash", "check", "text", "found").mapInArrow(
        run, "head long, text_hash long, check long, start int, piece binary"
    )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _indexed(pieces: DataFrame, width: int) -> DataFrame:
    """(text_hash, check, start, end) of matched spans; `pieces` comes sorted by cell and pair of blocks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groups(batches, ["head", "one", "two"]):
            one, two, start = (rows.column(c).to_pylist() for c in ("text_hash", "check", "start"))
            texts = rows.column("piece").to_pylist()
            ends = np.cumsum([len(x) for x in texts])
            spans = match_spans(np.frombuffer(b"".join(texts), np.uint8), ends, width)
            # adjoining spans of two pieces were joined: cut them at the ends of the pieces
            first = np.searchsorted(ends, spans[:, 0], "right").tolist()
            last = np.searchsorted(ends, spans[:, 1], "left").tolist()
            out = []
            for (a, b), i, j in zip(spans.tolist(), first, last, strict=True):
                for k in range(i, j + 1):
                    base = int(ends[k]) - len(texts[k])
                    out.append((one[k], two[k], start[k] + max(a, base) - base, start[k] + min(b, int(ends[k])) - base))
            if out:
                yield _batch(out, _SPANS)

    return pieces.mapInArrow(run, "text_hash long, check long, start int, end int")


def _hashed(docs: DataFrame) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.withColumns({"text_hash": F.xxhash64("text"), "check": F.xxhash64(F.lit(1), "text")})


def repeated_spans(docs: DataFrame, width: int = 400) -> DataFrame:
    """(text_hash, check, copies, spans) of the texts that have copies or spans that repeat elsewhere."""
    texts = _hashed(docs)
    distinct = stored(texts.groupBy("text_hash", "check").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")))
    rows = _shared(_stretches(texts, width))
    rows = rows.groupBy("text_hash").agg(F.collect_set(F.struct("head", "start", "end")).alias("found"))
    rows = rows.join(distinct.drop("copies"), "text_hash").alias("r")
    own = texts.alias("t")
    same = F.expr("r.text_hash = t.text_hash and r.check = t.check and r.doc_id <=> t.doc_id")
    rows = rows.join(own, same).select("r.text_hash", "r.check", "t.text", "r.found")
    pieces = stored(_pieces(rows, width).dropDuplicates(["head", "text_hash", "check", "start"]))
    cells = pieces.groupBy("head").agg(F.sum(F.length("piece")).alias("bytes"))
    blocks = F.when(F.col("bytes") < INDEX, 1).otherwise(F.ceil(2 * F.col("bytes") / BLOCK)).cast("int")
    placed = pieces.join(cells.select("head", blocks.alias("blocks")), "head")
    placed = placed.withColumn("own", F.pmod(F.xxhash64("text_hash", "start"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("with", F.explode(F.expr("sequence(0, blocks - 1)")))
    placed = placed.select(
        "head", F.least("own", "with").alias("one"), F.greatest("own", "with").alias("two"), "text_hash", "check", "start", "piece"
    )
    # so many tasks whatever the bytes are: an index takes far longer to build than to read
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.repartition(tasks, "head", "one", "two").sortWithinPartitions("head", "one", "two", "text_hash", "check", "start")
    spans = _indexed(placed, width).groupBy("text_hash", "check").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    distinct = distinct.join(spans, ["text_hash", "check"], "left")
    return distinct.where("copies > 1 or spans is not null").select("text_hash", "check", "copies", "spans")


def remove_repeats(docs: DataFrame, width: int = 400) -> DataFrame:
    """(doc_id, kept, spans, n_bytes, n_removed, n_spans) of every row; `kept` are the bytes that stay."""
    found = stored(repeated_spans(docs, width))
    rows = _hashed(docs).join(found, ["text_hash", "check"], "left").select("doc_id", "text", "copies", "spans")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            copies, spans = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for first, last, data, offsets in chunks(batch, "text"):
                kept, cut, size = [], [], []
                for row in range(first, last):
                    own = data[offsets[row - first] : offsets[row - first + 1]].tobytes()
                    runs = merged(np.array([(x["start"], x["end"]) for x in spans[row] or ()], np.int64).reshape(-1, 2)).tolist()
                    if (copies[row] or 0) > 1 and len(own) >= width:
                        runs = [[0, len(own)]]
                    parts, at = [], 0
                    for a, b in runs:
                        parts.append(own[at:a])
                        at = b
                    kept.append(b"".join([*parts, own[at:]]))
                    cut.append([{"start": a, "end": b} for a, b in runs])
                    size.append(len(own))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(kept, pa.binary()), pa.array(cut, span), pa.array(size, pa.int64())],
                    ["doc_id", "kept", "spans", "n_bytes"],
                )

    out = rows.mapInArrow(run, "doc_id long, kept binary, spans array<struct<start:int,end:int>>, n_bytes long")
    return out.withColumns({"n_removed": F.col("n_bytes") - F.length("kept"), "n_spans": F.size("spans").cast("long")})


def digest(removed: DataFrame) -> DataFrame:
    """The digest columns of remove_repeats."""
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
