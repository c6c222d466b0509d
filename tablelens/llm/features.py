"""Hashed text features for the classifiers, as arrays over the rows of an Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SPACES, chunks, mix, prefix_hash, span_hash, words

#: Bytes that end a word of letters and digits: all other ASCII.
NOT_WORD = np.ones(256, bool)
NOT_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
#: Bytes by kind: capital A, small letter or beyond ASCII a, digit 0, the rest as they are.
KIND = np.arange(256, dtype=np.uint8)
KIND[65:91], KIND[97:123], KIND[48:58], KIND[128:] = 65, 97, 48, 97
_U = np.uint64


def word_features(batch: pa.RecordBatch, bits: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, row, feature) of each chunk: the words of every text, hashed to `bits` bits."""
    for first, last, data, offsets in chunks(batch, "text"):
        data = LOWER[data]
        start, end, row = words(data, offsets, NOT_WORD)
        hashed = span_hash(prefix_hash(data), start, end)
        yield first, last, row, (hashed >> _U(64 - bits)).astype(np.int64)


def style_features(batch: pa.RecordBatch, bits: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, row, feature) of each chunk: of every token the letters in lower case and its shape.

    The shape of a token is the kinds of its last three bytes and whether it
    begins with two capitals; both are hashed to `bits` bits.
    """
    for first, last, data, offsets in chunks(batch, "text"):
        start, end, row = words(data, offsets, SPACES)
        kind = KIND[data]
        shape = np.zeros(len(start), np.uint64)
        for back in (1, 2, 3):
            at = end - back
            shape = shape * _U(256) + np.where(at >= start, kind[np.maximum(at, 0)], 0).astype(np.uint64)
        second = np.minimum(start + 1, len(data) - 1) if len(data) else start
        capital = (end - start > 1) & (kind[start] == 65) & (kind[second] == 65) if len(start) else np.zeros(0, bool)
        shape = mix(shape * _U(2) + capital.astype(np.uint64))
        own_start, own_end, own_row = words(LOWER[data], offsets, NOT_WORD)
        hashed = span_hash(prefix_hash(LOWER[data]), own_start, own_end)
        both = np.concatenate([shape, hashed])
        yield first, last, np.concatenate([row, own_row]), (both >> _U(64 - bits)).astype(np.int64)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id is in no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def sampled(rows: DataFrame, bound: int) -> DataFrame:
    """`bound` rows at most, chosen by the hash of doc_id."""
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def presence(docs: DataFrame, features, bits: int, columns: list[str]) -> DataFrame:
    """`columns` (long) of `docs` with `at` and `count`: the distinct features of each text and how often they occur."""
    schema = ", ".join(f"{c} long" for c in columns) + ", at array<int>, count array<int>"

    def run(batches):
        for batch in batches:
            for first, last, row, feature in features(batch, bits):
                key, count = np.unique((row.astype(np.int64) << bits) | feature, return_counts=True)
                cuts = np.searchsorted(key >> bits, np.arange(last - first + 1))
                at = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array((key & ((1 << bits) - 1)).astype(np.int32)))
                counts = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(count.astype(np.int32)))
                own = [batch.column(batch.schema.get_field_index(c)).slice(first, last - first).cast(pa.int64()) for c in columns]
                yield pa.RecordBatch.from_arrays([*own, at, counts], [*columns, "at", "count"])

    return docs.select(*columns, "text").mapInArrow(run, schema)


class Sparse:
    """Rows of (feature, value) pairs with the two products a linear model needs."""

    def __init__(self, at: np.ndarray, value: np.ndarray, cuts: np.ndarray) -> None:
        self.at, self.value, self.cuts, self.n = at, value, cuts, len(cuts) - 1
        self.row = np.repeat(np.arange(self.n), np.diff(cuts))

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.at] * self.value, minlength=self.n)

    def back(self, g: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.at, weights=g[self.row] * self.value, minlength=size)


def adam(gradient, w: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """`w` after `steps` steps along `gradient(w)`."""
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = gradient(w)
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        w = w - rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return w
