"""Circulant MinHash near-dedup against all pairs in plain code."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelens.llm import minhash, queries

FOLDER = "/root/testdata/sf0.001"


def words_of(rng, n, vocabulary=5000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    """Near copies of all degrees, a large group, a chain, equal, short, empty, null and very long texts."""
    rng = random.Random(11)
    rows = []
    for size in (12, 30, 60, 200):
        base = words_of(rng, size)
        for share in (0.0, 0.005, 0.01, 0.02, 0.03, 0.05):
            rows += [" ".join(w if rng.random() >= share else f"x{rng.randrange(9999)}" for w in base) for _ in range(6)]
    base = words_of(rng, 120)
    rows += [" ".join(base[:k] + [f"y{k}"] + base[k + 1 :]) for k in range(120)]  # all differ, most pairs link
    chain = words_of(rng, 400)
    rows += [" ".join(chain[4 * k : 4 * k + 120]) for k in range(60)]  # linked to neighbours only
    rows += [rows[0].upper(), rows[1] + " ", "one two", "one two", "a b c d e", "A b  c\td e", "", "  \n ", None, None]
    rows += ["é ü ß " * 40, "ab " * 600, "abcdefg" * 300, " ".join(words_of(rng, 30_000))]
    rng.shuffle(rows)
    return list(enumerate(rows))


def check(spark, rows, percent=85, **extra):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({k: F.lit(v) for k, v in extra.items()})
    found = minhash.near_duplicates(docs, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.jaccard(rows, percent)
    assert len(found) == len(rows) and all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_components(spark, corpus):
    check(spark, corpus, node=1, key=2, component_id=3, kept=4, keys=5)


@pytest.mark.parametrize("rounds", [1, 2])
def test_components_in_blocks(spark, corpus, monkeypatch, rounds):
    for name, value in (("ROUNDS", rounds), ("CHUNK", 7), ("BLOCK", 20), ("CHUNK_SHINGLES", 300), ("BLOCK_SHINGLES", 900), ("AT_ONCE", 5000)):
        monkeypatch.setattr(minhash, name, value)
    check(spark, corpus)


def test_known_components_are_extended(spark, monkeypatch):
    rng = random.Random(4)
    pairs = [[tuple(rng.sample(range(-60, 60), 2)) for _ in range(n)] for n in (30, 8, 25)]
    tables = [spark.createDataFrame(p, "a long, b long") for p in pairs]
    known = minhash.stored(minhash.components(tables[0]))
    known = minhash.extended(minhash.extended(known, tables[1]), tables[2])
    want = minhash.components(tables[0].union(tables[1]).union(tables[2]))
    assert sorted(known.collect()) == sorted(want.collect())
    # edges within components are not followed again
    monkeypatch.delattr(minhash, "components")
    assert minhash.extended(known, tables[1]) is known


def test_another_similarity(spark, corpus):
    check(spark, corpus[:200], 75)


def test_the_sample(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.op13_minhash_near_dedup(spark, FOLDER).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.jaccard(rows, 85)


def test_nothing_and_nulls(spark):
    def of(rows):
        return sorted((tuple(r) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)

    assert of([]) == []
    assert of([(1, None), (2, ""), (3, " ")]) == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (7, text + " end"), (5, text + " end"), (None, "else where"), (4, "b"), (4, "c"), (4, "b")]
    assert of(rows) == sorted(
        [(None, 36, 5, False), (7, 37, 5, False), (5, 37, 5, True), (None, 1, None, True), (4, 1, 4, True), (4, 1, 4, True), (4, 1, 4, True)], key=repr
    )


def test_coordinates_estimate_the_similarity():
    rng = np.random.default_rng(4)
    for share in (0.3, 0.7, 0.9):
        agree = []
        for _ in range(60):
            values = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
            n = int(400 * share)
            rest = (400 - n) // 2
            a, b = values[: n + rest], np.r_[values[:n], values[n + rest :]]
            agree.append((minhash.signature(a) == minhash.signature(b)).mean())
        assert abs(np.mean(agree) - n / 400) < 0.02


def test_bands():
    assert minhash.rows_per_band(85) == 5 and minhash.COORDINATES // 5 == 32
    for percent in (60, 75, 85, 95):
        rows = minhash.rows_per_band(percent)
        assert (1 - (percent / 100) ** rows) ** (minhash.COORDINATES // rows) <= minhash.MISS


def test_index_of_a_chunk():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 40, n, dtype=np.uint64)) for n in (5, 9, 30, 30, 60, 1)]
    index = minhash.ChunkIndex(sets)
    for own in sets:
        want = [k for k, s in enumerate(sets) if 100 * len(np.intersect1d(s, own)) >= 60 * len(np.union1d(s, own))]
        assert index.similar(own, 60).tolist() == want
