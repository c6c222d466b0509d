"""Near words, forms and roots against plain code."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablelens.llm import spelling_variants as sv

LOWER = {c: c + 32 for c in range(65, 91)}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[k + 1 :] == b[k + 1 :] or a[k:] == b[k + 1 :] or a[k + 1 :] == b[k:]


def grouped(words: dict[str, int], ratio=5):
    near = {a: [b for b in words if one_edit(a, b)] for a in words}
    form = {}
    for a, others in near.items():
        best = min(others, key=lambda b: (-words[b], b), default=None)
        form[a] = best if best is not None and words[best] >= ratio * words[a] else None
    out = set()
    for a in words:
        root = a
        while form[root]:
            root = form[root]
        out.add((a, words[a], len(near[a]), form[a], form[a] and words[form[a]], root))
    return out


def counted(rows, every=199):
    words = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            words[run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run] += 1
    return {w: n for w, n in words.items() if len(w) >= 6 and n >= 5}


def found(df):
    return {tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect()}


def words_like(rng, alphabet, lengths, n):
    """Words and words one or two edits from them."""
    words = {"".join(rng.choice(alphabet) for _ in range(rng.choice(lengths))) for _ in range(n)}
    for word in list(words):
        for _ in range(3):
            k, kind = rng.randrange(len(word) + 1), rng.randrange(3)
            word = word[:k] + ("" if kind == 0 else rng.choice(alphabet)) + word[k + (kind != 1) :]
            words.add(word)
    return {w: rng.choice((1, 1, 2, 5, 6, 30, 30, 200, 5000)) for w in words if w}


@pytest.mark.parametrize("limit", [50_000, 3])
def test_variants_of_any_words(spark, monkeypatch, limit):
    monkeypatch.setattr(sv, "LIMIT", limit)
    rng = random.Random(limit)
    words = words_like(rng, "ab", [1, 2, 3, 6, 7], 60) | words_like(rng, "abcéÿ\U0001f600", [5, 6, 7, 12], 80)
    df = spark.createDataFrame(list(words.items()), "word string, n long").withColumns({c: F.lit(1) for c in ("m", "lo", "key", "form")})
    assert found(sv.variants(df)) == grouped(words)


@settings(max_examples=6, deadline=None)
@given(st.dictionaries(st.text("abé", min_size=1, max_size=6), st.integers(1, 99), max_size=60))
def test_variants_of_hypothesis(spark, words):
    assert found(sv.variants(spark.createDataFrame(list(words.items()), "word string, n long"), 2)) == grouped(words, 2)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abc", max_size=6), max_size=40))
def test_composition(words):
    accepted = [frozenset(p) for p in sv.OneEdit(sv.Acceptor(sorted(words))).pairs()]
    assert len(accepted) == len(set(accepted))
    assert set(accepted) == {frozenset((a, b)) for a in words for b in words if one_edit(a, b)}


def test_acceptor_is_minimal():
    words = sorted(x + y + z for x in ("ab", "cb", "db") for y in ("", "q") for z in ("ing", "ed", "s"))
    acceptor = sv.Acceptor(words)
    assert len(acceptor.arcs) < 12  # all starts share one state, all ends another
    assert len({(f, tuple(a.items())) for f, a in zip(acceptor.final, acceptor.arcs, strict=True)}) == len(acceptor.arcs)


def test_very_long_words(spark, monkeypatch):
    monkeypatch.setattr(sv, "SEGMENT", 32)
    long = "".join(random.Random(1).choice("abcdef") for _ in range(3000))
    words = {long: 5, long[:1500] + "x" + long[1500:]: 30, long[1:]: 3, long + "z": 1, long[:77] + "y" + long[78:]: 2, "a" * 700: 4, "a" * 701: 40}
    assert found(sv.variants(spark.createDataFrame(list(words.items()), "word string, n long"))) == grouped(words)


def test_documents(spark):
    rng = random.Random(3)
    base = ["Writing", "writting", "überaus", "Überaus", "ubermut", "colour", "color", "colours", "x×yzzyx", "straße", "naïveté"]
    rows = [(rng.choice([None, *range(400)]), " ".join(rng.choices(base, k=25)) + rng.choice([".", "1x", "\n", ""])) for _ in range(500)]
    rows += [(1, None), (2, ""), (3, "12 ?"), (4, "short words" * 3000), (5, "Abcdefgh"), (5, "Abcdefgh")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("q") for c in ("word", "n", "run", "root")})
    got = found(sv.spelling_variants(df))
    assert got == grouped(counted(rows)) and any(r[3] for r in got)
    small = found(sv.spelling_variants(df, every=7))
    assert small == grouped(counted(rows, 7)) and small != got


def test_the_sample(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    words = counted(rows)
    got = found(sv.spelling_variants(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")))
    assert {(w, n) for w, n, *_ in got} == set(words.items())


def test_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert sv.spelling_variants(df).collect() == []
    assert sv.spelling_variants(spark.createDataFrame([(1, None), (2, "a b")], "doc_id long, text string")).collect() == []


def test_partitions_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(sv, "LIMIT", 40)
    words = [(f"prefix{a}{b}{c}", 1) for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"]
    parts = sv.partitions(spark.createDataFrame(words, "word string, n long"))
    assert parts.groupBy("m", "lo", "hi", "key").count().where("count > 40 and hi - lo > 1").isEmpty()
