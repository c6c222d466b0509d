"""Mixing, classifiers, language ID, chat formatting, top-k search and the pipeline."""

from __future__ import annotations

import math
import random
from collections import Counter
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from compare import differences, oracle_connection
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tablelens.llm import chat, language_id, mixing, quality, queries, topk, toxicity
from tablelens.llm.features import Sparse

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    _, found = differences(spark, oracle_connection(FOLDER), queries.QUERIES[name], queries.ORACLES[name], FOLDER)
    assert found is None


# ---------------------------------------------------------------- mixing


def plain_targets(sizes: dict, weights=(5, 2, 1)) -> dict:
    """Share, stop at three times the size, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = dict.fromkeys(order, 0.0), set(order), float(sum(sizes.values()))
    while left > 1e-9 and open_:
        total, excess = sum(weight[s] for s in open_), 0.0
        for s in sorted(open_, key=order.index):
            target[s] += left * weight[s] / total
            if target[s] >= 3 * sizes[s]:
                excess += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
        open_ = {s for s in open_ if target[s] < 3 * sizes[s]}
        left = excess
    return target


def test_mix_meets_its_targets(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, "w " * min(300, int(rng.paretovariate(1.1) * 5)), None, rng.choice(["a"] * 9 + ["b", "c", "é", "Z", None, ""]), 0) for i in range(1500)]
    rows += [(7, "w w w", None, "a", 0), (7, "w w w", None, "a", 0), (None, "w", None, "b", 0), (2000, None, None, "empty", 0), (2001, "", None, "empty", 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"size": F.lit("clash"), "bucket": F.lit(1), "share": F.lit(2)})
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    want = plain_targets(sizes)
    results = []
    for bucket in (mixing.BUCKET, 40):
        monkeypatch.setattr(mixing, "BUCKET", bucket)
        found = mixing.mix(docs).collect()
        assert len(found) == len(rows)
        taken = Counter()
        for r in found:
            taken[r.source] += r.taken
            assert r.taken <= 3 * r.size and r.source_size == sizes[r.source]
            assert math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-6)
        longest = {s: max(r.size for r in found if r.source == s) for s in sizes}
        assert all(abs(taken[s] - want[s]) <= longest[s] for s in sizes)
        assert abs(taken["a"] - want["a"]) < 0.01 * want["a"]
        assert sorted(map(str, mixing.mix(docs).collect())) == sorted(map(str, found))
        results.append(found)
    copies = mixing.mixed(docs)
    assert copies.count() == sum(r.copies for r in results[-1])
    assert set(docs.columns) <= set(copies.columns)
    assert mixing.mix(docs.limit(0)).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 500), min_size=1, max_size=40), st.floats(0.01, 0.99), st.integers(0, 99))
def test_pairs_keep_the_words(sizes, share, seed):
    size = np.sort(np.array(sizes, float))[::-1]
    shares = np.full(len(size), share)
    for out in (mixing._pooled(size, shares, np.random.default_rng(seed)), mixing._paired(size, shares, np.random.default_rng(seed), False)):
        assert ((out > 0) & (out < 1)).sum() <= 1 and out.min() >= 0 and out.max() <= 1
        assert math.isclose((out * size).sum(), (shares * size).sum(), rel_tol=1e-9)


def test_expectations_are_kept():
    size, share = np.array([90.0, 40, 30, 10, 5]), np.full(5, 0.3)
    drawn = [mixing._paired(size, mixing._pooled(size, share, rng), rng, True) for rng in map(np.random.default_rng, range(4000))]
    assert np.abs(np.mean(drawn, axis=0) - 0.3).max() < 0.04


# ---------------------------------------------------------------- classifiers


def graded_texts(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        toxic, poor = i % 6 == 0, i % 5 == 0
        w = [f"v{rng.randrange(300)}" for _ in range(rng.randrange(5, 60))]
        if toxic:
            w.insert(rng.randrange(len(w)), rng.choice(["vile", "rotten"]))
        if poor:
            w = [x.upper() + "!!" for x in w]
        rows.append((i, " ".join(w), None, "s", 0))
        labels.append((i, int(not poor), int(toxic)))
    rows += [(1000, None, None, None, None), (1001, "", None, None, None), (None, "vile rotten", None, None, None), (3, "twice", None, None, None)]
    labels += [(None, 1, 1), (5000, 0, 1), (7, None, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"toxic": F.lit("x"), "score": F.lit(1), "grade": F.lit(2)})
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def auc(score, label) -> float:
    rank = pd.Series(list(score)).rank().to_numpy()
    y = np.array(list(label))
    return (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


def test_toxicity_on_held_out_rows(spark):
    docs, labels = graded_texts(spark)
    found = toxicity.toxicity(docs, labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"] and found.count() == 604
    rows = [r for r in found.where("held_out and doc_id < 600").collect() if r.doc_id != 3]
    assert len(rows) > 100 and auc([r.score for r in rows], [int(r.doc_id % 6 == 0) for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found.collect())
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    low = Counter(r.doc_id for r in found.where("predicted = 0").collect())
    assert Counter(r.doc_id for r in kept.collect()) == low


def test_toxicity_without_positives_or_rows(spark):
    docs, labels = graded_texts(spark)
    assert {r.score for r in toxicity.toxicity(docs, labels.where("toxic = 0")).collect()} == {0.0}
    assert {r.score for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []


def test_risk_on_negatives_is_kept_from_below_zero():
    """Positives that the unlabelled texts hardly hold: the plain estimate of the negative risk would go below zero."""
    positive = Sparse(np.zeros(5, int), np.ones(5), np.arange(6))
    unlabelled = Sparse(np.ones(50, int), np.ones(50), np.arange(51))
    model = toxicity.fit_arrays(positive, unlabelled, 0.5, 2)
    assert np.isfinite(model.weights).all() and np.abs(model.weights).max() < 20


def test_grades_without_a_document_do_not_fill_the_sample(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE", 30)
    docs = spark.createDataFrame([(i, f"good words {i}" if i % 2 else f"bad text {i}") for i in range(30)], "doc_id long, text string")
    grades = spark.range(3000).selectExpr("id as doc_id", "id % 2 as grade")
    assert np.count_nonzero(quality.fit(docs, grades, 2).weights)


def test_quality_on_held_out_rows(spark):
    docs, labels = graded_texts(spark)
    grades = labels.select("doc_id", F.expr("quality * (2 - toxic)").alias("grade"))
    found = quality.quality(docs, grades, 3, 1)
    assert found.count() == 604
    rows = [r for r in found.where("held_out and doc_id < 600").collect() if r.doc_id != 3]
    assert auc([r.tail_probability for r in rows], [int(r.doc_id % 5 != 0) for r in rows]) > 0.95
    assert all(0 <= r.expected_grade <= 2 and 0 <= r.tail_probability <= 1 for r in found.collect())
    assert {r.tail_probability for r in quality.quality(docs, grades.where("grade = 2"), 3, 1).collect()} == {1.0}
    assert {r.tail_probability for r in quality.quality(docs, grades.where("grade = 0"), 3, 1).collect()} == {0.0}
    assert quality.quality(docs.limit(0), grades, 3, 1).collect() == []


def test_thresholds_stay_ordered():
    rng = np.random.default_rng(0)
    grade = rng.integers(0, 4, 400)
    x = Sparse(np.r_[np.arange(400) % 3, np.where(grade > 1, 3, 4)], np.ones(800), np.arange(0, 801, 2))
    x = Sparse(np.stack([np.arange(400) % 3, np.where(grade > 1, 3, 4)], 1).ravel(), np.ones(800), np.arange(0, 801, 2))
    weights, thresholds = quality.fit_arrays(x, grade, 4, 5)
    assert (np.diff(thresholds) > 0).all() and weights[3] > weights[4]


# ---------------------------------------------------------------- language


def plain_forward(word: bytes, pieces: dict) -> np.ndarray:
    """Sum over all segmentations, one by one."""
    if not word:
        return 1.0
    return sum(pieces[word[:k]] * plain_forward(word[k:], pieces) for k in range(1, len(word) + 1) if word[:k] in pieces)


def tables_of(pieces: dict) -> list:
    tables = []
    for size in range(1, max(map(len, pieces)) + 2):
        own = sorted((language_id._hash(p), p) for p in pieces if len(p) == size)
        tables.append((np.array([h for h, _ in own], np.uint64), np.array([pieces[p] for _, p in own]).reshape(-1, 2)))
    return tables


def test_long_words_are_scored_whole(monkeypatch):
    rng = np.random.default_rng(5)
    long = bytes(rng.choice(list(b"abc"), 29).tolist())
    pieces = {p: rng.random(2) * np.array([0.1, 1e-9]) for p in [b"a", b"b", b"c", b"ab", b"bca", long]}
    words = [bytes(rng.choice(list(b"abc"), n).tolist()) for n in (33, 64, 300, 3000)] + [b"ab" + long + b"c" * 5 + long]
    want = []
    for word in words:  # all segmentations, in numbers whose exponents do not end
        sums = [[Decimal(1), Decimal(1)]]
        for stop in range(1, len(word) + 1):
            ends = [p for p in pieces if word[max(0, stop - len(p)) : stop] == p]
            sums.append([sum((sums[stop - len(p)][k] * Decimal(pieces[p][k]) for p in ends), Decimal(0)) for k in (0, 1)])
        want.append([float(x.ln()) for x in sums[-1]])
    ends = np.cumsum([len(w) for w in words])
    data = np.frombuffer(b"".join(words), np.uint8)
    got = language_id.word_scores(data, ends - [len(w) for w in words], ends, tables_of(pieces))
    assert np.allclose(got, want, rtol=1e-9)
    monkeypatch.setattr(language_id, "POSITIONS", 7)
    assert np.allclose(got, language_id.word_scores(data, ends - [len(w) for w in words], ends, tables_of(pieces)))


def test_no_piece_of_the_vocabulary_is_left_out():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=language_id.VOCABULARY)
    found = set(language_id.vocabulary(language_id.VOCABULARY))
    pieces = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    assert all(model.id_to_piece(i).replace("\u2581", chr(language_id.MARK)).encode() in found for i in pieces)
    assert max(map(len, found)) > 12


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(1)
    pieces = {p: rng.random(2) * 0.1 for p in [b"a", b"b", b"c", b"ab", b"bc", b"abc", b"ca", b"cab", b"aa"]}
    tables = tables_of(pieces)
    words = [bytes(rng.choice(list(b"abc"), rng.integers(1, 9)).tolist()) for _ in range(40)]
    ends = np.cumsum([len(w) for w in words])
    got = language_id.word_scores(np.frombuffer(b"".join(words), np.uint8), ends - [len(w) for w in words], ends, tables)
    assert np.allclose(got, [np.log(np.maximum(plain_forward(w, pieces), 1e-300)) for w in words])


def test_marked_words():
    texts = [b"ab c1d", b"", "ü x".encode(), b"a" * 70]
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
    data, start, end, row = language_id.marked_words(np.frombuffer(b"".join(texts), np.uint8), offsets)
    got = [(int(r), data[s:e].tobytes()) for s, e, r in zip(start, end, row)]
    assert got == [
        (0, b"\x01ab"), (0, b"\x01c"), (0, b"\x01d"), (2, "\x01ü".encode()), (2, b"\x01x"),
        (3, b"\x01" + b"a" * 70),
    ]


def test_languages_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(9000, None, "en", "s", 0), (9001, "12 — 34 !!", "fr", "s", 0), (9002, "", None, "s", 0), (None, "the of and", "en", "s", 0)], DOCS)
    found = {r.doc_id: r for r in language_id.languages(docs.union(odd).withColumn("score", F.lit(0))).collect()}
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (9000, 9001, 9002))
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [i for i in truth if found[i].held_out]
    assert len(held) > 20 and np.mean([found[i].lang_pred == truth[i] for i in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in found.values())
    untaught = language_id.languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in untaught} == {"und"}
    assert language_id.languages(docs.limit(0)).collect() == []


# ---------------------------------------------------------------- chat


@settings(max_examples=300, deadline=None)
@given(st.text("<|\\n\nim_startend>é:0", max_size=30), st.text("<|\\\nab", max_size=8))
def test_turns_read_back(text, role):
    flat = chat.Flatten()
    flat.visit({"type": "text", "text": text})
    content = "".join(flat.out)
    head = f"{chat.START}{chat.escape_role(role)}\n"
    assert "<|" not in content
    assert chat.read_turn(f"{head}{content}{chat.END}\n", len(head), len(head) + len(content)) == (role, text, text)


def test_parts_become_placeholders(spark):
    rows = [
        (1, 0, "user", [("text", "see <|image:0|>", None, None, None, None, None), ("image", None, "a.png", 1024, 513, None, None), ("audio", None, "b.wav", None, None, 2.5, None)]),
        (1, 1, "assistant", [("document", None, "c.pdf", None, None, None, 3), ("video", None, "d", None, None, None, None), (None, "ok", None, None, None, None, None)]),
        (2, 0, None, None),
    ]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PARTS}")
    found = {(r.conv_id, r.turn): r for r in chat.format_turns(turns).collect()}
    first = found[1, 0]
    assert first.formatted == "<|im_start|>user\nsee <\\|image:0|><|image:0|><|audio:1|><|im_end|>\n"
    assert [(a.type, a.ref, a.tokens) for a in first.attachments] == [("image", "a.png", 1024), ("audio", "b.wav", 63)]
    content = first.formatted.split("\n", 1)[1]
    assert all(content[a.at :].startswith(f"<|{a.type}:{a.nth}|>") for a in first.attachments)
    assert found[1, 1].expanded_tokens == 3 * 768 and found[2, 0].formatted == "<|im_start|>\n<|im_end|>\n"
    whole = {r.conv_id: r for r in chat.conversations(chat.format_turns(turns)).collect()}
    assert whole[1].text == first.formatted + found[1, 1].formatted
    (span,) = whole[1].loss_spans
    assert whole[1].text[span.start : span.end] == "<|document:0|><|video:1|>ok"


def test_conversations_with_nulls_and_ties(spark):
    rows = [(None, 1, "user", "a"), (3, None, "user", None), (3, 2, "assistant", "x"), (3, 2, "assistant", "w"), (3, 2, "assistant", "w")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(turns)).collect()}
    assert got[3].n_turns == 4 and got[3].loss_chars == 3 and got[None].n_turns == 1
    assert got[3].loss_sha256 == __import__("hashlib").sha256(b"wwx").hexdigest()
    assert chat.read_back(chat.format_turns(turns.limit(0))).collect() == []


# ---------------------------------------------------------------- top-k


def plain_top(vectors, queries_, k):
    out = set()
    for q in queries_:
        scores = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])}
    return out


def test_top_products(spark, monkeypatch):
    monkeypatch.setattr(topk, "BUCKET", 32)
    monkeypatch.setattr(topk, "BLOCK", 7)
    rng = np.random.default_rng(2)
    data = {i: [float(x) for x in rng.normal(0, 0.2 + (i % 5), 6).astype(np.float32)] for i in range(400)}
    data |= {i: data[0] for i in range(400, 480)} | {480: [0.0] * 6, 481: [1e3, 0.0, 0.0, 0.0, 0.0, 0.0], 500: [2.0, 1.0], 1200: []}
    bad = [(1000, None), (1050, [1.0, None]), (1100, [float("nan")] * 6), (1150, [float("inf")] + [0.0] * 5), (None, [1.0] * 6)]
    rows = spark.createDataFrame([*data.items(), *bad], "vec_id long, embedding array<float>").withColumn("norm", F.lit("x"))
    vectors = rows.select("vec_id", topk.scaled(F.col("embedding")).alias("v"))
    whole = {i: [math.floor(256 * x) for x in v] + [0] * (6 - len(v)) for i, v in data.items()}
    for k in (1, 5, 600):
        got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_products(vectors, F.col("vec_id") % 50 == 0, k).collect()}
        assert got == plain_top(whole, [i for i in data if i % 50 == 0], k)
    assert topk.top_products(vectors.limit(0), F.lit(True)).collect() == []
    assert topk.top_products(vectors.where("vec_id = 3"), F.lit(True)).collect() == []


def test_rows_of_one_id_are_rows_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(topk, "BUCKET", 4)
    monkeypatch.setattr(topk, "BLOCK", 2)
    rows = [(0, [3, 4]), (0, [5, -1]), (0, [3, 4]), (7, []), (50, []), (50, [1, 1]), (9, [40_000, 2]), (8, [-3, 2**40]), (8, [-3, 2**40]), (7, [0, 0])]
    vectors = spark.createDataFrame(rows, "vec_id long, v array<long>")
    found = topk.top_products(vectors, F.col("vec_id") % 50 == 0, 3)
    want = []
    for n, (q, a) in enumerate(rows):
        others = sorted((-sum(x * y for x, y in zip(a, b)), i) for m, (i, b) in enumerate(rows) if m != n)
        want += [(q, r + 1, i, -x) for r, (x, i) in enumerate(others[:3]) if q % 50 == 0]
    assert sorted(map(tuple, found.collect())) == sorted(want)
    none = topk.top_products(vectors.where("size(v) = 0"), F.lit(True), 3)
    assert sorted(map(tuple, none.collect())) == [(7, 1, 50, 0), (50, 1, 7, 0)]


# ---------------------------------------------------------------- pipeline


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity" and len(corpus_pipeline.STAGES) == 5
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.count()
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER))
        if n < 4:
            assert docs.columns == columns and 0 < docs.count() <= before
            assert all(r.n_chars == len(r.text) for r in docs.collect() if r.text != texts[r.doc_id])
    assert docs.count() == corpus_pipeline.run(spark, FOLDER).count()


def test_stages_take_nulls_ties_and_nothing(spark, tmp_path):
    spark.read.parquet(f"{FOLDER}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, None, None, None, None), (1, "", None, None, 0), (1, "same text", "en", "s", 9), (1, "same text", "en", "s", 9), (2, "same text", None, None, None)]
    for chosen in (rows, []):
        docs = spark.createDataFrame(chosen, DOCS).withColumns({"hits": F.lit(1), "rank": F.lit("x"), "text2": F.lit(None).cast("string")})
        for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)))
            assert n == 4 or docs.columns == [*DOCS.replace(" long", "").replace(" string", "").split(", "), "hits", "rank", "text2"]
        assert (docs.count() > 0) == bool(chosen)


def test_grades_out_of_range_teach_nothing(spark):
    docs = spark.createDataFrame([(i, f"{'good words' if i % 2 else 'poor text'} number {i}") for i in range(60)], "doc_id long, text string")
    grades = [(i, i % 2) for i in range(60) if i % 5]
    odd = [(0, 5), (5, -1), (10, 99), (15, None)]
    plain, more = (quality.quality(docs, spark.createDataFrame(g, "doc_id long, grade long"), 2, 1) for g in (grades, grades + odd))
    assert {tuple(r) for r in plain.collect()} == {tuple(r) for r in more.collect()}
