"""Jaccard join, repeated byte strings, repeated lines and contamination against plain versions."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablelens.llm import decontaminate, jaccard_join, line_dedup, queries, run_length_index
from tablelens.llm.common import components

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows, **extra):
    return spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], DOCS).withColumns(
        {c: F.lit(v) for c, v in extra.items()}
    )


def words_of(rng, n, vocabulary=5000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    """Near copies of all degrees, equal texts, short, empty, null and very long ones, a shared passage."""
    rng = random.Random(5)
    rows, passage = [], " ".join(words_of(rng, 70))
    for size in (30, 60, 200):
        base = words_of(rng, size)
        for share in (0.0, 0.01, 0.02, 0.03, 0.05, 0.1, 0.2):
            for _ in range(4):
                own = [w if rng.random() >= share else f"x{rng.randrange(9999)}" for w in base]
                rows.append(" ".join(own))
    rows += [" ".join(words_of(rng, 40)) + "\n" + passage + "\n" + " ".join(words_of(rng, 30)) for _ in range(12)]
    rows += [rows[0].upper(), rows[1] + " ", "one two", "one two", "a b c d e", "A b  c\td e", "", "  \n ", None, None]
    rows += ["é ü ß " * 40, "ab " * 600, "abcdefg" * 300, " ".join(words_of(rng, 30_000))]
    rng.shuffle(rows)
    return list(enumerate(rows))


def check_jaccard(spark, rows, **extra):
    found = jaccard_join.jaccard_components(table(spark, rows, **extra))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == brute.jaccard(rows)


def test_jaccard_components(spark, corpus):
    check_jaccard(spark, corpus, n_shingles=1, s1=2, component_id=3, head=4)


def test_jaccard_in_blocks(spark, corpus, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 150)
    check_jaccard(spark, corpus)


def test_jaccard_without_frequent_shingles(spark, corpus, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FREQUENT", 1)
    check_jaccard(spark, corpus)


def test_jaccard_of_the_sample(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.op7_ngram_jaccard_join(spark, FOLDER)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == brute.jaccard(rows)


def test_jaccard_of_nothing(spark):
    assert jaccard_join.jaccard_components(table(spark, [])).collect() == []
    assert {r.component_id for r in jaccard_join.jaccard_components(table(spark, [(1, None), (2, "")])).collect()} == {1, 2}


def test_jaccard_of_rows_without_an_id(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (5, text), (3, text + " more"), (None, "x y z a b c d"), (9, "other words"), (None, None), (None, text + " more")]
    rows += [(7, "q"), (7, "q"), (8, text.replace("w", "v"))]
    found = jaccard_join.jaccard_components(table(spark, rows)).collect()
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, r.component_id or -1) for r in found)
    assert got == [(-1, 0, -1), (-1, 3, -1), (-1, 36, 3), (-1, 37, 3), (3, 37, 3), (5, 36, 3), (7, 1, 7), (7, 1, 7), (8, 36, 8), (9, 1, 9)]


def test_rows_without_an_id_link_as_others_do(spark):
    w = [f"w{i}" for i in range(40)]
    left, middle, right = " ".join(w[:32]), " ".join(w[:40]), " ".join(w[8:40])
    rows = [(4, left), (None, middle), (6, right), (3, " ".join(f"v{i}" for i in range(40))), (None, " ".join(f"v{i}" for i in range(41)))]
    rows += [(None, "a b c d e f"), (9, "o p q r s t"), (9, " ".join(f"x{i}" for i in range(10)))]
    found = jaccard_join.jaccard_components(table(spark, rows)).collect()
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in found)
    assert got == [(-1, 2, -1), (-1, 36, 4), (-1, 37, 3), (3, 36, 3), (4, 28, 4), (6, 28, 4), (9, 2, 9), (9, 6, 9)]


def test_near_copies_leave_one_document(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, "other text altogether here now"), (5, text), (3, text + " more"), (None, text), (None, "no id at all"), (None, "no id at all")]
    docs = table(spark, rows)
    left = jaccard_join.drop_near_copies(docs)
    assert left.columns == docs.columns and sorted((r.doc_id or -1) for r in left.collect()) == [-1, 1, 3]


def test_of_equal_rows_the_first_one_stays(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text, "c"), (1, text, "a"), (1, text, "b"), (2, text, "A")], "doc_id long, text string, source string")
    for _ in range(2):
        assert [tuple(r) for r in jaccard_join.drop_near_copies(docs.repartition(3)).collect()] == [(1, text, "a")]


def test_near_copies_are_told_by_row_not_by_id(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(3, a), (5, a), (5, b), (6, b), (7, "c d"), (7, "c d"), (7, None), (None, f"{b} more"), (None, b), (None, "e f"), (None, "e f")]
    left = jaccard_join.drop_near_copies(table(spark, rows, component="x", no_id=1, n=2)).collect()
    kept = sorted((r.doc_id or -1, r.text or "") for r in left)
    assert [x for x in kept if x[0] > 0] == [(3, a), (5, b), (7, ""), (7, "c d")]
    assert [x[1] for x in kept if x[0] < 0] == ["e f"]  # the others are near copies of a document with an id


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(50, 95))
def test_bounds_never_lose_a_pair(seed, percent):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 62, 120).astype(np.uint64)
    sets = [np.unique(rng.choice(base, rng.integers(1, 120))) for _ in range(40)]
    sizes = np.array([len(s) for s in sets])
    points = [jaccard_join.point(s) for s in sets]
    found = {(min(a, b), max(a, b)) for i, j in jaccard_join.bounded_pairs(points, sizes, percent) for a, b in zip(i.tolist(), j.tolist())}
    want = {(i, j) for i in range(40) for j in range(i + 1, 40) if jaccard_join.similar(sets[i], sets[j], percent)}
    assert want <= found


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 200), (200, 300)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(51)) and all(found[i] == 100 for i in range(100, 160))
    assert found[300] == found[200] == 200


# ---------------------------------------------------------------- repeated byte strings


def check_repeats(spark, rows, width):
    removed = run_length_index.remove_repeats(table(spark, rows, spans=1, copies=2, check=3), width)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in run_length_index.digest(removed).collect()}
    assert got == brute.repeats(rows, width)


@pytest.mark.parametrize("width", [40, 400])
def test_repeated_strings(spark, corpus, width):
    check_repeats(spark, corpus, width)


def test_repeated_strings_in_blocks(spark, corpus, monkeypatch):
    monkeypatch.setattr(run_length_index, "INDEX", 4000)
    monkeypatch.setattr(run_length_index, "BLOCK", 4000)
    monkeypatch.setattr(run_length_index, "PIECE", 700)
    check_repeats(spark, corpus, 100)


def test_repeated_strings_of_the_sample(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op1_suffix_array_dedup(spark, FOLDER).collect()}
    assert got == brute.repeats(rows)


def test_repeats_before_bytes_whose_hashes_collide(spark):
    # a Thue-Morse block and its complement have equal polynomial hashes modulo 2**64
    block = "a"
    for _ in range(11):
        block += block.translate({97: 98, 98: 97})
    rng = random.Random(1)
    shared = "".join(rng.choice("cdefgh") for _ in range(500))
    rows = [(1, shared + block), (2, shared + block.translate({97: 98, 98: 97}))]
    data = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    spans = run_length_index.match_spans(data, np.array([len(rows[0][1]), len(data)]), 400)
    gone = np.zeros(len(data), bool)
    for a, b in spans:
        gone[a:b] = True
    assert gone[:500].all() and gone[len(rows[0][1]) : len(rows[0][1]) + 500].all()
    check_repeats(spark, rows, 400)


def test_repeated_strings_of_nothing_and_of_null_ids(spark):
    assert run_length_index.remove_repeats(table(spark, [])).collect() == []
    rows = run_length_index.remove_repeats(table(spark, [(None, "ab" * 300), (None, "ab" * 300), (None, None), (1, "x")]))
    assert sorted((r.n_bytes, r.n_removed) for r in rows.collect()) == [(0, 0), (1, 0), (600, 600), (600, 600)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=25), min_size=1, max_size=6), st.integers(2, 6))
def test_index_marks_what_repeats(texts, width):
    data = [t.encode() for t in texts]
    ends = np.cumsum([len(x) for x in data])
    found = run_length_index.match_spans(np.frombuffer(b"".join(data), np.uint8), ends, width)
    seen, base, want = {}, 0, []
    for x in data:
        for k in range(len(x) - width + 1):
            seen.setdefault(x[k : k + width], []).append(base + k)
        base += len(x)
    for places in seen.values():
        if len(places) > 1:
            want += [(p, p + width) for p in places]
    want = run_length_index.merged(np.array(want, np.int64).reshape(-1, 2))
    assert run_length_index.merged(found).tolist() == want.tolist()


# ---------------------------------------------------------------- lines


def test_later_runs_of_lines_go(spark):
    line = [" ".join(f"l{k}w{i}" for i in range(20)) for k in range(8)]
    long = " ".join(f"p{i}" for i in range(55))
    rows = [
        (3, "\n".join([line[0], line[1], line[2], "", line[7]])),
        (5, "\n".join(["begin", line[0], "", line[1], line[2], "end"])),
        (6, "\n".join([line[0], line[3]])),
        (7, f"head\n{long}\ntail"),
        (8, f"{long}"),
        (9, None),
        (10, ""),
        (11, "\n\n"),
        (12, f"{long}\n{long}"),
    ]
    out = line_dedup.dedup_lines(table(spark, rows, runs=1, n_lines="x"))
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[3] == rows[0][1] and got[5] == "begin\nend" and got[6] == rows[2][1]
    assert got[7] == rows[3][1] and got[8] == "" and got[12] == ""
    assert got[9] is None and got[10] == "" and got[11] == "\n\n"
    assert line_dedup.dedup_lines(table(spark, [])).collect() == []


def test_runs_go_to_their_last_line(spark):
    rng = random.Random(8)
    pool = [" ".join(f"l{k}w{i}" for i in range(rng.choice([1, 3, 8, 20, 55]))) for k in range(14)]
    rows = []
    for i in range(120):
        start = rng.randrange(len(pool))
        run = pool[start : start + rng.randrange(1, 8)]
        own = [rng.choice(["", f"own{i} line", rng.choice(pool)]) for _ in range(rng.randrange(4))]
        rows.append((i, "\n".join([*own, *run, *own[:1], *run[: rng.randrange(3)]])))
    rows += [(200, "a b\n" * 60), (201, None), (202, "")]
    got = line_dedup.dedup_lines(table(spark, rows)).collect()
    want = brute.kept_lines(rows, line_dedup.MIN_WORDS)
    assert {r.doc_id: [x for x in (r.text or "").split("\n") if x.split()] for r in got} == want
    tail = f"{pool[0]} " + " ".join(f"t{i}" for i in range(60)) + "\nshort tail"
    got = line_dedup.dedup_lines(table(spark, [(1, tail), (2, f"{tail}\nown"), (3, f"own\n{tail}")])).collect()
    assert {r.doc_id: r.text for r in got} == {1: tail, 2: "own", 3: "own"}


def test_lines_of_repeated_ids_stay(spark):
    long = " ".join(f"p{i}" for i in range(55))
    rows = line_dedup.dedup_lines(table(spark, [(1, long), (1, long), (None, long)])).collect()
    assert sorted(r.text for r in rows) == ["", long, long]


def test_texts_of_one_id_keep_their_own_lines(spark):
    line = {x: " ".join(f"{x}{i}" for i in range(27)) for x in ("a0", "a1", "b0", "b1", "c0", "c1")}
    a, b, c = (f"{line[x + '0']}\n{line[x + '1']}" for x in "abc")
    rows = line_dedup.dedup_lines(table(spark, [(3, a), (7, a), (7, b), (None, a), (None, c), (None, None)])).collect()
    got = sorted((r.doc_id or -1, r.text or "", r.n_removed) for r in rows)
    assert got == sorted([(3, a, 0), (7, "", 2), (7, b, 0), (-1, "", 2), (-1, c, 0), (-1, "", 0)])
    # different texts that share a passage at the same lines, under one id and under none
    both = [f"{a}\n{line['b0']}", f"{a}\n{line['c0']}"]
    for i in (4, None):
        texts = [r.text for r in line_dedup.dedup_lines(table(spark, [(i, t) for t in both])).collect()]
        assert sum(a in t for t in texts) == 1 and line["b0"] in "".join(texts) and line["c0"] in "".join(texts)
    assert [r.text for r in line_dedup.dedup_lines(table(spark, [(None, a), (None, a)])).collect()] == [a, a]


# ---------------------------------------------------------------- contamination


def test_contamination_cases(spark):
    item = " ".join(f"q{i}" for i in range(15))
    bench = spark.createDataFrame([(1, item), (10, "Short ITEM"), (2, item + " tail"), (None, "nameless words here"), (4, None), (5, "")], "item_id long, text string")
    rest = " ".join(f"z{i}" for i in range(300))
    rows = [(1, f"a {item.upper()}. b"), (2, f"{rest} short, item"), (3, "short"), (4, None), (5, ""), (6, "nameless words here"), (7, f"{rest} {item}"), (1, "É q1")]
    found = decontaminate.contamination(table(spark, rows, words=1, hits=2, items=3, found=4), bench)
    got = sorted((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in found.collect())
    assert got == [
        (1, 2, 0, [], False), (1, 17, 15, ["1", "2"], True), (2, 302, 2, ["10"], False), (3, 1, 0, [], False),
        (4, 0, 0, [], False), (5, 0, 0, [], False), (6, 3, 3, [], True), (7, 315, 15, ["1", "2"], False),
    ]
    kept = decontaminate.drop_contaminated(table(spark, rows), bench)
    assert kept.columns == table(spark, rows).columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 5, 7]
    nothing = decontaminate.contamination(table(spark, rows), bench.limit(0))
    assert {(r.n_hit, r.contaminated) for r in nothing.collect()} == {(0, False)}
    assert decontaminate.contamination(table(spark, []), bench).collect() == []


def test_hits_of_one_id_meet_by_text(spark):
    item = " ".join(f"q{i}" for i in range(15))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = table(spark, [(None, f"own{k % 20} {item}") for k in range(40)] + [(1, f"{item} one"), (1, f"{item} two"), (None, None)])
    lists = decontaminate.gathered_hits(docs, decontaminate.benchmark_windows(bench), [13]).collect()
    assert len(lists) == 22 and {len(r.found) for r in lists} == {3}
    got = decontaminate.contamination(docs, bench).collect()
    assert len(got) == 43 and sum((r.n_words, r.n_hit, r["items"], len(r.hits)) == (16, 15, ["1"], 3) for r in got) == 42


def test_small_letters_do_not_depend_on_what_is_between_words(spark):
    rest = " ".join(f"Q{i}" for i in range(12))
    bench = spark.createDataFrame([(1, f"ΑΣ x {rest}"), (2, "İΣ")], "item_id long, text string")
    rows = [(1, f"ΑΣ'X {rest.lower()}"), (2, f"ΑΣ.x {rest}"), (3, f"ας x {rest}"), (4, "İΣ's")]
    found = decontaminate.contamination(table(spark, rows), bench).collect()
    assert {r.doc_id: (r.n_hit, r["items"]) for r in found} == {1: (14, ["1"]), 2: (14, ["1"]), 3: (13, ["1"]), 4: (1, ["2"])}


def test_contamination_without_broadcast(spark, monkeypatch):
    want = sorted(map(tuple, queries.op3_benchmark_decontamination(spark, FOLDER).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, queries.op3_benchmark_decontamination(spark, FOLDER).collect())) == want
