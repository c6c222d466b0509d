"""Language ID: segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
A word's probability is the sum over all ways to cut it into pieces, which the
forward algorithm adds up from left to right, over whole words and the longest
pieces, rescaled as it goes; a text's is the product over its words. The language with the largest product, times its share of the training
texts, is predicted, and its normalised probability is the score.

Words are runs of ASCII letters and bytes beyond ASCII in lower case, with a
mark in front; a text of a script without spaces is one word of any length. Every
single byte is a piece, so each word has a segmentation. The vocabulary's file
must lie at the same path on every executor. Probabilities are piece counts of the vocabulary's own
segmentation of the training texts, smoothed. The fit takes a bounded sample:
SAMPLE texts at most, those of the smallest id hashes; it counts in the tasks,
and (languages x pieces) counts reach the driver.

Texts are scored whole, in one pass without a shuffle. A word is scored once
per task and kept, KEPT words at most; more are scored again.

Defined cases: null text and text without a letter is `und` with score 0; null
languages and null ids teach nothing; without any training text all others are
`und` too; ties go to the smaller language name; rows that repeat are scored
each; extra columns stay out; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, mix, prefix_hash, span_hash, words
from .features import fold, sampled

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLE = 12_000
#: Words kept per task; smoothing in counts per piece.
KEPT, SMOOTH = 400_000, 0.05
#: Words of so many bytes are scored together, which cannot underflow; longer ones one by one, in blocks of positions.
SHORT, POSITIONS = 32, 1 << 16
MARK = 1
_U = np.uint64
_NOT_LETTER = np.ones(256, bool)
_NOT_LETTER[[*range(97, 123), *range(128, 256)]] = False
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Model:
    """Languages, their log shares, and per piece length the sorted hashes and probabilities of pieces."""

    languages: list[str]
    share: np.ndarray
    pieces: list[tuple[np.ndarray, np.ndarray]]


def vocabulary(path: str) -> list[bytes]:
    """Distinct pieces as bytes, MARK for the start of a word; all single bytes and MARK are among them."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = {bytes([i]): None for i in range(256)}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            piece = model.id_to_piece(i).replace("▁", chr(MARK)).encode()
            out[piece] = None
    return list(out)


def _counted(texts: DataFrame, path: str) -> DataFrame:
    """(lang, piece, count) over the vocabulary's own segmentation of `texts` (lang, text)."""

    def run(batches):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        for batch in batches:
            counts: dict[str, np.ndarray] = {}
            langs, own = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang, text in zip(langs, own, strict=True):
                clean = " ".join(re.findall(r"[^\W\d_]+", (text or "").lower()))
                ids = model.encode(clean)
                if ids:
                    counts[lang] = counts.get(lang, 0) + np.bincount(ids, minlength=model.get_piece_size())
            for lang, found in counts.items():
                at = np.flatnonzero(found)
                pieces = [model.id_to_piece(int(i)) for i in at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at)), pa.array(pieces), pa.array(found[at].astype(np.int64))], ["lang", "piece", "count"]
                )

    counted = texts.select("lang", "text").mapInArrow(run, "lang string, piece string, count long")
    return counted.groupBy("lang", "piece").agg(F.sum("count").alias("count"))


def _hash(piece: bytes) -> np.uint64:
    data = np.frombuffer(piece, np.uint8)
    return span_hash(prefix_hash(data), np.array([0]), np.array([len(data)]))[0]


def fit(docs: DataFrame, path: str = VOCABULARY) -> Model:
    """The model of training rows `docs` (doc_id, text, lang)."""
    known = docs.where("lang is not null and text is not null and doc_id is not null")
    ids = sampled(known.select("doc_id").distinct(), SAMPLE)
    texts = known.join(F.broadcast(ids), "doc_id")  # SAMPLE ids at most
    share = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # one row per language
    found = _counted(texts, path).toArrow()
    languages = sorted(set(found.column("lang").to_pylist()))
    pieces = vocabulary(path)
    place = {p: i for i, p in enumerate(pieces)}
    counts = np.full((len(pieces), max(1, len(languages))), SMOOTH)
    for lang, piece, n in zip(*(found.column(c).to_pylist() for c in ("lang", "piece", "count")), strict=True):
        raw = bytes([int(piece[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", piece) else piece.replace("▁", chr(MARK)).encode()
        if raw in place:
            counts[place[raw], languages.index(lang)] += n
    probability = counts / counts.sum(axis=0)
    tables = []
    for size in range(1, max(map(len, pieces)) + 1):
        own = [p for p in pieces if len(p) == size]
        hashes = np.array([_hash(p) for p in own], np.uint64)
        order = np.argsort(hashes)
        tables.append((hashes[order], probability[[place[own[i]] for i in order]]))
    total = sum(share[x] for x in languages)
    return Model(languages, np.log([share[x] / total for x in languages]) if languages else np.zeros(0), tables)


def word_scores(data: np.ndarray, start: np.ndarray, end: np.ndarray, pieces) -> np.ndarray:
    """Log probability of each word [start, end) of `data` under each language: the forward algorithm."""
    n_langs = pieces[0][1].shape[1]
    out = np.empty((len(start), n_langs))
    hashed = prefix_hash(data)
    size = end - start
    for n in np.unique(size[size <= SHORT]).tolist():
        own = np.flatnonzero(size == n)
        at = start[own]
        forward = np.zeros((n + 1, len(own), n_langs))
        forward[0] = 1.0
        for stop in range(1, n + 1):
            for length in range(1, min(stop, len(pieces)) + 1):
                place, hit = _found(hashed, at + stop - length, at + stop, pieces[length - 1][0])
                if len(hit):
                    forward[stop, hit] += forward[stop - length, hit] * pieces[length - 1][1][place[hit]]
        out[own] = np.log(np.maximum(forward[n], 1e-300))
    for k in np.flatnonzero(size > SHORT).tolist():
        out[k] = _long_word(hashed, int(start[k]), int(end[k]), pieces)
    return out


def _found(hashed: np.ndarray, start: np.ndarray, end: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the spans among the known hashes, and which spans are there."""
    if not len(known):
        return np.zeros(len(start), np.int64), np.empty(0, np.int64)
    value = span_hash(hashed, start, end)
    place = np.searchsorted(known, value)
    place[place == len(known)] = 0
    return place, np.flatnonzero(known[place] == value)


def _long_word(hashed: np.ndarray, start: int, end: int, pieces) -> np.ndarray:
    """Log probabilities of one word; the last sums are kept, each language scaled on its own."""
    longest, n_langs = len(pieces), pieces[0][1].shape[1]
    ring = np.zeros((longest + 1, n_langs))
    ring[0] = 1.0
    scaled = np.zeros(n_langs)
    for first in range(1, end - start + 1, POSITIONS):
        stops = np.arange(first, min(first + POSITIONS, end - start + 1))
        at, back, weight = [], [], []
        for length in range(1, longest + 1):
            own = stops[stops >= length]
            place, hit = _found(hashed, start + own - length, start + own, pieces[length - 1][0])
            at.append(own[hit])
            back.append(np.full(len(hit), length))
            weight.append(pieces[length - 1][1][place[hit]])
        at, back, weight = np.concatenate(at), np.concatenate(back), np.concatenate(weight)
        order = np.argsort(at, kind="stable")
        back, weight = back[order], weight[order]
        cuts = np.searchsorted(at[order], np.r_[stops, stops[-1] + 1])
        for stop, a, b in zip(stops.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            now = (ring[(stop - back[a:b]) % (longest + 1)] * weight[a:b]).sum(axis=0)
            ring[stop % (longest + 1)] = now
            small = now < 1e-100
            if small.any():
                ring[:, small] *= 1e100
                scaled[small] -= np.log(1e100)
    return np.log(np.maximum(ring[(end - start) % (longest + 1)], 1e-300)) + scaled


class _Words:
    """Scores of the words met so far, by their hash."""

    def __init__(self, pieces) -> None:
        self.pieces = pieces
        self.clear()

    def clear(self) -> None:
        self.hashes = np.empty(0, np.uint64)
        self.scores = np.empty((0, self.pieces[0][1].shape[1]))

    def get(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        code, distinct = pd.factorize(span_hash(prefix_hash(data), start, end))
        first = np.empty(len(distinct), np.int64)
        first[code[::-1]] = np.arange(len(code))[::-1]
        if len(self.hashes) > KEPT:
            self.clear()
        at = np.searchsorted(self.hashes, distinct)
        at[at == len(self.hashes)] = 0
        known = self.hashes[at] == distinct if len(self.hashes) else np.zeros(len(distinct), bool)
        scores = np.empty((len(distinct), self.scores.shape[1]))
        scores[known] = self.scores[at[known]]
        fresh = first[~known]
        scores[~known] = word_scores(data, start[fresh], end[fresh], self.pieces)
        hashes = np.concatenate([self.hashes, distinct[~known]])
        order = np.argsort(hashes)
        self.hashes, self.scores = hashes[order], np.concatenate([self.scores, scores[~known]])[order]
        return scores[code]


def marked_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start, end, row) of the words of lower-case texts, MARK before each."""
    start, end, row = words(data, offsets, _NOT_LETTER)
    size = end - start + 1
    begin = np.r_[0, np.cumsum(size)]
    out = np.empty(begin[-1], np.uint8)
    out[begin[:-1]] = MARK
    inside = np.ones(len(out), bool)
    inside[begin[:-1]] = False
    out[inside] = data[np.arange(int((size - 1).sum())) + np.repeat(start - np.r_[0, np.cumsum(size - 1)][:-1], size - 1)]
    return out, begin[:-1], begin[1:], row


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of `docs` (doc_id, text)."""
    languages, share, pieces = model.languages, model.share, model.pieces

    def run(batches):
        seen = _Words(pieces)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            lettered = np.array([bool(t) and _LETTER.search(t) is not None for t in texts], bool)
            lower = pa.RecordBatch.from_arrays([pa.array([(t or "").lower() for t in texts], pa.string())], ["text"])
            for first, last, data, offsets in chunks(lower, "text"):
                total = np.tile(share, (last - first, 1))
                data, start, end, row = marked_words(data, offsets)
                if len(start) and languages:
                    scores = seen.get(data, start, end)
                    for k in range(len(languages)):
                        total[:, k] += np.bincount(row, weights=scores[:, k], minlength=last - first)
                known = lettered[first:last] & bool(languages)
                best = total.argmax(axis=1) if languages else np.zeros(last - first, int)
                odds = np.exp(total - total.max(axis=1, keepdims=True)) if languages else np.ones((last - first, 1))
                score = np.where(known, 1 / odds.sum(axis=1), 0.0)
                named = [languages[b] if k else "und" for b, k in zip(best.tolist(), known.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(named, pa.string()), pa.array(score)],
                    ["doc_id", "lang_pred", "score"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def languages(docs: DataFrame, folds: int = 5, held: int = 0, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row; rows of the fold `held` teach nothing."""
    own = fold(F.col("doc_id"), folds)
    model = fit(docs.where(own != held).select("doc_id", "text", "lang"), path)
    return identify(docs, model).select("doc_id", F.coalesce(own == held, F.lit(False)).alias("held_out"), "lang_pred", "score")
