"""Quality classifier: ordinal cumulative-link regression.

Texts carry grades 0 .. K - 1. One weight vector over hashed text features is
shared by all grades, and ordered thresholds cut its score:

    P(grade <= k) = 1 / (1 + exp(-(threshold_k - w.x)))

The thresholds are the first one and the logarithms of the gaps, so they stay
in order. The fit minimises the negative log likelihood with weight decay; it
gives each text an expected grade and the probability of the grades from a
chosen one up, which selects.

Features are the words and the shapes of the tokens of the whole text, by
their logarithmic counts at unit length. The fit takes a bounded sample:
SAMPLE graded rows at most, those of the smallest id hashes.

Defined cases: null or empty text is scored by the thresholds alone; rows that
repeat a doc_id are scored each; grades without a document, null grades, grades
outside 0 .. K - 1 and null ids teach nothing; with fewer than two grades every tail probability is 1
if the only grade is in the tail, else 0; extra columns stay out; an empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import Sparse, adam, fold, presence, sampled, style_features

BITS = 18
SAMPLE = 12_000
#: Fit: steps, their length, weight decay, texts a feature must occur in.
STEPS, RATE, DECAY, LEAST = 250, 0.2, 2e-5, 3
#: Tail probability from which a text is selected.
THRESHOLD = 0.5


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray
    grades: int


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def cumulative(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade <= k) for k = -1 .. K - 1, one row per score."""
    inner = _sigmoid(thresholds[None, :] - score[:, None])
    return np.concatenate([np.zeros((len(score), 1)), inner, np.ones((len(score), 1))], axis=1)


def fit_arrays(x: Sparse, grade: np.ndarray, grades: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds."""
    n, cuts = x.n, grades - 1

    def thresholds(p: np.ndarray) -> np.ndarray:
        return p[0] + np.r_[0, np.cumsum(np.exp(p[1:]))]

    def gradient(p: np.ndarray) -> np.ndarray:
        w, own = p[:size], p[size:]
        c = cumulative(x.dot(w), thresholds(own))
        high, low = c[np.arange(n), grade + 1], c[np.arange(n), grade]
        mass = np.maximum(high - low, 1e-12)
        slope_high, slope_low = high * (1 - high) / mass, low * (1 - low) / mass
        by_score = (slope_high - slope_low) / n  # of the negative log likelihood
        by_cut = np.zeros(cuts)
        np.add.at(by_cut, grade[grade < cuts], -slope_high[grade < cuts] / n)
        np.add.at(by_cut, grade[grade > 0] - 1, slope_low[grade > 0] / n)
        by_gap = np.cumsum(by_cut[::-1])[::-1]
        by_gap[1:] *= np.exp(own[1:])
        return np.r_[x.back(by_score, size) + DECAY * w, by_gap]

    share = np.clip(np.cumsum(np.bincount(grade, minlength=grades))[:-1] / n, 1e-3, 1 - 1e-3)
    cut = np.log(share / (1 - share))
    start = np.r_[np.zeros(size), cut[0], np.log(np.maximum(np.diff(cut), 1e-2))]
    p = adam(gradient, start, STEPS, RATE)
    return p[:size], thresholds(p[size:])


def _unit(row: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    value = np.log1p(count)
    length = np.sqrt(np.bincount(row, weights=value * value, minlength=n))
    return value / length[row] if len(row) else value


def fit(docs: DataFrame, grades: DataFrame, n_grades: int) -> Model:
    """The model of training rows: `docs` (doc_id, text) and `grades` (doc_id, grade)."""
    valid = grades.where("doc_id is not null").where(F.col("grade").between(0, n_grades - 1))
    known = valid.groupBy("doc_id").agg(F.max("grade").alias("grade"))
    ids = docs.where("doc_id is not null").select("doc_id").distinct()
    known = known.join(ids, "doc_id", "left_semi")
    chosen = sampled(known, SAMPLE).select("doc_id", F.col("grade").cast("long").alias("grade"))
    texts = docs.join(F.broadcast(chosen), "doc_id")  # SAMPLE ids at most
    found = presence(texts, style_features, BITS, ["doc_id", "grade"]).toArrow().sort_by("doc_id")
    grade = found.column("grade").to_numpy().astype(np.int64)
    if not len(grade) or grade.min() == grade.max():
        only = int(grade[0]) if len(grade) else 0
        edge = np.where(np.arange(n_grades - 1) < only, -np.inf, np.inf)
        return Model(np.zeros(1 << BITS), edge, n_grades)
    lists = found.column("at").combine_chunks()
    at, count = lists.flatten().to_numpy().astype(np.int64), found.column("count").combine_chunks().flatten().to_numpy()
    x = Sparse(at, np.ones(len(at)), np.r_[0, np.cumsum(lists.value_lengths().to_numpy())])
    x.value = _unit(x.row, count, x.n)
    often = np.bincount(at, minlength=1 << BITS) >= LEAST
    keep, small = often[at], np.cumsum(often) - 1
    x.at, x.value, x.row = small[at[keep]], x.value[keep], x.row[keep]
    own, thresholds = fit_arrays(x, grade, n_grades, int(often.sum()))
    weights = np.zeros(1 << BITS)
    weights[often] = own
    return Model(weights, thresholds, n_grades)


def score(docs: DataFrame, model: Model, tail: int) -> DataFrame:
    """(doc_id, expected_grade, tail_probability) of every row: of grades >= `tail`."""
    weights, thresholds = model.weights.astype(np.float32), model.thresholds

    def run(batches):
        for batch in batches:
            for first, last, row, feature in style_features(batch, BITS):
                n = last - first
                key, count = np.unique((row.astype(np.int64) << BITS) | feature, return_counts=True)
                own = key >> BITS
                f = np.bincount(own, weights=weights[key & ((1 << BITS) - 1)] * _unit(own, count, n), minlength=n)
                c = cumulative(f, thresholds)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array((1 - c[:, 1:-1]).sum(axis=1)), pa.array(1 - c[:, tail])],
                    ["doc_id", "expected_grade", "tail_probability"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, expected_grade double, tail_probability double"
    )


def quality(docs: DataFrame, grades: DataFrame, n_grades: int, tail: int, folds: int = 4, held: int = 2) -> DataFrame:
    """(doc_id, held_out, expected_grade, tail_probability, selected) of every row; the fold `held` teaches nothing."""
    own = fold(F.col("doc_id"), folds)
    model = fit(docs.where(own != held).select("doc_id", "text"), grades.where(own != held).select("doc_id", "grade"), n_grades)
    out = score(docs, model, tail)
    return out.select(
        "doc_id",
        F.coalesce(own == held, F.lit(False)).alias("held_out"),
        "expected_grade",
        "tail_probability",
        (F.col("tail_probability") >= THRESHOLD).alias("selected"),
    )
