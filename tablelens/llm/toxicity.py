"""Toxicity: non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; all other texts of the training rows
are unlabelled, whatever their label says, and hold toxic ones at the rate of
the class prior. The risk of a classifier f is estimated from both alone as

    prior * E_P[loss(f)] + max(0, E_U[loss(-f)] - prior * E_P[loss(-f)])

where the second part, the risk on negatives, is kept from going below zero;
where a step would bring it there, the step goes the other way. f is linear in
the hashed distinct words of a text that positives hold more often, and the loss is logistic, so 1 / (1 +
exp(-f)) is a probability.

The fit takes a bounded sample: POSITIVES and UNLABELLED rows at most, those of
the smallest id hashes. Every text is scored whole, in one pass without a
shuffle.

Defined cases: null or empty text scores the bias alone; rows that repeat a
doc_id are scored each; labels without a document, null labels and null ids
teach nothing; without a positive or an unlabelled text every score is 0;
extra columns stay out; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import Sparse, adam, fold, presence, sampled, word_features

BITS = 18
POSITIVES, UNLABELLED = 4_000, 12_000
#: Score from which a text counts as toxic.
THRESHOLD = 0.3
#: Fit: steps, their length, weight decay times the number of positives, positives a feature must occur in.
STEPS, RATE, DECAY, LEAST = 200, 0.05, 0.4, 3
#: How many times as often as unlabelled texts positives must hold a feature. Others would add up in long texts.
LIFT = 2


@dataclass
class Model:
    weights: np.ndarray
    bias: float


def _loss_slope(f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logistic loss of f and its derivative."""
    return np.logaddexp(0, -f), -1 / (1 + np.exp(np.clip(f, -50, 50)))


def fit_arrays(positive: Sparse, unlabelled: Sparse, prior: float, size: int) -> Model:
    """Minimise the non-negative risk over weights and bias."""

    def gradient(w: np.ndarray) -> np.ndarray:
        fp, fu = positive.dot(w[:-1]) + w[-1], unlabelled.dot(w[:-1]) + w[-1]
        _, up = _loss_slope(fp)
        down_p, slope_p = _loss_slope(-fp)
        down_u, slope_u = _loss_slope(-fu)
        negative = down_u.mean() - prior * down_p.mean()
        gp, gu = prior * up / positive.n, np.zeros(unlabelled.n)
        if negative >= 0:
            gp, gu = gp + prior * slope_p / positive.n, -slope_u / unlabelled.n
        else:  # back to where the estimate is possible
            gp, gu = -prior * slope_p / positive.n, slope_u / unlabelled.n
        g = np.r_[positive.back(gp, size) + unlabelled.back(gu, size), gp.sum() + gu.sum()]
        g[:-1] += DECAY / positive.n * w[:-1]
        return g

    start = np.zeros(size + 1)
    start[-1] = np.log(prior / (1 - prior))
    w = adam(gradient, start, STEPS, RATE)
    return Model(w[:-1], float(w[-1]))


def _rows(table: pa.Table) -> Sparse:
    at = table.column("at").combine_chunks()
    cuts = np.r_[0, np.cumsum(at.value_lengths().to_numpy())]
    return Sparse(at.flatten().to_numpy().astype(np.int64), np.ones(cuts[-1]), cuts)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of training rows: `docs` (doc_id, text) and `labels` (doc_id, toxic)."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rate = known.agg(F.avg("toxic")).first()[0]
    empty = Model(np.zeros(1 << BITS), -np.inf)
    if not rate:
        return empty
    ids = docs.where("doc_id is not null").select("doc_id").distinct()
    toxic = sampled(known.where("toxic = 1").join(ids, "doc_id", "left_semi").select("doc_id"), POSITIVES)
    other = sampled(ids, UNLABELLED)
    chosen = toxic.select("doc_id", F.lit(1).alias("positive")).union(other.select("doc_id", F.lit(0).alias("positive")))
    texts = docs.join(F.broadcast(chosen), "doc_id")  # POSITIVES + UNLABELLED ids at most
    found = presence(texts, word_features, BITS, ["doc_id", "positive"]).drop("count").toArrow().sort_by([("positive", "ascending"), ("doc_id", "ascending")])
    mark = found.column("positive").to_numpy()
    positive, unlabelled = _rows(found.filter(pa.array(mark == 1))), _rows(found.filter(pa.array(mark == 0)))
    if not positive.n or not unlabelled.n:
        return empty
    in_positive = np.bincount(positive.at, minlength=1 << BITS)
    in_other = np.bincount(unlabelled.at, minlength=1 << BITS)
    often = (in_positive >= LEAST) & (in_positive * unlabelled.n >= LIFT * in_other * positive.n)
    small = np.cumsum(often) - 1
    for part in (positive, unlabelled):
        keep = often[part.at]
        part.at, part.value, part.row = small[part.at[keep]], part.value[keep], part.row[keep]
    model = fit_arrays(positive, unlabelled, min(max(float(rate), 1e-4), 0.9), int(often.sum()))
    weights = np.zeros(1 << BITS)
    weights[often] = model.weights
    return Model(weights, model.bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of `docs`."""
    weights, bias = model.weights.astype(np.float32), model.bias

    def run(batches):
        for batch in batches:
            for first, last, row, feature in word_features(batch, BITS):
                telling = weights[feature] != 0
                key = np.unique((row[telling].astype(np.int64) << BITS) | feature[telling])
                f = np.bincount(key >> BITS, weights=weights[key & ((1 << BITS) - 1)], minlength=last - first) + bias
                out = 1 / (1 + np.exp(-np.clip(f, -500, 500))) if np.isfinite(bias) else np.zeros(last - first)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(out)], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; rows of the fold `held` teach nothing."""
    own = fold(F.col("doc_id"), folds)
    model = fit(docs.where(own != held).select("doc_id", "text"), labels.where(own != held).select("doc_id", "toxic"))
    out = score(docs, model)
    return out.select("doc_id", F.coalesce(own == held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """The rows of `docs` whose own text scores below THRESHOLD."""
    own = fold(F.col("doc_id"), folds)
    model = fit(docs.where(own != held).select("doc_id", "text"), labels.where(own != held).select("doc_id", "toxic"))
    weights, bias = model.weights.astype(np.float32), model.bias

    def run(batches):
        for batch in batches:
            for first, last, row, feature in word_features(batch, BITS):
                telling = weights[feature] != 0
                key = np.unique((row[telling].astype(np.int64) << BITS) | feature[telling])
                f = np.bincount(key >> BITS, weights=weights[key & ((1 << BITS) - 1)], minlength=last - first) + bias
                low = f < np.log(THRESHOLD / (1 - THRESHOLD))
                yield batch.slice(first, last - first).filter(pa.array(low))

    return docs.mapInArrow(run, docs.schema)
