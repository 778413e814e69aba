"""Quality classifier learned from positive and unlabelled texts.

Trusted positives are texts labelled as good; unlabelled texts stand for the web.  With the
share p of good texts on the web, the risk of the bad class is the unlabelled risk minus p times
the positives' risk of being called bad; an estimate of it below zero is overfitting, so
it counts as zero (non-negative risk).  p is estimated from the labelled rows of the
training fold.  Rows of the held-out fold are not read in training.

A text is described by shares of character classes, word lengths and repetition; each measure is
cut at quantiles of the unlabelled texts, and the model adds up one weight per measure and bin.
Training uses at most ``POSITIVES`` and ``UNLABELLED`` texts, the first in hash order.

Rows: null and empty texts are scored like any other, by their measures of zero.  Without any
positive or unlabelled text every score is the prior, 0.5 if that is unknown too.  A null
``doc_id`` is scored, and isn't held out.  Rows that share a ``doc_id`` are scored one by one; one of them
can be in the sample.  Equal texts have equal scores.  ``quality_scores`` reads only doc_id and text;
``keep_good`` keeps all columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labelled import held_out, sample_ids, sampled
from .words import shingles, slices, word_hashes

POSITIVES, UNLABELLED = 10_000, 20_000
BINS = 16
MEASURED_BYTES = 1 << 19     # text measured at once: a bound on a worker's memory
ACCEPT = 0.3
STEPS = 600

_MARKS = [c for c in range(0x21, 0x7F) if not chr(c).isalnum()]
_CLASS = np.full(256, len(_MARKS) + 6, np.uint8)       # control characters
_CLASS[_MARKS] = np.arange(len(_MARKS))
_CLASS[0x30:0x3A] = len(_MARKS)
_CLASS[0x41:0x5B] = len(_MARKS) + 1
_CLASS[0x61:0x7B] = len(_MARKS) + 2
_CLASS[0x80:] = len(_MARKS) + 3
_CLASS[0x20] = len(_MARKS) + 4
_CLASS[0x0A] = len(_MARKS) + 5
_CLASSES = len(_MARKS) + 7
MEASURES = _CLASSES + 9


def measures(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(documents x MEASURES) of a slice of texts."""
    n = len(ends)
    size = np.diff(np.concatenate([[0], ends]))
    doc = np.repeat(np.arange(n), size)
    shares = np.bincount(doc * _CLASSES + _CLASS[data], minlength=n * _CLASSES).reshape(n, _CLASSES).astype(float)
    shares /= np.maximum(size, 1)[:, None]
    words, bounds = word_hashes(data, ends)
    count = np.diff(bounds)
    each = np.maximum(count, 1)
    of = np.repeat(np.arange(n), count)

    def distinct(d: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((h, d))
        d, h = d[order], h[order]
        first = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (h[1:] != h[:-1])]))[:len(d)]
        return d[first], np.diff(np.append(first, len(d)))

    once_of, times = distinct(of, words) if len(words) else (of, of)
    kinds = np.bincount(once_of, minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, once_of, times)
    same = np.zeros(n)
    if len(words) > 1:
        again = np.flatnonzero((words[1:] == words[:-1]) & (of[1:] == of[:-1]))
        same = np.bincount(of[again], minlength=n).astype(float)
    tri_of, tri = shingles(words, bounds, 3)
    tri_kinds = np.bincount(distinct(tri_of, tri)[0], minlength=n) if len(tri) else np.zeros(n)
    letters = shares[:, len(_MARKS) + 1:len(_MARKS) + 4].sum(axis=1)
    odd = shares[:, :len(_MARKS)].sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        entropy = -np.nansum(np.where(shares > 0, shares * np.log(shares), 0), axis=1)
    own = [np.log1p(count), letters * size / each, kinds / each, top / each, same / each,
           tri_kinds / np.maximum(count - 2, 1), odd, entropy,
           shares[:, len(_MARKS) + 1] / np.maximum(letters, 1e-9)]
    return np.column_stack([shares, *own]).astype(np.float32)


@dataclass
class Model:
    """Additive model over binned measures; ``score`` gives the probability of the good class."""

    prior: float = 0.5
    edges: list[np.ndarray] = field(default_factory=list)
    weights: np.ndarray | None = None
    bias: float = 0.0

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], "left") + j * (BINS + 1) for j, e in enumerate(self.edges)])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        return _sigmoid(self.weights[self.bins(x)].sum(axis=1) + self.bias)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    """Minimise the non-negative risk by Adam; the logistic loss, a small quadratic penalty."""
    if not len(positive) or not len(unlabelled) or not 0 < prior < 1:
        return Model(prior=prior)
    model = Model(prior, [np.unique(np.quantile(unlabelled[:, j], np.linspace(0, 1, BINS + 1)[1:-1]))
                          for j in range(unlabelled.shape[1])])
    p, u = model.bins(positive), model.bins(unlabelled)
    size = len(model.edges) * (BINS + 1)
    w = np.zeros(size + 1)
    w[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(w), np.zeros_like(w)

    def slope(rows: np.ndarray, of: np.ndarray) -> np.ndarray:
        g = np.bincount(rows.reshape(-1), np.repeat(of, rows.shape[1]), size)
        return np.append(g, of.sum()) / len(rows)

    for step in range(1, STEPS + 1):
        zp, zu = w[p].sum(axis=1) + w[-1], w[u].sum(axis=1) + w[-1]
        sp, su = _sigmoid(zp), _sigmoid(zu)
        bad_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        good, bad = prior * slope(p, sp - 1), slope(u, su) - prior * slope(p, sp)
        g = good + bad if bad_risk >= 0 else -bad     # below zero, walk back out of the overfit
        g[:-1] += 1e-4 * w[:-1]
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w -= 0.08 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    model.weights, model.bias = w[:-1], float(w[-1])
    return model


def _measured(text: Column) -> Column:
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [measures(data, ends) for data, ends in slices(batch, MEASURED_BYTES)]
            flat = np.concatenate([np.empty((0, MEASURES), np.float32), *parts])
            yield pa.ListArray.from_arrays(
                pa.array(np.arange(len(flat) + 1, dtype=np.int32) * MEASURES), pa.array(flat.reshape(-1)))

    return F.arrow_udf(measure, "array<float>")(text)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labels' training fold."""
    known = labels.where(~held_out(F.col("doc_id")) & F.col("quality").isNotNull())
    counts = known.agg(F.count("*").alias("n"), F.sum((F.col("quality") == 1).cast("int")).alias("good")).first()
    prior = min(max(counts["good"] / counts["n"], 0.01), 0.99) if counts["n"] else 0.5
    chosen = sample_ids(labels, F.col("quality") == 1, POSITIVES, "p").union(sample_ids(docs, None, UNLABELLED, "u"))
    # at most POSITIVES + UNLABELLED ids: a broadcast of bounded size
    rows = sampled(docs, chosen).select("role", _measured(F.col("text")).alias("x")).toPandas()
    of = lambda r: np.stack(rows["x"][rows["role"] == r].tolist()) if (rows["role"] == r).any() else np.empty((0, MEASURES))
    return fit(of("p"), of("u"), prior)


def quality_score(text: Column, model: Model) -> Column:
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [model.score(measures(data, ends)) for data, ends in slices(batch, MEASURED_BYTES)]
            yield pa.array(np.concatenate([np.empty(0), *parts]))

    return F.arrow_udf(score, "double")(text).alias("score")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), quality_score(F.col("text"), model))
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, training: DataFrame | None = None) -> DataFrame:
    """The documents that the classifier accepts; their columns stay."""
    model = train(docs if training is None else training, labels)
    return docs.where(quality_score(F.col("text"), model) >= ACCEPT)
