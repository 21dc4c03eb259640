"""Toxicity severity by cumulative-link ordinal regression over sparse word features.

P(severity > k) = logistic(x . w - threshold_k): one weight per word for all thresholds, in
order.  The given labels say toxic or not.  Grades come from them by how often a toxic text
uses marker words, which nearly always stand in toxic texts: few, some or many.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescompass.llm.rule_quality import labelled_sample
from salescompass.llm.storage import stored, unused
from salescompass.llm.words import NOT_ALPHANUMERIC, Words, byte_texts, pieces

SAMPLE = 12_000  # labelled rows that a model is fitted on, those of the smallest hash of doc_id
FEATURE_BITS = 20
PREFIXES = (4, 5, 6, 7)  # bytes
LEAST_TEXTS = 5  # sample texts that must hold a word
ASSOCIATION = 4.0  # standard errors by which a word's toxic share exceeds the sample's
MARKER = 0.8  # toxic share of the texts that hold a marker word
GRADES = 3
PENALTY = 2e-3
TOXIC_FROM = 0.3  # probability of a severity above 0; toxic texts are rare in the sample, so less than one half tells
STEPS = 800


class SeverityModel(NamedTuple):
    features: np.ndarray  # sorted
    weights: np.ndarray
    thresholds: np.ndarray  # ascending; empty if nothing could be learnt

    def above(self, eta: np.ndarray) -> np.ndarray:
        """Texts x thresholds: probability of a severity above each."""
        return _logistic(eta[:, None] - self.thresholds)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _hits(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text and feature of the words, then of the beginnings of longer words, which stand for inflected forms."""
    text = words.text
    yield text, (words.hash >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
    for size in PREFIXES:
        of, hashes = words.prefixes(size)
        yield text[of], (hashes >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def feature_counts(texts: list[bytes | None], known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, feature and count of the distinct features, all or only ``known`` ones; words are lower-cased and hashed."""
    keys = []
    for text, feature in _hits(Words(texts, NOT_ALPHANUMERIC, lower=True)):
        keep = slice(None) if known is None else known[feature]
        keys.append(text[keep] << FEATURE_BITS | feature[keep])
    key, counts = np.unique(np.concatenate(keys), return_counts=True)
    return key >> FEATURE_BITS, key & ((1 << FEATURE_BITS) - 1), counts


def _features(batches):
    for batch in batches:
        texts = byte_texts(batch.column("text"))
        for low, high in pieces(texts):
            text, feature, counts = feature_counts(texts[low:high])
            offsets = pa.array(np.searchsorted(text, np.arange(high - low + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id")[low:high], batch.column("label")[low:high],
                    pa.ListArray.from_arrays(offsets, pa.array(feature, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32())),
                ],
                names=["doc_id", "label", "features", "counts"],
            )


class Sparse(NamedTuple):
    """Texts x features as the places and values that are not zero."""

    text: np.ndarray
    column: np.ndarray
    value: np.ndarray
    shape: tuple[int, int]

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.text, self.value * weights[self.column], minlength=self.shape[0])

    def back(self, per_text: np.ndarray) -> np.ndarray:
        """The transposed matrix times a number for each text."""
        return np.bincount(self.column, self.value * per_text[self.text], minlength=self.shape[1])


def fit_cumulative_link(x: Sparse, grade: np.ndarray, penalty: float = PENALTY, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds for grades 0 … K: accelerated proximal gradient steps on the
    mean negative log-likelihood with an L1 penalty on the weights."""
    (n, d), k = x.shape, int(grade.max())
    share = np.array([(grade > j).mean() for j in range(k)])
    thresholds = -np.log(share / (1 - share))
    weights = np.zeros(d)
    vector = np.ones(d) / max(1, d) ** 0.5
    norm = 0.0
    for _ in range(20):  # largest eigenvalue of x'x / n bounds the curvature
        vector = x.back(x.times(vector)) / n
        norm = np.linalg.norm(vector)
        vector = vector / norm if norm else vector
    step = 1 / (0.5 * norm + 0.5)
    looking, momentum, look_thresholds = weights, 1.0, thresholds
    for _ in range(steps):
        eta = x.times(looking)
        # F(upper threshold - eta) and F(lower threshold - eta); their difference is the likelihood
        upper = np.where(grade < k, _logistic(np.append(look_thresholds, np.inf)[grade] - eta), 1.0)
        lower = np.where(grade > 0, _logistic(np.concatenate([[-np.inf], look_thresholds])[grade] - eta), 0.0)
        slope = (1 - upper - lower) / n  # of the loss by minus eta
        likely = np.maximum(upper - lower, 1e-12) * n
        by_upper, by_lower = upper * (1 - upper) / likely, lower * (1 - lower) / likely
        by_threshold = np.bincount(grade[grade > 0] - 1, by_lower[grade > 0], minlength=k) - np.bincount(grade[grade < k], by_upper[grade < k], minlength=k)
        new = looking - step * x.back(slope)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        # the order is kept by the likelihood; ``maximum`` guards against a long step
        new_thresholds = np.maximum.accumulate(look_thresholds - step * by_threshold + np.arange(k) * 1e-9)
        next_momentum = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        pull = (momentum - 1) / next_momentum
        looking = new + pull * (new - weights)
        look_thresholds = np.maximum.accumulate(new_thresholds + pull * (new_thresholds - thresholds))
        weights, thresholds, momentum = new, new_thresholds, next_momentum
    return weights, thresholds


def _grades(toxic: np.ndarray, markers: np.ndarray) -> np.ndarray:
    """0 for clean texts; toxic ones by thirds of their marker counts.  Grades without texts are closed up."""
    cuts = np.quantile(markers[toxic], np.arange(1, GRADES) / GRADES, method="higher") if toxic.any() else np.zeros(0)
    grade = np.where(toxic, 1 + np.searchsorted(cuts, markers, side="left"), 0)
    return np.unique(grade, return_inverse=True)[1]


def _fit(table: pa.Table) -> pa.Table:
    """The model as rows; the one group holds at most SAMPLE texts."""
    order = np.argsort(table.column("doc_id").to_numpy(), kind="stable")
    table = table.take(pa.array(order))
    toxic = table.column("label").to_numpy() > 0
    features = table.column("features").combine_chunks()
    text = np.repeat(np.arange(len(features)), np.diff(features.offsets.to_numpy()))
    feature, count = features.flatten().to_numpy(), table.column("counts").combine_chunks().flatten().to_numpy()
    names, index = np.unique(feature, return_inverse=True)
    texts = np.bincount(index, minlength=len(names))
    hits = np.bincount(index, toxic[text], minlength=len(names))
    share = toxic.mean()
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) / np.maximum(texts, 1))
    telling = (texts >= LEAST_TEXTS) & (hits / np.maximum(texts, 1) - share >= ASSOCIATION * error)
    empty = pa.table({"feature": pa.array([], pa.int32()), "value": pa.array([], pa.float64())})
    if not telling.any() or share in (0.0, 1.0):
        return empty
    marker = telling & (hits >= MARKER * texts)
    markers = np.bincount(text, count * marker[index], minlength=len(toxic))
    column = np.cumsum(telling) - 1
    use = telling[index]
    place, value = column[index[use]], 1 + np.log(count[use])
    scale = np.sqrt(np.bincount(place, value**2, minlength=int(telling.sum())) / len(toxic))
    x = Sparse(text[use], place, value / scale[place], (len(toxic), len(scale)))
    weights, thresholds = fit_cumulative_link(x, _grades(toxic, markers))
    kept = np.flatnonzero(weights)
    # thresholds go first, as features below zero
    return pa.table({
        "feature": pa.array(np.concatenate([-1 - np.arange(len(thresholds)), names[telling][kept]]), pa.int32()),
        "value": pa.array(np.concatenate([thresholds, (weights / scale)[kept]]), pa.float64()),
    })


def fit_severity(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> SeverityModel:
    """Fit on a bounded sample of labelled rows that are not held out.

    The model is a few numbers per telling word.  Without labels of both classes there are
    no thresholds, and every text has severity 0.
    """
    rows = labelled_sample(docs, labels, label, sample).mapInArrow(_features, "doc_id long, label double, features array<int>, counts array<int>")
    model = stored(rows, "toxic-sample").groupBy().applyInArrow(_fit, "feature int, value double").toArrow()
    feature, value = (model.column(i).to_numpy() for i in range(2))
    is_threshold = feature < 0
    words = np.argsort(feature[~is_threshold])
    return SeverityModel(
        feature[~is_threshold][words].astype(np.int64), value[~is_threshold][words],
        value[is_threshold][np.argsort(-feature[is_threshold])],
    )


def severity(text: Column, model: SeverityModel) -> Column:
    """Struct of ``severity`` (expected grade), ``toxic`` (a severity above 0 has at least the
    probability TOXIC_FROM) and ``grade`` (the median, 1 at least if toxic)."""

    @F.arrow_udf("struct<severity:double,grade:int,toxic:boolean>")
    def grade(column: pa.Array) -> pa.Array:
        texts = byte_texts(column)
        known = np.zeros(1 << FEATURE_BITS, bool)
        known[model.features] = True
        eta = np.zeros(len(texts))
        for low, high in pieces(texts):
            of, feature, counts = feature_counts(texts[low:high], known)
            if len(of):
                weight = model.weights[np.searchsorted(model.features, feature)]
                eta[low:high] = np.bincount(of, weight * (1 + np.log(counts)), minlength=high - low)
        above = model.above(eta)
        toxic = (above[:, :1] >= TOXIC_FROM).any(axis=1)
        level = np.maximum((above >= 0.5).sum(axis=1), toxic)
        return pa.StructArray.from_arrays(
            [pa.array(above.sum(axis=1), pa.float64()), pa.array(level, pa.int32()), pa.array(toxic)], ["severity", "grade", "toxic"]
        )

    return grade(text)


def graded(docs: DataFrame, model: SeverityModel) -> DataFrame:
    """Adds ``severity``, ``grade`` and ``toxic`` to every row; input columns of these names are replaced.

    Null and empty texts have no words and the severity of a text without telling words.
    """
    out = docs.drop("severity", "grade", "toxic")
    at = unused("_grade", out)
    return out.withColumn(at, severity(F.col("text"), model)).select("*", f"{at}.severity", f"{at}.grade", f"{at}.toxic").drop(at)
