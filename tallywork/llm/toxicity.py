"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A document is the set of its hashed features: single words, pairs of neighbours, and pairs with one word left out in
between. The features of a bounded sample of labelled rows are hashed in parallel; one task then runs FTRL-proximal over
them, with a rate per coordinate and L1, so that most weights are exactly zero. What remains is a compact table
of non-zero weights that is broadcast for scoring. (Shards that learn apart and are averaged were tried: with 6 of
them half of the toxic documents were missed, as a rare word then has too little evidence in each.)
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallywork.llm.common import arrow_rows, forget, kept_rows, mix, word_hashes

TOKENS = re.compile(r"\w+")


@dataclass(frozen=True)
class Settings:
    """``bits``: log2 of the number of features. ``alpha``, ``beta``: per-coordinate rates. ``l1``, ``l2``: penalties.

    ``bound``: labelled rows used at most (about), which the training task holds as features; ``passes``: over them.
    """

    bits: int = 22
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.1
    passes: int = 4
    bound: int = 16_000
    seed: int = 11


#: Feature 0 is the bias; no other feature is hashed to it.
BIAS = 0


def hashed(text: str | None, bits: int) -> np.ndarray:
    """The features of a whole text, repeats included."""
    words = word_hashes(TOKENS.findall((text or "").lower()))
    size = np.uint64((1 << bits) - 1)
    parts = [mix(words)]
    for kind, gap in ((1, 1), (2, 2)):
        if len(words) > gap:
            parts.append(mix(words[:-gap] * np.uint64(0x9E3779B97F4A7C15 + 2 * kind) + words[gap:]))
    return (np.concatenate(parts) % size + np.uint64(1)).astype(np.int64)


def ftrl(rows: list[np.ndarray], labels: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The features of non-zero weight, sorted, and their weights."""
    size = 1 << settings.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    rates = settings.beta / settings.alpha + settings.l2
    order = np.random.default_rng(settings.seed)

    def weights(at: np.ndarray) -> np.ndarray:
        own = z[at]
        shrunk = np.sign(own) * settings.l1 - own
        return np.where(np.abs(own) <= settings.l1, 0.0, shrunk / (np.sqrt(n[at]) / settings.alpha + rates))

    for _ in range(settings.passes):
        for i in order.permutation(len(rows)):
            at = rows[i]
            w = weights(at)
            error = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - labels[i]
            before = n[at]
            after = before + error * error
            z[at] += error - (np.sqrt(after) - np.sqrt(before)) / settings.alpha * w
            n[at] = after
    final = weights(np.arange(size + 1))
    kept = np.flatnonzero(final)
    return kept, final[kept]


def learn(labelled: DataFrame, settings: Settings = Settings()) -> tuple[np.ndarray, np.ndarray]:
    """Sorted features and their weights, from rows of (text, label, id); empty without rows.

    ``labelled`` must be bounded (``common.label_sample``): one task holds its features.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            ids, texts, labels = (batch.column(i).to_pylist() for i in range(3))
            at = [np.append(BIAS, np.unique(hashed(t, settings.bits))).astype(np.int32).tobytes() for t in texts]
            yield {"id": ids, "label": labels, "features": at}
        forget()

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        rows, labels = [], []
        for batch in batches:
            labels += batch.column(1).to_pylist()
            rows += [np.frombuffer(raw, np.int32) for raw in batch.column(2).to_pylist()]
        if rows:
            at, w = ftrl(rows, np.array(labels, np.float64), settings)
            yield {"feature": at.tolist(), "weight": w.tolist()}
        forget()

    prepared = arrow_rows(labelled.select("id", "text", "label"), sets, "id long, label int, features binary")
    one = prepared.repartition(1).sortWithinPartitions("id", "features")
    found = arrow_rows(one, fit, "feature long, weight double").orderBy("feature").collect()
    return np.array([r.feature for r in found], np.int64), np.array([r.weight for r in found], np.float64)


def scores(texts: list[str | None], features: np.ndarray, weights: np.ndarray, bits: int) -> list[float]:
    """Probability of label 1 for each text."""
    if not len(features):
        return [0.0] * len(texts)
    known = np.zeros(1 << bits, bool)
    known[features] = True
    bias = float(weights[0]) if features[0] == BIAS else 0.0
    out = []
    for text in texts:
        at = hashed(text, bits)
        found = np.unique(at[known[at]])
        total = bias + float(weights[np.searchsorted(features, found)].sum())
        out.append(1.0 / (1.0 + float(np.exp(-np.clip(total, -35.0, 35.0)))))
    return out


@dataclass(frozen=True)
class Model:
    """Non-zero weights by feature, and the threshold from which a text is toxic."""

    features: np.ndarray
    weights: np.ndarray
    bits: int
    threshold: float = 0.3

    def score(self, docs: DataFrame, text: str = "text", keep: str = "doc_id") -> DataFrame:
        """``keep``, score and predicted for each row's whole text; one row per row, null counts as empty."""
        model = docs.sparkSession.sparkContext.broadcast(self)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            own = model.value
            for batch in batches:
                found = scores(batch.column(1).to_pylist(), own.features, own.weights, own.bits)
                predicted = [int(p >= own.threshold) for p in found]
                yield {keep: batch.column(0), "score": found, "predicted": predicted}

        kind = docs.schema[keep].dataType.simpleString()
        return arrow_rows(docs.select(keep, F.col(text)), run, f"`{keep}` {kind}, score double, predicted int")

    def keep_clean(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """The rows that score below the threshold, with all their columns as they are."""
        model, at = docs.sparkSession.sparkContext.broadcast(self), docs.columns.index(text)

        def clean(batch: pa.RecordBatch) -> list[bool]:
            own = model.value
            found = scores(batch.column(at).to_pylist(), own.features, own.weights, own.bits)
            return [p < own.threshold for p in found]

        return kept_rows(docs, clean)


def train(labelled: DataFrame, settings: Settings = Settings(), threshold: float = 0.3) -> Model:
    """A model from (text, label, id) rows."""
    features, weights = learn(labelled, settings)
    return Model(features, weights, settings.bits, threshold)
