"""Text quality by a small convolutional network over bytes, in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it. Each byte has a learned vector; learned filters
slide over the chunk and keep their largest answer. The largest and the mean answers over all chunks of a text go
through one hidden layer into one probability. Training runs in one task over a bounded sample of labelled texts;
scoring runs where the texts are.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallywork.llm.common import arrow_rows


@dataclass(frozen=True)
class Settings:
    """``chunk`` and ``overlap`` in bytes; ``width``: bytes under a filter, which moves by half of it.

    ``rounds``: passes over the texts, and as many more as make ``steps`` steps where there are few of them. ``bound``: labelled
    texts used at most (about); the training task holds them as bytes.
    """

    chunk: int = 512
    overlap: int = 64
    vector: int = 8
    filters: int = 32
    width: int = 16
    hidden: int = 24
    rounds: int = 6
    steps: int = 600
    batch: int = 32
    rate: float = 0.004
    bound: int = 6_000
    seed: int = 5


Parameters = dict[str, np.ndarray]


def chunks_of(text: str | None, settings: Settings) -> np.ndarray:
    """The chunks of a whole text, one per row, filled up with zero bytes; an empty text is one empty chunk."""
    raw = np.frombuffer((text or "").encode("utf-8"), np.uint8)
    move = settings.chunk - settings.overlap
    n = max(1, -(-(len(raw) - settings.overlap) // move))
    padded = np.zeros((n - 1) * move + settings.chunk, np.uint8)
    padded[: len(raw)] = raw
    return np.lib.stride_tricks.as_strided(padded, (n, settings.chunk), (move, 1))


def start(settings: Settings) -> Parameters:
    """Random first parameters."""
    random = np.random.default_rng(settings.seed)
    size = settings.width * settings.vector

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (random.standard_normal(shape) * scale).astype(np.float32)

    vectors = normal(256, settings.vector, scale=0.5)
    vectors[0] = 0  # what chunks are filled up with
    return {
        "vectors": vectors,
        "filters": normal(size, settings.filters, scale=size**-0.5),
        "offsets": np.zeros(settings.filters, np.float32),
        "hidden": normal(2 * settings.filters, settings.hidden, scale=(2 * settings.filters) ** -0.5),
        "hidden_offsets": np.zeros(settings.hidden, np.float32),
        "out": normal(settings.hidden, scale=settings.hidden**-0.5),
        "out_offset": np.zeros(1, np.float32),
    }


def convolve(p: Parameters, chunks: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The largest answer of each filter in each chunk, and the place of its window."""
    n, half = len(chunks), settings.width // 2
    vectors = p["vectors"][chunks]
    answers = []
    for at in (0, half):
        count = (settings.chunk - at) // settings.width
        windows = vectors[:, at : at + count * settings.width].reshape(n * count, -1)
        answers.append((windows @ p["filters"]).reshape(n, count, -1))
    both = np.concatenate(answers, axis=1)
    best = both.argmax(axis=1)
    top = np.take_along_axis(both, best[:, None, :], axis=1)[:, 0] + p["offsets"]
    first = answers[0].shape[1]
    place = np.where(best < first, best * settings.width, (best - first) * settings.width + half)
    return np.maximum(top, 0), place


def _pool(answers: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    mean = np.add.reduceat(answers, starts) / sizes[:, None]
    return np.concatenate([np.maximum.reduceat(answers, starts), mean], axis=1)


def _head(p: Parameters, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.maximum(pooled @ p["hidden"] + p["hidden_offsets"], 0)
    total = hidden @ p["out"] + p["out_offset"]
    return hidden, 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def scores(p: Parameters, texts: list[str | None], settings: Settings, group: int = 768) -> list[float]:
    """Probability of label 1 for each whole text; chunks go through the filters in bounded groups."""
    if not texts:
        return []
    largest = np.zeros((len(texts), settings.filters), np.float32)
    summed = np.zeros((len(texts), settings.filters), np.float64)
    sizes = np.zeros(len(texts), np.int64)

    def flush(parts: list[np.ndarray], owners: list[np.ndarray]) -> None:
        answers, _ = convolve(p, np.concatenate(parts), settings)
        owner = np.concatenate(owners)
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        own = owner[starts]
        largest[own] = np.maximum(largest[own], np.maximum.reduceat(answers, starts))
        summed[own] += np.add.reduceat(answers, starts, dtype=np.float64)

    parts, owners, held = [], [], 0
    for i, text in enumerate(texts):
        chunks = chunks_of(text, settings)
        sizes[i] = len(chunks)
        for at in range(0, len(chunks), group):
            part = chunks[at : at + group]
            parts.append(part)
            owners.append(np.full(len(part), i))
            held += len(part)
            if held >= group:
                flush(parts, owners)
                parts, owners, held = [], [], 0
    if parts:
        flush(parts, owners)
    pooled = np.concatenate([largest, (summed / sizes[:, None]).astype(np.float32)], axis=1)
    return _head(p, pooled)[1].astype(np.float64).tolist()


def gradients(p: Parameters, chunks: np.ndarray, sizes: np.ndarray, labels: np.ndarray, settings: Settings) -> Parameters:
    """Gradients of the mean log loss over some texts; ``sizes`` are their numbers of chunks."""
    starts = np.cumsum(sizes) - sizes
    answers, place = convolve(p, chunks, settings)
    pooled = _pool(answers, starts, sizes)
    hidden, found = _head(p, pooled)
    error = ((found - labels) / len(labels)).astype(np.float32)
    to_hidden = error[:, None] * p["out"] * (hidden > 0)
    to_pooled = to_hidden @ p["hidden"].T
    owner = np.repeat(np.arange(len(sizes)), sizes)
    k = settings.filters
    top = pooled[owner, :k] == answers
    # A largest answer that several chunks share is shared in the gradient too.
    shared = np.add.reduceat(top, starts, dtype=np.float32)
    to_answers = to_pooled[owner, :k] * top / np.maximum(shared, 1)[owner] + (to_pooled[:, k:] / sizes[:, None])[owner]
    to_answers *= answers > 0
    row, column = np.nonzero(to_answers)
    strength = to_answers[row, column]
    bytes_at = chunks[row[:, None], place[row, column][:, None] + np.arange(settings.width)]
    windows = p["vectors"][bytes_at].reshape(len(row), -1)
    to_filters = np.zeros_like(p["filters"].T)
    to_vectors = np.zeros_like(p["vectors"])
    for f in range(k):
        own = column == f
        to_filters[f] = strength[own] @ windows[own]
        # How often each byte stands at each place under the filter, weighted, gives the bytes' gradients.
        weights = p["filters"][:, f].reshape(settings.width, -1)
        for j in range(settings.width):
            counts = np.bincount(bytes_at[own, j], strength[own], 256)
            to_vectors += np.outer(counts, weights[j]).astype(np.float32)
    to_vectors[0] = 0
    return {
        "vectors": to_vectors,
        "filters": to_filters.T,
        "offsets": to_answers.sum(axis=0),
        "hidden": pooled.T @ to_hidden,
        "hidden_offsets": to_hidden.sum(axis=0),
        "out": hidden.T @ error,
        "out_offset": error.sum(keepdims=True),
    }


def fit(texts: list[str | None], labels: np.ndarray, settings: Settings = Settings()) -> Parameters:
    """Parameters after passes of Adam over the texts, in an order that follows from the seed."""
    p = start(settings)
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    random, step = np.random.default_rng(settings.seed), 0
    per_round = -(-len(texts) // settings.batch)
    rounds = max(settings.rounds, -(-settings.steps // max(1, per_round)))
    steps = max(1, rounds * per_round)
    for _ in range(rounds):
        order = random.permutation(len(texts))
        for at in range(0, len(order), settings.batch):
            some = order[at : at + settings.batch]
            parts = [chunks_of(texts[i], settings) for i in some]
            sizes = np.array([len(c) for c in parts])
            found = gradients(p, np.concatenate(parts), sizes, labels[some], settings)
            step += 1
            rate = settings.rate * (1 - step / (steps + 1))
            for k, g in found.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
    return {k: v.astype(np.float32) for k, v in p.items()}


@dataclass(frozen=True)
class Model:
    """A trained network, and the threshold from which a text is good."""

    parameters: Parameters
    settings: Settings
    threshold: float = 0.7

    def score(self, docs: DataFrame, text: str = "text", keep: str = "doc_id") -> DataFrame:
        """``keep``, score and predicted for each row's whole text; one row per row, null counts as empty."""
        model = docs.sparkSession.sparkContext.broadcast(self)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            own = model.value
            for batch in batches:
                found = scores(own.parameters, batch.column(1).to_pylist(), own.settings)
                predicted = [int(s >= own.threshold) for s in found]
                yield {keep: batch.column(0), "score": found, "predicted": predicted}

        kind = docs.schema[keep].dataType.simpleString()
        return arrow_rows(docs.select(keep, F.col(text)), run, f"`{keep}` {kind}, score double, predicted int")


def train(labelled: DataFrame, settings: Settings = Settings(), threshold: float = 0.7) -> Model:
    """A model from (text, label, id) rows, which must be bounded: one task holds their texts.

    Without rows the network keeps its random start, so that scores are still between 0 and 1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        texts: list[str] = []
        labels: list[int] = []
        for batch in batches:
            texts += batch.column(1).to_pylist()
            labels += batch.column(2).to_pylist()
        if texts:
            yield {"parameters": [pickle.dumps(fit(texts, np.array(labels, np.float32), settings))]}

    one = labelled.select("id", "text", "label").repartition(1).sortWithinPartitions("id", "text")
    found = arrow_rows(one, run, "parameters binary").first()
    return Model(pickle.loads(found.parameters) if found else start(settings), settings, threshold)
