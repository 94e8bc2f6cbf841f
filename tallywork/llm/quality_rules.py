"""Quality rules on whole texts, with repetition measured by suffix arrays.

The suffixes (in words) of the documents of a chunk are sorted together by prefix doubling, each document apart. The
longest common prefix of neighbouring suffixes is the length of an interval of equal prefixes; the longest repeat that
starts at a word is the larger one of its two neighbours. The union of these spans is the union of all maximal repeated
substrings. Everything is vectorised over the chunk; no document is cut.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallywork.llm.common import WORDS, arrow_rows, kept_rows

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"


@dataclass(frozen=True)
class Limits:
    """What a kept text must satisfy.

    ``least_words`` and ``repeat_percent`` are the base rules: fewer words, or more than this percentage of words in
    3-word windows found twice or more, fail. ``covered`` limits the fraction of words inside repeated substrings of
    at least ``repeat_words`` words, ``longest`` the words of the longest repeated substring.
    """

    least_words: int = 50
    repeat_percent: int = 50
    repeat_words: int = 5
    covered: float = 0.3
    longest: int = 100


def repeats(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """At each word, the length of the longest repeated substring that starts there and stays in its document.

    ``words`` holds the word numbers of all documents one after the other, ``starts`` where each document begins.
    """
    n = len(words)
    longest = np.zeros(n, np.int32)
    if n < 2:
        return longest
    lengths = np.diff(np.append(starts, n))
    doc = np.repeat(np.arange(len(starts), dtype=np.int64), lengths)
    end = np.repeat(starts + lengths, lengths)
    key = doc * (int(words.max()) + 1) + words
    order = np.argsort(key, kind="stable")
    ranks = [_ranks(key[order], order, n)]
    step, active = 1, np.arange(n)
    while True:
        rank = ranks[-1]
        # Ranks are the places of the first member of a group, so a group of one never changes again.
        sizes = np.bincount(rank[active], minlength=n)
        active = active[sizes[rank[active]] > 1]
        if not len(active):
            break
        after = active + step
        follows = np.where(after < end[active], rank[np.minimum(after, n - 1)] + 1, 0).astype(np.int64)
        key = rank[active].astype(np.int64) * (n + 1) + follows
        order = np.argsort(key, kind="stable")
        sorted_key, sorted_old = key[order], rank[active][order]
        place = np.arange(len(active))
        new_start = np.maximum.accumulate(np.where(np.append(True, sorted_key[1:] != sorted_key[:-1]), place, 0))
        old_start = np.maximum.accumulate(np.where(np.append(True, sorted_old[1:] != sorted_old[:-1]), place, 0))
        refined = rank.copy()
        refined[active[order]] = sorted_old + (new_start - old_start)
        ranks.append(refined)
        step *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[ranks[-1]] = np.arange(n)
    # Common prefix of neighbours in suffix order: take the doubled lengths from the longest to the shortest.
    left, right = suffixes[:-1], suffixes[1:]
    pairs = np.flatnonzero(ranks[0][left] == ranks[0][right])
    if not len(pairs):
        return longest
    a, b = left[pairs].copy(), right[pairs].copy()
    common = np.zeros(len(pairs), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        rank = ranks[level]
        inside = (a < end[left[pairs]]) & (b < end[right[pairs]])
        same = inside & (rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)])
        grown = np.where(same, 1 << level, 0)
        a += grown
        b += grown
        common += grown
    np.maximum.at(longest, left[pairs], common)
    np.maximum.at(longest, right[pairs], common)
    return longest


def _ranks(sorted_key: np.ndarray, order: np.ndarray, n: int) -> np.ndarray:
    first = np.append(True, sorted_key[1:] != sorted_key[:-1])
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    return rank


def covered(spans: np.ndarray, least: int) -> np.ndarray:
    """True for each word inside a span of at least ``least`` words; spans[i] is the length of the one from word i."""
    n = len(spans)
    edges = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(spans >= least)
    edges[at] += 1
    np.subtract.at(edges, at + spans[at], 1)
    return np.cumsum(edges[:-1]) > 0


def measure(texts: list[str | None], limits: Limits, chunk: int = 262_144) -> dict[str, list]:
    """The columns of ``judge`` for texts, as lists."""
    out: dict[str, list] = defaultdict(list)
    pending: list[list[str]] = []
    held = 0

    def flush() -> None:
        nonlocal held
        numbers: dict[str, int] = defaultdict(count().__next__)
        sizes = np.array([len(w) for w in pending], np.int64)
        words = np.fromiter((numbers[x] for w in pending for x in w), np.int64, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        spans = repeats(words, starts[sizes > 0])
        triple = covered(np.where(spans >= 3, 3, 0), 3)
        inside = covered(spans, limits.repeat_words)
        for start, size in zip(starts.tolist(), sizes.tolist()):
            own = slice(start, start + size)
            out["n_repeat_words"].append(int(triple[own].sum()))
            out["repeated_words"].append(int(inside[own].sum()))
            out["longest_repeat"].append(int(spans[own].max(initial=0)))
        pending.clear()
        held = 0

    for text in texts:
        value = text or ""
        words = WORDS.findall(value)
        lines = [line for line in value.split("\n") if line.strip(BLANKS)]
        out["n_words"].append(len(words))
        out["word_chars"].append(len(value) - sum(map(value.count, BLANKS)))
        out["n_symbols"].append(sum(map(value.count, SYMBOLS)))
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
        pending.append(words)
        held += len(words)
        if held >= chunk:
            flush()
    flush()
    out["base_failed"] = [
        n < limits.least_words or 100 * r > limits.repeat_percent * n
        for n, r in zip(out["n_words"], out["n_repeat_words"])
    ]
    out["kept"] = [
        not failed and repeated <= limits.covered * n and longest <= limits.longest
        for failed, repeated, n, longest in zip(
            out["base_failed"], out["repeated_words"], out["n_words"], out["longest_repeat"]
        )
    ]
    return out


MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, repeated_words long, longest_repeat long"
)


def judge(docs: DataFrame, text: str = "text", keep: str = "doc_id", limits: Limits = Limits()) -> DataFrame:
    """``keep`` with the measures and the verdict ``kept`` of each row's whole text.

    One row per row, repeated rows included; null counts as a text without words, which the base rules reject.
    ``repeated_words`` are the words inside repeated substrings of ``limits.repeat_words`` words or more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            yield measure(batch.column(1).to_pylist(), limits) | {keep: batch.column(0)}

    kind = docs.schema[keep].dataType.simpleString()
    return arrow_rows(docs.select(keep, F.col(text)), run, f"`{keep}` {kind}, {MEASURES}")


def keep_good(docs: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The rows whose text is kept, with all their columns as they are (whatever they are called)."""
    at = docs.columns.index(text)

    return kept_rows(docs, lambda batch: measure(batch.column(at).to_pylist(), limits)["kept"])
