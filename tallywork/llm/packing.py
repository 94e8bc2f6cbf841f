"""Best-fit packing of token sequences, planned on a histogram of lengths.

The driver plans over counts: at most as many numbers as there are lengths up to the limit, however many documents there
are. Runs of equal bins are kept as ranges, so placing all pieces of a length takes a few steps. Pieces then take the
planned slots by their rank within their length, which the tasks count and a prefix sum over tasks completes.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallywork.llm.common import arrow_rows, materialise
from tallywork.llm.vocabularies import Recent, Vocabulary, broadcast_file, once

#: White space of the vocabulary's pattern where ``str.split`` would also cut at \x1c-\x1f.
_CONTROLS = re.compile(r"[\x1c-\x1f]")
_BLANKS = re.compile(r"(?:(?![\x1c-\x1f])\s)+")


class _Ids(Recent):
    """Little-endian 32-bit ids of pieces without white space."""

    def __init__(self, vocabulary: Vocabulary, limit: int):
        super().__init__(vocabulary.ids_of, limit)
        self.vocabulary = vocabulary

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, for a vocabulary that drops white space."""
        if self.vocabulary.special(text):
            return self.vocabulary.whole(text)
        if _CONTROLS.search(text):
            return b"".join(self[p] for p in _BLANKS.split(text) if p)
        return b"".join(map(self.__getitem__, text.split()))


def cut(
    docs: DataFrame,
    vocabulary: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end: int = 1,
    size: int = 4096,
    cached: int = 500_000,
) -> DataFrame:
    """Pieces of at most ``size`` tokens: doc_id, piece, start, length, ids (32-bit little-endian) per row.

    A document is its ids and then ``end``. Only documents of more than ``size`` tokens are cut. A null text is empty
    and becomes one piece of one token. Rows are cut one by one: repeated rows and null ids give pieces of their own.
    """
    file = broadcast_file(docs.sparkSession, vocabulary)
    tail, width = np.array([end], "<u4").tobytes(), 4 * size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        ids = once((vocabulary, "ids", cached), lambda: _Ids(Vocabulary(file.value, cached), cached))
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("doc_id", "piece", "start", "length", "ids")}
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = ids.encode(value or "") + tail
                for piece, at in enumerate(range(0, len(raw), width)):
                    part = raw[at : at + width]
                    out["doc_id"].append(key)
                    out["piece"].append(piece)
                    out["start"].append(at // 4)
                    out["length"].append(len(part) // 4)
                    out["ids"].append(part)
            yield out

    kind = docs.schema[doc_id].dataType.simpleString()
    columns = docs.select(F.col(doc_id), F.col(text))
    return arrow_rows(columns, run, f"doc_id {kind}, piece int, start long, length long, ids binary", holds=True)


#: A step of a plan: pieces [rank, rank + count) of a length go to bins from ``bin`` on, ``each`` to a bin, from ``offset``.
STEP = "length, rank, count, bin, each, offset"


def plan(counts: dict[int, int], size: int = 4096) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts by length; the steps, as in ``STEP``.

    The longest go first, each to the fullest bin that still takes it. Bins that are equally full are one range. A
    range at least halves its free room whenever it is used, so the steps are at most about 36 times the lengths.
    """
    steps = []
    free: list[tuple[int, int, int]] = []  # (room left, first bin, number of bins), in order of room
    bins = 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(free, (length, -1, -1))
            if at < len(free):
                room, first, number = free.pop(at)
            else:
                number = -(-left // (size // length))
                room, first, bins = size, bins, bins + number
            each = room // length
            whole = min(number, left // each)
            if whole:
                steps.append((length, rank, whole * each, first, each, size - room))
                rank, left = rank + whole * each, left - whole * each
                _put(free, room - each * length, first, whole)
            if number > whole:
                first, number = first + whole, number - whole
                if left:  # one bin takes what is left, fewer than it could
                    steps.append((length, rank, left, first, left, size - room))
                    _put(free, room - left * length, first, 1)
                    first, number, left = first + 1, number - 1, 0
                _put(free, room, first, number)
    return steps


def _put(free: list, room: int, first: int, number: int) -> None:
    if room and number:
        bisect.insort(free, (room, first, number))


def pack(pieces: DataFrame, size: int = 4096) -> DataFrame:
    """``pieces`` (with a column ``length`` from 1 to ``size``) with sequence_id and offset.

    Every sequence is filled from offset 0 without gaps. Equal lengths are interchangeable, so which of several equal
    or repeated rows takes which slot follows from the order in which tasks read them. No rows give no sequences. ``pieces`` is
    written once to the shared folder; rows of one length, however many, are never gathered.
    """
    names = pieces.columns
    kept = [f.name for f in pieces.schema.fields]
    at = kept.index("length")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in batches:
            lengths = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            own = np.empty(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            grouped = lengths[order]
            first = np.flatnonzero(np.append(True, grouped[1:] != grouped[:-1])) if len(grouped) else []
            run = np.arange(len(grouped)) - np.repeat(first, np.diff(np.append(first, len(grouped)))).astype(np.int64)
            own[order] = run + seen[grouped]
            seen += np.bincount(lengths, minlength=size + 1)
            yield {n: batch.column(i) for i, n in enumerate(names)} | {
                "__task": np.full(len(lengths), task),
                "__rank": own,
            }

    rows = materialise(arrow_rows(pieces, ranked, f"{schema}, __task int, __rank long", holds=True), "pieces")
    per_task = rows.groupBy("length", "__task").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("length").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("length", "__task", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    counts = {r.length: r.n for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    steps = np.array(plan(counts, size), np.int64).reshape(-1, 6)
    # Steps in order of (length, rank), so that a search finds the one a piece belongs to.
    steps = steps[np.lexsort((steps[:, 1], steps[:, 0]))]
    shared = rows.sparkSession.sparkContext.broadcast(steps)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        own = shared.value
        most = np.int64(1) << 48  # more pieces of one length than this cannot be
        keys = own[:, 0] * most + own[:, 1]
        for batch in batches:
            lengths = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column(len(names)).to_numpy(zero_copy_only=False).astype(np.int64)
            step = own[np.searchsorted(keys, lengths * most + rank, side="right") - 1]
            within = rank - step[:, 1]
            yield {n: batch.column(i) for i, n in enumerate(names)} | {
                "sequence_id": step[:, 3] + within // step[:, 4],
                "offset": step[:, 5] + within % step[:, 4] * lengths,
            }

    numbered = rows.join(bases, ["length", "__task"]).select(
        *[F.col(f"`{n}`") for n in names], (F.col("__rank") + F.col("__base")).alias("__global")
    )
    return arrow_rows(numbered, placed, f"{schema}, sequence_id long, offset long", holds=True)


def pack_documents(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", size: int = 4096) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset per piece of each document."""
    pieces = cut(docs, vocabulary, doc_id, text, size=size)
    summed = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(summed, size)
