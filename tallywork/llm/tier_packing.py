"""Packing into windows of several lengths: the largest one and its halves down to ``shortest``, none of them padded.

Documents are cut into full windows of the largest length; what is left of each, its rest, is routed to the shortest tier
that holds it whole. A tier has one window per rest; its gap is filled with the longest whole rests of shorter tiers that fit. The
shortest rests are held back as filler: strung together, they are cut to what the gaps still lack. What filler is left makes
windows of its own, the last few of them ever smaller powers of two. Windows of a tier are dealt evenly to step groups of about
the same number of tokens.

All this is planned on the driver over counts by length (no more of them than the largest window has tokens), never over
documents; rests then find their place by their rank within their length.
"""

from __future__ import annotations

import bisect
import json
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallywork.llm.common import arrow_rows, materialise
from tallywork.llm.vocabularies import Vocabulary, broadcast_file, once

#: Texts of these characters are cut alike by all versions of Unicode, whatever library does it.
_SETTLED = re.compile("[\x00-ɏ‐-‧‰-›]*")


class _Encoder:
    """Ids of whole texts as the ``tokenizers`` library gives them.

    Where a vocabulary's merges are in the order of their ids, ``tiktoken`` gives the same ids in a third of the time. It gets the
    texts without special strings and without characters that are not in every version of Unicode.
    """

    def __init__(self, raw: bytes, pattern: str | None):
        self.vocabulary = Vocabulary(raw, 1)
        self.fast = self._ranked(json.loads(raw), pattern) if pattern else None

    def _ranked(self, spec: dict, pattern: str):
        import tiktoken

        model, steps = spec["model"], json.dumps([spec.get("normalizer"), spec.get("pre_tokenizer")])
        merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model.get("merges", [])]
        known = model["vocab"]
        letters = {letter: byte for byte, letter in self.vocabulary.letters.items()}
        if '"ByteLevel"' not in steps or '"add_prefix_space": true' in steps or spec.get("normalizer"):
            return None
        if any(known.get(m) != 256 + i for i, m in enumerate(merges)):
            return None
        ranks = {bytes(letters[c] for c in token): rank for token, rank in known.items() if rank < 256 + len(merges)}
        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> bytes:
        """Native 32-bit ids."""
        if self.fast is None or self.vocabulary.special(text) or not (text.isascii() or _SETTLED.fullmatch(text)):
            return self.vocabulary.whole(text)
        return array("I", self.fast.encode_ordinary(text)).tobytes()


def cut(
    docs: DataFrame,
    vocabulary: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end: int = 0,
    window: int = 1024,
    pattern: str | None = None,
) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids (32-bit little-endian), task, rank per piece of at most ``window`` tokens.

    A document is its ids and then ``end``; a null text is empty. All pieces of a document but the last are full. ``task`` and
    ``rank`` number the pieces of one length, once the rows are written. ``pattern`` is that of a byte-level vocabulary; with it
    texts are encoded faster, to the same ids.
    """
    file = broadcast_file(docs.sparkSession, vocabulary)
    tail, width = np.array([end], "<u4").tobytes(), 4 * window
    columns = ("doc_id", "start", "length", "doc_tokens", "ids", "rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        from pyspark import TaskContext

        encoder = once((vocabulary, "encoder", pattern), lambda: _Encoder(file.value, pattern))
        task, seen, held = TaskContext.get().partitionId(), [0] * (window + 1), 0
        out: dict[str, list] = {c: [] for c in columns}
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = encoder.ids(value or "") + tail
                for at in range(0, len(raw), width):
                    part = raw[at : at + width]
                    n = len(part) // 4
                    for c, v in zip(columns, (key, at // 4, n, len(raw) // 4, part, seen[n])):
                        out[c].append(v)
                    seen[n] += 1
                held += len(raw)
            if held > 1 << 22:
                yield out | {"task": [task] * len(out["rank"])}
                out, held = {c: [] for c in columns}, 0
        yield out | {"task": [task] * len(out["rank"])}

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, doc_tokens long, ids binary, task int, rank long"
    return arrow_rows(docs.select(F.col(doc_id), F.col(text)), run, schema, holds=True)


@dataclass
class Plan:
    """Where rests go. Windows are numbered from 0.

    ``filler``: rests up to this length are filler. ``steps``: (length, rank, count, first window, each, offset): so many whole
    rests from a rank on, ``each`` to a window. ``gaps``: (start, room, first window, offset): from ``start`` on, the string of filler
    is cut to the rooms of one window after another. ``windows``: (first window, number, length, how many of that length before).
    ``taken``: rests of each length that have a place.
    """

    filler: int
    steps: list[tuple[int, ...]] = field(default_factory=list)
    gaps: list[tuple[int, ...]] = field(default_factory=list)
    windows: list[tuple[int, ...]] = field(default_factory=list)
    taken: dict[int, int] = field(default_factory=dict)


def plan(counts: dict[int, int], window: int = 1024, shortest: int = 64) -> Plan:
    """The plan for so many pieces of each length up to ``window``; its size depends on the lengths, not on the counts.

    Filler is taken from as few tiers as give enough of it to fill all gaps; with all rests as filler there are no gaps.
    """
    tiers = [window]
    while tiers[-1] > shortest:
        tiers.append(tiers[-1] // 2)
    for filler in [0, *tiers[:0:-1], window - 1]:
        found = Plan(filler)
        whole = {n: c for n, c in counts.items() if c and filler < n}
        total = _open(found, whole, tiers)
        supply = sum(n * c for n, c in counts.items() if n <= filler)
        lacking = sum(room * number for room, _, _, number in found.gaps)
        if supply >= lacking:
            break
    at = 0
    gaps = []
    for room, first, offset, number in found.gaps:
        gaps.append((at, room, first, offset))
        at += room * number
    # Filler that no gap takes: windows of the shortest tier that holds such rests, then powers of two.
    size = next(t for t in reversed(tiers) if t >= min(filler, window))
    left = supply - lacking
    while left:
        size = min(size, 1 << (left.bit_length() - 1))
        number = left // size
        gaps.append((at, size, total, 0))
        found.windows.append((total, number, size))
        at, total, left = at + number * size, total + number, left - number * size
    found.gaps = gaps
    before: dict[int, int] = {}
    numbered = []
    for first, number, size in found.windows:
        numbered.append((first, number, size, before.get(size, 0)))
        before[size] = before.get(size, 0) + number
    found.windows = numbered
    return found


def _open(found: Plan, left: dict[int, int], tiers: list[int]) -> int:
    """Plan whole rests: a window for each, tier by tier, and shorter ones in its gap. Returns the number of windows."""
    lengths, total = sorted(left), 0
    for k, tier in enumerate(tiers):
        least, opened = tiers[k + 1] if k + 1 < len(tiers) else 0, total
        while lengths and lengths[-1] > least:
            length = lengths[-1]
            number = left[length]
            rank = _take(left, lengths, length, number, found)
            found.steps.append((length, rank, number, total, 1, 0))
            _fill(found, left, lengths, tier - length, total, number, length)
            total += number
        if total > opened:
            found.windows.append((opened, total - opened, tier))
    return total


def _take(left: dict[int, int], lengths: list[int], length: int, number: int, found: Plan) -> int:
    """Count some rests of a length as placed; the rank of the first of them."""
    rank = found.taken.get(length, 0)
    found.taken[length] = rank + number
    left[length] -= number
    if not left[length]:
        del left[length]
        lengths.remove(length)
    return rank


def _fill(found: Plan, left: dict[int, int], lengths: list[int], room: int, first: int, number: int, offset: int) -> None:
    """Fill the rooms of some equal windows with the longest whole rests that fit; what nothing fits is a gap."""
    todo = [(room, first, number, offset)]
    while todo:
        room, first, number, offset = todo.pop()
        at = bisect.bisect_right(lengths, room)
        if not room:
            continue
        if not at:
            found.gaps.append((room, first, offset, number))
            continue
        length = lengths[at - 1]
        each = min(room // length, left[length])
        whole = min(number, left[length] // each)
        rank = _take(left, lengths, length, whole * each, found)
        found.steps.append((length, rank, whole * each, first, each, offset))
        if number > whole:
            todo.append((room, first + whole, number - whole, offset))
        todo.append((room - each * length, first, whole, offset + each * length))


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end: int = 0,
    window: int = 1024,
    shortest: int = 64,
    step_tokens: int = 65_536,
    pattern: str | None = None,
) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id, offset, window, step_group, step_at per piece.

    Every id of a document, and ``end`` after them, lies in one piece. Each sequence is full: the column ``window`` is its length, a power of two. Sequences of one window are dealt to step groups of about
    ``step_tokens`` tokens that differ by one sequence at most; ordering groups of all windows by ``step_at`` (0 to 1) mixes them evenly.
    Null texts are empty and have one token; repeated rows and null ids are documents of their own; no rows give no pieces.
    Other columns are left alone, whatever their names. Which of several rests of one length goes where follows from the order in
    which tasks read them. Pieces are written once to the shared folder.
    """
    if window & (window - 1) or shortest & (shortest - 1) or not 0 < shortest <= window:
        raise ValueError("window and shortest must be powers of two, shortest not above window")
    rows = materialise(cut(docs, vocabulary, doc_id, text, end, window, pattern), "cut")
    per_task = materialise(rows.groupBy("length", "task").agg(F.count("*").alias("n")), "per_task")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    counts = {r.length: r.n for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    own = plan(counts, window, shortest)
    groups = {}
    for _, number, size, _ in own.windows:
        groups[size] = groups.get(size, 0) + number
    groups = {size: max(1, -(-number * size // step_tokens)) for size, number in groups.items()}
    rests = rows.where(F.col("length") < window).join(bases.where(F.col("length") < window), ["length", "task"])
    rests = rests.select("doc_id", "start", "length", "doc_tokens", "ids", (F.col("rank") + F.col("base")).alias("rank"))
    placed = _placed(rests, own, counts, groups)
    # Full pieces are the first windows of a plan, in order of rank. Their bases are one row per task.
    full = rows.where(F.col("length") == window).join(
        F.broadcast(bases.where(F.col("length") == window).select("task", "base")), "task"
    )
    sequence = F.col("rank") + F.col("base")
    group = F.pmod(sequence, F.lit(groups.get(window, 1)))
    return placed.union(
        full.select(
            "doc_id", "start", "length", "ids", "doc_tokens", sequence.alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
            F.lit(window).alias("window"), group.alias("step_group"), ((group + 0.5) / groups.get(window, 1)).cast("double").alias("step_at"),
        )
    )


def _placed(rows: DataFrame, own: Plan, counts: dict[int, int], groups: dict[int, int]) -> DataFrame:
    """Rests by rank within their length to their windows; filler is cut where the plan says."""
    steps = np.array(sorted(own.steps), np.int64).reshape(-1, 6)
    gaps = np.array(own.gaps, np.int64).reshape(-1, 4)
    windows = np.array(own.windows, np.int64).reshape(-1, 4)
    # Where the filler of each length begins in the string.
    begins, at = {}, 0
    for length in sorted(n for n in counts if n <= own.filler):
        begins[length], at = at, at + length * counts[length]
    shared = rows.sparkSession.sparkContext.broadcast((steps, gaps, windows, groups, begins, own.filler))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        steps, gaps, windows, groups, begins, filler = shared.value
        most = np.int64(1) << 44  # more pieces of one length than this cannot be
        keys, starts = steps[:, 0] * most + steps[:, 1], gaps[:, 0]
        for batch in batches:
            length = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column(5).to_numpy(zero_copy_only=False).astype(np.int64)
            whole = np.flatnonzero(length > filler)
            step = steps[np.searchsorted(keys, length[whole] * most + rank[whole], side="right") - 1]
            within = rank[whole] - step[:, 1]
            yield told(batch.take(pa.array(whole)), step[:, 3] + within // step[:, 4], step[:, 5] + within % step[:, 4] * step[:, 0])
            short = batch.take(pa.array(np.flatnonzero(length <= filler)))
            out: dict[str, list] = {c: [] for c in (*short.schema.names[:5], "sequence", "offset")}
            for key, start, n, tokens, ids, r in zip(*(c.to_pylist() for c in short.columns)):
                at = begins[n] + r * n
                done = 0
                while done < n:
                    k = int(np.searchsorted(starts, at, side="right")) - 1
                    into = at - int(starts[k])
                    room, place = int(gaps[k, 1]), into % int(gaps[k, 1])
                    size = min(n - done, room - place)
                    values = (key, start + done, size, tokens, ids[4 * done : 4 * (done + size)], int(gaps[k, 2]) + into // room, int(gaps[k, 3]) + place)
                    for c, v in zip(out, values):
                        out[c].append(v)
                    done, at = done + size, at + size
            places = [np.array(out.pop(c), np.int64) for c in ("sequence", "offset")]
            pieces = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), short.schema.types)], names=list(out))
            yield told(pieces, *places)

    def told(pieces: pa.RecordBatch, sequence: np.ndarray, offset: np.ndarray) -> dict:
        windows, groups = shared.value[2:4]
        row = windows[np.searchsorted(windows[:, 0], sequence, side="right") - 1]
        number = np.array([groups[s] for s in row[:, 2].tolist()], np.int64)
        group = (row[:, 3] + sequence - row[:, 0]) % number
        return {c: pieces.column(i) for i, c in enumerate(("doc_id", "start", "length", "doc_tokens", "ids"))} | {
            "sequence_id": sequence,
            "offset": offset,
            "window": row[:, 2],
            "step_group": group,
            "step_at": (group + 0.5) / number,
        }

    schema = (
        f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, `offset` long, "
        "`window` int, step_group long, step_at double"
    )
    return arrow_rows(rows, run, schema, holds=True)
