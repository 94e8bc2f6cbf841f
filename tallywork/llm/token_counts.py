"""Token counts by a two-tier lookup in the map tasks.

Tier one is a table of the corpus' frequent pieces and their token counts, found by a pass over all
documents and broadcast; it holds at most ``frequent`` entries however large the corpus is. Tier two is a cache in
each Python worker, which encodes what tier one lacks and forgets everything when it is full. Pieces are never
shuffled: the frequency pass sends a bounded summary per task.

Both tiers only save work. A count is that of the library in every case: byte-level patterns always end a match
before a blank that follows a non-blank, so a text may be cut there and encoded piece by piece. Texts with special
strings are given to the library whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallywork.llm.common import arrow_rows
from tallywork.llm.vocabularies import LONG, Recent, Vocabulary, broadcast_file, once, spaced_pieces


def frequent_pieces(docs: DataFrame, text: str = "text", frequent: int = 32_768, per_task: int = 8_192) -> list[str]:
    """The pieces that occur most often in all documents, by the sums of the tasks' most frequent ones.

    Each task counts all its pieces (dropping single occurrences whenever it holds a million) and reports its
    ``per_task`` highest counts, without long pieces. A piece missed here costs a few encodings more, never a wrong count.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                if value:
                    pieces = spaced_pieces(value)
                    if max(map(len, pieces)) > LONG:
                        pieces = [p for p in pieces if len(p) <= LONG]
                    seen.update(pieces)
            if len(seen) > 1_000_000:
                seen = Counter({k: n for k, n in seen.items() if n > 1})
                if len(seen) > 1_000_000:
                    seen = Counter(dict(seen.most_common(500_000)))
        top = seen.most_common(per_task)
        yield {"piece": [k for k, _ in top], "n": [n for _, n in top]}

    counted = arrow_rows(docs.select(F.col(text)), count, "piece string, n long", holds=True)
    best = counted.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(frequent)
    return [row.piece for row in best.collect()]


class _Lengths(Recent):
    """Token counts of pieces: the broadcast table, which stays, and what the worker has learnt."""

    def __init__(self, first: list[tuple[str, int]], vocabulary: Vocabulary, limit: int):
        super().__init__(lambda piece: len(vocabulary.ids_of(piece)) // 4, limit + 2 * len(first))
        self.first, self.vocabulary = first, vocabulary
        self.update(first)

    def clear(self) -> None:
        super().clear()
        self.update(self.first)


def count_tokens(
    docs: DataFrame,
    vocabulary: str,
    text: str = "text",
    keep: list[str | Column] | None = None,
    limit: int = 1024,
    frequent: int = 32_768,
    cached: int = 800_000,
) -> DataFrame:
    """``keep`` columns with n_bytes (UTF-8), n_tokens and over_limit of each row's whole text.

    ``vocabulary`` is the path of a byte-level ``tokenizers`` file. One row comes out per row that goes in, repeated
    rows included; a null text counts as empty (0 bytes, 0 tokens). Other columns are left alone, whatever their
    names; ``keep`` defaults to doc_id.
    """
    file = broadcast_file(docs.sparkSession, vocabulary)
    own = Vocabulary(file.value, cached)
    table = [(piece, len(own.ids_of(piece)) // 4) for piece in frequent_pieces(docs, text, frequent)]
    shared = docs.sparkSession.sparkContext.broadcast(table)
    kept = [F.col(c) if isinstance(c, str) else c for c in keep or ["doc_id"]]
    rows = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    names = rows.columns[:-1]
    key = (vocabulary, "lengths", cached, frequent, hash(tuple(table)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        lengths = once(key, lambda: _Lengths(shared.value, Vocabulary(file.value, cached), cached))
        for batch in batches:
            texts = batch.column(len(names)).to_pylist()
            tokens = [
                len(lengths.vocabulary.whole(t)) // 4
                if lengths.vocabulary.special(t)
                else sum(map(lengths.__getitem__, spaced_pieces(t)))
                for t in texts
            ]
            yield {name: batch.column(i) for i, name in enumerate(names)} | {
                "n_bytes": [len(t) if t.isascii() else len(t.encode("utf-8")) for t in texts],
                "n_tokens": tokens,
                "over_limit": [n > limit for n in tokens],
            }

    return arrow_rows(rows, count, f"{schema}, n_bytes long, n_tokens long, over_limit boolean", holds=True)
