"""Byte-level BPE over whole corpora: every distinct word goes through the merges once.

Texts are cut into words where the vocabulary's pattern always ends a match: before a blank that follows something else.
A block is what one task reads up to a size in bytes. Its positions stay as numbers of the block's distinct words, the
commonest first; only the distinct words are shuffled, grouped into bundles by a hash, so that all copies of a word in the
corpus meet in one task, which encodes it once. The ids go back to the block, which puts them together by position.
Frequent words cost no more than one row per block, and no group has to fit in memory but a block.

Words and positions come from two readings of the documents, as a copy of the positions would take more disk than
it saves time. A checksum of each block's texts makes the job fail, rather than mix blocks, should the second reading
differ; tables read the same every time.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh3_64_intdigest

from tallywork.llm.common import arrow_rows, partitions
from tallywork.llm.vocabularies import LONG, broadcast_file, once, read_ranks, spaced_pieces

BLOCK = 40 << 20


def _packed(words: list[bytes]) -> bytes:
    """Words with their lengths, compressed."""
    lengths = _numbers(np.fromiter(map(len, words), np.uint32, len(words)))
    return len(lengths).to_bytes(4, "little") + lengths + zstandard.ZstdCompressor(6).compress(b"".join(words))


def _unpacked(raw: bytes) -> list[bytes]:
    n = int.from_bytes(raw[:4], "little")
    ends = np.cumsum(_from_numbers(raw[4 : 4 + n]), dtype=np.int64).tolist()
    joined = zstandard.ZstdDecompressor().decompress(raw[4 + n :])
    return [joined[a:b] for a, b in zip([0, *ends], ends)]


def _numbers(values: np.ndarray) -> bytes:
    """Numbers below 2^32, compressed by bytes of equal weight."""
    if not len(values):
        return b"\0"
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T
    used = max(1, (int(values.max()).bit_length() + 7) // 8)
    return bytes([used]) + zstandard.ZstdCompressor(6).compress(np.ascontiguousarray(planes[:used]).tobytes())


def _from_numbers(raw: bytes) -> np.ndarray:
    used = raw[0]
    if not used:
        return np.zeros(0, np.uint32)
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[1:]), np.uint8)
    planes = np.zeros((4, len(flat) // used), np.uint8)
    planes[:used] = flat.reshape(used, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


#: Rows on their way: ids of a bundle's words (kind 0), which bundle each word is in (1), texts of a block (2).
_ROW = "block long, kind int, first int, keys array<{}>, sizes binary, payload binary, counts binary, check long"


def _blocks(docs: DataFrame, bundles: int, block: int, words: bool) -> DataFrame:
    """The distinct words of each block in bundles (``words``), or its positions."""
    kind = docs.schema.fields[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        task, made = 0, 0
        numbers: dict[str, int] = defaultdict(count().__next__)
        chosen: list[tuple[list, np.ndarray, np.ndarray]] = []
        size, check = 0, 0

        def row(kind: int, first: int, payload: bytes, keys: list | None = None, sizes: bytes | None = None) -> dict:
            return {
                "block": [(task << 32) | made], "kind": [kind], "first": [first], "keys": [keys], "sizes": [sizes],
                "payload": [payload], "counts": [None], "check": [check - (1 << 63)],
            }

        def close() -> Iterator[dict]:
            seen = np.zeros(len(numbers), np.int64)
            for _, _, flat in chosen:
                seen += np.bincount(flat, minlength=len(numbers))
            order = np.argsort(-seen, kind="stable")
            listed = list(numbers)
            ranked = [listed[i].encode("utf-8") for i in order.tolist()]
            own = np.fromiter((zlib.crc32(raw) % bundles for raw in ranked), np.uint32, len(ranked))
            if words:
                groups: dict[int, list[bytes]] = defaultdict(list)
                for raw, bundle in zip(ranked, own.tolist()):
                    groups[bundle].append(raw)
                for bundle, members in groups.items():
                    yield row(0, bundle, _packed(members))
                return
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order))
            yield row(1, 0, _numbers(own))
            for k, (keys, lengths, flat) in enumerate(chosen):
                yield row(2, k, _numbers(rank[flat]), keys, _numbers(lengths))

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            task = batch.column(2)[0].as_py() if keys else task
            done = 0
            while done < len(texts):
                pieces, first = [], done
                while done < len(texts) and size < block:
                    value = texts[done] or ""
                    pieces.append(list(map(numbers.__getitem__, spaced_pieces(value))))
                    check = xxh3_64_intdigest(value, check)
                    size += len(value) + 32
                    done += 1
                lengths = np.fromiter(map(len, pieces), np.uint32, len(pieces))
                flat = np.fromiter((n for p in pieces for n in p), np.uint32, int(lengths.sum()))
                chosen.append((keys[first:done], lengths, flat))
                if size >= block:
                    yield from close()
                    numbers.clear()
                    numbers.default_factory = count().__next__
                    chosen.clear()
                    size, check, made = 0, 0, made + 1
        if chosen:
            yield from close()

    return arrow_rows(docs, run, _ROW.format(kind), holds=True)


def _encoder(ranks: dict[bytes, int], pattern: str):
    import tiktoken

    return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _encoded(bundles: DataFrame, ranks, pattern: str, cached: int) -> DataFrame:
    """Ids and counts in place of each bundle's words; a task sees all copies of a word and encodes it once."""
    key = dict(bundles.dtypes)["keys"].removeprefix("array<").removesuffix(">")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encoder = once(("ranks", hash(ranks.value), pattern), lambda: _encoder(read_ranks(ranks.value), pattern))
        known: dict[bytes, bytes] = {}
        for batch in batches:
            ids, counts = [], []
            for raw in batch.column(5).to_pylist():
                parts = []
                for word in _unpacked(raw):
                    found = known.get(word)
                    if found is None:
                        found = np.array(encoder.encode_ordinary(word.decode("utf-8")), "<u4").tobytes()
                        if len(word) <= LONG:
                            if len(known) >= cached:
                                known.clear()
                            known[word] = found
                    parts.append(found)
                counts.append(_numbers(np.fromiter(map(len, parts), np.uint32, len(parts)) // 4))
                ids.append(_numbers(np.frombuffer(b"".join(parts), "<u4")))
            same = {n: batch.column(i) for i, n in enumerate(("block", "kind", "first", "keys", "sizes"))}
            yield same | {"payload": ids, "counts": counts, "check": batch.column(7)}

    return arrow_rows(bundles, run, _ROW.format(key), holds=True)


def encode(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    doc_id: str = "doc_id",
    text: str = "text",
    block: int = BLOCK,
    cached: int = 500_000,
) -> DataFrame:
    """(doc_id, ids array<int>) of each row's whole text, by the ranks of a rank file and the pattern that splits texts.

    A row comes out for every row, repeated ones included; a null text is empty and has no ids. Special strings are ordinary
    text. Other columns are left out.
    """
    spark = docs.sparkSession
    ranks = broadcast_file(spark, vocabulary)
    n = partitions(spark)
    # Enough bundles for every task to get several, whatever the cluster; a bundle's share of a block is small.
    bundles = max(256, 4 * n)
    # The partition as the reading itself counts it, which is the same where the reading is part of a union.
    source = docs.select(F.col(doc_id), F.col(text), F.spark_partition_id())
    kind = source.schema.fields[0].dataType.simpleString()
    back = _encoded(_blocks(source, bundles, block, words=True).repartition(n, "first"), ranks, pattern, cached)
    # Rows of a block follow one another: its words' ids by bundle, which bundle each word is in, and its texts.
    together = (
        back.unionByName(_blocks(source, bundles, block, words=False))
        .repartition(n, "block")
        .sortWithinPartitions("block", "kind", "first")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        current, parts, table, checks = None, [], None, set()
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)))
            for own, kind, _, keys, sizes, payload, counts, check in rows:
                if own != current:
                    current, parts, checks = own, [], set()
                checks.add(check)
                if len(checks) > 1:
                    raise RuntimeError("the documents read differently the second time")
                if kind == 0:
                    parts.append((payload, counts))
                elif kind == 1:
                    table = _table(parts, _from_numbers(payload))
                    parts = []
                else:
                    yield from _assembled(keys, _from_numbers(sizes), _from_numbers(payload), *table)

    return arrow_rows(together, run, f"doc_id {kind}, ids array<int>", holds=True)


def _table(parts: list[tuple[bytes, bytes]], bundles: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each of a block's words has its ids (starts, ends), and all ids, from the parts in order of bundles."""
    ids = np.concatenate([_from_numbers(i) for i, _ in parts] or [np.zeros(0, np.uint32)]).astype(np.int32)
    sizes = np.concatenate([_from_numbers(c) for _, c in parts] or [np.zeros(0, np.uint32)]).astype(np.int64)
    if len(sizes) != len(bundles):
        raise RuntimeError("words of a block are missing")
    order = np.argsort(bundles, kind="stable")
    total = np.cumsum(sizes)
    starts, ends = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    starts[order], ends[order] = total - sizes, total
    return starts, ends, ids


def _assembled(keys, sizes, positions, starts, ends, ids, most: int = 4_000_000) -> Iterator[dict]:
    """Rows of (doc_id, ids) of some texts of a block, at most about ``most`` words at a time."""
    until = np.cumsum(sizes, dtype=np.int64)
    first = 0
    while first < len(sizes):
        base = int(until[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(until, base + most, side="right")))
        at = positions[base : int(until[last - 1])].astype(np.int64)
        length = ends[at] - starts[at]
        total = np.cumsum(length)
        # Each id's place: the start of its word's ids and then one after the other.
        place = np.arange(int(total[-1]) if len(total) else 0) + np.repeat(starts[at] - (total - length), length)
        edges = np.append(0, total)[until[first:last] - base]
        offsets = np.append(0, edges).astype(np.int32)
        yield {
            "doc_id": keys[first:last],
            "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids[place], pa.int32())),
        }
        first = last


def decode(encoded: DataFrame, vocabulary: str, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """``encoded`` with ``out``, the bytes that each row's ids stand for, joined from the table of token bytes.

    The table has one row per token of the vocabulary and is broadcast. A null list gives null, an id that the
    table lacks an error. A column named ``out`` is replaced.
    """
    ranks = broadcast_file(encoded.sparkSession, vocabulary)
    kept = [f for f in encoded.schema.fields if f.name != out]
    names = [f.name for f in kept]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    at = names.index(ids)

    def table() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        tokens = read_ranks(ranks.value)
        lengths = np.zeros(max(tokens.values()) + 1, np.int64)
        for token, rank in tokens.items():
            lengths[rank] = len(token)
        joined = b"".join(token for token, _ in sorted(tokens.items(), key=lambda x: x[1]))
        return np.frombuffer(joined, np.uint8), np.cumsum(lengths) - lengths, lengths

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        flat, starts, lengths = once(("tokens", hash(ranks.value)), table)
        for batch in batches:
            lists = batch.column(at)
            if isinstance(lists, pa.ChunkedArray):
                lists = lists.combine_chunks()
            offsets = np.asarray(lists.offsets)
            all_ids = lists.values.to_numpy(zero_copy_only=False)
            valid = lists.is_valid().to_numpy(zero_copy_only=False)
            found: list[bytes | None] = []
            for i in range(len(lists)):
                if not valid[i]:
                    found.append(None)
                    continue
                own = all_ids[offsets[i] : offsets[i + 1]]
                if len(own) and (own.min() < 0 or own.max() >= len(lengths) or not lengths[own].all()):
                    raise ValueError("an id is not in the vocabulary")
                length = lengths[own]
                total = np.cumsum(length)
                place = np.arange(int(total[-1]) if len(total) else 0) + np.repeat(starts[own] - (total - length), length)
                found.append(flat[place].tobytes())
            yield {name: batch.column(i) for i, name in enumerate(names)} | {out: found}

    return arrow_rows(encoded.select(*[f"`{n}`" for n in names]), run, f"{schema}, `{out}` binary", holds=True)
