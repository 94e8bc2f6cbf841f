"""Collocations: phrases of two and three words that occur more often than their parts make likely, per language.

Words get ids in order of frequency, so that the counts of pairs of frequent words crowd into a few tiles of the square of
ids. The tasks cut the square into tiles, low ones with fewer rows, and count each tile's pairs: full tiles by direct address (one
``bincount`` over the tile), sparse ones as sorted coordinates. Tiles then meet their like and are added up, a tile in one task.
Pairs that are frequent enough are ranked by frequency in turn and take the place of the first word: pair id and word
id make the tiles of three words.

Ids by rank are for the most frequent words (pairs) only, at most ``words`` (``pairs``), which are broadcast. All others that are
frequent enough have a hash for an id and are counted as sorted coordinates, dealt by a hash; which words that are is told by a filter of
bounded size, and what it lets through wrongly falls out in the end. Words whose hashes clash are given ids by rank.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from xxhash import xxh64_intdigest

from tallywork.llm.common import arrow_rows, materialise, mix, partitions

#: For the bytes of a text: letters to lower case, marks and line ends that end a piece, tabs as blanks.
_TABLE = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\x0b\x0c\r\t", bytes(range(97, 123)) + b"\n" * 9 + b" ")

#: What stands for the end of a piece and for an empty string among ids.
END, NONE = 1 << 62, (1 << 62) + 1

#: Columns of a tile, and its bits; at most 1 << BITS cells.
COLUMNS, BITS = 2048, 22


@dataclass(frozen=True)
class Settings:
    """``least``: occurrences of a candidate. ``inside``: hundredths of a candidate's occurrences inside a longer one that drop it.

    ``top``: phrases of a language that are returned. ``words``, ``pairs``: ids by rank at most. ``letters``: bytes of a word that
    may have one. ``buffer``: pairs that a task counts at a time. ``bits``: of a filter at most. ``shares``: of a language's phrases that
    are ranked apart first.
    """

    least: int = 10
    inside: int = 50
    top: int = 2000
    words: int = 1 << 17
    pairs: int = 1 << 18
    letters: int = 64
    buffer: int = 3 << 19
    bits: int = 1 << 24
    shares: int = 32


def _edges(rows: int) -> np.ndarray:
    """Where bands of tiles begin: 32 rows at first, then as many as there are before, up to 2048."""
    found = [0, 32]
    while found[-1] < rows:
        found.append(found[-1] + min(found[-1], 2048))
    return np.array(found, np.int64)


class Tiles:
    """The square of ``rows`` left ids and ``columns`` right ids, cut into tiles."""

    def __init__(self, rows: int, columns: int):
        self.edges, self.across = _edges(max(1, rows)), -(-max(1, columns) // COLUMNS)

    def codes(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Tile and cell of each pair of ids, in one number."""
        band = np.searchsorted(self.edges, left, side="right") - 1
        tile = band * self.across + right // COLUMNS
        return tile << BITS | (left - self.edges[band]) * COLUMNS | right % COLUMNS

    def ids(self, tile: int, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Left and right ids of a tile's cells."""
        band, column = divmod(tile, self.across)
        return self.edges[band] + cells // COLUMNS, column * COLUMNS + cells % COLUMNS

    def area(self, tile: int) -> int:
        band = tile // self.across
        return int(self.edges[band + 1] - self.edges[band]) * COLUMNS


def tile_counts(tiles: Tiles, codes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(tile, cells in order, how often each occurs) of some codes; tiles that are full enough by direct address."""
    if not len(codes):
        return
    tile = codes >> BITS
    most = np.bincount(tile)
    area = np.diff(tiles.edges)[np.arange(len(most)) // tiles.across] * COLUMNS
    full = most * 8 >= area
    dense = full[tile]
    inner = codes[dense]
    inner = inner[np.argsort((inner >> BITS).astype(np.uint16 if len(most) < 1 << 16 else np.int64), kind="stable")]
    ends = np.cumsum(most * full)
    for t in np.flatnonzero(full & (most > 0)).tolist():
        counts = np.bincount(inner[ends[t] - most[t] : ends[t]] & ((1 << BITS) - 1), minlength=int(area[t]))
        cells = np.flatnonzero(counts)
        yield t, cells, counts[cells]
    values, counts = np.unique(codes[~dense], return_counts=True)
    if len(values):
        first = np.flatnonzero(np.append(True, values[1:] >> BITS != values[:-1] >> BITS))
        for a, b in zip(first.tolist(), np.append(first[1:], len(values)).tolist()):
            yield int(values[a]) >> BITS, values[a:b] & ((1 << BITS) - 1), counts[a:b]


def _packed(values: np.ndarray) -> bytes:
    """Numbers in four planes of bytes, so that compression finds the zeros."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1).astype(np.int64)


class _Sums:
    """Adds up the counts of one tile: as coordinates while it is sparse, then by direct address."""

    def __init__(self, area: int):
        self.area, self.waiting, self.size, self.dense = area, [], 0, None

    def add(self, cells: np.ndarray, counts: np.ndarray) -> None:
        if self.dense is not None:
            self.dense[cells] += counts
            return
        self.waiting.append((cells, counts))
        self.size += len(cells)
        if self.size * 4 >= self.area:
            dense = np.zeros(self.area, np.int64)
            for own, n in self.waiting:
                dense[own] += n
            self.dense, self.waiting = dense, []

    def found(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Cells with at least so many, and their counts."""
        if self.dense is None:
            cells, at = np.unique(np.concatenate([c for c, _ in self.waiting]), return_inverse=True)
            counts = np.zeros(len(cells), np.int64)
            np.add.at(counts, at, np.concatenate([n for _, n in self.waiting]))
        else:
            cells = np.flatnonzero(self.dense)
            counts = self.dense[cells]
        kept = counts >= least
        return cells[kept], counts[kept]


def word_id(seed: int, word: bytes) -> int:
    """The negative 64-bit hash that stands for a word; ``seed`` is that of its language."""
    return (xxh64_intdigest(word, seed) | 1 << 63) - (1 << 64)


def lang_seed(lang: str) -> int:
    return xxh64_intdigest(lang.encode("utf-8"), 42)


def _hash(lang: str, word: str):
    """``word_id`` in columns."""
    return F.xxhash64(lang, word).bitwiseOR(F.lit(-(1 << 63)))


def _filter(keys: DataFrame, of: str, bits: int) -> np.ndarray:
    """Bits set for the long keys of a table, as 64-bit words; a single full word, which lets all through, if they are too many."""
    count = keys.count()
    if not count:
        return np.zeros(1, np.uint64)
    if 4 * count > bits:
        return np.full(1, np.iinfo(np.uint64).max)
    size = min(bits, max(1 << 12, 1 << (8 * count).bit_length()))
    place = F.pmod(F.col(of), F.lit(size))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    rows = keys.groupBy(F.floor(place / 64).alias("w")).agg(F.bit_or(one).alias("b")).toArrow()
    words = np.zeros(size // 64, np.uint64)
    words[rows["w"].to_numpy()] = rows["b"].to_numpy().view(np.uint64)
    return words


def _told(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys have their bit."""
    place = keys & (64 * len(words) - 1)  # the number of bits is a power of two
    return (words[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A key of a pair of ids, from 0 up."""
    both = mix(left.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix(right.view(np.uint64)))
    return (both >> np.uint64(1)).view(np.int64)


@dataclass
class _Shared:
    """What tasks need to turn words into ids: words (with lang) in order of rank, the filter of those without a rank, clashing words to pass over."""

    name: str
    head: pa.Table
    tail: np.ndarray
    skipped: frozenset


class _Ids(dict):
    """The ids of a language's words; those without one by rank are looked up in the filter each time."""

    def __init__(self, lang: str, first: dict[bytes, int], shared: _Shared):
        super().__init__(first | {b"": NONE, b"\n": END})
        self.lang, self.shared, self.seed = lang, shared, lang_seed(lang)

    def __missing__(self, word: bytes) -> int:
        value = word_id(self.seed, word)
        words = self.shared.tail
        place = value & (64 * len(words) - 1)
        if not int(words[place >> 6]) >> (place & 63) & 1:
            return END
        return END if self.shared.skipped and (self.lang, word.decode("utf-8")) in self.shared.skipped else value


class _Lookup:
    """Ids of all languages' words."""

    def __init__(self, shared: _Shared):
        self.shared, self.others = shared, {}
        heads: dict[str, dict[bytes, int]] = {}
        for k, (lang, word) in enumerate(zip(shared.head["lang"].to_pylist(), shared.head["word"].cast("binary").to_pylist())):
            heads.setdefault(lang, {})[word] = k
        self.heads = {lang: _Ids(lang, first, shared) for lang, first in heads.items()}

    def of(self, lang: str) -> _Ids:
        found = self.heads.get(lang) or self.others.get(lang)
        if found is None:
            if len(self.others) > 256:
                self.others.clear()
            found = self.others[lang] = _Ids(lang, {}, self.shared)
        return found


def _tokens(text: bytes) -> list[bytes]:
    """Words, ends of pieces (as line ends) and empty strings of a text."""
    return text.translate(_TABLE).replace(b"\n", b" \n ").split(b" ")


def _joined(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[tuple[str, bytes]]:
    """(lang, texts of that language joined), some at a time."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            held.setdefault(lang, []).append(text)
            size += len(text) + 1
            if size > most:
                for key, texts in held.items():
                    yield key, b"\n".join(texts)
                held, size = {}, 0
    for key, texts in held.items():
        yield key, b"\n".join(texts)


def count_words(texts: DataFrame, most: int = 3 << 22) -> DataFrame:
    """(lang, word, n) of all words of (lang, text); tasks count first and hand on what they hold at about ``most`` bytes of different words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: dict[str, dict[bytes, int]] = {}
        sums: dict[str, list[np.ndarray]] = {}
        size = 0

        class Numbers(dict):
            def __missing__(self, word: bytes) -> int:
                nonlocal size
                size += len(word) + 32
                value = self[word] = len(self)
                return value

        def told() -> Iterator[dict]:
            nonlocal size
            for lang, numbers in held.items():
                counts = sums[lang]
                words = [w for w in numbers if w not in (b"", b"\n")]
                n = counts[[numbers[w] for w in words]]
                for at in range(0, len(words), 1 << 16):
                    some = words[at : at + (1 << 16)]
                    yield {"lang": [lang] * len(some), "word": some, "n": n[at : at + (1 << 16)]}
            held.clear()
            sums.clear()
            size = 0

        for lang, text in _joined(batches):
            numbers = held.setdefault(lang, Numbers())
            tokens = _tokens(text)
            own = np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens))
            counts = np.bincount(own, minlength=len(numbers))
            before = sums.get(lang)
            if before is not None:
                counts[: len(before)] += before
            sums[lang] = counts
            if size > most:
                yield from told()
        yield from told()

    counted = arrow_rows(texts.select("lang", "text"), run, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _summed(counted: DataFrame, tiles: Tiles, width: int, least: int, decode) -> DataFrame:
    """Tiles and coordinates added up over all tasks: the id columns and n. ``decode(left, right)`` gives the ids of cells."""
    dealt = counted.repartition(partitions(counted.sparkSession), "tile").sortWithinPartitions("tile")
    names = [f"id{k + 1}" for k in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        tile, sums = None, None

        def told() -> Iterator[dict]:
            if sums is None:
                return
            if tile >= 0:
                cells, counts = sums.found(least)
                ids = decode(*tiles.ids(tile, cells)) if len(cells) else None
            else:
                ids, counts = sums.found(least)
            if len(counts):
                yield dict(zip(names, ids)) | {"n": counts}

        for batch in batches:
            for own, cells, counts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if own != tile:
                    yield from told()
                    tile, sums = own, _Sums(tiles.area(own)) if own >= 0 else _Coordinates(width)
                sums.add(np.cumsum(_unpacked(cells)) if own >= 0 else np.frombuffer(cells, "<i8").reshape(width, -1), _unpacked(counts))
        yield from told()

    return arrow_rows(dealt, run, ", ".join(f"{c} long" for c in names) + ", n long")


def added(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different columns of ``values`` in order, and the sums of their counts."""
    order = np.lexsort(values[::-1])
    values, counts = values[:, order], counts[order]
    first = np.flatnonzero(np.append(True, (values[:, 1:] != values[:, :-1]).any(axis=0)))
    return values[:, first], np.add.reduceat(counts, first)


class _Coordinates:
    """Adds up the counts of sorted coordinates, whenever twice as many wait as there are."""

    def __init__(self, width: int):
        self.values, self.counts = np.zeros((width, 0), np.int64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, values: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((values, counts))
        self.size += len(counts)
        if self.size > max(1 << 16, 2 * len(self.counts)):
            self.merge()

    def merge(self) -> None:
        if self.size:
            values = np.concatenate([self.values, *(v for v, _ in self.waiting)], axis=1)
            self.values, self.counts = added(values, np.concatenate([self.counts, *(n for _, n in self.waiting)]))
            self.waiting, self.size = [], 0

    def found(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        self.merge()
        kept = self.counts >= least
        return self.values[:, kept], self.counts[kept]


def _counted(texts: DataFrame, tiles: Tiles, positions, settings: Settings) -> DataFrame:
    """Written (tile, cells, counts): the counts of each tile, by task, and of coordinates in tiles below 0 by a hash.

    ``positions()`` gives (left, right) of the pairs with ids by rank, and the id columns of the others. There are so many tiles of
    coordinates that a task that adds up has some of them.
    """
    dealt = 16 * partitions(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        codes: list[np.ndarray] = []
        rest: list[np.ndarray] = []
        held = 0
        position = positions()

        def told() -> Iterator[dict]:
            nonlocal codes, rest, held
            out: dict[str, list] = {"tile": [], "cells": [], "counts": []}
            size = 0
            for tile, cells, counts in tile_counts(tiles, np.concatenate(codes) if codes else np.zeros(0, np.int64)):
                out["tile"].append(tile)
                out["cells"].append(_packed(np.diff(cells, prepend=0)))
                out["counts"].append(_packed(counts))
                size += len(cells)
                if size > 1 << 20:
                    yield out
                    out, size = {c: [] for c in out}, 0
            yield out
            if rest:
                values = np.concatenate(rest, axis=1)
                values, counts = added(values, np.ones(values.shape[1], np.int64))
                tile = _mixed(values[0], values[1]) % dealt
                order = np.argsort(tile, kind="stable")
                values, counts, tile = values[:, order], counts[order], tile[order]
                ends = np.append(np.flatnonzero(tile[1:] != tile[:-1]) + 1, len(tile))
                starts = np.append(0, ends[:-1])
                yield {
                    "tile": -1 - tile[starts],
                    "cells": [np.ascontiguousarray(values[:, a:b]).astype("<i8").tobytes() for a, b in zip(starts, ends)],
                    "counts": [_packed(counts[a:b]) for a, b in zip(starts, ends)],
                }
            codes, rest, held = [], [], 0

        for lang, text in _joined(batches):
            ids = position.ids(lang, _tokens(text))
            left, right, others = position.pairs(ids)
            codes.append(tiles.codes(left, right))
            held += len(left)
            if others.shape[1]:
                rest.append(others)
                held += others.shape[1]
            if held > settings.buffer:
                yield from told()
        if held:
            yield from told()

    return materialise(arrow_rows(texts.select("lang", "text"), run, "tile long, cells binary, counts binary"), "tiles")


#: A worker keeps the ids of the last table of words only.
_lookups: dict[str, _Lookup] = {}


class _Two:
    """Pairs of neighbouring words."""

    def __init__(self, shared: _Shared):
        if shared.name not in _lookups:
            _lookups.clear()
            _lookups[shared.name] = _Lookup(shared)
        self.lookup = _lookups[shared.name]

    def ids(self, lang: str, tokens: list[bytes]) -> np.ndarray:
        found = np.fromiter(map(self.lookup.of(lang).__getitem__, tokens), np.int64, len(tokens))
        return found[found != NONE]

    def pairs(self, ids: np.ndarray):
        left, right = ids[:-1], ids[1:]
        known = (left != END) & (right != END)
        left, right = left[known], right[known]
        ranked = (left >= 0) & (right >= 0)
        return left[ranked], right[ranked], np.stack([left[~ranked], right[~ranked]])


class _Three(_Two):
    """Triples as pairs of a frequent pair and a word."""

    def __init__(self, shared: _Shared, ranks: np.ndarray, tail: np.ndarray):
        super().__init__(shared)
        self.order = np.argsort(ranks, kind="stable")
        self.ranks, self.tail = ranks[self.order], tail

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ids of pairs by rank; -1: may be frequent, but has none; -2: not frequent."""
        out = np.full(len(left), -2, np.int64)
        known = (left != END) & (right != END)
        out[known & _told(self.tail, _mixed(left, right))] = -1
        near = np.flatnonzero((left >= 0) & (right >= 0) & known)
        if len(self.ranks) and len(near):
            keys = left[near] << 32 | right[near]
            at = np.minimum(np.searchsorted(self.ranks, keys), len(self.ranks) - 1)
            hit = self.ranks[at] == keys
            out[near[hit]] = self.order[at[hit]]
        return out

    def pairs(self, ids: np.ndarray):
        rank = self.rank(ids[:-1], ids[1:])
        at = np.flatnonzero((rank[:-1] > -2) & (rank[1:] > -2))
        ranked = (rank[at] >= 0) & (ids[at + 2] >= 0)
        some, others = at[ranked], at[~ranked]
        return rank[some], ids[some + 2], np.stack([ids[others], ids[others + 1], ids[others + 2]])


def phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", unknown: str = "und", settings: Settings = Settings()
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases.

    Texts are lower-cased (A-Z), cut into pieces at marks and line ends and these into words at blanks and tabs. ``a`` counts a phrase within
    pieces, overlaps included, ``n`` all words of the language. Cut after its first k words a phrase has parts of
    frequency l and r and the score floor(1000000 a a / (l r)); the lowest-scoring cut counts, ties go to the smaller k.
    Phrases that a longer candidate holds are dropped if it has ``inside`` hundredths of their occurrences. Ranks are by score and a
    downwards, then by the phrase's bytes. Null texts are empty, a null language is ``unknown``; repeated rows count each time. Texts
    without words, languages without candidates and empty tables give no rows; other columns are left alone, whatever their
    names. Products are exact for counts below 10^16.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang), F.lit(unknown)).alias("lang"), F.col(text).alias("text")).where(
        "text is not null and text != ''"
    )
    words = materialise(count_words(texts).withColumn("hash", _hash("lang", "word")), "words")
    total = words.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = materialise(words.where(F.col("n") >= settings.least), "frequent")
    # Words whose hashes clash with a frequent one's: these are told apart by rank, or passed over.
    clash = words.groupBy("hash").agg(F.count("*").alias("c"), F.max("n").alias("m"))
    clash = clash.where((F.col("c") > 1) & (F.col("m") >= settings.least)).select("hash")
    clashing = words.join(clash, "hash").select("lang", "word", "n").collect()
    first = (
        frequent.where(F.octet_length("word") <= settings.letters)
        .orderBy(F.desc("n"), "lang", "word").limit(settings.words).select("lang", "word", "hash", "n").toArrow()
    )
    known = set(zip(first["lang"].to_pylist(), first["word"].to_pylist())) if clashing else set()
    more = [r for r in clashing if r.n >= settings.least and (r.lang, r.word) not in known]
    head = pa.table(
        {
            "lang": pa.array(first["lang"].to_pylist() + [r.lang for r in more], pa.string()),
            "word": pa.array(first["word"].to_pylist() + [r.word for r in more], pa.string()),
        }
    )
    ranked = head.append_column("id", pa.array(np.arange(len(head)), pa.int64()))
    ranked = materialise(spark.createDataFrame(ranked) if len(head) else spark.createDataFrame([], "lang string, word string, id long"), "ranked")
    names = frequent.join(ranked, ["lang", "word"], "left")
    names = materialise(
        names.select("lang", "word", "n", F.coalesce("id", "hash").alias("id"), (F.col("id").isNull()).alias("far")), "names"
    )
    tail = _filter(names.where("far").select("id"), "id", settings.bits)
    skipped = frozenset((r.lang, r.word) for r in clashing if r.n < settings.least)
    shared = spark.sparkContext.broadcast(_Shared(uuid.uuid4().hex, head, tail, skipped))
    tiles = Tiles(len(head), len(head))
    two = _counted(texts, tiles, lambda: _Two(shared.value), settings)
    pairs = _summed(two, tiles, 2, settings.least, lambda left, right: (left, right))
    pairs = materialise(pairs, "counted")
    # What the filter let through wrongly is no frequent word, and goes.
    valid = names.where("far").select("id")
    for side in ("id1", "id2"):
        real = pairs.where(F.col(side) >= 0)
        pairs = real.union(pairs.where(F.col(side) < 0).join(valid.withColumnRenamed("id", side), side, "left_semi").select(*pairs.columns))
    pairs = materialise(pairs, "pairs")
    both = (F.col("id1") >= 0) & (F.col("id2") >= 0)
    best = pairs.where(both).orderBy(F.desc("n"), "id1", "id2").limit(settings.pairs).select("id1", "id2").toArrow()
    left, right = best["id1"].to_numpy(), best["id2"].to_numpy()
    ranks = left << 32 | right
    placed = materialise(
        spark.createDataFrame(pa.table({"id1": left, "id2": right, "ranked": np.ones(len(left), np.int32)}))
        if len(left) else spark.createDataFrame([], "id1 long, id2 long, ranked int"), "placed",
    )
    far = pairs.join(placed, ["id1", "id2"], "left").where("ranked is null").select("id1", "id2")

    def mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            yield {"key": _mixed(*(np.ascontiguousarray(batch.column(i).to_numpy(zero_copy_only=False)) for i in range(2)))}

    tail_pairs = _filter(materialise(arrow_rows(far, mixed, "key long"), "far"), "key", settings.bits)
    recursion = spark.sparkContext.broadcast((ranks, tail_pairs))
    tiles = Tiles(len(ranks), len(head))
    three = _counted(texts, tiles, lambda: _Three(shared.value, *recursion.value), settings)

    def decode(pair: np.ndarray, word: np.ndarray) -> tuple:
        own = recursion.value[0][pair]
        return own >> 32, own & 0xFFFFFFFF, word

    triples = materialise(_summed(three, tiles, 3, settings.least, decode), "triples")
    return _best(names, total, pairs, triples, settings)


def _best(names: DataFrame, total: DataFrame, pairs: DataFrame, triples: DataFrame, settings: Settings) -> DataFrame:
    """Candidates with their scores, those inside longer ones dropped, the best of each language."""

    def score(l: str, r: str):
        exact = "decimal(38,0)"
        return F.expr(f"cast(cast(a as {exact}) * a * 1000000 as {exact}) div cast(cast({l} as {exact}) * {r} as {exact})")

    def word(k: int, *more: str) -> DataFrame:
        return names.select(F.col("id").alias(f"id{k}"), F.col("word").alias(f"w{k}"), F.col("n").alias(f"n{k}"), *more)

    # Triples whose pairs are not both known hold a word that only seemed frequent.
    pair = pairs.withColumnRenamed("n", "p")
    full = (
        triples.withColumnRenamed("n", "a")
        .join(pair.withColumnRenamed("p", "p12"), ["id1", "id2"])
        .join(pair.toDF("id2", "id3", "p23"), ["id2", "id3"])
    )
    full = materialise(full, "full")
    longer = full.select("id1", "id2", "a").union(full.select("id2", "id3", "a"))
    longer = longer.groupBy("id1", "id2").agg(F.max("a").alias("longer"))
    kept = pairs.withColumnRenamed("n", "a").join(longer, ["id1", "id2"], "left")
    kept = kept.where(F.coalesce(F.col("longer") * 100 < F.col("a") * settings.inside, F.lit(True)))
    two = kept.join(word(1, "lang"), "id1").join(word(2), "id2").select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("n1").alias("l"), F.col("n2").alias("r"), score("n1", "n2").alias("score")
    )
    three = full.join(word(1, "lang"), "id1").join(word(2).drop("n2"), "id2").join(word(3), "id3")
    three = three.withColumn("s1", score("n1", "p23")).withColumn("s2", score("p12", "n3"))
    later = F.col("s2") < F.col("s1")
    three = three.select(
        "lang",
        F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
        "a",
        F.when(later, F.col("p12")).otherwise(F.col("n1")).alias("l"),
        F.when(later, F.col("n3")).otherwise(F.col("p23")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    order = (F.desc("score"), F.desc("a"), "phrase")
    # The best of each share of a language first, so that a language with very many phrases is not ranked in one task.
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(settings.shares))).orderBy(*order)
    best = two.union(three).withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= settings.top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= settings.top)
    return best.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )
