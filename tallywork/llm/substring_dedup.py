"""Passages that repeat across documents, found as near paragraphs and by their words, and removed from all but one document.

First come paragraphs: lines, lines of few words taken together, and blocks between blank lines. Bands of MinHash minima (``bands`` says
how many reach the recall asked for) bring near ones together; those that collide are verified by the exact Jaccard similarity of
their five-word shingles and form components. A component stays in the document of the smallest id and goes from the others.

Then come passages that paragraphs leave, those inside lines or wrapped otherwise. Seeds are windows of words whose hash is the
lowest of some ``around + 1`` neighbouring windows, whatever the lines: two texts that share ``least`` words in a row
always share a seed inside them. Seeds in what the paragraphs have removed already do not count. Neighbouring seeds that lie alike in the document that
keeps them are one stretch.

From the ends of paragraphs and stretches the texts are compared outwards with the document that keeps them, up to where they
differ. What is marked so goes if it makes a run of at least ``least`` words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh3_64_intdigest

from tallywork.llm.cells import Groups, search_cells
from tallywork.llm.common import arrow_rows, drop, materialise, mix, shingle_hashes, thinned, word_hashes
from tallywork.llm.components import connected_components

#: Bytes between words, as ``bytes.split`` cuts.
_BLANK = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))


@dataclass(frozen=True)
class Settings:
    """``width``: words of a shingle. ``similar``: least Jaccard similarity. ``recall``: of a pair just that similar.

    ``rows``: minima that must agree in a band. ``around``: neighbours of which a seed is the lowest. ``least``: words of a run
    that is removed.
    """

    width: int = 5
    similar: float = 0.8
    recall: float = 0.98
    rows: int = 2
    around: int = 10
    least: int = 16

    @property
    def bands(self) -> int:
        """Bands such that a pair of similarity ``similar`` collides with probability ``recall``."""
        return max(1, math.ceil(math.log(1 - self.recall) / math.log(1 - self.similar**self.rows)))

    @property
    def seed(self) -> int:
        """Words of a seed; with ``around`` neighbours they are ``least`` words."""
        return max(self.width, self.least - self.around)


def paragraphs(lines: list[int], width: int) -> list[tuple[int, int]]:
    """(first word, word after the last) of the paragraphs of ``width`` words or more, from the words of each line."""
    after, n = [], 0  # words before each line end, and in all
    for own in lines:
        n += own
        after.append(n)
    after.pop()
    found = set()
    blocks = [0, *sorted({b for a, b in zip(after, after[1:]) if a == b}), n]
    found.update(zip(blocks, blocks[1:]))
    start = before = 0
    for end in [*sorted(set(after)), n]:
        if end - before >= width:  # short lines before a long one do not join it
            found.update([(before, end), (start, before)])
            start = end
        elif end - start >= width:
            found.add((start, end))
            start = end
        before = end
    return sorted((a, b) for a, b in found if b - a >= width)


def lowest(values: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """The lowest of every ``width`` neighbours, by windows of doubling width."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = pick(out[:-step], out[step:])
        done += step
    return out


@dataclass
class Banded:
    """Some texts' words, one after the other, their paragraphs with keys and signatures, and their seeds with keys.

    ``words_at``, ``spans_at``, ``seeds_at``: where those of each text begin, and the end. Spans and seeds count words from the
    beginning of their text.
    """

    words: np.ndarray
    words_at: np.ndarray
    shingles: np.ndarray
    spans: np.ndarray
    spans_at: np.ndarray
    keys: np.ndarray
    sigs: np.ndarray
    seeds: np.ndarray
    seeds_at: np.ndarray
    seed_keys: np.ndarray


def banded(texts: list[bytes | None], settings: Settings) -> Banded:
    """The paragraphs and seeds of whole texts (as UTF-8), hashed together."""
    spans, spans_at, words_at, listed = [], [0], [0], []
    for text in texts:
        lines = [line.split() for line in (text or b"").split(b"\n")]
        spans += paragraphs([len(line) for line in lines], settings.width)
        spans_at.append(len(spans))
        for line in lines:
            listed += line
        words_at.append(len(listed))
    words = word_hashes(listed)
    words_at, spans_at = np.array(words_at, np.int64), np.array(spans_at, np.int64)
    spans = np.array(spans, np.int64).reshape(-1, 2)
    shingles = shingle_hashes(words, settings.width)
    keys = np.zeros((len(spans), settings.bands), np.uint64)
    sigs = np.zeros((len(spans), 2), np.uint64)
    if len(spans):
        # Of the ranges between edges, every other one is a paragraph's. None reaches into the next text.
        first = np.repeat(words_at[:-1], np.diff(spans_at))[:, None]
        edges = (spans + first - np.array([0, settings.width - 1])).reshape(-1)
        last = np.iinfo(np.uint64).max
        for band in range(settings.bands):
            for row in range(settings.rows):
                salt = mix(np.array([band * settings.rows + row + 1], np.uint64))
                lows = np.minimum.reduceat(np.append(mix(shingles ^ salt), last), edges)[::2]
                keys[:, band] = mix(keys[:, band] + lows + np.uint64(band))
        for k in range(2):
            sums = np.add.reduceat(np.append(mix(shingles + np.uint64(k + 77)), np.uint64(0)), edges)[::2]
            sigs[:, k] = mix(sums + np.uint64(k))
    seeds, seeds_at, seed_keys = _seeds(words, words_at, settings)
    return Banded(words, words_at, shingles, spans, spans_at, keys, sigs, seeds, seeds_at, seed_keys)


def _seeds(words: np.ndarray, words_at: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where seeds begin, where those of each text begin, and their keys. Texts of fewer than ``least`` words have none."""
    found = mix(shingle_hashes(words, settings.seed) ^ np.uint64(0x5EED))
    windows = settings.least - settings.seed + 1
    lows = lowest(found, windows) if len(found) >= windows else np.zeros(0, np.uint64)
    # Windows of one text only; the lowest of others is set to what no seed equals.
    text = np.repeat(np.arange(len(words_at) - 1), np.diff(words_at))
    if len(lows):
        lows = np.where(text[: len(lows)] == text[len(words) - len(lows) :], lows, np.uint64(0))
    edge = np.zeros(windows - 1, np.uint64)
    highest = lowest(np.concatenate([edge, lows, edge]), windows, np.maximum) if len(lows) else found[:0]
    at = np.flatnonzero((found[: len(highest)] == highest) & (highest > 0))
    if len(at):
        # Of equal seeds in a row, as repeated words make them, some are enough: no window of neighbours is left without one.
        new = np.append(True, (found[at[1:]] != found[at[:-1]]) | (at[1:] - at[:-1] >= windows) | (text[at[1:]] != text[at[:-1]]))
        share = (at - at[np.flatnonzero(new)[np.cumsum(new) - 1]]) // max(1, (windows + 1) // 2)
        at = at[new | np.append(True, share[1:] != share[:-1])]
    seeds_at = np.searchsorted(at, words_at)
    return at - words_at[text[at]], seeds_at, found[at]


def overlaps(sets: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """How many members each two of some sets have in common: products of blocks of the table of sets and members."""
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[order]
    member = np.cumsum(np.append(False, np.diff(flat[order]) != 0))
    # Members of one set only are in no overlap.
    shared = np.bincount(member)[member] > 1
    owner, member = owner[shared], member[shared]
    member = np.cumsum(np.append(False, np.diff(member) != 0)) if len(member) else member
    out = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(member[-1]) + 1 if len(member) else 0, columns):
        first, end = np.searchsorted(member, [at, at + columns])
        block = np.zeros((len(sets), columns), np.float32)
        block[owner[first:end], member[first:end] - at] = 1
        out += block @ block.T
    return out


def exact_jaccard(settings: Settings, names: list[bytes], sides: list[int], sets: list[np.ndarray]) -> Iterator[tuple[bytes, bytes]]:
    """Links of a cell that join groups not linked yet, by the sizes of sets and of what they have in common."""
    sizes = np.array([len(s) for s in sets])
    total = sizes[:, None] + sizes
    if len(names) > 2:
        both = overlaps(sets)
    else:
        both = np.full(total.shape, len(np.intersect1d(sets[0], sets[-1], assume_unique=True)))
    near = np.tril(both >= settings.similar * (total - both), -1)
    side = np.array(sides)
    if side.any():
        near &= side[:, None] != side
    groups = Groups(len(names))
    for x, y in np.argwhere(near).tolist():
        if groups.root(x) != groups.root(y):
            groups.join(x, y)
            yield names[x], names[y]


def _marked(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, doc_id, text): ``doc`` stands for the id and the text together."""
    return docs.select(
        F.xxhash64(F.col(doc_id), F.col(text)).alias("doc"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text")
    )


def _some(batch: pa.RecordBatch, text: int, letters: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list]]:
    """A batch in slices of about so many bytes, with their texts as UTF-8."""
    texts = batch.column(text).cast(pa.binary()).to_pylist()
    first = size = 0
    for k, value in enumerate(texts):
        size += len(value or "")
        if size >= letters or k + 1 == len(texts):
            yield batch.slice(first, k + 1 - first), texts[first : k + 1]
            first, size = k + 1, 0


def _lists(values: np.ndarray | pa.Array, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values) if isinstance(values, np.ndarray) else values)


def _plain(column: pa.Array) -> list:
    """What ``to_pylist`` gives, by way of flat columns: lists of structs take far less time so."""
    kind = column.type
    if not column.null_count:
        if pa.types.is_integer(kind):
            return column.to_numpy(zero_copy_only=False).tolist()
        if pa.types.is_list(kind):
            values, ends = _plain(column.flatten()), np.cumsum(column.value_lengths().to_numpy()).tolist()
            return [values[a:b] for a, b in zip([0, *ends], ends)]
        if pa.types.is_struct(kind):
            names = [f.name for f in kind]
            return [dict(zip(names, row)) for row in zip(*map(_plain, column.flatten()))]
    return column.to_pylist()


def _parts(source: DataFrame, settings: Settings) -> DataFrame:
    """A written row per document: its paragraphs and seeds, with their keys."""
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for some, texts in _some(batch, 2):
                b = banded(texts, settings)
                yield {
                    "doc": some.column(0),
                    "doc_id": some.column(1),
                    "start": _lists(b.spans[:, 0].astype(np.int32), b.spans_at),
                    "end": _lists(b.spans[:, 1].astype(np.int32), b.spans_at),
                    "sig1": _lists(b.sigs[:, 0].view(np.int64), b.spans_at),
                    "sig2": _lists(b.sigs[:, 1].view(np.int64), b.spans_at),
                    "keys": _lists(_lists(b.keys.reshape(-1).view(np.int64), np.arange(len(b.keys) + 1) * settings.bands), b.spans_at),
                    "seeds": _lists(b.seeds.astype(np.int32), b.seeds_at),
                    "seed_keys": _lists(b.seed_keys.view(np.int64), b.seeds_at),
                }

    schema = (
        f"doc long, doc_id {kind}, start array<int>, `end` array<int>, sig1 array<long>, sig2 array<long>, keys array<array<long>>, "
        "seeds array<int>, seed_keys array<long>"
    )
    return materialise(arrow_rows(source, run, schema), "parts")


def _shared(pairs: DataFrame, label: str) -> DataFrame:
    """The written keys that several documents have."""
    met = pairs.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high")
    return materialise(met.select("key"), label)


def _rank():
    """Ids first, then rows without one; equal ids by their texts' hashes."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("doc").alias("doc"))


def _marks(placed: DataFrame) -> DataFrame:
    """What documents share, from written (root, doc, doc_id, start, end).

    (doc, start, end, removed, keeper, component_id, n_docs) and where the same begins and ends in a partner: the
    document that keeps it or, for that one, the last that holds it. A document shows its first occurrence.
    """
    shown = placed.groupBy("root", "doc").agg(F.min(F.struct(_rank().alias("rank"), "start", "end")).alias("s"))
    held = shown.groupBy("root").agg(F.min("s").alias("first"), F.max("s").alias("last"), F.count("*").alias("n_docs"))
    joined = placed.join(materialise(held.where("n_docs > 1"), "held"), "root")
    removed = F.col("doc") != F.col("first.rank.doc")
    partner = F.when(removed, F.col("first")).otherwise(F.col("last"))
    return joined.select(
        "doc",
        "start",
        "end",
        removed.alias("removed"),
        F.col("first.rank.doc").alias("keeper"),
        F.col("first.rank.id").alias("component_id"),
        "n_docs",
        partner["rank"]["doc"].alias("partner"),
        partner["start"].alias("p_start"),
        partner["end"].alias("p_end"),
    )


def _paragraph_marks(source: DataFrame, parts: DataFrame, settings: Settings) -> DataFrame:
    """Marks of paragraphs that several documents hold, alike or nearly."""
    shared = _shared(parts.select("doc", F.explode(F.flatten("keys")).alias("key")), "shared")
    each = parts.select("doc", "doc_id", F.explode(F.arrays_zip("start", "end", "sig1", "sig2", "keys")).alias("p"))
    keyed = each.select("doc", "doc_id", "p.start", "p.end", "p.sig1", "p.sig2", F.explode("p.keys").alias("key"))
    sig = F.unhex(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in ("sig1", "sig2")]))
    hits = thinned(keyed, "key", shared, "key").join(shared, "key").select("key", "doc", "doc_id", "start", "end", sig.alias("sig"))
    hits = materialise(hits, "hits")
    # Equal paragraphs need no comparison; keys of several different ones do, and of keys that bring the same ones together, one.
    # One document shows each different paragraph.
    shown = hits.groupBy("key", "sig").agg(F.min(F.struct("doc", "start", "end")).alias("r"))
    both = [F.bit_xor(F.xxhash64("sig", F.lit(k))).alias(f"h{k}") for k in range(2)]
    groups = shown.groupBy("key").agg(F.count("*").alias("n"), *both).where("n > 1")
    groups = materialise(groups.groupBy("n", "h0", "h1").agg(F.min("key").alias("key")).select("key", "n"), "groups")
    met = materialise(shown.join(groups, "key"), "met")
    shows = met.groupBy("sig").agg(F.min("r").alias("r")).select("sig", "r.*")
    shows = materialise(shows.groupBy("doc").agg(F.collect_list(F.struct("sig", "start", "end")).alias("shown")), "shows")
    texts = thinned(source, "doc", shows, "doc").dropDuplicates(["doc"]).join(shows, "doc").select("text", "shown")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            out: dict[str, list] = {"sig": [], "size": [], "set": []}
            for value, shown in zip(batch.column(0).cast(pa.binary()).to_pylist(), _plain(batch.column(1))):
                windows = shingle_hashes(word_hashes(value.split()), settings.width)
                for s in shown:
                    own = np.unique(windows[s["start"] : s["end"] - settings.width + 1])
                    out["sig"].append(s["sig"])
                    out["size"].append(len(own))
                    out["set"].append(own.tobytes())
            yield out

    found = materialise(arrow_rows(texts, sets, "sig binary, size int, set binary"), "paragraphs")
    # Two similar sets are in the same range of sizes or in neighbouring ones, so in a large group sets of very different sizes
    # need not meet.
    size = F.floor(F.log("size") / F.lit(-math.log(settings.similar))).cast("long")
    ranges = F.when(F.col("n") > 96, F.array(size, size + 1)).otherwise(F.array(F.lit(-1).cast("long")))
    ranged = met.select("key", "sig", "n").join(found.select("sig", "size"), "sig").select("key", "sig", "size", F.explode(ranges).alias("range"))
    placed = materialise(ranged.select(F.xxhash64("key", "range").alias("cluster"), "sig", "size"), "clusters")
    sizes = placed.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("size").alias("w"))
    members = placed.select("cluster", "sig").join(found.select("sig", "set"), "sig").withColumnRenamed("sig", "item")
    links = materialise(search_cells(members, lambda *cell: exact_jaccard(settings, *cell), sizes=sizes), "links")
    drop(found, met, shows)
    roots = connected_components(links).select(F.col("node").alias("sig"), F.col("component").alias("root"))
    once = hits.groupBy("doc", "start", "end").agg(F.first("doc_id").alias("doc_id"), F.first("sig").alias("sig"))
    placed = once.join(materialise(roots, "roots"), "sig", "left").select(
        F.coalesce("root", "sig").alias("root"), "doc", "doc_id", "start", "end"
    )
    placed = materialise(placed, "placed")
    marks = materialise(_marks(placed), "paragraph-marks")
    drop(hits, shared, placed)
    return marks


def _gone(marks: DataFrame, settings: Settings) -> DataFrame:
    """(doc, gone): what the marks of paragraphs remove from each document, as ranges of words."""
    per_doc = marks.groupBy("doc").agg(
        F.sort_array(F.collect_set(F.struct("start", "end", "removed", "keeper", "n_docs"))).alias("found")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            out: dict[str, list] = {"doc": [], "gone": []}
            for doc, found in zip(*(_plain(batch.column(i)) for i in range(2))):
                gone = [{"first": r["start"], "end": r["end"]} for r in _runs(found, settings) if r["removed"]]
                if gone:
                    out["doc"].append(doc)
                    out["gone"].append(gone)
            yield out

    return materialise(arrow_rows(per_doc, run, "doc long, gone array<struct<first: int, `end`: int>>"), "gone")


def _seed_marks(parts: DataFrame, gone: DataFrame, settings: Settings) -> DataFrame:
    """Marks of seeds that several documents hold where the paragraphs left them."""
    seeds = parts.select("doc", "doc_id", F.explode(F.arrays_zip("seed_keys", "seeds")).alias("s"))
    seeds = seeds.select("doc", "doc_id", F.col("s.seed_keys").alias("key"), F.col("s.seeds").alias("start"))
    shared = _shared(seeds.select("key", "doc"), "shared-seeds")
    hits = thinned(seeds, "key", shared, "key").join(shared, "key").join(gone, "doc", "left")
    end = F.col("start") + settings.seed
    # A seed of which a word is gone is not held any more.
    touched = F.exists("gone", lambda g: (g["first"] < end) & (g["end"] > F.col("start")))
    placed = hits.where(~F.coalesce(touched, F.lit(False))).select(
        F.col("key").alias("root"), "doc", "doc_id", "start", end.alias("end")
    )
    placed = materialise(placed, "placed-seeds")
    marks = materialise(_marks(placed), "seed-marks")
    drop(shared, placed)
    return marks


def _chained(found: list[dict]) -> Iterator[dict]:
    """Marks of a document, in order, with those that follow each other here taken together, if one partner has them all.

    A stretch begins where its first mark does and ends where its last one does, here and in the partner. Marks that lie in the partner
    otherwise than the one before, as repeated words do, must touch it; else a word between them may differ. Of their numbers of documents
    the largest is kept.
    """
    open_: dict[tuple, dict] = {}
    for mark in found:
        side = (mark["partner"], mark["removed"], mark["keeper"])
        last = open_.get(side)
        if last is not None and mark["start"] <= last["end"] + (mark["p_end"] - mark["end"] == last["p_end"] - last["end"]):
            if mark["end"] > last["end"]:
                last["end"], last["p_end"] = mark["end"], mark["p_end"]
            last["n_docs"] = max(last["n_docs"], mark["n_docs"])
            continue
        if last is not None:
            yield last
        open_[side] = dict(mark)
    yield from open_.values()


def _stretches(marks: DataFrame) -> DataFrame:
    """The marks of each document with neighbours taken together."""
    names = [c for c in marks.columns if c != "doc"]
    per_doc = marks.groupBy("doc").agg(F.sort_array(F.collect_set(F.struct(*names))).alias("found"))
    kinds = {f.name: f.dataType.simpleString() for f in marks.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in marks_columns}
            for doc, found in zip(*(_plain(batch.column(i)) for i in range(2))):
                for own in _chained(found):
                    for c in names:
                        out[c].append(own[c])
                    out["doc"].append(doc)
            yield out

    marks_columns = list(marks.columns)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in marks_columns)
    return materialise(arrow_rows(per_doc, run, schema), "stretches")


def _partners(source: DataFrame, stretches: DataFrame, gone: DataFrame, settings: Settings) -> DataFrame:
    """(partner, place, before, after): words around the places of partners that stretches ask for, up to what is gone from them."""
    asked = stretches.select("partner", F.explode(F.array("p_start", "p_end")).alias("place"))
    asked = asked.groupBy(F.col("partner").alias("doc")).agg(F.collect_set("place").alias("places"))
    asked = materialise(asked.join(gone, "doc", "left"), "asked")
    texts = thinned(source, "doc", asked, "doc").dropDuplicates(["doc"]).join(asked, "doc").select("doc", "text", "places", "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            partner, place, before, after = [], [], [], []
            before_at, after_at = [0], [0]
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for doc, value, places, lost in zip(batch.column(0).to_pylist(), texts, *(_plain(batch.column(i)) for i in (2, 3))):
                words = value.split()
                ends = np.array([0, *(g["end"] for g in lost or [])])
                firsts = np.array([*(g["first"] for g in lost or []), len(words)])
                at = np.array(places)
                first = np.maximum(at - settings.around, ends[np.searchsorted(ends, at, side="right") - 1])
                end = np.minimum(at + settings.around, firsts[np.searchsorted(firsts, np.minimum(at, len(words)))])
                for own, a, b in zip(places, first.tolist(), end.tolist()):
                    before += words[a:own][::-1]
                    before_at.append(len(before))
                    after += words[own:b]
                    after_at.append(len(after))
                partner += [doc] * len(places)
                place += places
            yield {
                "partner": partner,
                "place": place,
                "before": _lists(word_hashes(before).view(np.int64), np.array(before_at)),
                "after": _lists(word_hashes(after).view(np.int64), np.array(after_at)),
            }

    return materialise(arrow_rows(texts, run, "partner long, place int, before array<long>, after array<long>"), "around")


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """A row per run of repeated words of one fate in a document.

    Columns: doc (a hash of id and text), doc_id, start and end (in characters; the end is where the next word begins),
    n_words, component_id, n_docs and removed. n_docs are the documents that hold the paragraph or seed at the run's first word (of
    several the one that most hold; seeds are counted where paragraphs left them), component_id is the smallest doc_id of these.
    A passage counts as repeated where at least two documents hold it; repeats inside one document are left alone. Rows
    of the same id and text are one document and have their spans once. Null and empty texts have none, an empty table gives no rows. Rows
    without an id take part, but come after all others when the one to keep is chosen. Other columns are left alone, whatever their names.
    """
    source = _marked(docs, doc_id, text)
    kind = source.schema["doc_id"].dataType.simpleString()
    parts = _parts(source, settings)
    marks = _paragraph_marks(source, parts, settings)
    gone = _gone(marks, settings)
    more = _seed_marks(parts, gone, settings)
    drop(parts)
    stretches = _stretches(marks.union(more))
    drop(marks, more)
    around = _partners(source, stretches, gone, settings)
    head = around.select("partner", F.col("place").alias("p_start"), "before")
    tail = around.select("partner", F.col("place").alias("p_end"), "after")
    full = stretches.join(head, ["partner", "p_start"]).join(tail, ["partner", "p_end"])
    names = ("start", "end", "removed", "keeper", "component_id", "n_docs", "before", "after")
    per_doc = full.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct(*names))).alias("found"))
    texts = thinned(source, "doc", stretches, "doc").dropDuplicates(["doc"]).join(per_doc, "doc")

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("doc", "doc_id", "start", "end", "n_words", "component_id", "n_docs", "removed")}
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            for doc, key, value, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, _plain(batch.column(3))):
                words = value.split()
                for own in found:
                    first, end = own["start"], own["end"]
                    own["start"] -= _alike(words[max(0, first - settings.around) : first][::-1], own["before"])
                    own["end"] += _alike(words[end : end + settings.around], own["after"])
                found.sort(key=lambda p: p["start"])
                places = None
                for run in _runs(found, settings):
                    places = _places(value) if places is None else places
                    out["doc"].append(doc)
                    out["doc_id"].append(key)
                    out["start"].append(int(places[run["start"]]))
                    out["end"].append(int(places[run["end"]]))
                    out["n_words"].append(run["end"] - run["start"])
                    for column in ("component_id", "n_docs", "removed"):
                        out[column].append(run[column])
            yield out

    schema = f"doc long, doc_id {kind}, start long, `end` long, n_words long, component_id {kind}, n_docs long, removed boolean"
    return arrow_rows(texts.select("doc", "doc_id", "text", "found"), located, schema)


def _alike(own: list[bytes], other: list[int]) -> int:
    """How many words are equal to those of the hashes, from the first on."""
    n = 0
    for word, wanted in zip(own, other):
        if xxh3_64_intdigest(word) != wanted % (1 << 64):
            break
        n += 1
    return n


def _places(value: bytes) -> np.ndarray:
    """Where each word of a text begins, in characters, and where the text ends."""
    raw = np.frombuffer(value, np.uint8)
    blank = _BLANK[raw]
    first = np.flatnonzero(~blank & np.append(True, blank[:-1]))
    # Characters before each byte: bytes that do not go on with one.
    before = np.cumsum((raw & 0xC0) != 0x80)
    return np.append(before[first] - 1, before[-1] if len(before) else 0)


def _runs(found: list[dict], settings: Settings) -> Iterator[dict]:
    """Stretches of one fate inside long enough runs of the marks, which are in order of their starts.

    A word that one mark removes and another keeps goes. Fewer than ``width`` words between marks of one keeper and fate go with
    them: they are edits inside a passage.
    """
    if not found:
        return
    fate = np.zeros(max(p["end"] for p in found) + 1, np.int8)  # 1: kept, 2: removed
    marks, reached = list(found), {}
    for p in found:
        side = (p["keeper"], p["removed"])
        last = reached.get(side, p["start"])
        if 0 < p["start"] - last < settings.width:
            marks.append(p | {"start": last, "end": p["start"]})
        reached[side] = max(last, p["end"])
    for removed in (False, True):
        for p in marks:
            if p["removed"] == removed:
                fate[p["start"] : p["end"]] = 1 + removed
    turns = np.flatnonzero(np.diff(np.append(np.int8(0), (fate > 0).astype(np.int8))))
    for first, end in zip(turns[::2].tolist(), turns[1::2].tolist()):
        if end - first < settings.least:
            continue
        inner = (first + 1 + np.flatnonzero(np.diff(fate[first:end]))).tolist()
        for a, b in zip([first, *inner], [*inner, end]):
            own = (p for p in marks if p["start"] <= a < p["end"] and p["removed"] == (fate[a] == 2))
            yield max(own, key=lambda p: p["n_docs"]) | {"start": a, "end": b}


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: str | None = "n_chars", settings: Settings = Settings()
) -> DataFrame:
    """``docs`` with repeated passages left in one document each.

    All rows stay, with their columns; a text may become empty. ``length``, if there is such a column, is set to the
    new text's characters where passages were removed.
    """
    spans = repeated_spans(docs, doc_id, text, settings).where("removed")
    gone = spans.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__gone"))
    gone = materialise(gone.withColumnRenamed("doc", "__doc"), "removed")
    names = docs.columns
    marked = docs.withColumn("__doc", F.xxhash64(F.col(doc_id), F.col(text)))
    joined = marked.join(gone, "__doc", "left")
    # What is left are the stretches between the removed ones: from each end to the next start.
    left = F.concat(F.array(F.lit(0).cast("long")), F.col("__gone.end"))
    until = F.concat(F.col("__gone.start"), F.array(F.length(text).cast("long")))
    kept = F.array_join(
        F.zip_with(left, until, lambda a, b: F.substring(F.col(text), (a + 1).cast("int"), (b - a).cast("int"))), ""
    )
    joined = joined.withColumn("__new", F.when(F.col("__gone").isNotNull(), kept).otherwise(F.col(text)))
    columns = []
    for f in docs.schema.fields:
        own = F.col(f"`{f.name}`")
        if f.name == text:
            own = F.col("__new")
        elif f.name == length:
            own = F.when(F.col("__gone").isNotNull(), F.length("__new").cast(f.dataType)).otherwise(own)
        columns.append(own.alias(f.name))
    return joined.select(*columns)
