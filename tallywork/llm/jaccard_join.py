"""Documents linked by the Jaccard similarity of their word n-grams, found by T-occurrence search.

Two sets of at least the threshold t in similarity share T = t * max(sizes) members. The search looks for the documents that
occur at least T times in the inverted lists of a document's shingles, the DivideSkip way: the longest lists are set
aside, the short ones merged and counted, and what could still reach T is looked up in the long lists by binary search.

Lists of a whole corpus have no bound, so the search runs inside clusters that no link leaves. Documents of equal sets are
one item. A pair of similarity t differs in at most H = (1 - t) / (1 + t) of the summed sizes; cut into more than H parts by
hash, two such sets agree in at least one part entirely. Items that agree in a part (of the same range of sizes) are
in one cluster, unless only few do and a sketch of both sets shows that they cannot reach the threshold, so that parts
that agree by chance do not glue clusters together. The corpus' most frequent shingles, whose lists are the longest, are left out of the parts: this loses no
pair, and keeps common phrases from gluing clusters together. Where frequent shingles are nearly all of a set, the
parts are of the whole set. Clusters are cut into cells of bounded size, see ``cells``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallywork.llm.cells import Groups, search_cells
from tallywork.llm.common import arrow_rows, drop, forget, kept_rows, materialise, mix, shingle_hashes, thinned, word_hashes
from tallywork.llm.components import connected_components

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Join:
    """Similarity of at least ``over`` / ``under`` on windows of ``width`` words (75/100 or more).

    ``frequent``: number of shingles that count as frequent at most; ``seen``: occurrences that make one so.
    """

    width: int = 3
    over: int = 90
    under: int = 100
    frequent: int = 65_536
    seen: int = 24


def lower_words(text: str | None) -> list[bytes]:
    """The words of a text, A-Z in lower case, as UTF-8; bytes split at the blanks that the contract names."""
    return (text or "").encode().translate(_LOWER).split()


def shingles(text: str | None, width: int) -> np.ndarray:
    """The sorted set of a text's windows of ``width`` words; fewer words are one window; none, an empty set."""
    words = lower_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(shingle_hashes(word_hashes(words), min(width, len(words))))


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """``shingles`` of each text; the windows of all texts are hashed together."""
    words = [lower_words(text) for text in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    hashes = word_hashes([w for own in words for w in own])
    windows = shingle_hashes(hashes, width)
    out, at = [], 0
    for n in sizes.tolist():
        if n >= width:
            own = np.sort(windows[at : at + n - width + 1])
            out.append(own[np.append(True, own[1:] != own[:-1])])
        else:  # one window of all words, or none
            out.append(shingle_hashes(hashes[at : at + n], n) if n else np.zeros(0, np.uint64))
        at += n
    return out


def signature(members: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest()


def _bounds() -> list[int]:
    """Where ranges of sizes begin: each about 1.4 times the one before."""
    found = [1]
    while found[-1] < 1 << 40:
        found.append(max(found[-1] + 1, int(found[-1] * 1.42)))
    return found


_BOUNDS = np.array(_bounds(), np.int64)


def _families(n: int, join: Join) -> list[tuple[int, int]]:
    """(name, most differences of a pair) for the ranges of sizes in which a set of size n may meet another."""
    at = int(np.searchsorted(_BOUNDS, n, side="right")) - 1
    low, high = int(_BOUNDS[at]), int(_BOUNDS[at + 1])
    few = join.under - join.over
    all_ = join.under + join.over
    found = [(2 * at, 2 * (high - 1) * few // all_)]
    # Pairs on both sides of a bound have families of their own.
    for k, bound in ((at, low), (at + 1, high)):
        top = (bound - 1) * join.under // join.over
        if (n < bound and n * join.under >= bound * join.over) or bound <= n <= top:
            found.append((2 * k + 1, (bound - 1 + top) * few // all_))
    return found


def _parts(members: np.ndarray, family: int, differences: int, salt: int) -> tuple[np.ndarray, int]:
    """A key per part that has members, and the number of parts."""
    count = 1 if differences == 0 else differences + 3 + differences // 64
    name = (family << 8) | salt
    spread = mix(members + np.uint64(name * 0x9E3779B97F4A7C15 % (1 << 64)))
    part = ((spread >> np.uint64(32)) % np.uint64(count)).astype(np.uint16 if count <= 1 << 16 else np.int64)
    order = np.argsort(part, kind="stable")
    part, spread = part[order], mix(spread[order])
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
    sums = np.add.reduceat(spread, first) if len(first) else np.zeros(0, np.uint64)
    return mix(sums + mix(part[first].astype(np.uint64) + np.uint64(name << 32))), count


def keys(members: np.ndarray, frequent: np.ndarray, join: Join) -> np.ndarray:
    """Keys of a set; any two sets that reach the threshold have one in common."""
    n = len(members)
    if not n:
        return np.zeros(0, np.uint64)
    rare = members
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, members), len(frequent) - 1)
        rare = members[frequent[at] != members]
    most = (n + n * join.under // join.over) * (join.under - join.over) // (join.under + join.over)
    out = []
    for family, differences in _families(n, join):
        found, count = _parts(rare, family, differences, 0)
        out.append(found)
        # Parts without members agree with anything. If that may leave no telling part, take the whole set, and
        # should that not do either, one key for all such sets of the family.
        if len(found) <= min(most, differences):
            found, count = _parts(members, family, differences, 1)
            out.append(found)
            if len(found) <= min(most, differences):
                out.append(mix(np.array([(family << 8) | 2], np.uint64)))
    return np.concatenate(out)


def parity_bits(members: np.ndarray) -> bytes:
    """Of each of 2n or more bits (a power of two), whether an odd number of a set's members falls on it.

    Bits in which two sets differ are at most the members that only one of them has. Halves of a sketch, added
    up without carry, are the sketch of half the bits.
    """
    bits = max(64, 1 << (2 * len(members) - 1).bit_length())
    odd = np.bincount((mix(members) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def may_link(join: Join, n: int, own: bytes, m: int, other: bytes) -> bool:
    """False only if sets of these sizes and sketches cannot reach the threshold."""
    if min(n, m) * join.under < join.over * max(n, m):
        return False
    x, y = np.frombuffer(own, np.uint64), np.frombuffer(other, np.uint64)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum()) * (join.under + join.over) <= (n + m) * (join.under - join.over)


def parted(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of fewer rows, whose words are held as objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


class _Counts:
    """How often each of very many numbers was met, for those met most often; bounded in memory."""

    def __init__(self, most: int):
        self.most, self.held, self.counts = most, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting, self.size, self.least = [], 0, 1

    def add(self, values: np.ndarray) -> None:
        self.waiting.append(values)
        self.size += len(values)
        if self.size > self.most:
            self.merge()

    def merge(self) -> None:
        """Add up; when too many are held, those met least often go, and the bound rises for as long as it must."""
        if not self.size:
            return
        fresh, n = np.unique(np.concatenate(self.waiting), return_counts=True)
        self.waiting, self.size = [], 0
        if len(self.held):
            at = np.minimum(np.searchsorted(self.held, fresh), len(self.held) - 1)
            old = self.held[at] == fresh
            self.counts[at[old]] += n[old]
            fresh, n = fresh[~old], n[~old]
        where = np.searchsorted(self.held, fresh)
        self.held, self.counts = np.insert(self.held, where, fresh), np.insert(self.counts, where, n)
        while len(self.held) > self.most:
            self.least += 1
            kept = self.counts >= self.least
            self.held, self.counts = self.held[kept], self.counts[kept]


def frequent_shingles(docs: DataFrame, text: str, join: Join, per_task: int = 16_384, most: int = 1 << 19) -> np.ndarray:
    """The sorted shingles that occur most often, from the tasks' most frequent ones; at most ``join.frequent``.

    A task counts all occurrences and holds ``most`` shingles and as many waiting ones. What is missed here, or met often in a few
    documents only, makes the search slower and never loses a pair.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        counts = _Counts(most)
        for batch in parted(batches):
            words = [lower_words(value) for value in batch.column(0).to_pylist()]
            sizes = np.array([len(w) for w in words], np.int64)
            found = shingle_hashes(word_hashes([w for own in words for w in own]), join.width)
            # Windows that begin in the last words of a text reach into the next one.
            ends = np.cumsum(sizes)[:, None] - np.arange(1, join.width)
            inside = np.ones(len(found), bool)
            ends = ends[(ends >= 0) & (ends < len(found))]
            inside[ends] = False
            counts.add(found[inside])
        counts.merge()
        top = np.argsort(-counts.counts, kind="stable")[:per_task]
        top = top[counts.counts[top] > 1]
        yield {"shingle": counts.held[top].view(np.int64), "n": counts.counts[top]}
        forget()

    counted = arrow_rows(docs.select(F.col(text)), run, "shingle long, n long")
    total = counted.groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= join.seen)
    best = total.orderBy(F.desc("n"), "shingle").limit(join.frequent).collect()
    return np.sort(np.array([r.shingle for r in best], np.int64).view(np.uint64))


def divide_skip(join: Join, names: list[bytes], sides: list[int], sets: list[np.ndarray]) -> Iterator[tuple[bytes, bytes]]:
    """Links of a cell that join groups not linked yet, by T-occurrence search over its inverted lists."""
    two = any(sides)
    indexed = [k for k, side in enumerate(sides) if side == 0]
    asking = [k for k, side in enumerate(sides) if side == 1] if two else indexed
    if not indexed or not asking:
        return
    total = len(names)
    members = np.concatenate([sets[k] for k in indexed])
    holders = np.repeat(np.array(indexed, np.int64), [len(sets[k]) for k in indexed])
    order = np.argsort(members, kind="stable")  # holders stay in order within a list
    members, holders = members[order], holders[order]
    starts = np.flatnonzero(np.append(True, members[1:] != members[:-1]))
    heads, ends = members[starts], np.append(starts[1:], len(members))
    lists = np.repeat(np.arange(len(starts)), ends - starts)
    places = lists * total + holders
    sizes = np.array([len(s) for s in sets], np.int64)
    groups = Groups(total)
    for q in asking:
        n = int(sizes[q])
        needed = -(-join.over * n // join.under)
        at = np.searchsorted(heads, sets[q])
        at[at == len(heads)] = 0
        at = at[heads[at] == sets[q]]
        if len(at) < needed:
            continue
        lengths = ends[at] - starts[at]
        at = at[np.argsort(lengths, kind="stable")]
        longest = int(lengths.max())
        aside = min(needed - 1, int(needed / (0.01 * math.log2(longest + 1) + 1)))
        short, long = at[: len(at) - aside], at[len(at) - aside :]
        # The merge of the short lists: how often each holder occurs in them.
        span = ends[short] - starts[short]
        merged = np.repeat(starts[short] - (np.cumsum(span) - span), span) + np.arange(int(span.sum()))
        counts = np.bincount(holders[merged], minlength=total)
        found = np.flatnonzero(counts >= max(1, needed - aside))
        if not two:
            found = found[found < q]
        found = found[(sizes[found] * join.under >= join.over * n) & (n * join.under >= join.over * sizes[found])]
        for r in found[np.argsort(-counts[found], kind="stable")].tolist():
            if groups.root(r) == groups.root(q):
                continue
            probes = long * total + r
            spots = np.searchsorted(places, probes)
            spots[spots == len(places)] = 0
            both = int(counts[r]) + int((places[spots] == probes).sum())
            if join.under * both >= join.over * (n + int(sizes[r]) - both):
                groups.join(q, r)
                yield names[q], names[r]


def cell_links(join: Join, names: list[bytes], sides: list[int], sets: list[np.ndarray]) -> list[tuple[bytes, bytes]]:
    """Links of a cell that join groups; of two blocks, only those between what neither of them links by itself.

    A block's own links come from the cell where it meets itself. So two blocks of one large group of near copies give one link.
    """
    found = list(divide_skip(join, names, sides, sets))
    if not any(sides) or len(found) < 2:
        return found
    groups = Groups(len(names))
    for own in (0, 1):
        block = [k for k, side in enumerate(sides) if side == own]
        for a, b in divide_skip(join, block, [0] * len(block), [sets[k] for k in block]):
            groups.join(a, b)
    place = {name: k for k, name in enumerate(names)}
    return [(a, b) for a, b in found if groups.join(place[a], place[b])]


@dataclass
class Found:
    """``rows``: (doc_id, n, sig, ...) per row of the documents; ``linked``: (sig, root) of the sets that have links."""

    rows: DataFrame
    linked: DataFrame


def clustered(pairs: DataFrame, rows: DataFrame, join: Join, few: int = 32) -> DataFrame:
    """Written (node, component) of items that may be linked, from their (key, item) and (item, sig, n, bits) of all rows.

    Of a key that many rows have, all items point at the smallest. Of one that at most ``few`` have, each two items do, and
    pairs whose sketches rule a link out are left out; so every two sets that reach the threshold stay connected.
    """
    met = pairs.groupBy("key").agg(F.min("item").alias("low"), F.max("item").alias("high"), F.count("*").alias("held"))
    shared = materialise(met.where("low < high").select("key", "low", "held"), "shared")
    # Written, as both kinds of edges read them and the keys behind them are costly.
    hits = materialise(thinned(pairs, "key", shared, "key").join(shared, "key"), "hits")
    drop(shared)
    many = hits.where((F.col("held") > few) & (F.col("item") != F.col("low"))).select(F.col("item").alias("a"), F.col("low").alias("b"))
    groups = hits.where(F.col("held") <= few).groupBy("key").agg(F.collect_set("item").alias("items"))
    each = groups.select(F.explode("items").alias("a"), "items").select("a", F.explode("items").alias("b"))
    edges = each.where("a < b").withColumn("tested", F.lit(True)).union(many.withColumn("tested", F.lit(False)))
    edges = materialise(edges.distinct(), "edges")
    drop(hits)
    tested = edges.where("tested").select("a", "b")
    ends = materialise(tested.select(F.explode(F.array("a", "b")).alias("item")).distinct(), "ends")
    # Of one item there may be several sets, though hardly ever.
    sketches = thinned(rows.select("item", "sig", "n", "bits"), "item", ends, "item").dropDuplicates(["sig"]).drop("sig")
    sketches = materialise(sketches, "sketches")
    full = tested.join(sketches.toDF("a", "n", "own"), "a").join(sketches.toDF("b", "m", "other"), "b")

    def able(batch: pa.RecordBatch) -> list[bool]:
        return [may_link(join, *row) for row in zip(*(batch.column(k).to_pylist() for k in range(2, 6)))]

    kept = kept_rows(full.select("a", "b", "n", "own", "m", "other"), able).select("a", "b")
    found = materialise(connected_components(kept.union(edges.where("NOT tested").select("a", "b"))), "clusters")
    drop(edges, ends, sketches)
    return found


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", join: Join = Join(), keep: bool = False) -> Found:
    """Sizes and signatures of all rows, and the components of linked sets.

    With ``keep`` the rows have all columns of ``docs`` as c0, c1 and so on, and ``row``, which tells them apart.
    """
    names = docs.columns
    own = [f"c{i}" for i in range(len(names))] if keep else []
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    named = plain.select(
        F.col(f"c{names.index(doc_id)}").alias("doc_id"), F.col(f"c{names.index(text)}").alias("text"), *own
    ).withColumn("hash", F.xxhash64("text"))
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_shingles(named, "text", join))
    carried = ["doc_id", "hash", *own]
    fields = {f.name: f.dataType.simpleString() for f in named.schema.fields}

    def keyed(sets: list[np.ndarray]) -> list[np.ndarray]:
        return [keys(members, frequent.value, join).view(np.int64) for members in sets]

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in parted(batches):
            sets = shingle_sets(batch.column(0).to_pylist(), join.width)
            sigs = [signature(members) if len(members) else None for members in sets]
            out = {c: batch.column(i + 1) for i, c in enumerate(carried)} | {
                "n": [len(members) for members in sets],
                "sig": sigs,
                "item": [int.from_bytes(sig[:8], "little", signed=True) if sig else None for sig in sigs],
                "bits": [parity_bits(members) if len(members) else None for members in sets],
            }
            yield out if keep else out | {"keys": keyed(sets)}
        forget()

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in parted(batches):
            yield {"item": batch.column(1), "keys": keyed(shingle_sets(batch.column(0).to_pylist(), join.width))}
        forget()

    schema = ", ".join(f"{c} {fields[c]}" for c in carried) + ", n long, sig binary, item long, bits binary"
    rows = arrow_rows(named.select("text", *carried), sized, schema if keep else f"{schema}, keys array<long>")
    # Written once, so that row numbers stay what they are.
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()) if keep else rows, "sets")
    # Of written rows the text is read again, else of the documents. Keys take more room than texts, so they are not written
    # beside them but made from them where they are asked for.
    hashed = rows.select("doc_id", "hash", F.col(f"c{names.index(text)}").alias("text")) if keep else named
    sources = rows.where("n > 0")
    if keep:
        sources = arrow_rows(sources.select(f"c{names.index(text)}", "item"), again, "item long, keys array<long>")
    clusters = clustered(sources.select(F.explode("keys").alias("key"), "item"), rows, join)
    # One row of the documents stands for all that have its set.
    first = rows.where("n > 0").groupBy("sig").agg(
        F.min_by(F.struct("doc_id", "hash", "item", "n"), F.struct("doc_id", "hash")).alias("r")
    )
    chosen = first.select("sig", "r.n", F.col("r.doc_id").alias("id"), F.col("r.hash").alias("own"), F.col("r.item").alias("node"))
    chosen = materialise(chosen.join(clusters, "node").select("sig", "id", "own", "n", F.col("component").alias("cluster")), "chosen")
    drop(clusters)
    sizes = chosen.groupBy("cluster").agg(F.sum("n").alias("w"), F.count("*").alias("n"))
    texts = thinned(hashed, "hash", chosen, "own").join(chosen, (F.col("hash") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("id")))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            out: dict[str, list] = {"cluster": [], "item": [], "set": []}
            for cluster, sig, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
                members = shingles(value, join.width)
                if signature(members) == sig:  # else another text of the same hash
                    out["cluster"].append(cluster)
                    out["item"].append(sig)
                    out["set"].append(members.tobytes())
            yield out

    members = arrow_rows(texts.select("cluster", "sig", "text"), sets, "cluster long, item binary, set binary")
    links = search_cells(members, lambda *cell: cell_links(join, *cell), sizes=sizes)
    roots = connected_components(links).select(F.col("node").alias("sig"), F.col("component").alias("root"))
    return Found(rows, materialise(roots, "roots"))


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", join: Join = Join()) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row.

    Rows of equal sets are linked, as are rows whose sets reach the threshold; component_id is the smallest doc_id
    among the rows that links reach. Every row is a document of its own, so rows of one doc_id and different texts are not
    linked by their id. Null texts and texts without words have an empty set and keep their own doc_id. Rows
    without a doc_id are linked like others; a component that has no id at all gets null.
    """
    found = find(docs, doc_id, text, join)
    full = found.rows.where("n > 0").select("doc_id", "n", "sig")
    rooted = full.join(found.linked, "sig", "left").select("doc_id", "n", F.coalesce("root", "sig").alias("root"))
    lowest = materialise(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "lowest")
    named = rooted.join(lowest, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = found.rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return named.union(empty)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", join: Join = Join()) -> DataFrame:
    """The rows of ``docs`` but for those that duplicate another: of each component the smallest doc_id stays.

    Of repeated rows one stays; rows with an id go before rows without. Texts without words all stay. Columns keep
    their names and values, whatever they are. The documents are written once, with their keys.
    """
    found = find(docs, doc_id, text, join, keep=True)
    own = [f"c{i}" for i in range(len(docs.columns))]
    full = found.rows.where("n > 0").select("doc_id", "sig", "row")
    rooted = full.join(found.linked, "sig", "left").select("doc_id", "row", F.coalesce("root", "sig").alias("root"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    best = rooted.groupBy("root").agg(F.min_by("row", order).alias("row")).select("row")
    kept = found.rows.join(materialise(best, "kept"), "row", "left_semi").select(*own)
    return kept.union(found.rows.where("n = 0").select(*own)).toDF(*docs.columns)
