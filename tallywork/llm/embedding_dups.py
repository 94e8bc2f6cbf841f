"""Near-duplicate vectors by small-world graphs, one per shard of a label.

Equal vectors are one item. Items of a label (and length) are dealt to shards of bounded size. Every shard gets a graph, which is built
once and written, and the items of all shards of the label query it (each two shards meet once, as the cosine is symmetric).
Before a graph is queried, audits tell how wide its beam must be: some of the queries, and near copies of the shard's own vectors, planted
so that there are links to be found whatever the data, are compared with the whole shard by brute force; the beam is
widened until the graph finds enough of their links. It is widened further for single queries as long as all that the beam holds are
links. What a search finds is verified in double precision. Tasks report each item's number of links and a forest of
the links, never all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallywork.llm.cells import Groups
from tallywork.llm.common import arrow_rows, materialise, partitions
from tallywork.llm.components import connected_components
from tallywork.llm.hnsw import Graph


@dataclass(frozen=True)
class Settings:
    """Links are cosines of at least ``least``. A graph holds about ``shard`` vectors.

    ``beam``: width to begin with; ``audited``, ``planted``: queries and planted near copies that are compared with the whole shard;
    ``recall``: the share of their links that a search must find before its beam is accepted.
    """

    least: float = 0.98
    shard: int = 4_096
    beam: int = 32
    audited: int = 64
    planted: int = 64
    recall: float = 0.99


#: Cosines in single precision that may be links in double precision; far above the error.
SLACK = 1e-4


def units(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one in single precision, for graphs."""
    return (vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.float32)


def planted_copies(unit: np.ndarray, count: int, least: float) -> np.ndarray:
    """Near copies of some of the vectors, with cosines from ``least`` to 1."""
    random = np.random.default_rng(7)
    base = unit[random.integers(0, len(unit), count)]
    away = random.normal(size=base.shape).astype(np.float32)
    away -= (away * base).sum(axis=1)[:, None] * base
    length = np.linalg.norm(away, axis=1)[:, None]
    away = np.where(length > 1e-6, away / np.maximum(length, 1e-6), 0)
    cosine = random.uniform(least, 1, (count, 1)).astype(np.float32)
    made = cosine * base + np.sqrt(1 - cosine * cosine) * away
    return (made / np.linalg.norm(made, axis=1)[:, None]).astype(np.float32)


def audited_beam(graph: Graph, asked: np.ndarray, settings: Settings) -> tuple[int, float]:
    """The beam whose recall over audited and planted queries is high enough, and that recall.

    Queries whose beam holds nothing but links are left out: they are widened by themselves later.
    """
    unit = graph.vectors
    some = np.random.default_rng(1).permutation(len(asked))[: settings.audited]
    queries = np.concatenate([asked[some], planted_copies(unit, settings.planted, settings.least)])
    slack = np.float32(settings.least - SLACK)
    truth = (queries @ unit.T >= slack).sum(axis=1)
    beam = min(settings.beam, len(unit))
    while True:
        _, score = graph.search(queries, beam)
        found = (score >= slack).sum(axis=1)
        open_ = (found == beam) & (beam < len(unit))
        real, hit = int(truth[~open_].sum()), int(np.minimum(found, truth)[~open_].sum())
        recall = hit / real if real else 1.0
        if recall >= settings.recall or beam == len(unit):
            return beam, recall
        beam = min(2 * beam, len(unit))


def cell_links(
    graph: Graph, left: np.ndarray, right: np.ndarray | None, beam: int, settings: Settings
) -> Iterator[tuple[int, np.ndarray]]:
    """(query, its links) of a cell: the rows of ``right`` against the graph of ``left``, or ``left`` against itself.

    Vectors are in double precision, neither zero nor with a component that isn't finite.
    """
    queries = left if right is None else right
    left_norm, query_norm = np.linalg.norm(left, axis=1), np.linalg.norm(queries, axis=1)
    asked = graph.vectors if right is None else units(right)
    slack = np.float32(settings.least - SLACK)

    def exact(q: int, ids: np.ndarray) -> np.ndarray:
        ids = ids[ids != q] if right is None else ids
        return ids[left[ids] @ queries[q] / (left_norm[ids] * query_norm[q]) >= settings.least]

    todo = np.arange(len(queries))
    while len(todo):
        ids, score = graph.search(asked[todo], beam)
        near = score >= slack
        full = near.all(axis=1) & (beam < len(left))
        for k in np.flatnonzero(~full & near.any(axis=1)).tolist():
            yield int(todo[k]), exact(int(todo[k]), ids[k][near[k]])
        todo, beam = todo[full], min(2 * beam, len(left))


def both_ends(seen: np.ndarray, copies: np.ndarray, block: int = 256) -> np.ndarray:
    """Links of each item, from a square of packed bits in which a link may stand for one of its ends only."""
    n = len(copies)
    out = np.zeros(n, np.int64)
    for at in range(0, n, block):
        own = np.unpackbits(seen[at : at + block], axis=1)[:, :n]
        other = np.unpackbits(seen[:, at // 8 : (at + block) // 8], axis=1)[:, : len(own)].T
        for k, row in enumerate(own | other):
            out[at + k] = copies[row.view(bool)].sum()
    return out


@dataclass
class Found:
    """``rows``: (vec_id, node, ...) of all rows, ``items``: (node, copies) of different vectors.

    ``searched``: (a, links) per item of a search, (a, b) per link of its forest, (shard, other, beam, recall) per search.
    """

    rows: DataFrame
    items: DataFrame
    searched: DataFrame


def find(vectors: DataFrame, vec_id: str, embedding: str, label: str, settings: Settings) -> Found:
    """All searches of all shards."""
    source = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("v"), F.col(label).alias("label"))
    value = F.col("v").cast("array<double>")
    # Of NULLs, NaN and infinities, none survives the comparison; exists() is null where only nulls are met.
    odd = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    any_ = F.exists(value, lambda x: x != 0)
    usable = F.col("label").isNotNull() & value.isNotNull() & ~F.coalesce(odd, F.lit(True)) & F.coalesce(any_, F.lit(False))
    node = F.when(usable, F.xxhash64(F.col("label"), F.size("v"), value))
    rows = materialise(source.select("vec_id", node.alias("node"), "label", value.alias("v")), "vectors")
    items = rows.where("node is not null").groupBy("label", F.size("v").alias("size"), "node").agg(
        F.count("*").alias("copies"), F.first("v").alias("v")
    )
    items = materialise(items, "items")
    sizes = items.groupBy("label", "size").agg(F.ceil(F.count("*") / settings.shard).cast("int").alias("shards"))
    own = F.pmod(F.xxhash64("node", F.lit("shard")), F.col("shards")).cast("int")
    placed = items.join(materialise(sizes, "sizes"), ["label", "size"]).select(
        F.xxhash64("label", "size").alias("group"), own.alias("shard"), "shards", "node", "copies", "v"
    )
    n = partitions(vectors.sparkSession)
    dealt = placed.repartition(n, "group", "shard").sortWithinPartitions("group", "shard", "node")

    def members(batches: Iterator[pa.RecordBatch], keys: int):
        """(heads..., vector) per row; the vector is the last column."""
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(keys)]
            lists = batch.column(keys)
            flat, offsets = lists.values.to_numpy(zero_copy_only=False), np.asarray(lists.offsets)
            for k, head in enumerate(zip(*columns)):
                yield *head, flat[offsets[k] : offsets[k + 1]]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        names = ("group", "shard", "shards", "node", "copies")
        for _, group in groupby(members(batches, 5), key=lambda r: r[:2]):
            held = list(group)
            matrix = np.array([r[5] for r in held])
            near = Graph(units(matrix)).rows()
            for at in range(0, len(held), 1024):
                some = held[at : at + 1024]
                yield {c: [r[k] for r in some] for k, c in enumerate(names)} | {
                    "near": near[at : at + 1024],
                    "v": [r[5] for r in some],
                }

    schema = "group long, shard int, shards int, node long, copies long, near binary, v array<double>"
    graphs = materialise(arrow_rows(dealt, build, schema), "graphs")
    # A graph meets the queries of its own shard and of those after it; in its own cell its vectors are the queries.
    kept = graphs.withColumn("other", F.explode(F.sequence(F.col("shard"), F.col("shards") - 1)))
    asking = graphs.where("shard > 0").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("shard") - 1)))
    cells = kept.select("group", F.col("shard").alias("i"), F.col("other").alias("j"), F.lit(0).alias("side"), "node", "copies", "near", "v").union(
        asking.select("group", "i", F.col("shard").alias("j"), F.lit(1).alias("side"), "node", "copies", F.lit(None).cast("binary").alias("near"), "v")
    )
    dealt = cells.repartition(n, "group", "i", "j").sortWithinPartitions("group", "i", "j", "side", "node")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        none = {"a": None, "b": None, "links": None, "shard": None, "other": None, "beam": None, "recall": None}
        for (_, i, j), group in groupby(members(batches, 7), key=lambda r: r[:3]):
            cell = list(group)
            nodes, copies = np.array([r[4] for r in cell], np.int64), np.array([r[5] for r in cell], np.int64)
            size = sum(r[3] == 0 for r in cell)
            left, right = np.array([r[7] for r in cell[:size]]), np.array([r[7] for r in cell[size:]])
            if not size or (i != j and not len(right)):
                continue
            graph = Graph.of_rows(units(left), [r[6] for r in cell[:size]])
            beam, recall = audited_beam(graph, graph.vectors if i == j else units(right), settings)
            yield {c: [v] for c, v in (none | {"shard": int(i), "other": int(j), "beam": beam, "recall": recall}).items()}
            links = np.zeros(len(cell), np.int64)
            groups, forest = Groups(len(cell)), []
            seen = np.zeros((size, -(-size // 8)) if i == j else 0, np.uint8)
            for q, found in cell_links(graph, left, None if i == j else right, beam, settings):
                own = q if i == j else size + q
                if i == j:
                    row = np.zeros(size, bool)
                    row[found] = True
                    seen[q] = np.packbits(row)
                else:
                    links[own] += copies[found].sum()
                    links[found] += copies[own]
                for other in found.tolist():
                    if groups.root(own) != groups.root(other):
                        groups.join(own, other)
                        forest.append((nodes[own], nodes[other]))
            if i == j:
                links[:size] = both_ends(seen, copies[:size])
            some = np.flatnonzero(links)
            yield {c: [None] * len(some) for c in none} | {"a": nodes[some], "links": links[some]}
            yield {c: [None] * len(forest) for c in none} | {"a": [a for a, _ in forest], "b": [b for _, b in forest]}

    schema = "a long, b long, links long, shard int, other int, beam int, recall double"
    return Found(rows, items.select("node", "copies"), materialise(arrow_rows(dealt, search, schema), "searched"))


def audits(found: Found) -> DataFrame:
    """(shard, other, beam, recall) per search of a shard's graph by a shard's vectors."""
    return found.searched.where("recall is not null").select("shard", "other", "beam", "recall")


def near_duplicates(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    settings: Settings = Settings(),
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row.

    Rows are compared only where labels are equal and not null and vectors equally long. Vectors that are null, empty or zero,
    or hold a null or a component that isn't finite, link with nothing. Equal vectors of a label link with each other
    (repeated rows too) and share what they link with. component_id is the smallest vec_id that links reach, kept
    whether it is the row's own; rows without a vec_id take part, and are kept only if nothing else is reached. Other columns
    are left alone, whatever their names; an empty table gives no rows.
    """
    return linked(find(vectors, vec_id, embedding, label, settings))


def linked(found: Found) -> DataFrame:
    """The result of ``near_duplicates`` from the searches."""
    rows, searched = found.rows, found.searched
    counts = searched.where("links is not null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    roots = materialise(connected_components(searched.where("b is not null")), "roots")
    copies = found.items.select("node", (F.col("copies") - 1).alias("same"))
    known = (
        rows.where("node is not null")
        .select("vec_id", "node")
        .join(copies, "node")
        .join(materialise(counts, "counts"), "node", "left")
        .join(roots, "node", "left")
        .select("vec_id", (F.col("same") + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("root"))
    )
    lowest = materialise(known.groupBy("root").agg(F.min("vec_id").alias("component_id")), "lowest")
    full = known.join(lowest, "root").select("vec_id", "n_links", "component_id")
    alone = rows.where("node is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return full.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
