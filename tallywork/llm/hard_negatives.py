"""Hard negatives of anchors: the best rows of other labels whose score lies in a window below a positive's.

The windows of an anchor's positives overlap. Their upper limits split the scores into disjoint slots, so a row falls into one
slot only. Combiners keep the first ``k`` rows of each slot, per block of rows and again over all blocks. Slots follow each
other downwards, so the first ``k`` rows below a limit are those of its slot and the slots under it, in this order: one merge per
suffix of the slots answers every window, and the lower limits cut its end.

Anchors meet rows in blocks: rows of one length of vectors (for positives, and one label) are dealt to blocks of bounded size by a
hash, and every block sees the anchors it is asked about in one stream. No block is gathered beyond its size, and no score leaves a
task but the first few of each slot.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallywork.llm.common import arrow_rows, materialise, partitions


@dataclass(frozen=True)
class Settings:
    """``positives``: best rows of its label that an anchor is asked with. ``k``: negatives of each.

    A negative's score is at least ``low`` and at most ``high`` hundredths of the positive's. ``numbers``: of vectors in a block.
    ``together``: anchors that a block is scored against at a time.
    """

    positives: int = 5
    k: int = 10
    low: int = 30
    high: int = 90
    numbers: int = 1 << 20
    together: int = 64


def scores(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact integer inner products, a row per anchor."""
    if not rows.size or not anchors.size:
        return np.zeros((len(anchors), len(rows)), np.int64)
    most = int(np.abs(rows).max()) * int(np.abs(anchors).max()) * rows.shape[1]
    if most < 1 << 53:  # then doubles are exact, and much faster
        return (anchors.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return anchors @ rows.T


def best(values: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """Of ``places`` the ``k`` first by value downwards, equal values by place."""
    if len(places) > k:
        own = values[places]
        places = places[own >= np.partition(own, len(own) - k)[len(own) - k]]
    return places[np.lexsort((places, -values[places]))[:k]]


@dataclass
class Block:
    """Rows of a block in order of their ids, and the scores of some anchors against them."""

    ids: pa.Array
    nodes: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray


def _blocks(dealt: DataFrame, answer, settings: Settings, schema: str) -> DataFrame:
    """``answer(block, anchors, scores)`` for each block and the anchors asked of it, some at a time.

    ``dealt`` has size, part, block, asks, vec_id, node, label, v and what ``answer`` takes of an anchor; within a task it is
    sorted by the first four and vec_id, so that a block's rows come before its anchors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        key, held, block = None, [], None
        for batch in batches:
            heads = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])
            turns = np.flatnonzero((heads[:, 1:] != heads[:, :-1]).any(axis=0)) + 1
            for first, end in zip([0, *turns.tolist()], [*turns.tolist(), batch.num_rows]):
                if first == end:
                    continue
                part, own = batch.slice(first, end - first), tuple(heads[:3, first].tolist())
                if own != key:
                    key, held, block = own, [], None
                if not heads[3, first]:
                    held.append(part)
                    continue
                if block is None:
                    rows = pa.Table.from_batches(held).combine_chunks().to_batches() if held else []
                    block, held = Block(*_columns(rows[0], own[0])) if rows else False, []
                if block:
                    for at in range(0, part.num_rows, settings.together):
                        some = part.slice(at, settings.together)
                        yield answer(block, some, scores(block.vectors, _columns(some, own[0])[3]))

    return arrow_rows(dealt, run, schema)


def _columns(batch: pa.RecordBatch, size: int) -> tuple:
    """ids, nodes, labels and vectors of a batch."""
    flat = batch.column(7).flatten().to_numpy(zero_copy_only=False)
    return (
        batch.column(4),
        batch.column(5).to_numpy(zero_copy_only=False),
        batch.column(6).to_numpy(zero_copy_only=False),
        flat.reshape(batch.num_rows, size),
    )


def _dealt(rows: DataFrame, anchors: DataFrame, part, settings: Settings) -> DataFrame:
    """Rows in blocks of one size and ``part``, and anchors sent to every block of their own."""
    extra = [c for c in anchors.columns if c not in rows.columns]
    rows = rows.withColumn("part", part)
    blocks = F.ceil(F.count("*") * F.greatest("size", F.lit(1)) / settings.numbers).cast("int")
    sizes = materialise(rows.groupBy("size", "part").agg(blocks.alias("blocks")), "blocks")
    own = F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int")
    types = {f.name: f.dataType for f in anchors.schema.fields}
    held = rows.join(sizes, ["size", "part"]).select(
        "size", "part", own.alias("block"), F.lit(0).alias("asks"), "vec_id", "node", "label", "v",
        *[F.lit(None).cast(types[c]).alias(c) for c in extra],
    )
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    asked = anchors.withColumn("part", part).join(sizes, ["size", "part"]).select(
        "size", "part", every.alias("block"), F.lit(1).alias("asks"), "vec_id", "node", "label", "v", *extra
    )
    met = held.union(asked).repartition(partitions(rows.sparkSession), "size", "part", "block")
    return met.sortWithinPartitions("size", "part", "block", "asks", F.asc_nulls_last("vec_id"), "node")


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` rows of each key by score downwards, then id; cut in the map tasks before it is shuffled."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    anchors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "vector",
    label: str = "label",
    settings: Settings = Settings(),
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score per anchor, positive and negative.

    ``rows`` and ``anchors`` have an id, a label (a whole number) and a vector of whole numbers; anchors are rows of ``rows`` too.
    A score is the inner product; higher ones come first, ties by the smaller id, rows without an id last. Vectors are
    compared with those of their length only. Rows whose label or vector is null take no part, nor do anchors without an id.
    Rows equal in id, label and vector count once; rows that share an anchor's id are neither its positives nor its negatives.
    Components beyond some 3 * 10^8 / sqrt(length) count as that much, so that scores fit 64 bits; a vector with a null component takes no part. Empty tables
    and anchors with no positive, or no row in a window, give no rows. Other columns are left alone, whatever their names.
    """
    def taken(frame: DataFrame) -> DataFrame:
        named = frame.select(F.col(vec_id).alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<long>").alias("v"))
        whole = named.where(F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull()))
        # A hundred times the inner product of such components still fits 64 bits.
        limit = F.floor(F.sqrt(F.lit(2.0**63 / 100) / F.greatest(F.size("v"), F.lit(1)))) - 1
        fit = F.transform("v", lambda x: F.greatest(F.least(x, limit), -limit))
        return whole.select("vec_id", "label", F.size("v").alias("size"), fit.alias("v")).withColumn("node", F.xxhash64("vec_id", "label", "v")).distinct()

    rows = materialise(taken(rows), "rows")
    anchors = materialise(taken(anchors).where("vec_id is not null"), "anchors")
    kind = rows.schema["vec_id"].dataType.simpleString()

    def nearest(block: Block, asked: pa.RecordBatch, found: np.ndarray) -> dict:
        out: dict[str, list] = {"node": [], "other": [], "score": []}
        places = []
        same, nodes = batch_same(block.ids, asked.column(4)), asked.column(5).to_pylist()
        for k, own in enumerate(asked.column(6).to_pylist()):
            some = np.flatnonzero((block.labels == own) & ~same(k))
            some = best(found[k], some, settings.positives)
            places.append(some)
            out["node"] += [nodes[k]] * len(some)
            out["score"] += found[k][some].tolist()
        return _told(block, places, out)

    part = _dealt(rows, anchors, F.col("label"), settings)
    near = _blocks(part, nearest, settings, f"node long, id {kind}, other long, score long")
    positives = materialise(_first(near, ["node"], settings.positives), "positives")
    # The limits of an anchor's positives, the highest first.
    upper = F.expr(f"(score * {settings.high} - pmod(score * {settings.high}, 100)) div 100")
    lower = F.expr(f"(score * {settings.low} + pmod(-score * {settings.low}, 100)) div 100")
    ends = positives.select("node", "rank", "id", "score", upper.alias("upper"), lower.alias("lower"))
    limits = ends.groupBy("node").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "upper"))), lambda x: x["upper"]).alias("upper"),
        F.min("lower").alias("lower"),
    )
    asking = materialise(anchors.join(limits, "node"), "asking")

    def slotted(block: Block, asked: pa.RecordBatch, found: np.ndarray) -> dict:
        out: dict[str, list] = {"node": [], "slot": [], "other": [], "score": []}
        places = []
        same, nodes, labels = batch_same(block.ids, asked.column(4)), asked.column(5).to_pylist(), asked.column(6).to_pylist()
        for k, (tops, floor) in enumerate(zip(asked.column(8).to_pylist(), asked.column(9).to_pylist())):
            own = found[k]
            some = np.flatnonzero((own <= tops[0]) & (own >= floor) & (block.labels != labels[k]) & ~same(k))
            if not len(some):
                continue
            slot = np.searchsorted(-np.array(tops), -own[some], side="right")
            for s in np.unique(slot).tolist():
                kept = best(own, some[slot == s], settings.k)
                places.append(kept)
                out["node"] += [nodes[k]] * len(kept)
                out["slot"] += [s] * len(kept)
                out["score"] += own[kept].tolist()
        return _told(block, places, out)

    part = _dealt(rows, asking.select("vec_id", "label", "size", "v", "node", "upper", "lower"), F.lit(0).cast("long"), settings)
    found = _blocks(part, slotted, settings, f"node long, slot int, id {kind}, other long, score long")
    slots = _first(found, ["node", "slot"], settings.k)
    # At most ``positives`` times ``k`` rows an anchor. In order of slot and rank they run from the highest score to the lowest.
    runs = slots.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("slot", "rank", "id", "score"))).alias("run"))
    below = F.slice(F.filter("run", lambda x: x["slot"] >= F.col("at")), 1, settings.k)
    within = F.filter(below, lambda x: x["score"] >= F.col("lower"))
    asked = ends.select("node", F.col("rank").alias("at"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), "lower")
    windows = asked.join(materialise(runs, "runs"), "node").select("node", "positive_id", "positive_score", F.posexplode(within).alias("place", "r"))
    names = anchors.select("node", F.col("vec_id").alias("anchor_id"))
    return windows.join(names, "node").select(
        "anchor_id", "positive_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("r.id").alias("negative_id"),
        "positive_score", F.col("r.score").alias("negative_score"),
    )


def batch_same(ids: pa.Array, asked: pa.Array):
    """For the k-th anchor, which of a block's ids are its own."""
    import pyarrow.compute as pc

    def same(k: int) -> np.ndarray:
        return pc.fill_null(pc.equal(ids, asked[k]), False).to_numpy(zero_copy_only=False)

    return same


def _told(block: Block, places: list[np.ndarray], out: dict) -> dict:
    """The found rows' ids and nodes beside the rest."""
    at = np.concatenate(places) if places else np.zeros(0, np.int64)
    return out | {"id": block.ids.take(pa.array(at)), "other": block.nodes[at]}


def from_embeddings(vectors: DataFrame, scale: int = 256, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, vector, label: embeddings as whole numbers, ``floor(scale * x)``; those with a null, NaN or infinity have none."""
    x = F.col(embedding).cast("array<double>")
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = F.when(~F.coalesce(odd, F.lit(True)), F.transform(x, lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(2.0**62)), F.lit(-(2.0**62))))))
    return vectors.select(F.col(vec_id).alias("vec_id"), whole.alias("vector"), F.col(label).alias("label"))
