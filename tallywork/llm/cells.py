"""Pair searches inside clusters, cut into cells of bounded size.

A cluster of items that may be linked is dealt to blocks by a hash of the item; every two blocks of a cluster meet in
one cell (and every block by itself), so each pair of a cluster meets exactly once however large it is, and no task holds
more than a few blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallywork.llm.common import arrow_rows, forget, materialise, partitions

#: Items of one cell: ids, which block each is from (0 or 1; all 0 where a block meets itself), sorted sets.
Search = Callable[[list[bytes], list[int], list[np.ndarray]], Iterator[tuple[bytes, bytes]]]


def search_cells(
    members: DataFrame, search: Search, items: int = 96, weight: int = 400_000, sizes: DataFrame | None = None
) -> DataFrame:
    """Links (a, b) that ``search`` finds between members of a cluster.

    ``members`` has (cluster long, item binary, set binary), the set as sorted unsigned 64-bit numbers. A block holds
    about ``items`` items and ``weight`` numbers; a single larger set is a block of its own. Repeated members count once.
    ``sizes``, where it is known, gives (cluster, n, w) of all clusters: different members and their numbers. Members are not
    written in that case, and repeated ones are left out where they meet.
    """
    n = partitions(members.sparkSession)
    if sizes is None:
        members = materialise(members.dropDuplicates(["cluster", "item"]), "members")
        sizes = members.groupBy("cluster").agg(F.count("*").alias("n"), F.sum(F.length("set") / 8).alias("w"))
    blocks = F.greatest(F.ceil(F.col("n") / items), F.ceil(F.col("w") / weight)).cast("int")
    sizes = materialise(sizes.where("n > 1").select("cluster", blocks.alias("__blocks")), "sizes")
    own = F.pmod(F.xxhash64("item"), F.col("__blocks")).cast("int")
    placed = members.join(sizes, "cluster").select("*", own.alias("__own"))
    met = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)).alias("__other"))
    cells = met.select(
        "cluster",
        F.least("__own", "__other").alias("i"),
        F.greatest("__own", "__other").alias("j"),
        (F.col("__own") > F.col("__other")).cast("int").alias("side"),
        "item",
        "set",
    )
    dealt = cells.repartition(n, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "item")

    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):  # few sets at a time, as they may be large
                yield from zip(*(column.to_pylist() for column in batch.slice(at, 64).columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for _, group in groupby(rows(batches), key=lambda r: r[:3]):
            # In order of items, so that repeated ones follow each other and are not gathered.
            cell = [next(same) for _, same in groupby(group, key=lambda r: r[4])]
            sets = [np.frombuffer(r[5], np.uint64) for r in cell]
            links = list(search([r[4] for r in cell], [r[3] for r in cell], sets))
            if links:
                yield {"a": [a for a, _ in links], "b": [b for _, b in links]}
        forget()

    return arrow_rows(dealt, run, "a binary, b binary")


class Groups:
    """Which of a cell's items are already linked, directly or not."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        """Link two items; false if they were linked already."""
        x, y = self.root(x), self.root(y)
        self.parent[x] = y
        return x != y
