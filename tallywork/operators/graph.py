"""Degrees and breadth-first search over adjacency data."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.functions.text import blank_fields
from tallywork.operators.aggregates import with_names
from tallywork.session import materialise, scratch_path, write_rows

#: So many tables of found ids a search reads one by one; when there are more of a size, they are written as one.
SINGLY = 16


def degrees(lines: DataFrame, value: str = "value", count_trailing: bool = False) -> DataFrame:
    """(id, degree): neighbours named on all the lines of a node.

    ``count_trailing`` counts every blank as a separator, so that a blank at the end of a line
    counts as one more neighbour.
    """
    fields = blank_fields(F.col(value)).alias("fields")
    counted = F.split(F.col(value), " ") if count_trailing else F.col("fields")
    return (
        lines.select(fields, value)
        .select(F.get("fields", F.lit(0)).try_cast("long").alias("id"), (F.size(counted) - 1).alias("named"))
        .groupBy("id")
        # Lines without an id are dropped by a count, which Spark does not push below the split.
        .agg(F.sum("named").alias("degree"), F.count("id").alias("_lines"))
        .filter(F.col("_lines") > 0)
        .drop("_lines")
    )


def most_connected(degree: DataFrame, names: DataFrame, name: str = "name") -> DataFrame:
    """The node of the highest degree (the smallest id among equals) with its name."""
    return with_names(degree.orderBy(F.desc("degree"), "id").limit(1), names, "id", "id", name)


def of_degree(degree: DataFrame, names: DataFrame, wanted: int = 1, name: str = "name") -> DataFrame:
    """Named nodes of exactly the wanted degree, by id."""
    return _named(degree.filter(F.col("degree") == wanted), names, name)


def _named(chosen: DataFrame, names: DataFrame, name: str) -> DataFrame:
    """Nodes that have a name, by id.

    Ids are never NULL here. The null-safe comparison says so without a NOT NULL filter, which
    Spark would push below the split of the lines.
    """
    lookup = names.select(F.col("id").alias("_id"), name)
    return chosen.join(lookup, F.col("id").eqNullSafe(F.col("_id"))).drop("_id").orderBy("id")


def least_connected(
    degree: DataFrame, names: DataFrame, at_least: int = 0, name: str = "name"
) -> DataFrame:
    """Named nodes of the lowest degree of all nodes (not of those of one neighbour) that is ``at_least`` so high, by id.

    The degrees are used twice, so they are written first. The lowest one is a scalar subquery:
    one value, no join and no trip to the driver.
    """
    degree = materialise(degree, "degrees")
    lowest = degree.filter(F.col("degree") >= at_least).select(F.min("degree")).scalar()
    return _named(degree.filter(F.col("degree") == lowest), names, name)


def breadth_first(
    edges: DataFrame, source: int, target: int | None = None, max_rounds: int | None = 10
) -> DataFrame:
    """(id, distance, hits) of the nodes within ``max_rounds`` steps of ``source``; None searches to the end.

    ``hits`` is how many edges led to the node in the round that found it, repeated edges
    counted each time. With a ``target`` the search ends in the round that finds it. A target that is the source
    itself is found at distance 0 with no hits; ``separation`` tells when an edge first leads back to it.

    Each round is one job that writes its new nodes to the shared folder; nothing is kept in
    executors. The next round joins that table with the edges: its size on disk decides between
    a broadcast and a shuffle, and a hub that makes a shuffle partition large is split by the
    adaptive skew join. Counts per reached node are added up before they are shuffled. The ids of
    earlier rounds are put together now and then, so that a deep search does not read a table per round in every round.
    """
    return _search(edges, source, target, max_rounds)[0]


def _search(
    edges: DataFrame, source: int, target: int | None, max_rounds: int | None
) -> tuple[DataFrame, DataFrame, bool]:
    """The nodes found, the written edges, and whether the last round still found new nodes that lead on."""
    spark = edges.sparkSession
    graph = materialise(edges.groupBy("src", "dst").agg(F.count("*").alias("edges")), "edges")
    root = scratch_path(spark, "search")
    # The distance is read from the folder name. As a literal in the plan it would make Spark
    # compile new code in every round.
    reader = spark.read.schema("id long, hits long, distance int").option("basePath", root)

    rounds = [f"{root}/distance=0"]
    spark.createDataFrame([(source, 0)], "id long, hits long").write.parquet(rounds[0])
    seen = [rounds[:]]
    distance, open_ = 0, True
    while open_ and (max_rounds is None or distance < max_rounds) and not (target == source and distance == 0):
        distance += 1
        frontier = reader.parquet(rounds[-1]).select(F.col("id").alias("src"))
        reached = (
            graph.join(frontier, "src")
            .groupBy(F.col("dst").alias("id"))
            .agg(F.sum("edges").alias("hits"))
        )
        fresh = reached.join(_ids(spark, *chain(*seen)), "id", "left_anti")
        rounds.append(f"{root}/distance={distance}")
        write_rows(fresh.select("id", "hits"), rounds[-1])
        _note(spark, seen, rounds[-1])

        found = (
            reader.parquet(rounds[-1])
            .agg(F.count("*").alias("n"), F.count_if(F.col("id") == F.lit(target)).alias("target"))
            .first()
        )
        open_ = found["n"] > 0
        if found["target"] > 0:
            break
    return reader.parquet(*rounds).select("id", "distance", "hits"), graph, open_


def _ids(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.schema("id long").parquet(*paths)


def _note(spark: SparkSession, seen: list[list[str]], path: str) -> None:
    """Add a written round to the paths of found ids, which go by size: a table of one size takes in ``SINGLY`` + 1 of the size below.

    So an id is written again as often as the logarithm of the rounds says, and as few paths are read.
    """
    for paths in seen:
        paths.append(path)
        if len(paths) <= SINGLY:
            return
        path = scratch_path(spark, "seen")
        write_rows(_ids(spark, *paths), path)
        paths.clear()
    seen.append([path])


def distances(
    nodes: DataFrame, edges: DataFrame, source: int, max_rounds: int | None = None
) -> DataFrame:
    """(id, distance, open) of every node.

    The search goes on to its end, so a NULL distance means that no path leads there. Where ``max_rounds`` ends it
    before, ``open`` is true where NULL may be for want of rounds only: the last one allowed still found new nodes.
    """
    reached, _, open_ = _search(edges, source, None, max_rounds)
    joined = nodes.select("id").join(reached.select("id", "distance"), "id", "left")
    return joined.withColumn("open", F.col("distance").isNull() & F.lit(open_))


def separation(
    edges: DataFrame, source: int, target: int, max_rounds: int | None = 10
) -> DataFrame:
    """(id, distance, hits) of the target: one row, none if it is not reached.

    Where the target is the source, the distance is that of the shortest way back to it, with the edges that close it
    as hits: one round more than the nearest node with an edge to the source.
    """
    if source != target:
        return meet(edges, source, target, max_rounds)[0]
    limit = None if max_rounds is None else max_rounds - 1
    reached, graph, _ = _search(edges, source, None, limit)
    back = graph.filter(F.col("dst") == target).select(F.col("src").alias("id"), "edges").join(reached, "id")
    ways = back.groupBy("distance").agg(F.sum("edges").alias("hits")).orderBy("distance").limit(1)
    return ways.select(F.lit(target).cast("long").alias("id"), (F.col("distance") + 1).alias("distance"), "hits")


def meet(
    edges: DataFrame, source: int, target: int, max_rounds: int | None = 10
) -> tuple[DataFrame, int]:
    """(id, distance, hits) of the target as in ``separation``, and how many edges the search joined.

    The search goes on from both ends, each round from the end whose last nodes have fewer edges, until a new node is among the last
    ones of the other end. The hits are the edges into the target from nodes one step nearer to the source: they are
    found by going on from where the ends met, over nodes of the other end's search only.

    A round writes its new nodes with the number of their edges onwards; the sum tells what the next round from this end joins.
    """
    spark = edges.sparkSession
    graph = materialise(edges.groupBy("src", "dst").agg(F.count("*").alias("edges")), "edges")
    near = _End(spark, graph.select(F.col("src").alias("from"), F.col("dst").alias("to")), source)
    far = _End(spark, graph.select(F.col("dst").alias("from"), F.col("src").alias("to")), target)
    joined, met = 0, None
    while max_rounds is None or near.rounds + far.rounds < max_rounds:
        if not (near.width and far.width):
            break
        grown, other = (near, far) if near.width <= far.width else (far, near)
        joined += grown.width
        grown.grow()
        common = grown.last().join(other.last().select("id"), "id", "left_semi").select("id")
        if not common.isEmpty():
            met = materialise(common, "met")
            break
    if met is None:
        return spark.createDataFrame([], "id long, distance int, hits long"), joined
    distance = near.rounds + far.rounds
    if far.rounds == 0:
        before = near.level(near.rounds - 1)
    else:
        before = met
        for level in range(far.rounds - 1, 0, -1):
            step = graph.join(before.select(F.col("id").alias("src")), "src").select(F.col("dst").alias("id")).distinct()
            before = step.join(far.level(level).select("id"), "id", "left_semi")
    into = graph.filter(F.col("dst") == target).join(before.select(F.col("id").alias("src")), "src", "left_semi")
    found = into.agg(F.sum("edges").alias("hits"))
    return found.select(F.lit(target).cast("long").alias("id"), F.lit(distance).alias("distance"), "hits"), joined


class _End:
    """One end of a search: written nodes by round, and the number of edges onwards from the last ones."""

    def __init__(self, spark, arcs: DataFrame, start: int) -> None:
        self._arcs = arcs
        self._degrees = materialise(arcs.groupBy(F.col("from").alias("id")).agg(F.count("*").alias("onwards")), "degrees")
        self._root = scratch_path(spark, "end")
        self._reader = spark.read.schema("id long, onwards long, distance int").option("basePath", self._root)
        self.rounds = -1
        self._write(spark.createDataFrame([(start,)], "id long"))

    def _write(self, fresh: DataFrame) -> None:
        self.rounds += 1
        counted = fresh.join(self._degrees, "id", "left").select("id", F.coalesce("onwards", F.lit(0).cast("long")).alias("onwards"))
        counted.write.parquet(f"{self._root}/distance={self.rounds}")
        self.width = self.last().agg(F.sum("onwards")).first()[0] or 0

    def level(self, number: int) -> DataFrame:
        return self._reader.parquet(f"{self._root}/distance={number}")

    def last(self) -> DataFrame:
        return self.level(self.rounds)

    def grow(self) -> None:
        reached = self._arcs.join(self.last().select(F.col("id").alias("from")), "from").select(F.col("to").alias("id"))
        seen = self._reader.parquet(*[f"{self._root}/distance={k}" for k in range(self.rounds + 1)])
        self._write(reached.distinct().join(seen.select("id"), "id", "left_anti"))
