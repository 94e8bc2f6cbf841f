import random

import duckdb
import pytest

from helpers import rows
from tallywork.operators import graph
from tallywork.plans.contract import ORACLES, QUERIES
from tallywork.sources.adjacency import edges_of, nodes_of, parse_adjacency


def adjacency(spark, *lines):
    return spark.createDataFrame([(line,) for line in lines], ["value"])


def test_degrees_add_up_over_lines(spark):
    lines = adjacency(spark, "1 2 3 ", "1 4", "2 1", "5", "x 9")
    assert rows(graph.degrees(lines)) == [(1, 3), (2, 1), (5, 0)]
    assert rows(graph.degrees(lines, count_trailing=True)) == [(1, 4), (2, 1), (5, 0)]


def test_most_and_least_connected(spark):
    degree = graph.degrees(adjacency(spark, "1 2 3", "2 1 3", "3 1", "4 1", "5", "7 3"))
    names = spark.createDataFrame([(1, "one"), (3, "three"), (4, "four"), (5, "five")], ["id", "name"])
    assert rows(graph.most_connected(degree, names)) == [(1, 2, "one")]
    assert [tuple(r) for r in graph.of_degree(degree, names).collect()] == [(3, 1, "three"), (4, 1, "four")]
    assert rows(graph.least_connected(degree, names)) == [(5, 0, "five")]
    assert rows(graph.least_connected(degree, names, at_least=1)) == [(3, 1, "three"), (4, 1, "four")]


def test_search_counts_repeated_edges_of_the_first_round_only(spark):
    lines = adjacency(spark, "1 2 3 2", "2 4 4", "3 4", "2 4", "4 5", "5 4", "9 1")
    edges = edges_of(parse_adjacency(lines))
    assert rows(graph.breadth_first(edges, 1)) == [
        (1, 0, 0),
        (2, 1, 2),
        (3, 1, 1),
        (4, 2, 4),
        (5, 3, 1),
    ]
    assert rows(graph.separation(edges, 1, 4)) == [(4, 2, 4)]
    assert rows(graph.separation(edges, 1, 9)) == []
    nodes = nodes_of(parse_adjacency(lines))
    assert (9, None, False) in rows(graph.distances(nodes, edges, 1))


def test_search_stops_at_the_round_limit(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)], ["src", "dst"])
    assert rows(graph.separation(edges, 0, 4, max_rounds=3)) == []
    assert rows(graph.breadth_first(edges, 0, max_rounds=3))[-1] == (3, 3, 1)


def plain_search(edges, source):
    found, front = {source: (0, 0)}, {source}
    for distance in range(1, 11):
        hits = {}
        for a, b in edges:
            if a in front and b not in found:
                hits[b] = hits.get(b, 0) + 1
        found.update({node: (distance, n) for node, n in hits.items()})
        front = set(hits)
    return sorted((node, *rest) for node, rest in found.items())


@pytest.mark.parametrize("seed,hub", [(1, False), (2, True)])
def test_search_equals_plain_search(spark, seed, hub):
    draw = random.Random(seed)
    edges = [(draw.randrange(60), draw.randrange(60)) for _ in range(75)]
    if hub:
        edges += [(7, draw.randrange(60)) for _ in range(60)]
    edges.append((0, 7))
    got = graph.breadth_first(spark.createDataFrame(edges, ["src", "dst"]), 0)
    assert sorted(tuple(r) for r in got.collect()) == plain_search(edges, 0)


def test_search_to_the_end_and_open_frontiers(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(15)], ["src", "dst"])
    nodes = spark.range(17)
    full = rows(graph.distances(nodes, edges, 0, max_rounds=None))
    assert full[12] == (12, 12, False) or (12, 12, False) in full
    assert (16, None, False) in full
    cut = rows(graph.distances(nodes, edges, 0, max_rounds=10))
    assert (12, None, True) in cut and (10, 10, False) in cut


def test_way_back_to_the_source(spark):
    edges = spark.createDataFrame([(1, 2), (2, 1), (2, 1), (1, 3), (3, 1)], ["src", "dst"])
    assert rows(graph.separation(edges, 1, 1)) == [(1, 2, 3)]
    assert rows(graph.separation(spark.createDataFrame([(1, 2)], ["src", "dst"]), 1, 1)) == []
    assert rows(graph.separation(spark.createDataFrame([(1, 1)], ["src", "dst"]), 1, 1)) == [(1, 1, 1)]


@pytest.mark.parametrize("seed", range(6))
def test_search_from_both_ends_equals_plain_search(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(50), draw.randrange(50)) for _ in range(draw.choice([60, 90, 140]))]
    edges += [(0, draw.randrange(50)) for _ in range(3)] + edges[:10]
    frame = spark.createDataFrame(edges, ["src", "dst"])
    plain = {node: (node, *rest) for node, *rest in plain_search(edges, 0)}
    for target in draw.sample(range(1, 50), 3):
        assert rows(graph.separation(frame, 0, target)) == ([plain[target]] if target in plain else [])


def test_search_from_both_ends_joins_fewer_edges(spark):
    """A hub near the source: from the other end the way is narrow."""
    edges = [(0, 1), *((1, k) for k in range(10, 400)), *((k, k + 400) for k in range(10, 400)), (450, 2), (2, 3), (3, 4)]
    found, joined = graph.meet(spark.createDataFrame(edges, ["src", "dst"]), 0, 4)
    assert rows(found) == [(4, 6, 1)] and joined < 10
    found, joined = graph.meet(spark.createDataFrame(edges, ["src", "dst"]), 0, 9)
    assert rows(found) == [] and joined == 0
    assert rows(graph.separation(spark.createDataFrame(edges, ["src", "dst"]), 0, 4, max_rounds=5)) == []
    assert rows(graph.separation(spark.createDataFrame(edges, ["src", "dst"]), 0, 4, max_rounds=None)) == [(4, 6, 1)]


def whole_search(edges, source):
    found, front, distance = {source: (0, 0)}, {source}, 0
    while front:
        distance, hits = distance + 1, {}
        for a, b in edges:
            if a in front and b not in found:
                hits[b] = hits.get(b, 0) + 1
        found.update({node: (distance, n) for node, n in hits.items()})
        front = set(hits)
    return found


def test_distances_go_to_the_end_unless_told_otherwise(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(14)], ["src", "dst"])
    assert rows(graph.distances(spark.range(16), edges, 0)) == sorted(
        [(i, i, False) for i in range(15)] + [(15, None, False)], key=repr
    )


def test_deep_search_equals_plain_search(spark, monkeypatch):
    """Ids of earlier rounds put together twice over; edges lead back to rounds of every such table."""
    monkeypatch.setattr(graph, "SINGLY", 2)
    draw = random.Random(5)
    edges = [(i, i + 1) for i in range(24)] + [(i, draw.randrange(i + 1)) for i in range(25) for _ in range(2)]
    edges += [(i, 100 + i) for i in range(0, 25, 2)] + [(100 + i, i + 1) for i in range(0, 24, 2)] + [(24, 0), (3, 4), (50, 0)]
    got = graph.breadth_first(spark.createDataFrame(edges, ["src", "dst"]), 0, max_rounds=None)
    assert {r.id: (r.distance, r.hits) for r in got.collect()} == whole_search(edges, 0)


def test_bfs_distances_goes_beyond_ten_rounds(spark, tmp_path):
    """Users one after the other, a way back, one user far off, and one whom no event leads to."""
    users = [*range(8, 23), 12, 40, 8, 60]
    types = ["a"] * 17 + ["b", "c"]
    events = spark.createDataFrame([(i, u, t) for i, (u, t) in enumerate(zip(users, types))], "event_id long, user_id long, event_type string")
    events.write.parquet(f"{tmp_path}/events.parquet")
    got = rows(QUERIES["bfs_distances"](spark, str(tmp_path)))
    assert got == sorted([(u, u - 8) for u in range(8, 23)] + [(40, 5), (60, None)], key=repr)
    tables = duckdb.connect()
    tables.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    assert sorted(tables.execute(ORACLES["bfs_distances"]).fetchall(), key=repr) == got
