"""Degrees and searches over adjacency lines made of the contract tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.operators import graph
from tallywork.plans.registry import query
from tallywork.session import materialise
from tallywork.sources.adjacency import edges_of, nodes_of, parse_adjacency
from tallywork.sources.files import read_table

SOURCE, TARGET = 8, 3


def _line_items(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")


def part_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A line per line item: part, supplier and, if returned, the order. Parts repeat."""
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_orderkey").cast("string"))
    return _line_items(spark, folder).select(
        F.concat_ws(" ", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), returned).alias("value")
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A line per line item: order and part, with a blank at the end."""
    return _line_items(spark, folder).select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit(" "), F.col("l_partkey").cast("string"), F.lit(" ")).alias(
            "value"
        )
    )


def part_names(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))


def order_names(spark: SparkSession, folder: str) -> DataFrame:
    """An order goes by the name of its customer."""
    orders = read_table(spark, folder, "orders")
    customers = read_table(spark, folder, "customer")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id"), F.col("c_name").alias("name")
    )


def follow_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A line per event: its user and, if the next event is of the same type, that one's user."""
    events = read_table(spark, folder, "events").select("event_id", "user_id", "event_type")
    after = events.select(
        (F.col("event_id") - 1).alias("event_id"), "event_type", F.col("user_id").alias("next_user")
    )
    return events.join(after, ["event_id", "event_type"], "left").select(
        F.concat_ws(" ", F.col("user_id").cast("string"), F.col("next_user").cast("string")).alias("value")
    )


_PART_DEGREE = """
    SELECT l_partkey AS id, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END) AS BIGINT) AS degree
    FROM lineitem GROUP BY l_partkey
"""
_ORDER_DEGREE = "SELECT l_orderkey AS id, count(*) AS degree FROM lineitem GROUP BY l_orderkey"
_FOLLOWS = """
    SELECT a.user_id AS src, b.user_id AS dst
    FROM events a JOIN events b ON b.event_id = a.event_id + 1 AND b.event_type = a.event_type
"""
_SEARCH = f"""
    WITH RECURSIVE follows AS ({_FOLLOWS}),
    walk(id, distance) AS (
        SELECT CAST({SOURCE} AS BIGINT), 0
        UNION
        SELECT dst, distance + 1 FROM walk JOIN follows ON src = id WHERE distance < 10
    ),
    found AS (SELECT id, min(distance) AS distance FROM walk GROUP BY id)
"""
# To the end: a user's row is written once, in the step that first comes to them, so the walk ends by itself.
_SEARCH_ALL = f"""
    WITH RECURSIVE follows AS ({_FOLLOWS}),
    found(id, distance) USING KEY (id) AS (
        SELECT CAST({SOURCE} AS BIGINT), 0
        UNION
        SELECT dst, min(distance) + 1 FROM found JOIN follows ON src = id
        WHERE dst IS NOT NULL AND dst NOT IN (SELECT id FROM recurring.found)
        GROUP BY dst
    )
"""


@query(
    "adjacency_edges",
    """
    SELECT src, dst, count(*) AS n FROM (
        SELECT l_partkey AS src, l_suppkey AS dst FROM lineitem
        UNION ALL SELECT l_partkey, l_orderkey FROM lineitem WHERE l_returnflag = 'R'
    ) GROUP BY src, dst
    """,
)
def adjacency_edges(spark, folder):
    edges = edges_of(parse_adjacency(part_lines(spark, folder)))
    return edges.groupBy("src", "dst").agg(F.count("*").alias("n"))


@query(
    "adjacency_nodes",
    """
    SELECT l_partkey AS id FROM lineitem UNION SELECT l_suppkey FROM lineitem
    UNION SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'
    """,
)
def adjacency_nodes(spark, folder):
    return nodes_of(parse_adjacency(part_lines(spark, folder)))


@query("tabbed_degree", "SELECT o_orderkey AS id, CAST(2 AS BIGINT) AS degree FROM orders")
def tabbed_degree(spark, folder):
    """Lines that begin, end and are separated by tabs and blanks."""
    orders = read_table(spark, folder, "orders")
    key, customer = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    return graph.degrees(orders.select(F.concat(F.lit("\t "), key, F.lit(" \t"), customer, F.lit("\t"), customer, F.lit("\t")).alias("value")))


@query("node_degree", _PART_DEGREE)
def node_degree(spark, folder):
    return graph.degrees(part_lines(spark, folder))


@query("node_degree_trailing", "SELECT l_orderkey AS id, 2 * count(*) AS degree FROM lineitem GROUP BY l_orderkey")
def node_degree_trailing(spark, folder):
    return graph.degrees(order_lines(spark, folder), count_trailing=True)


@query(
    "most_connected",
    f"""
    SELECT id, degree, p_name AS name
    FROM (SELECT * FROM ({_PART_DEGREE}) ORDER BY degree DESC, id LIMIT 1) LEFT JOIN part ON p_partkey = id
    """,
)
def most_connected(spark, folder):
    return graph.most_connected(graph.degrees(part_lines(spark, folder)), part_names(spark, folder))


@query(
    "least_connected_one",
    f"""
    SELECT id, degree, c_name AS name FROM ({_ORDER_DEGREE})
    JOIN orders ON o_orderkey = id JOIN customer ON c_custkey = o_custkey
    WHERE degree = 1
    """,
)
def least_connected_one(spark, folder):
    return graph.of_degree(graph.degrees(order_lines(spark, folder)), order_names(spark, folder))


@query(
    "least_connected_min",
    f"""
    WITH d AS ({_PART_DEGREE})
    SELECT id, degree, p_name AS name FROM d JOIN part ON p_partkey = id
    WHERE degree = (SELECT min(degree) FROM d)
    """,
)
def least_connected_min(spark, folder):
    return graph.least_connected(graph.degrees(part_lines(spark, folder)), part_names(spark, folder))


@query(
    "bfs_distances",
    f"""
    {_SEARCH_ALL}
    SELECT users.user_id AS id, found.distance
    FROM (SELECT DISTINCT user_id FROM events) users LEFT JOIN found ON found.id = users.user_id
    """,
)
def bfs_distances(spark, folder):
    """The search to its end, so that nothing is open."""
    adjacency = materialise(parse_adjacency(follow_lines(spark, folder)), "adjacency")
    return graph.distances(nodes_of(adjacency), edges_of(adjacency), SOURCE, max_rounds=None).drop("open")


@query(
    "bfs_all_distances",
    f"""
    {_SEARCH.replace("distance < 10", "distance < 30")}
    SELECT users.user_id AS id, found.distance, false AS open
    FROM (SELECT DISTINCT user_id FROM events) users LEFT JOIN found ON found.id = users.user_id
    """,
)
def bfs_all_distances(spark, folder):
    """The search to its end; on these tables that is far below the SQL's 30 rounds."""
    adjacency = materialise(parse_adjacency(follow_lines(spark, folder)), "adjacency")
    return graph.distances(nodes_of(adjacency), edges_of(adjacency), SOURCE, max_rounds=None)


@query(
    "bfs_hits",
    f"""
    {_SEARCH}
    SELECT t.id, t.distance, count(*) AS hits
    FROM found t JOIN follows ON dst = t.id JOIN found s ON s.id = src AND s.distance = t.distance - 1
    WHERE t.id = {TARGET} GROUP BY t.id, t.distance
    """,
)
def bfs_hits(spark, folder):
    return graph.separation(edges_of(parse_adjacency(follow_lines(spark, folder))), SOURCE, TARGET)
