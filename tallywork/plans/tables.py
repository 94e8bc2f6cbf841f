"""Keyed aggregates, lookups and small queries over the contract tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywork.operators import aggregates, queries
from tallywork.plans.registry import query
from tallywork.sources.files import read_table


@query(
    "rating_histogram",
    "SELECT l_linenumber, count(*) AS n FROM lineitem GROUP BY l_linenumber",
)
def rating_histogram(spark, folder):
    return aggregates.histogram(read_table(spark, folder, "lineitem"), "l_linenumber")


@query(
    "item_counts",
    "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey",
)
def item_counts(spark, folder):
    return aggregates.popular(read_table(spark, folder, "lineitem"), "l_partkey", k=None)


@query(
    "popular_items",
    "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 10",
)
def popular_items(spark, folder):
    return aggregates.popular(read_table(spark, folder, "lineitem"), "l_partkey")


@query(
    "popular_items_named",
    """
    SELECT l_partkey, n, p_name FROM (
        SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 10
    ) LEFT JOIN part ON p_partkey = l_partkey
    """,
)
def popular_items_named(spark, folder):
    return aggregates.popular_named(
        read_table(spark, folder, "lineitem"),
        "l_partkey",
        read_table(spark, folder, "part"),
        "p_partkey",
        "p_name",
    )


@query(
    "item_counts_named",
    """
    SELECT l_partkey, n, p_name
    FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey)
    LEFT JOIN part ON p_partkey = l_partkey
    """,
)
def item_counts_named(spark, folder):
    return aggregates.popular_named(
        read_table(spark, folder, "lineitem"),
        "l_partkey",
        read_table(spark, folder, "part"),
        "p_partkey",
        "p_name",
        k=None,
    )


@query("name_lookup", "SELECT s_name FROM supplier WHERE s_suppkey = 5")
def name_lookup(spark, folder):
    return aggregates.name_of(read_table(spark, folder, "supplier"), "s_suppkey", 5, "s_name")


@query(
    "avg_by_key",
    """
    SELECT c_nationkey, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(c_acctbal) AS mean
    FROM customer GROUP BY c_nationkey
    """,
)
def avg_by_key(spark, folder):
    return aggregates.average_by_key(read_table(spark, folder, "customer"), "c_nationkey", "c_acctbal", scale=2)


@query(
    "spend_by_customer",
    """
    SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_spent
    FROM orders GROUP BY o_custkey
    """,
)
def spend_by_customer(spark, folder):
    totals = aggregates.spend_by_customer(read_table(spark, folder, "orders"), "o_custkey", "o_totalprice")
    return totals.withColumn("total_spent", F.col("total_spent").cast("double"))


@query(
    "top_spenders_ascending",
    """
    SELECT o_custkey, CAST(total AS DOUBLE) AS total_spent FROM (
        SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
        FROM orders GROUP BY o_custkey ORDER BY total, o_custkey LIMIT 10
    )
    """,
)
def top_spenders_ascending(spark, folder):
    totals = aggregates.spend_by_customer(
        read_table(spark, folder, "orders"), "o_custkey", "o_totalprice", ascending=True
    )
    return totals.limit(10).withColumn("total_spent", F.col("total_spent").cast("double"))


_LOWEST = "round(CAST(min(l_quantity) AS DOUBLE) * CAST(0.1 AS DOUBLE) * CAST(1.8 AS DOUBLE) + CAST(32 AS DOUBLE), 2)"
_HIGHEST = _LOWEST.replace("min(", "max(")


@query(
    "min_by_key",
    f"SELECT l_suppkey, {_LOWEST} AS lowest FROM lineitem WHERE l_returnflag = 'A' GROUP BY l_suppkey",
)
def min_by_key(spark, folder):
    return aggregates.lowest_by_key(
        read_table(spark, folder, "lineitem"), "l_suppkey", "l_returnflag", "l_quantity", "A"
    )


@query(
    "max_by_key",
    f"SELECT l_suppkey, {_HIGHEST} AS highest FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_suppkey",
)
def max_by_key(spark, folder):
    return aggregates.highest_by_key(
        read_table(spark, folder, "lineitem"), "l_suppkey", "l_returnflag", "l_quantity", "R"
    )


@query(
    "min_max_by_key",
    f"""
    SELECT l_suppkey, lowest, highest
    FROM (SELECT l_suppkey, {_LOWEST} AS lowest FROM lineitem WHERE l_returnflag = 'A' GROUP BY l_suppkey)
    JOIN (SELECT l_suppkey, {_HIGHEST} AS highest FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_suppkey)
    USING (l_suppkey)
    """,
)
def min_max_by_key(spark, folder):
    return aggregates.extremes_by_key(
        read_table(spark, folder, "lineitem"), "l_suppkey", "l_returnflag", "l_quantity", "A", "R"
    )


@query(
    "sql_range_filter",
    "SELECT p_partkey, p_name, p_size FROM part WHERE p_size >= 13 AND p_size <= 19",
)
def sql_range_filter(spark, folder):
    part = read_table(spark, folder, "part").select("p_partkey", "p_name", "p_size")
    return queries.in_range(part, "p_size", 13, 19)


@query(
    "sql_group_count",
    "SELECT p_size, count(*) AS n FROM part GROUP BY p_size",
)
def sql_group_count(spark, folder):
    part = read_table(spark, folder, "part")
    return queries.sql_over(part, "SELECT p_size, count(*) AS n FROM {people} GROUP BY p_size ORDER BY p_size")


@query("select_column", "SELECT p_name FROM part")
def select_column(spark, folder):
    return read_table(spark, folder, "part").select("p_name")


@query("select_filter_lt", "SELECT p_partkey, p_size FROM part WHERE p_size < 21")
def select_filter_lt(spark, folder):
    return queries.below(read_table(spark, folder, "part").select("p_partkey", "p_size"), "p_size", 21)


@query("group_count", "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand")
def group_count(spark, folder):
    return queries.rows_per_value(read_table(spark, folder, "part"), "p_brand")


@query("arith_projection", "SELECT p_name, p_size + 10 AS p_size_plus_10 FROM part")
def arith_projection(spark, folder):
    return queries.shifted(read_table(spark, folder, "part"), "p_name", "p_size", 10)


@query("string_filter", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 30")
def string_filter(spark, folder):
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return lines.filter("l_quantity > 30")


@query("substring_filter", "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'red')")
def substring_filter(spark, folder):
    return queries.containing(read_table(spark, folder, "part").select("p_partkey", "p_name"), "p_name", "red")


@query(
    "key_value_join",
    "SELECT o_orderkey, o_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
)
def key_value_join(spark, folder):
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_name")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")


@query(
    "several_aggregates",
    """
    SELECT l_suppkey, count(*) AS n, count(l_shipdate) AS shipped, min(l_quantity) AS least,
           max(l_quantity) AS most, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM lineitem GROUP BY l_suppkey
    """,
)
def several_aggregates(spark, folder):
    return (
        read_table(spark, folder, "lineitem")
        .groupBy("l_suppkey")
        .agg(
            F.count("*").alias("n"),
            F.count("l_shipdate").alias("shipped"),
            F.min("l_quantity").alias("least"),
            F.max("l_quantity").alias("most"),
            F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("total"),
        )
    )


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(spark, folder):
    return read_table(spark, folder, "lineitem").agg(F.count("*").alias("n"))
