"""Folds and holdouts over the orders table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywork.operators import splits
from tallywork.plans.registry import query
from tallywork.sources.files import read_table


def _orders(spark, folder):
    return read_table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice")


_FOLDS = "SELECT o_custkey, o_orderkey, CAST(ntile(5) OVER (ORDER BY o_custkey, o_orderkey) AS INTEGER) AS fold FROM orders"


@query("kfold_assign", _FOLDS)
def kfold_assign(spark, folder):
    rows = _orders(spark, folder).select("o_custkey", "o_orderkey")
    return splits.assign_folds(rows, ["o_custkey", "o_orderkey"], 5)


@query(
    "kfold_base_sizes",
    f"""
    WITH folds AS ({_FOLDS}), sizes AS (SELECT fold, count(*) AS n FROM folds GROUP BY fold)
    SELECT fold, n AS test_rows, CAST((SELECT sum(n) FROM sizes) - n AS BIGINT) AS base_rows FROM sizes
    """,
)
def kfold_base_sizes(spark, folder):
    """Rows of test and base set per fold."""
    folds = splits.assign_folds(_orders(spark, folder).select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"])
    sizes = folds.groupBy("fold").agg(F.count("*").alias("test_rows"))
    every = sizes.select(F.sum("test_rows")).scalar()
    return sizes.withColumn("base_rows", every - F.col("test_rows"))


def _ranked(start: int, stop: int) -> str:
    return f"""
    SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey)
        BETWEEN {start} AND {stop} AS is_test
    FROM orders
    """


@query("holdout_per_user", _ranked(1, 10))
def holdout_per_user(spark, folder):
    return splits.holdout_per_user(_orders(spark, folder), "o_custkey", ["o_orderkey"])


@query("holdout_second_ten", _ranked(11, 20))
def holdout_second_ten(spark, folder):
    return splits.holdout_per_user(_orders(spark, folder), "o_custkey", ["o_orderkey"], 11, 20)


@query(
    "holdout_limited",
    f"""
    SELECT o_custkey, o_orderkey, o_totalprice,
           is_test AND count(*) FILTER (WHERE is_test) OVER (ORDER BY o_orderkey) <= 1000 AS is_test
    FROM ({_ranked(1, 10)})
    """,
)
def holdout_limited(spark, folder):
    return splits.holdout_per_user(_orders(spark, folder), "o_custkey", ["o_orderkey"], max_test=1000)


@query(
    "random_split_sizes",
    """
    SELECT CASE WHEN CAST(('0x' || substr(md5(concat_ws('|', o_orderkey, '42')), 1, 8)) AS BIGINT) < 2147483648
           THEN 'first' ELSE 'second' END AS part, count(*) AS n
    FROM orders GROUP BY 1
    """,
)
def random_split_sizes(spark, folder):
    """Rows in each part of a seeded 50/50 split."""
    first, second = splits.random_parts(_orders(spark, folder), [0.5, 0.5], ["o_orderkey"])
    sizes = [
        part.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n")
        for name, part in (("first", first), ("second", second))
    ]
    return sizes[0].unionByName(sizes[1])


@query("random_split_whole", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders")
def random_split_whole(spark, folder):
    """The parts of a random split put together again."""
    first, second = splits.random_parts(_orders(spark, folder), [0.8, 0.2], ["o_orderkey"])
    return first.unionByName(second)
