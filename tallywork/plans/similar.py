"""Similarity over the contract tables: each line item is an order's rating of a supplier by quantity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.operators import similarity
from tallywork.plans.registry import query
from tallywork.session import scratch_path
from tallywork.sinks import save
from tallywork.sources.files import read_table

TARGET = 5
COLUMNS = {"user": "l_orderkey", "item": "l_suppkey", "rating": "l_quantity"}


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem")


def _nine(df: DataFrame) -> DataFrame:
    return df.withColumn("score", F.round("score", 9))


_RATINGS = "SELECT l_orderkey AS u, l_suppkey AS i, l_quantity AS r FROM lineitem"
_COSINE = f"""
    SELECT item1, item2, n, CASE WHEN xx * yy <> 0 THEN xy / (sqrt(xx) * sqrt(yy)) ELSE 0 END AS score
    FROM (
        SELECT a.i AS item1, b.i AS item2, count(*) AS n,
               sum(a.r * a.r) AS xx, sum(b.r * b.r) AS yy, sum(a.r * b.r) AS xy
        FROM ({_RATINGS}) a JOIN ({_RATINGS}) b ON a.u = b.u AND a.i < b.i
        GROUP BY a.i, b.i
    )
"""


def _sets(rating_over: int) -> str:
    return f"SELECT DISTINCT l_orderkey AS u, l_suppkey AS i FROM lineitem WHERE l_quantity > {rating_over}"


def _common(rating_over: int) -> str:
    return f"""
    SELECT a.i AS item1, b.i AS item2, count(*) AS n
    FROM ({_sets(rating_over)}) a JOIN ({_sets(rating_over)}) b ON a.u = b.u AND a.i < b.i
    GROUP BY a.i, b.i
    """


def _jaccard_sql(rating_over: int) -> str:
    return f"""
    SELECT item1, item2, n, c1.c AS count1, c2.c AS count2, n / CAST(c1.c + c2.c - n AS DOUBLE) AS score
    FROM ({_common(rating_over)})
    JOIN (SELECT i, count(*) AS c FROM ({_sets(rating_over)}) GROUP BY i) c1 ON c1.i = item1
    JOIN (SELECT i, count(*) AS c FROM ({_sets(rating_over)}) GROUP BY i) c2 ON c2.i = item2
    WHERE c1.c > 10 AND c2.c > 10 AND n > 1
    """


def _best_sql(pairs: str, score_over: float, pairs_over: int) -> str:
    return f"""
    SELECT item, round(score, 9) AS score, n, s_name FROM (
        SELECT CASE WHEN item1 = {TARGET} THEN item2 ELSE item1 END AS item, score, n FROM ({pairs})
        WHERE (item1 = {TARGET} OR item2 = {TARGET}) AND score > {score_over} AND n > {pairs_over}
        ORDER BY score DESC, n DESC, item LIMIT 10
    ) LEFT JOIN supplier ON s_suppkey = item
    """


@query("item_pairs", _common(0))
def item_pairs(spark, folder):
    return similarity.common_raters(ratings(spark, folder), **COLUMNS)


@query(
    "similarity_jaccard",
    f"SELECT item1, item2, n, count1, count2, round(score, 9) AS score FROM ({_jaccard_sql(25)})",
)
def similarity_jaccard(spark, folder):
    return _nine(similarity.jaccard_pairs(ratings(spark, folder), **COLUMNS, rating_over=25))


@query(
    "similarity_cosine",
    f"SELECT item1, item2, n, round(score, 9) AS score FROM ({_COSINE})",
)
def similarity_cosine(spark, folder):
    """Every pair with a common user."""
    return _nine(similarity.cosine_pairs(ratings(spark, folder), **COLUMNS))


@query(
    "similarity_cosine_over_20",
    f"SELECT item1, item2, n, round(score, 9) AS score FROM ({_COSINE}) WHERE n > 20",
)
def similarity_cosine_over_20(spark, folder):
    """Pairs with more than 20 common users."""
    return _nine(similarity.cosine_pairs(ratings(spark, folder), **COLUMNS, pairs_over=20))


@query(
    "similarity_cosine_frequent",
    f"SELECT item1, item2, n, round(score, 9) AS score FROM ({_COSINE}) WHERE n > 5",
)
def similarity_cosine_frequent(spark, folder):
    return _nine(similarity.cosine_pairs(ratings(spark, folder), **COLUMNS, pairs_over=5))


@query(
    "top_partners",
    f"""
    WITH pairs AS (SELECT item1, item2, n, round(score, 9) AS score FROM ({_COSINE})),
    sides AS (
        SELECT item1 AS item, item2 AS partner, n, score FROM pairs
        UNION ALL SELECT item2, item1, n, score FROM pairs
    )
    SELECT * FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, n DESC, partner) AS INTEGER) AS rank
        FROM sides
    ) WHERE rank <= 10
    """,
)
def top_partners(spark, folder):
    """The ten best partners of every item, by rounded scores so that ties are the same everywhere."""
    return similarity.top_partners_per_item(_nine(similarity.cosine_pairs(ratings(spark, folder), **COLUMNS)))


def _names(spark: SparkSession, folder: str) -> dict:
    return {"names": read_table(spark, folder, "supplier"), "names_key": "s_suppkey", "name": "s_name"}


@query("similar_items_jaccard", _best_sql(_jaccard_sql(25), 0.001, 1))
def similar_items_jaccard(spark, folder):
    return _nine(
        similarity.similar_by_jaccard(
            ratings(spark, folder), TARGET, **COLUMNS, rating_over=25, score_over=0.001, pairs_over=1,
            **_names(spark, folder),
        )
    )


@query("similar_items_cosine", _best_sql(_COSINE, 0.5, 1))
def similar_items_cosine(spark, folder):
    return _nine(
        similarity.similar_by_cosine(
            ratings(spark, folder), TARGET, **COLUMNS, score_over=0.5, pairs_over=1, **_names(spark, folder)
        )
    )


@query("similar_items_saved", _best_sql(_COSINE, 0.5, 1))
def similar_items_saved(spark, folder):
    """Save the pair table laid out by item, then ask the saved table for the best partners."""
    path = scratch_path(spark, "pairs")
    similarity.save_pairs(similarity.cosine_pairs(ratings(spark, folder), **COLUMNS), path)
    return _nine(
        similarity.similar_in_saved(spark, path, TARGET, score_over=0.5, pairs_over=1, **_names(spark, folder))
    )


@query("similar_items_sorted", _best_sql(_COSINE, 0.5, 1))
def similar_items_sorted(spark, folder):
    """Save the pair table sorted by pair, then ask the saved table for the best partners."""
    path = scratch_path(spark, "pairs")
    pairs = similarity.cosine_pairs(ratings(spark, folder), **COLUMNS)
    save(pairs, path, sort_by=("item1", "item2"))
    return _nine(
        similarity.similar_in_table(
            spark.read.parquet(path), TARGET, score_over=0.5, pairs_over=1, **_names(spark, folder)
        )
    )
