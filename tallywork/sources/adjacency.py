"""Adjacency lists: a line holds a node id, then the ids of its neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions.text import blank_fields


def parse_adjacency(lines: DataFrame, value: str = "value") -> DataFrame:
    """(id, neighbours) per line, both NULL where a line does not start with a whole number.

    An id may take several lines. There is no filter on the id here: it would be pushed below the
    split, and each line would be split once for the test and once for the result.
    """
    fields = blank_fields(F.col(value)).alias("fields")
    node = F.get("fields", F.lit(0)).try_cast("long")
    named = F.transform(F.slice("fields", 2, F.size("fields")), lambda field: field.try_cast("long"))
    return lines.select(fields).select(
        node.alias("id"), F.when(node.isNotNull(), named).alias("neighbours")
    )


def edges_of(adjacency: DataFrame) -> DataFrame:
    """(src, dst), one row per neighbour named on a line, so repeats keep their number."""
    # The outer form keeps Spark from adding a size test that computes the array twice.
    return adjacency.select(
        F.col("id").alias("src"), F.explode_outer("neighbours").alias("dst")
    ).filter(F.col("dst").isNotNull())


def nodes_of(adjacency: DataFrame) -> DataFrame:
    """Every id that heads a line or is named on one."""
    return (
        adjacency.select(F.explode_outer(F.concat(F.array("id"), "neighbours")).alias("id"))
        .filter(F.col("id").isNotNull())
        .distinct()
    )
