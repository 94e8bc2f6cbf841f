"""Fitted trees as columns: which leaf a row falls into, without running the model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.regression import DecisionTreeRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Node:
    """A node by its place: 1 is the root, 2n and 2n + 1 are the children of n. Leaves have no feature."""

    place: int
    prediction: float
    feature: int | None = None
    threshold: float | None = None
    left: Node | None = None
    right: Node | None = None


def tree_of(model: DecisionTreeRegressionModel) -> Node:
    """The nodes of a fitted tree on continuous features; as many as the tree has, whatever the rows."""

    def read(node, place: int) -> Node:
        if node.subtreeDepth() == 0:
            return Node(place, node.prediction())
        split = node.split()
        left, right = read(node.leftChild(), 2 * place), read(node.rightChild(), 2 * place + 1)
        return Node(place, node.prediction(), split.featureIndex(), split.threshold(), left, right)

    return read(model._call_java("rootNode"), 1)


def leaf_of(tree: Node, features: Sequence[str]) -> Column:
    """The place of the leaf that a row falls into, from its feature columns.

    As in the model, values up to the threshold go left and NaN goes right. A NULL goes right too.
    """
    return _walk(tree, features, lambda node: F.lit(node.place).cast("long"))


def prediction_of(tree: Node, features: Sequence[str]) -> Column:
    """The model's prediction, as an expression that compiles with the rest of a query."""
    return _walk(tree, features, lambda node: F.lit(float(node.prediction)))


def _walk(node: Node, features: Sequence[str], value) -> Column:
    if node.left is None:
        return value(node)
    goes_left = F.coalesce(F.col(features[node.feature]).cast("double") <= node.threshold, F.lit(False))
    return F.when(goes_left, _walk(node.left, features, value)).otherwise(_walk(node.right, features, value))


def inner_nodes(tree: Node) -> list[Node]:
    """The nodes that split, from the root on."""
    if tree.left is None:
        return []
    return [tree, *inner_nodes(tree.left), *inner_nodes(tree.right)]


def leaves(rows: DataFrame, tree: Node, features: Sequence[str], label: str) -> DataFrame:
    """(leaf, n, prediction, mean) of the leaves that rows fall into; the mean is that of the rows."""
    placed = rows.select(leaf_of(tree, features).alias("leaf"), prediction_of(tree, features).alias("prediction"), F.col(label).alias("_y"))
    return placed.groupBy("leaf").agg(F.count("*").alias("n"), F.first("prediction").alias("prediction"), F.avg("_y").alias("mean"))


def splits(rows: DataFrame, tree: Node, features: Sequence[str]) -> DataFrame:
    """(node, feature, below, above) of the nodes that split: rows on either side, from one count per leaf."""
    counts = rows.groupBy(leaf_of(tree, features).alias("leaf")).agg(F.count("*").alias("n"))
    named = [(node.place, features[node.feature]) for node in inner_nodes(tree)]
    nodes = rows.sparkSession.createDataFrame(named, "node long, feature string")
    # A leaf is below every node whose place is a prefix of its own, in binary.
    above = F.expr(
        "explode(transform(sequence(1, length(bin(leaf)) - 1), "
        "k -> struct(shiftright(leaf, k) AS node, shiftright(leaf, k - 1) % 2 AS side)))"
    )
    counted = counts.filter(F.col("leaf") > 1).select("n", above.alias("_a")).groupBy(F.col("_a.node").alias("node")).agg(
        F.sum(F.when(F.col("_a.side") == 0, F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("_a.side") == 1, F.col("n")).otherwise(0)).alias("above"),
    )
    return nodes.join(counted, "node")
