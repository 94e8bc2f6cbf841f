"""Regression and recommendation on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    DecisionTreeRegressor,
    LinearRegression,
    LinearRegressionModel,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.operators.aggregates import with_names
from tallywork.operators.recommendations import best_items, inner
from tallywork.operators.splits import numbered
from tallywork.session import materialise


def assemble(df: DataFrame, features: Sequence[str], label: str, *keep: str) -> DataFrame:
    """(features, label) and what to ``keep``: the feature columns as one vector."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return assembler.transform(df).select("features", F.col(label).cast("double").alias("label"), *keep)


def fit_line(
    examples: DataFrame,
    max_iter: int = 10,
    reg_param: float = 0.3,
    elastic_net: float = 0.8,
    tol: float = 1e-6,
) -> LinearRegressionModel:
    """Elastic-net linear regression.

    With up to 4,096 features Spark sums the normal equations in one pass over the rows and
    iterates on that small matrix only.
    """
    return LinearRegression(
        maxIter=max_iter, regParam=reg_param, elasticNetParam=elastic_net, tol=tol
    ).fit(examples)


def line_terms(model: LinearRegressionModel, examples: DataFrame, features: Sequence[str]) -> DataFrame:
    """(term, value): the intercept and one slope per feature."""
    terms = [("intercept", float(model.intercept))]
    terms += [(name, float(slope)) for name, slope in zip(features, model.coefficients)]
    return examples.sparkSession.createDataFrame(terms, "term string, value double")


def fit_tree(examples: DataFrame, **params: object) -> DecisionTreeRegressionModel:
    """Decision-tree regression with Spark's defaults unless ``params`` say otherwise."""
    return DecisionTreeRegressor(featuresCol="features", labelCol="label", **params).fit(examples)


def predict(model: LinearRegressionModel | DecisionTreeRegressionModel, examples: DataFrame) -> DataFrame:
    """(prediction, label) of each example."""
    return model.transform(examples).select("prediction", "label")


def regression_metrics(scored: DataFrame) -> DataFrame:
    """(metric, value): rmse, mse, r2 and mae from one pass over (prediction, label)."""
    miss = F.col("label") - F.col("prediction")
    sums = scored.agg(
        F.avg(miss * miss).alias("mse"),
        F.avg(F.abs(miss)).alias("mae"),
        F.var_pop("label").alias("spread"),
    )
    wide = sums.select(
        F.sqrt("mse").alias("rmse"),
        "mse",
        F.when(F.col("spread") != 0, 1 - F.col("mse") / F.col("spread")).alias("r2"),
        "mae",
    )
    return wide.unpivot([], ["rmse", "mse", "r2", "mae"], "metric", "value")


@dataclass(frozen=True)
class Recommender:
    """Fitted factors, with the numbers that stand for users and items."""

    model: ALSModel
    users: DataFrame
    items: DataFrame
    user: str
    item: str


def fit_recommender(
    ratings: DataFrame,
    user: str,
    item: str,
    rating: str,
    max_iter: int = 5,
    reg_param: float = 0.01,
    seed: int = 42,
) -> Recommender:
    """Alternating least squares on explicit ratings.

    Spark's ALS takes ids of 32 bits only, so users and items are numbered first (fewer than 2^31 of each).
    Rows without a user, item or rating are left out.
    """
    given = ratings.select(user, item, F.col(rating).cast("float").alias(rating)).dropna()
    users, items = _numbered(given, user, "_user"), _numbered(given, item, "_item")
    rows = given.join(users, user).join(items, item).select("_user", "_item", rating)
    als = ALS(maxIter=max_iter, regParam=reg_param, userCol="_user", itemCol="_item", ratingCol=rating, seed=seed)
    return Recommender(als.fit(rows), users, items, user, item)


def _numbered(rows: DataFrame, column: str, number: str) -> DataFrame:
    """(column, number) of its distinct values; which has which number does not matter."""
    found = numbered(rows.select(column).distinct())
    return materialise(found.select(column, (F.col("position") - 1).cast("int").alias(number)), "numbered")


def normal_residuals(model: Recommender, ratings: DataFrame, rating: str, reg_param: float = 0.01) -> DataFrame:
    """(user, n, residual) per user: how far its factors are from solving the normal equations of the last half-step.

    A fit ends with the users' factors u given the items' v: (sum of v v' + reg n) u = sum of r v over the user's n ratings.
    ``residual`` is the largest difference of the two sides over all factors, as a share of the largest sum of |r v|.
    Both sides are summed by user in one pass; with u known, v (v'u - r) is added up and no matrix is formed.
    """
    user, item, rank = model.user, model.item, model.model.rank
    given = ratings.select(user, item, F.col(rating).cast("float").alias("_r")).dropna()
    u = model.model.userFactors.toDF("_user", "_u").join(model.users, "_user").select(user, "_u")
    v = model.model.itemFactors.toDF("_item", "_v").join(model.items, "_item").select(item, "_v")
    miss = inner("_u", "_v", rank) - F.col("_r")
    rows = given.join(v, item).join(u, user).withColumn("_miss", miss)
    sums = rows.groupBy(user).agg(
        F.count("*").alias("n"),
        F.first("_u").alias("_u"),
        *[F.sum(F.col("_miss") * F.col("_v")[k]).alias(f"_s{k}") for k in range(rank)],
        *[F.sum(F.abs(F.col("_r") * F.col("_v")[k])).alias(f"_b{k}") for k in range(rank)],
    )
    gaps = [F.abs(F.col(f"_s{k}") + F.col("n") * reg_param * F.col("_u")[k]) for k in range(rank)]
    whole = F.greatest(*[F.col(f"_b{k}") for k in range(rank)], F.lit(1e-30))
    return sums.select(user, "n", (F.greatest(*gaps) / whole).alias("residual"))


def recommend(
    model: Recommender,
    users: DataFrame,
    names: DataFrame,
    names_key: str,
    name: str,
    k: int = 10,
) -> DataFrame:
    """(user, item, rating, name): the ``k`` best items of each given user; unknown users have none."""
    user, item = model.user, model.item
    asked = users.select(user).distinct().join(model.users, user)
    asked = asked.join(model.model.userFactors.toDF("_user", "_u"), "_user")
    asked = asked.select(F.col(user).alias("user"), F.col("_u").alias("u"))
    offered = model.model.itemFactors.toDF("_item", "_v").join(model.items, "_item")
    offered = offered.select(F.col(item).alias("item"), F.col("_v").alias("v"))
    best = best_items(asked, offered, model.model.rank, k)
    found = best.select(
        F.col("user").alias(user), F.col("item").alias(item), F.col("score").cast("float").alias("rating")
    )
    return with_names(found, names, item, names_key, name).orderBy(user, F.desc("rating"), item)
