"""The best items of many users from factors, without scoring every user against every item."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.session import materialise

# Far above the rounding of sums of products in doubles.
SLACK = 1 + 1e-9


def inner(left: str, right: str, rank: int) -> Column:
    """The inner product of two arrays of ``rank`` numbers, as one expression that compiles."""
    return reduce(add, [F.col(left)[k].cast("double") * F.col(right)[k].cast("double") for k in range(rank)])


def best_items(
    users: DataFrame, items: DataFrame, rank: int, k: int = 10, first: int = 256, growth: int = 8, part: int = 4096
) -> DataFrame:
    """(user, item, score): the ``k`` items with the highest inner products for each of ``users`` (user, u) among ``items`` (item, v).

    Items are taken in blocks, those with the largest norms first. A product is at most the product of the norms, so a user
    whose k-th best score is above that bound for the next block is finished and drops out; what the others still have to beat
    cuts their products before they are ranked. ``first`` is the (approximate) size of the first block, later ones are ``growth`` times the
    one before; blocks are cut into parts of about ``part`` items, and users meet a part through an equi-join on its number.

    The same rows as scoring all pairs: ties go to the smaller item. Users without a vector have no rows.
    """
    sized = items.where("v is not null").withColumn("norm", F.sqrt(inner("v", "v", rank)))
    sized = materialise(sized, "item-norms")
    edges = _edges(sized, first, growth)
    block = reduce(add, [(F.col("norm") < edge).cast("int") for edge in edges], F.lit(0))
    sized = sized.withColumn("block", block)
    # A row for each of the few blocks.
    blocks = sized.groupBy("block").agg(F.max("norm").alias("most"), F.count("*").alias("n")).orderBy("block").collect()

    asked = users.where("u is not null").withColumn("norm", F.sqrt(inner("u", "u", rank)))
    asked = materialise(asked.withColumn("least", F.lit(None).cast("double")), "asked")
    order = Window.partitionBy("user").orderBy(F.desc("score"), "item")
    best = None
    for number, own in enumerate(blocks):
        parts = -(-own.n // part)
        here = sized.filter(F.col("block") == own.block).select(
            "item", "v", F.pmod(F.xxhash64("item"), F.lit(parts)).cast("int").alias("part")
        )
        spread = asked.select("user", "u", "least", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
        scored = spread.join(here, "part").select("user", "item", inner("u", "v", rank).alias("score"), "least")
        found = scored.filter(F.col("least").isNull() | (F.col("score") >= F.col("least"))).drop("least")
        if best is not None:
            found = found.union(best)
        ranked = found.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k).drop("_rank")
        best = materialise(ranked, "best")
        if number + 1 == len(blocks):
            break
        reached = best.groupBy("user").agg(F.count("*").alias("_held"), F.min("score").alias("_least"))
        least = F.when(F.col("_held") >= k, F.col("_least"))
        bound = F.col("norm") * blocks[number + 1].most * SLACK
        asked = (
            asked.drop("least")
            .join(reached, "user", "left")
            .withColumn("least", least)
            .drop("_held", "_least")
            .filter(F.col("least").isNull() | (F.col("least") <= bound))
        )
        asked = materialise(asked, "asked")
        if asked.isEmpty():
            break
    if best is None:
        fields = [users.schema["user"], items.schema["item"], T.StructField("score", T.DoubleType())]
        return users.sparkSession.createDataFrame([], T.StructType(fields))
    return best


def _edges(sized: DataFrame, first: int, growth: int) -> list[float]:
    """Norms between the blocks, the largest first; from quantiles, so blocks have about the sizes asked for."""
    n, fractions, taken, size = sized.count(), [], first, first * growth
    while taken < n:
        fractions.append(1 - taken / n)
        taken, size = taken + size, size * growth
    if not fractions:
        return []
    found = sized.agg(F.percentile_approx("norm", fractions, 10_000)).first()[0]
    return sorted(set(found), reverse=True)
