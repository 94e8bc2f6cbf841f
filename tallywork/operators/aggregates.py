"""Keyed counts, averages, sums and extremes.

Every operator here aggregates before it shuffles (partial sums in the map tasks), so one key
that holds a large part of the rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.functions.scalars import exact, fahrenheit_from_tenths


def histogram(df: DataFrame, value: str) -> DataFrame:
    """Rows per value, in order of the value."""
    return df.groupBy(value).agg(F.count("*").alias("n")).orderBy(value)


def popular(df: DataFrame, key: str, k: int | None = 10) -> DataFrame:
    """Keys with the most rows, ties by key; ``k`` None for all of them."""
    ranked = _counts(df, key).orderBy(F.desc("n"), key)
    return ranked if k is None else ranked.limit(k)


def _counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"))


def with_names(df: DataFrame, names: DataFrame, key: str, names_key: str, name: str) -> DataFrame:
    """Add ``name`` by key, NULL where there is none.

    No broadcast hint: Spark broadcasts ``names`` when its size allows and shuffles otherwise.
    """
    lookup = names.select(F.col(names_key).alias("_key"), name)
    return df.join(lookup, df[key] == lookup["_key"], "left").drop("_key")


def popular_named(
    df: DataFrame, key: str, names: DataFrame, names_key: str, name: str, k: int | None = 10
) -> DataFrame:
    """``popular`` with names; only the ``k`` winners meet the names table."""
    chosen = _counts(df, key) if k is None else popular(df, key, k)
    return with_names(chosen, names, key, names_key, name).orderBy(F.desc("n"), key)


def name_of(names: DataFrame, key: str, wanted: object, name: str) -> DataFrame:
    """The name of one key, as a filter that reaches the scan."""
    return names.filter(F.col(key) == wanted).select(name)


def average_by_key(df: DataFrame, key: str, value: str, scale: int | None = None) -> DataFrame:
    """Mean per key, in order of the key.

    ``scale`` sums as decimals with so many places, which makes the mean repeatable.
    """
    if scale is None:
        mean = F.avg(value)
    else:
        mean = F.sum(exact(F.col(value), scale)).cast("double") / F.count(value)
    return df.groupBy(key).agg(mean.alias("mean")).orderBy(key)


def spend_by_customer(
    df: DataFrame, customer: str, amount: str, ascending: bool = False, scale: int = 2
) -> DataFrame:
    """Total per customer as a decimal, largest first unless ``ascending``.

    Each amount is rounded to ``scale`` decimals before it is added.
    """
    totals = df.groupBy(customer).agg(F.sum(exact(F.col(amount), scale)).alias("total_spent"))
    order = F.asc("total_spent") if ascending else F.desc("total_spent")
    return totals.orderBy(order, customer)


def lowest_by_key(
    df: DataFrame,
    key: str,
    kind: str,
    value: str,
    wanted: str = "TMIN",
    convert: Callable[[Column], Column] = fahrenheit_from_tenths,
) -> DataFrame:
    """Smallest ``wanted`` value per key, converted after the minimum is known."""
    chosen = df.filter(F.col(kind) == wanted)
    return chosen.groupBy(key).agg(F.min(value).alias("_v")).select(key, convert(F.col("_v")).alias("lowest"))


def highest_by_key(
    df: DataFrame,
    key: str,
    kind: str,
    value: str,
    wanted: str = "TMAX",
    convert: Callable[[Column], Column] = fahrenheit_from_tenths,
) -> DataFrame:
    """Largest ``wanted`` value per key, converted after the maximum is known."""
    chosen = df.filter(F.col(kind) == wanted)
    return chosen.groupBy(key).agg(F.max(value).alias("_v")).select(key, convert(F.col("_v")).alias("highest"))


def extremes_by_key(
    df: DataFrame,
    key: str,
    kind: str,
    value: str,
    low: str = "TMIN",
    high: str = "TMAX",
    convert: Callable[[Column], Column] = fahrenheit_from_tenths,
) -> DataFrame:
    """Lowest ``low`` and highest ``high`` value of the keys that have both.

    One scan and one shuffle where two filtered aggregates and a join would need two of each.
    """
    return (
        df.filter(F.col(kind).isin(low, high))
        .groupBy(key)
        .agg(
            F.count(F.when(F.col(kind) == low, 1)).alias("_lows"),
            F.count(F.when(F.col(kind) == high, 1)).alias("_highs"),
            F.min(F.when(F.col(kind) == low, F.col(value))).alias("_low"),
            F.max(F.when(F.col(kind) == high, F.col(value))).alias("_high"),
        )
        .filter((F.col("_lows") > 0) & (F.col("_highs") > 0))
        .select(key, convert(F.col("_low")).alias("lowest"), convert(F.col("_high")).alias("highest"))
    )
