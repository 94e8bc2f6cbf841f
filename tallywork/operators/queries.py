"""SQL over a registered view, and the small DataFrame queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sql_over(df: DataFrame, statement: str, view: str = "people", **values: object) -> DataFrame:
    """Run SQL in which ``{view}`` stands for ``df`` and ``:name`` for a value; no view is left behind."""
    return df.sparkSession.sql(statement, args=values or None, **{view: df})


def in_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows whose column lies in [low, high], by SQL."""
    return sql_over(
        df, f"SELECT * FROM {{people}} WHERE `{column}` >= :low AND `{column}` <= :high", low=low, high=high
    )


def below(df: DataFrame, column: str, bound: float) -> DataFrame:
    """Rows whose column is under the bound."""
    return df.filter(F.col(column) < bound)


def rows_per_value(df: DataFrame, column: str) -> DataFrame:
    """Row count per value."""
    return df.groupBy(column).agg(F.count("*").alias("n"))


def shifted(df: DataFrame, name: str, column: str, by: float) -> DataFrame:
    """``name`` beside ``column + by``."""
    return df.select(name, (F.col(column) + by).alias(f"{column}_plus_{by}"))


def containing(df: DataFrame, column: str, part: str) -> DataFrame:
    """Rows whose text holds ``part``."""
    return df.filter(F.col(column).contains(part))
