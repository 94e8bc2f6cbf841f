"""Streaming counts over parsed access logs or other rows.

Both counts run in complete mode as a whole-table view and set no watermark by default: their state holds
every group seen. For status codes that is a handful of rows. For windows it grows with time and
with the number of distinct values, spread over the shuffle partitions; a ``watermark`` bounds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def running_counts(rows: DataFrame, key: str = "status") -> DataFrame:
    """Rows seen so far per key."""
    return rows.groupBy(key).agg(F.count("*").alias("n"))


def sliding_counts(
    rows: DataFrame,
    key: str = "endpoint",
    size: str = "30 seconds",
    slide: str = "10 seconds",
    time: Column | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """(window_start, window_end, key, n), most rows first.

    The time is the moment of processing unless a ``time`` column is given. With a ``watermark`` ("10 minutes", say)
    windows older than the latest time less that are closed and leave the state; the rows are then in no order, and
    the stream is to be written in append or update mode.
    """
    stamped = rows.withColumn("_time", F.current_timestamp() if time is None else time)
    if watermark is not None:
        stamped = stamped.withWatermark("_time", watermark)
    counted = (
        stamped.groupBy(F.window("_time", size, slide).alias("_w"), key)
        .agg(F.count("*").alias("n"))
        .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), key, "n")
    )
    return counted.orderBy(F.desc("n"), "window_start", key) if watermark is None else counted
