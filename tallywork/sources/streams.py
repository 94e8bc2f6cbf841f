"""Streaming readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def stream_lines(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of text files as they arrive in ``folder``."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(folder)


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of the test data as a stream.

    The stream reader takes folders and globs but no single file, hence a glob that only the table's own name fits.
    """
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{name[:-1]}[{name[-1]}].parquet")
