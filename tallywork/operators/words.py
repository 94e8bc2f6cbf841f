"""Word counts over whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions.text import ascii_only, split_words


def word_count(
    lines: DataFrame, value: str = "value", mode: str = "ascii", ascending: bool = False
) -> DataFrame:
    """Occurrences of each lower-case word, most frequent first unless ``ascending``.

    ``mode`` tells whether letters outside ASCII belong to a word ("unicode") or end it ("ascii").
    """
    pieces = lines.select(F.explode(split_words(F.col(value), mode)).alias("piece"))
    order = F.asc("n") if ascending else F.desc("n")
    return (
        pieces.filter(F.col("piece") != "")
        .groupBy(F.lower("piece").alias("word"))
        .agg(F.count("*").alias("n"))
        .orderBy(order, "word")
    )


def fold_words(counts: DataFrame) -> DataFrame:
    """Word counts with the words cut to ASCII for display; words left empty are hidden."""
    shown = counts.select(ascii_only(F.col("word")).alias("word"), "n")
    return shown.filter(F.col("word") != "")
