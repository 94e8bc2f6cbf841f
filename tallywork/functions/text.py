"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Runs of characters that separate words.
WORD_BREAKS = {
    "ascii": r"\W+",
    "unicode": r"[^\p{L}\p{N}_]+",
}


def split_words(text: Column, mode: str = "ascii") -> Column:
    """The pieces of a text between word breaks, empty ones among them."""
    return F.split(text, WORD_BREAKS[mode])


def ascii_only(text: Column) -> Column:
    """The text without its non-ASCII characters."""
    return F.regexp_replace(text, r"[^\x00-\x7F]", "")


def blank_fields(value: Column) -> Column:
    """The fields of a line between runs of white space of any kind, also where it begins or ends with some."""
    return F.split(F.regexp_replace(value, r"^\s+|\s+$", ""), r"\s+")
