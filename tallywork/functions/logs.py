"""Access-log lines (common log format) to typed columns, in batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The patterns of the log fields.
CONTENT_SIZE = r"\s(\d+)$"
STATUS = r"\s(\d{3})\s"
REQUEST = r"\"(\S+)\s(\S+)\s*(\S*)\""
TIME = r"\[(\d{2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2} -\d{4})]"
TIME_ANY_OFFSET = r"\[(\d{2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2} [+-]\d{4})]"
HOST = r"(^\S+\.[\S+\.]+\S+)\s"


def parse_logs(
    lines: DataFrame, value: str = "value", any_offset: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Fields of each line; text fields are '' and numbers NULL where a pattern does not match.

    ``any_offset`` also takes times east of Greenwich. ``keep`` names columns to carry along.
    """

    def part(pattern: str):
        return F.regexp_extract(value, pattern, 1)

    # The request is looked for once. Its parts hold no white space, so what matched splits into them.
    found = F.regexp_extract(value, REQUEST, 0)
    request = F.split(F.substring(found, F.lit(2), F.length(found) - 2), r"\s+")

    return lines.select(
        *keep,
        part(HOST).alias("host"),
        part(TIME_ANY_OFFSET if any_offset else TIME).alias("timestamp"),
        F.coalesce(F.get(request, F.lit(0)), F.lit("")).alias("method"),
        F.coalesce(F.get(request, F.lit(1)), F.lit("")).alias("endpoint"),
        F.coalesce(F.get(request, F.lit(2)), F.lit("")).alias("protocol"),
        part(STATUS).try_cast("int").alias("status"),
        part(CONTENT_SIZE).try_cast("int").alias("content_size"),
    )
