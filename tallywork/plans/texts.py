"""Word counts and access logs over the contract tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.functions import logs
from tallywork.functions.logs import parse_logs
from tallywork.functions.text import ascii_only
from tallywork.operators.words import fold_words, word_count
from tallywork.plans.registry import query
from tallywork.sources.files import read_table
from tallywork.streaming.counts import running_counts


def _words_sql(breaks: str) -> str:
    return f"""
    SELECT word, count(*) AS n
    FROM (SELECT lower(unnest(regexp_split_to_array(text, '{breaks}'))) AS word FROM documents)
    WHERE word <> '' GROUP BY word
    """


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents").select("doc_id", "text")


@query("word_count_ascii", _words_sql(r"\W+"))
def word_count_ascii(spark, folder):
    return word_count(_texts(spark, folder), "text")


@query("word_count_unicode", _words_sql(r"[^\p{L}\p{N}_]+"))
def word_count_unicode(spark, folder):
    return word_count(_texts(spark, folder), "text", mode="unicode", ascending=True)


@query(
    "word_count_folded",
    f"""
    SELECT folded AS word, n
    FROM (SELECT regexp_replace(word, '[^\\x00-\\x7F]', '', 'g') AS folded, n
          FROM ({_words_sql(r"[^\p{L}\p{N}_]+")}))
    WHERE folded <> ''
    """,
)
def word_count_folded(spark, folder):
    return fold_words(word_count(_texts(spark, folder), "text", mode="unicode"))


@query(
    "ascii_fold",
    "SELECT doc_id, md5(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')) AS folded FROM documents",
)
def ascii_fold(spark, folder):
    return read_table(spark, folder, "documents").select("doc_id", F.md5(ascii_only(F.col("text"))).alias("folded"))


def log_lines(events: DataFrame) -> DataFrame:
    """Access-log lines made of events: good ones, and every kind of irregular one."""
    is_type = F.col("event_type").__eq__
    host = F.when(is_type("error"), F.lit("localhost")).otherwise(
        F.concat(F.lit("host"), F.col("user_id").cast("string"), F.lit(".example.org"))
    )
    offset = F.when(is_type("signup"), F.lit("+0100")).otherwise(F.lit("-0700"))
    method = F.when(is_type("purchase"), F.lit("POST")).otherwise(F.lit("GET"))
    protocol = F.when(is_type("signup"), F.lit("")).otherwise(F.lit(" HTTP/1.1"))
    status = (
        F.when(is_type("view"), F.lit("200"))
        .when(is_type("click"), F.lit("304"))
        .when(is_type("purchase"), F.lit("201"))
        .when(is_type("signup"), F.lit("302"))
        .otherwise(F.lit("500"))
    )
    size = F.when(is_type("click"), F.lit("-")).otherwise(F.floor(F.col("value") * 100).cast("string"))
    line = F.concat(
        host,
        F.lit(" - - ["),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"),
        F.lit(" "),
        offset,
        F.lit('] "'),
        method,
        F.lit(" /"),
        F.col("event_type"),
        F.lit("/"),
        F.col("user_id").cast("string"),
        protocol,
        F.lit('" '),
        status,
        F.lit(" "),
        size,
    )
    broken = F.concat(F.lit("line "), F.col("event_id").cast("string"), F.lit(" is not a request"))
    return events.select(
        "event_id", F.when(is_type("error") & (F.col("value") < 10), broken).otherwise(line).alias("value")
    )


LINES_SQL = """
    SELECT event_id, CASE WHEN event_type = 'error' AND value < 10
        THEN 'line ' || event_id || ' is not a request'
        ELSE CASE WHEN event_type = 'error' THEN 'localhost' ELSE 'host' || user_id || '.example.org' END
        || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' '
        || CASE WHEN event_type = 'signup' THEN '+0100' ELSE '-0700' END || '] "'
        || CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END
        || ' /' || event_type || '/' || user_id
        || CASE WHEN event_type = 'signup' THEN '' ELSE ' HTTP/1.1' END || '" '
        || CASE event_type WHEN 'view' THEN '200' WHEN 'click' THEN '304' WHEN 'purchase' THEN '201'
                           WHEN 'signup' THEN '302' ELSE '500' END
        || ' ' || CASE WHEN event_type = 'click' THEN '-' ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END
        END AS line
    FROM events
"""


def parse_sql(any_offset: bool) -> str:
    """The same fields by the same patterns."""

    def part(pattern: str, group: int = 1) -> str:
        return f"regexp_extract(line, '{pattern}', {group})"

    return f"""
    SELECT event_id, {part(logs.HOST)} AS host,
           {part(logs.TIME_ANY_OFFSET if any_offset else logs.TIME)} AS timestamp,
           {part(logs.REQUEST, 1)} AS method, {part(logs.REQUEST, 2)} AS endpoint, {part(logs.REQUEST, 3)} AS protocol,
           TRY_CAST({part(logs.STATUS)} AS INTEGER) AS status,
           TRY_CAST({part(logs.CONTENT_SIZE)} AS INTEGER) AS content_size
    FROM ({LINES_SQL})
    """


def event_lines(spark: SparkSession, folder: str) -> DataFrame:
    return log_lines(read_table(spark, folder, "events").drop("props"))


@query("log_parse", parse_sql(False))
def log_parse(spark, folder):
    return parse_logs(event_lines(spark, folder), keep=("event_id",))


@query("log_parse_any_offset", parse_sql(True))
def log_parse_any_offset(spark, folder):
    return parse_logs(event_lines(spark, folder), any_offset=True, keep=("event_id",))


STATUS_SQL = f"SELECT status, count(*) AS n FROM ({parse_sql(False)}) GROUP BY status"


@query("log_status_counts", STATUS_SQL)
def log_status_counts(spark, folder):
    return running_counts(parse_logs(event_lines(spark, folder)))


@query(
    "log_endpoint_counts",
    f"SELECT endpoint, count(*) AS n FROM ({parse_sql(False)}) GROUP BY endpoint",
)
def log_endpoint_counts(spark, folder):
    return running_counts(parse_logs(event_lines(spark, folder)), "endpoint")
