import pytest
from pyspark.sql import functions as F

from helpers import rows
from tallywork.functions.logs import parse_logs
from tallywork.functions.scalars import other_of_pair, ratio_or_zero
from tallywork.functions.text import ascii_only
from tallywork.operators.words import fold_words, word_count


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame([("Half-Moon: Café, café!",), ("",), ("half ÄÖ --",)], ["value"])


def test_ascii_words_end_at_other_letters(lines):
    assert rows(word_count(lines)) == [("caf", 2), ("half", 2), ("moon", 1)]


def test_unicode_words(lines):
    counts = word_count(lines, mode="unicode")
    assert [tuple(r) for r in counts.collect()] == [
        ("café", 2),
        ("half", 2),
        ("moon", 1),
        ("äö", 1),
    ]
    assert rows(fold_words(counts)) == [("caf", 2), ("half", 2), ("moon", 1)]


def test_rising_order(lines):
    assert [r.n for r in word_count(lines, ascending=True).collect()] == [1, 2, 2]


def test_scalars(spark):
    df = spark.createDataFrame([("naïve €5", 6.0, 0.0, 1, 2), ("x", 6.0, 4.0, 2, 1)], ["t", "n", "d", "a", "b"])
    got = df.select(
        ascii_only(F.col("t")), ratio_or_zero(F.col("n"), F.col("d")), other_of_pair(F.col("a"), F.col("b"), 1)
    )
    assert rows(got) == [("nave 5", 0.0, 2), ("x", 1.5, 2)]


LOG = [
    '10.1.2.3 - - [05/Mar/2031:07:08:09 -0000] "GET /start HTTP/1.1" 200 55',
    'host.example.org - - [05/Mar/2031:07:08:09 +0100] "GET /a HTTP/1.1" 304 -',
    'localhost - - [05/Mar/2031:07:08:09 -0700] "GET /b" 404 7',
    "not a log line",
    "",
]


def test_log_fields(spark):
    logs = parse_logs(spark.createDataFrame([(line,) for line in LOG], ["value"]))
    assert [tuple(r) for r in logs.collect()] == [
        ("10.1.2.3", "05/Mar/2031:07:08:09 -0000", "GET", "/start", "HTTP/1.1", 200, 55),
        ("host.example.org", "", "GET", "/a", "HTTP/1.1", 304, None),
        ("", "05/Mar/2031:07:08:09 -0700", "GET", "/b", "", 404, 7),
        ("", "", "", "", "", None, None),
        ("", "", "", "", "", None, None),
    ]


def test_any_offset(spark):
    logs = parse_logs(spark.createDataFrame([(LOG[1],)], ["value"]), any_offset=True)
    assert logs.first().timestamp == "05/Mar/2031:07:08:09 +0100"
