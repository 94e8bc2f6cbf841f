"""Text sources over the contract tables: lines made by Spark, then parsed or read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork import schemas
from tallywork.operators.aggregates import histogram
from tallywork.plans.registry import query
from tallywork.session import scratch_path
from tallywork.sinks import save
from tallywork.sources import files
from tallywork.sources.files import read_table


def _joined(df: DataFrame, sep: str, *columns: str) -> DataFrame:
    return df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in columns]).alias("value"))


def _fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


_ORDER = _fields(o_orderkey=T.LongType(), o_custkey=T.LongType(), o_totalprice=T.DoubleType())
_LINE = _fields(l_orderkey=T.LongType(), l_suppkey=T.LongType(), l_quantity=T.DoubleType())


@query("lines_comma", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def lines_comma(spark, folder):
    lines = _joined(read_table(spark, folder, "orders"), ",", *_ORDER.names)
    return files.split_fields(lines, _ORDER)


@query("lines_tab", "SELECT l_orderkey, l_suppkey, l_quantity FROM lineitem")
def lines_tab(spark, folder):
    lines = _joined(read_table(spark, folder, "lineitem"), "\t", *_LINE.names)
    return files.split_fields(lines, _LINE, sep="\t")


@query("lines_double_colon", "SELECT l_orderkey, l_suppkey, l_quantity FROM lineitem")
def lines_double_colon(spark, folder):
    lines = _joined(read_table(spark, folder, "lineitem"), "::", *_LINE.names)
    return files.split_fields(lines, _LINE, sep="::")


@query(
    "lines_blank_field",
    "SELECT CAST(l_linenumber AS VARCHAR) AS picked, count(*) AS n FROM lineitem GROUP BY l_linenumber",
)
def lines_blank_field(spark, folder):
    lines = _joined(read_table(spark, folder, "lineitem"), " ", "l_orderkey", "l_suppkey", "l_linenumber", "l_tax")
    return histogram(lines.select(files.blank_field(2).alias("picked")), "picked")


@query("saved_header_inferred", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def saved_header_inferred(spark, folder):
    path = scratch_path(spark, "customers")
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    save(customers, path, fmt="csv", header=True)
    inferred = files.read_with_header(spark, path)
    return inferred.withColumn("c_custkey", F.col("c_custkey").cast("long"))


@query("saved_pipe_latin1", "SELECT CAST(p_partkey AS INTEGER) AS movie_id, p_name || ' é' AS title FROM part")
def saved_pipe_latin1(spark, folder):
    """A wide pipe-separated Latin-1 file of which the first two fields are read."""
    path = scratch_path(spark, "titles")
    wide = read_table(spark, folder, "part").select(
        "p_partkey", F.concat("p_name", F.lit(" é")), "p_brand", "p_type", "p_size"
    )
    save(wide, path, fmt="csv", sep="|", encoding="ISO-8859-1")
    return files.read_delimited(spark, path, schemas.TITLES, sep="|", encoding="ISO-8859-1")


@query("saved_blank_names", "SELECT p_partkey AS id, p_name AS name FROM part")
def saved_blank_names(spark, folder):
    """Blank-separated id and name; the quotes around names let them hold blanks."""
    path = scratch_path(spark, "names")
    save(read_table(spark, folder, "part").select("p_partkey", "p_name"), path, fmt="csv", sep=" ")
    return files.read_delimited(spark, path, schemas.NAMES, sep=" ")


def _line_feeds_to_blanks(text: str) -> Column:
    return F.regexp_replace(text, r"[\r\n]", " ")


@query(
    "saved_text_lines",
    "SELECT md5(regexp_replace(text, '[\\r\\n]', ' ', 'g')) AS line FROM documents",
)
def saved_text_lines(spark, folder):
    path = scratch_path(spark, "texts")
    texts = read_table(spark, folder, "documents").select(_line_feeds_to_blanks("text").alias("value"))
    save(texts, path, fmt="text")
    return files.read_lines(spark, path).select(F.md5("value").alias("line"))
