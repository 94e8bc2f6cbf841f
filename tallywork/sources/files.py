"""Delimited and plain text sources. A path may be any Hadoop URI."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallywork.functions.text import blank_fields
from tallywork.session import materialise, scratch_path


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType,
    sep: str = ",",
    encoding: str = "UTF-8",
) -> DataFrame:
    """Headerless file with a given schema; fields beyond the schema are ignored."""
    return spark.read.schema(schema).option("sep", sep).option("encoding", encoding).csv(path)


def read_with_header(
    spark: SparkSession, path: str, sep: str = ",", schema: StructType | str | None = None, sample: int = 1_000
) -> DataFrame:
    """File with a header row. Without a schema the types are those that all values fit, as ``typed_copy`` finds them."""
    if schema is None:
        return typed_copy(spark, path, sep, sample)
    return spark.read.option("header", True).option("sep", sep).schema(schema).csv(path)


def typed_copy(spark: SparkSession, path: str, sep: str = ",", sample: int = 1_000) -> DataFrame:
    """A written, typed copy of a file with a header row, made in one read if the first ``sample`` lines show the types.

    The types that Spark infers for those lines are taken for the read of the file. Lines that do not fit are kept
    whole beside the copy; some of them (up to ``sample``) then join the lines that types are inferred from, and the file is read again, until
    the types stay as they are. A column without any value among the lines is tried as whole numbers first.
    """
    lines = spark.read.text(path).filter(F.trim("value") != "")
    first = lines.first()
    if first is None:
        return spark.read.option("header", True).csv(path)
    header = first[0]
    known = [row[0] for row in lines.limit(sample + 1).collect() if row[0] != header]
    reader = spark.read.option("header", True).option("sep", sep).option("columnNameOfCorruptRecord", "_line")
    kinds = _kinds(spark, header, known, sep)
    while True:
        copy = materialise(reader.schema(f"{kinds}, _line string").csv(path), "typed")
        odd = copy.filter(F.col("_line").isNotNull()).select("_line").limit(sample).collect()
        known += [row[0] for row in odd]
        before, kinds = kinds, _kinds(spark, header, known, sep) if odd else kinds
        if kinds == before:
            return copy.drop("_line")


def _kinds(spark: SparkSession, header: str, lines: list[str], sep: str) -> str:
    """The columns with the types that Spark infers from some lines."""
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(line,) for line in [header, *lines]], "value string").coalesce(1).write.text(path)
    read = spark.read.option("header", True).option("sep", sep).option("inferSchema", True).csv(path)
    some = read.agg(*[F.count(F.col(f"`{c}`")).alias(str(i)) for i, c in enumerate(read.columns)]).first()
    return ", ".join(
        f"`{f.name}` {f.dataType.simpleString() if some[i] else 'int'}" for i, f in enumerate(read.schema.fields)
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One ``value`` column, one row per line."""
    return spark.read.text(path)


def in_file_order(df: DataFrame, name: str = "line") -> DataFrame:
    """Add a sortable ``name`` that gives the rows of freshly read files in their order there.

    Compares by file, then by block in the file, then by row in the block.
    """
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.withColumn(name, place)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of the test data, a single file or a folder of part files."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def split_fields(
    lines: DataFrame, schema: StructType, sep: str = ",", value: str = "value"
) -> DataFrame:
    """Typed fields of delimited lines that are already a column."""
    parsed = F.from_csv(F.col(value), schema.toDDL(), {"sep": sep})
    return lines.select(parsed.alias("_f")).select("_f.*")


def blank_field(index: int, value: str = "value") -> Column:
    """The field at ``index`` of a line split at white space, NULL where the line is shorter."""
    return F.get(blank_fields(F.col(value)), F.lit(index))


def frame_from_rows(
    spark: SparkSession, rows: Iterable[Row | tuple | list], schema: StructType | list[str] | None = None
) -> DataFrame:
    """Small driver-side rows as a DataFrame: Row objects, or tuples with names or a schema."""
    return spark.createDataFrame(list(rows), schema)

