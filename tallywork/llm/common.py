"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema
from xxhash import xxh3_64_intdigest

from tallywork.llm import vocabularies
from tallywork.session import materialise

__all__ = [
    "WORDS",
    "arrow_rows",
    "drop",
    "forget",
    "held_out",
    "kept_rows",
    "label_sample",
    "materialise",
    "mix",
    "partitions",
    "shingle_hashes",
    "table",
    "thinned",
    "word_hashes",
]

#: Words as the word-based contracts define them: runs of anything but space and \t \n \v \f \r.
WORDS = re.compile(r"[^\x20\x09-\x0D]+")

#: Rows that ``arrow_rows`` hands on at a time.
SLICE = 1024


def drop(*written: DataFrame) -> None:
    """Delete the files of tables that ``materialise`` gave, once nothing reads them any more."""
    for own in written:
        context = own.sparkSession.sparkContext
        for folder in {file.rsplit("/", 1)[0] for file in own.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a test folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``SLICE`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def arrow_rows(
    df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str, holds: bool = False
) -> DataFrame:
    """``mapInArrow`` for a function that yields a dict of column lists per batch.

    Batches are handed on in slices, so that a worker holds few rows as Python objects at a time. Workers live on between
    tasks: what earlier ones left, such as another operator's pieces, is given back first unless the function ``holds`` it.
    """
    struct = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(struct)

    def run(batches):
        if not holds:
            forget()
        for columns in rows(sliced(batches)):
            arrays = [
                c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in arrow
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, struct)


def kept_rows(df: DataFrame, kept: Callable[[pa.RecordBatch], list[bool]]) -> DataFrame:
    """The rows of ``df`` of which ``kept`` says so, with all their columns as they are.

    It gets slices, as with ``arrow_rows``. What the worker held is given back at the beginning and the end of a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in sliced(batches):
            yield batch.filter(pa.array(kept(batch), pa.bool_()))
        forget()

    return df.mapInArrow(run, df.schema)


#: Most bits of the filter in ``thinned``: two million rows of 64 bits are broadcast at most.
FILTER_BITS = 1 << 27


def filter_bits(wanted: int) -> int:
    """Bits for so many keys: eight each, up to the most there are; 0 if even those would be full."""
    return min(FILTER_BITS, max(1 << 16, 1 << (8 * wanted).bit_length())) if wanted <= FILTER_BITS else 0


def thinned(rows: DataFrame, key: str, wanted: DataFrame, of: str) -> DataFrame:
    """``rows`` without most of those whose long ``key`` is not among the ``of`` values of ``wanted``.

    To be called before a join of the two, which then shuffles little of a large side: keys are hashed to some bits for each of
    them, which are broadcast and looked up in the map tasks. No row that the join needs is dropped. ``wanted`` should be a written
    table, as it is counted first. With more keys than ``FILTER_BITS`` all rows pass; the join does what the filter leaves.
    """
    bits = filter_bits(wanted.count())
    if not bits:
        return rows

    def bit(column: str):
        return F.pmod(F.xxhash64(F.col(column), F.lit("bit")), F.lit(bits))

    one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("__bit") % 64).cast("int"))
    words = (
        wanted.select(bit(of).alias("__bit"))
        .groupBy(F.floor(F.col("__bit") / 64).alias("__word"))
        .agg(F.bit_or(one).alias("__bits"))
    )
    marked = rows.withColumn("__at", bit(key)).withColumn("__word", F.floor(F.col("__at") / 64))
    kept = marked.join(F.broadcast(words), "__word").where(F.getbit("__bits", (F.col("__at") % 64).cast("int")) == 1)
    return kept.select(*[f"`{c}`" for c in rows.columns])


def held_out(doc_id) -> F.Column:
    """True where crc32 of the id, written as text, leaves 2 on division by 4 (false for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def label_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(text, label) of at most about ``bound`` labelled rows that are not held out.

    The rows are those whose hashed id falls below a limit, so the same rows come out on every run and cluster.
    Rows without an id, text or label are left out. A document labelled twice counts twice.
    """
    named = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_label")).where(
        F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out(F.col("_id"))
    )
    share = min(1.0, bound / max(1, named.count()))
    rank = F.pmod(F.xxhash64(F.col("_id"), F.lit("labelled")), F.lit(1 << 30))
    chosen = named.where(rank < int(share * (1 << 30)))
    return (
        docs.select(F.col("doc_id").alias("_key"), F.col("text").alias("_text"))
        .where(F.col("_text").isNotNull())
        .join(chosen, F.col("_key") == F.col("_id"))
        .select(F.col("_text").alias("text"), F.col("_label").alias("label"), F.col("_id").alias("id"))
    )


#: Gives freed memory back to the system; the C library of Linux has it.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def forget() -> None:
    """Give back what a worker holds between tasks: vocabularies with their pieces, and memory that Arrow and the C library keep
    for later."""
    if vocabularies.dismiss():
        gc.collect()  # a vocabulary and its cache refer to each other
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values (a bijection)."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def word_hashes(words: list[str] | list[bytes]) -> np.ndarray:
    """A 64-bit hash per word; that of a text is the one of its UTF-8 bytes."""
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash per window of ``width`` words, from the hashes of the words."""
    n = len(words) - width + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    out = mix(words[:n] + np.uint64(width))
    for k in range(1, width):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[k : n + k])
    return out
