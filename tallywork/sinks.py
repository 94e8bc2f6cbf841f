"""Where results go: files, and streams written to console, memory or a table folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallywork.session import scratch_path


def save(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    sort_by: Sequence[str | Column] = (),
    **options: object,
) -> None:
    """Write a folder of files; with ``sort_by`` the files hold one global order."""
    if sort_by:
        df = df.orderBy(*sort_by)
    df.write.mode(mode).options(**options).format(fmt).save(path)


def save_for_lookup(df: DataFrame, path: str, key: str, buckets: int = 64, sort_by: Sequence[str | Column] = ()) -> None:
    """Write a folder from which ``look_up`` reads the rows of one ``key`` without reading the others.

    Rows lie in folders by a hash of the key, and sorted by key in a file, so that a reader skips most of it. Adaptive execution
    cuts the folder of a hot key into several files.
    """
    dealt = df.withColumn("_bucket", _bucket(F.col(key), F.lit(buckets))).hint("rebalance", "_bucket")
    dealt.sortWithinPartitions("_bucket", key, *sort_by).write.partitionBy("_bucket").parquet(path)


def look_up(spark: SparkSession, path: str, key: str, value: object) -> DataFrame:
    """The rows of ``save_for_lookup`` with this value of the key; one folder is read."""
    saved = spark.read.parquet(path)
    wanted = F.lit(value).cast(saved.schema[key].dataType)
    # How many buckets there are is in their names, so that this is a question to the names of folders only.
    here = F.col("_bucket") == _bucket(wanted, F.substring_index("_bucket", "-", -1).cast("int"))
    return saved.filter(here & (F.col(key) == wanted)).drop("_bucket")


def _bucket(key: Column, buckets: Column) -> Column:
    return F.concat_ws("-", F.pmod(F.xxhash64(key), buckets).cast("string"), buckets.cast("string"))


def start_stream(
    df: DataFrame,
    name: str,
    fmt: str = "console",
    output_mode: str = "complete",
    checkpoint: str | None = None,
    once: bool = False,
    **options: object,
) -> StreamingQuery:
    """Start a named query. ``once`` handles what is there now and stops by itself."""
    writer = df.writeStream.outputMode(output_mode).format(fmt).queryName(name).options(**options)
    writer = writer.option("checkpointLocation", checkpoint or scratch_path(df.sparkSession, name))
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


class _BatchFolders:
    """A query whose batches go to folders of their own below a path.

    Folders are named by batch id, so a batch that is run again after a failure overwrites itself. A folder counts once it is
    finished, which Spark's writer marks.
    """

    mode = "append"

    def __init__(
        self,
        df: DataFrame,
        name: str,
        path: str | None = None,
        checkpoint: str | None = None,
        once: bool = False,
    ) -> None:
        self._spark = df.sparkSession
        self._schema = df.schema
        self._path = path or scratch_path(self._spark, name)
        writer = (
            df.writeStream.outputMode(self.mode)
            .queryName(name)
            .foreachBatch(self._write)
            .option("checkpointLocation", checkpoint or scratch_path(self._spark, f"{name}-log"))
        )
        if once:
            writer = writer.trigger(availableNow=True)
        self.query = writer.start()

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(self._folder("batch", batch_id))

    def _folder(self, kind: str, batch_id: int) -> str:
        return f"{self._path}/{kind}-{batch_id}"

    def _finished(self, kind: str = "batch") -> list[int]:
        """Ids of the finished folders of a kind, oldest first."""
        marks = self._spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self._path}/{kind}-*/_SUCCESS")
        found = marks.getFileSystem(self._hadoop_conf()).globStatus(marks) or []
        names = [mark.getPath().getParent().getName() for mark in found]
        return sorted(int(name.removeprefix(f"{kind}-")) for name in names)

    def _hadoop_conf(self):
        return self._spark.sparkContext._jsc.hadoopConfiguration()

    def _delete(self, kind: str, batch_ids: Sequence[int]) -> None:
        for batch_id in batch_ids:
            folder = self._spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._folder(kind, batch_id))
            folder.getFileSystem(self._hadoop_conf()).delete(folder, True)

    def _read(self, paths: Sequence[str]) -> DataFrame:
        if not paths:
            return self._spark.createDataFrame([], self._schema)
        return self._spark.read.schema(self._schema).parquet(*paths)


class TableStream(_BatchFolders):
    """A complete-mode query whose every batch replaces the table at ``latest()``.

    Readers keep the finished table while the next one is written. The last two are kept.
    """

    mode = "complete"

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        super()._write(batch, batch_id)
        self._delete("batch", self._finished()[:-2])

    def latest(self) -> DataFrame:
        """The newest finished table, also one from before a restart; empty before the first batch."""
        return self._read([self._folder("batch", batch_id) for batch_id in self._finished()[-1:]])


class UpsertStream(_BatchFolders):
    """An update-mode query whose batches write the changed rows only, by ``keys``.

    The batches are a log of changes. After every ``compact_every`` of them the log and the table before it are merged into a
    new table; what was merged is kept for readers until the next time, so reading costs the table and at most
    twice as many batches. A batch that is run again writes the same rows to the same folder, and nothing if it is in the
    table already.
    """

    mode = "update"

    def __init__(self, df: DataFrame, name: str, keys: Sequence[str], compact_every: int = 16, **places) -> None:
        self._keys, self._every = list(keys), compact_every
        super().__init__(df, name, **places)

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        tables = self._finished("table")
        if tables and batch_id <= tables[-1]:
            return
        super()._write(batch, batch_id)
        since = [b for b in self._finished() if not tables or b > tables[-1]]
        if len(since) >= self._every:
            self._merged(tables[-1:], since).write.mode("overwrite").parquet(self._folder("table", batch_id))
            # The table just written stands on its own; the one before it and its log serve readers until the next.
            self._delete("table", tables[:-1])
            self._delete("batch", [b for b in self._finished() if tables and b <= tables[-1]])

    def _merged(self, tables: Sequence[int], batches: Sequence[int]) -> DataFrame:
        """The newest row of each key."""
        rows = self._read([self._folder("table", t) for t in tables]).withColumn("_batch", F.lit(-1).cast("long"))
        for batch_id in batches:
            own = self._read([self._folder("batch", batch_id)])
            rows = rows.union(own.withColumn("_batch", F.lit(batch_id).cast("long")))
        others = [c for c in self._schema.names if c not in self._keys]
        newest = rows.groupBy(*self._keys).agg(F.max_by(F.struct(*others), "_batch").alias("_row"))
        return newest.select(*[c if c in self._keys else F.col(f"_row.{c}").alias(c) for c in self._schema.names])

    def latest(self) -> DataFrame:
        """The newest row of each key seen so far, also from before a restart."""
        tables = self._finished("table")
        return self._merged(tables[-1:], [b for b in self._finished() if not tables or b > tables[-1]])


class AppendStream(_BatchFolders):
    """An append-mode query: what the watermark has closed is written once, and never again.

    A batch that is run again after a failure replaces what it wrote before.
    """

    def closed(self) -> DataFrame:
        """All rows that are final, also those from before a restart."""
        return self._read([self._folder("batch", batch_id) for batch_id in self._finished()])

    def late(self) -> int:
        """Rows that came after their window was closed and count nowhere, among the batches that the query still remembers.

        Rows of one key and window in one batch are added up before they are looked at, and count as one here.
        """
        return sum(
            operator.get("numRowsDroppedByWatermark", 0)
            for progress in self.query.recentProgress
            for operator in progress["stateOperators"]
        )


def run_stream(df: DataFrame, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Run a stream over the input that is there now; return its table.

    With ``keys`` batches write the rows that changed, else all.
    """
    stream = UpsertStream(df, name, keys, once=True) if keys else TableStream(df, name, once=True)
    stream.query.awaitTermination()
    return stream.latest()
