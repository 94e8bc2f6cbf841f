"""Session factory and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path
from urllib.parse import urlsplit

from pyspark.sql import SparkSession

#: Whether Spark deletes the shuffle files of a query at its end.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_made: list[str] = []
_proven: set[tuple[str, str]] = set()
_local_folder: tempfile.TemporaryDirectory | None = None


def build_session(app: str = "tallywork", master: str | None = None, **conf: object) -> SparkSession:
    """Session with adaptive execution and UTC.

    ``conf`` keys use ``__`` for dots, e.g. ``spark__sql__shuffle__partitions=8``.
    Cluster sizing (executors, memory, shuffle partitions) is left to spark-submit.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or what ``setCheckpointDir`` was given, or the warehouse.

    Only a session without executors of its own (``local``) may go without; it then gets a temporary folder, which executors
    need not see even on the driver's host. Where executors run on other hosts, a folder of a local file system may be a
    mounted one that all share, or each host's own disk, of which reads would miss rows. Tasks write rows to it once; it is
    refused unless all of them come back.
    """
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        named = named or spark.conf.get("spark.sql.warehouse.dir", None)
        if not named:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if not master.startswith("local-cluster") and _scheme(spark, named) == "file":
            _prove(spark, named.rstrip("/"))
    if named:
        return named.rstrip("/")
    if _local_folder is None:
        _local_folder = tempfile.TemporaryDirectory(prefix="tallywork-", ignore_cleanup_errors=True)
    return Path(_local_folder.name).as_uri()


def _prove(spark: SparkSession, folder: str) -> None:
    """Refuse a folder of a local file system that the executors do not share; asked once per application and folder."""
    refused = f"{folder} is a local folder that not all executors share; set spark.checkpoint.dir to one that they do"
    try:
        if (spark.sparkContext.applicationId, folder) in _proven:
            return
        rows = 2 * spark.sparkContext.defaultParallelism
        back = _rows_back(spark, f"{folder}/proof-{uuid.uuid4().hex}", rows)
    except Exception as error:
        raise RuntimeError(refused) from error
    if back != rows:
        raise RuntimeError(refused)
    _proven.add((spark.sparkContext.applicationId, folder))


def _rows_back(spark: SparkSession, path: str, rows: int) -> int:
    """How many of the rows that as many tasks write are read again."""
    _made.append(path)
    spark.range(0, rows, 1, rows).write.parquet(path)
    return spark.read.schema("id long").parquet(path).count()


def _scheme(spark: SparkSession, path: str) -> str:
    """The kind of file system a path is in; that of ``fs.defaultFS`` where it names none."""
    return urlsplit(path).scheme or urlsplit(spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")).scheme


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables made inside the block when it ends; those made before it stay.

    Results built on them must be saved inside the block.
    """
    global _made
    before, _made = _made, []
    try:
        yield
    finally:
        drop_scratch(spark)
        _made = before


def drop_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables made so far; returns how many paths were there.

    Call it when the results built on them have been saved.
    """
    context, dropped = spark.sparkContext, 0
    while _made:
        path = context._jvm.org.apache.hadoop.fs.Path(_made.pop())
        dropped += path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    return dropped


def write_rows(df, path: str) -> None:
    """Write ``df`` to ``path``; the shuffle files of the writing are deleted as soon as the rows are written."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


def materialise(df, label: str):
    """Write ``df`` once and read it back.

    Cuts lineage without tying the rows to any executor, and gives later joins the real
    size in bytes, so Spark's own threshold decides whether a side is broadcast. No shuffle files stay.
    """
    path = scratch_path(df.sparkSession, label)
    write_rows(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
