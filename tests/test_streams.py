import uuid

from pyspark.sql import functions as F

from helpers import rows
from test_words_logs import LOG
from tallywork.functions.logs import parse_logs
from tallywork.sinks import AppendStream, TableStream, UpsertStream, run_stream, start_stream
from tallywork.sources.files import read_lines
from tallywork.sources.streams import stream_lines, stream_table
from tallywork.streaming.counts import running_counts, sliding_counts


def name():
    return f"q_{uuid.uuid4().hex}"


def test_running_counts_in_memory(spark, tmp_path):
    (tmp_path / "a.log").write_text("\n".join(LOG[:3]) + "\n")
    query_name = name()
    query = start_stream(running_counts(parse_logs(stream_lines(spark, str(tmp_path)))), query_name, "memory")
    try:
        query.processAllAvailable()
        assert rows(spark.table(query_name)) == [(200, 1), (304, 1), (404, 1)]
        (tmp_path / "b.log").write_text("\n".join(LOG[2:4]) + "\n")
        query.processAllAvailable()
        assert rows(spark.table(query_name)) == [(200, 1), (304, 1), (404, 2), (None, 1)]
    finally:
        query.stop()


def test_table_stream_replaces_its_table(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.log").write_text(LOG[0] + "\n")
    stream = TableStream(running_counts(parse_logs(stream_lines(spark, str(folder)))), name(), str(tmp_path / "out"))
    try:
        assert stream.latest().columns == ["status", "n"]
        stream.query.processAllAvailable()
        assert rows(stream.latest()) == [(200, 1)]
        (folder / "b.log").write_text(LOG[0] + "\n" + LOG[1] + "\n")
        stream.query.processAllAvailable()
        assert rows(stream.latest()) == [(200, 2), (304, 1)]
    finally:
        stream.query.stop()


def test_stream_takes_up_where_it_stopped(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    place = {"path": str(tmp_path / "out"), "checkpoint": str(tmp_path / "log"), "once": True}
    for text in ("a 1", "a 2", "b 3"):
        (folder / f"{text}.txt").write_text(text[0] + "\n")
        stream = TableStream(running_counts(stream_lines(spark, str(folder)), "value"), name(), **place)
        stream.query.awaitTermination()
    assert rows(stream.latest()) == [("a", 2), ("b", 1)]
    stream = TableStream(running_counts(stream_lines(spark, str(folder)), "value"), name(), **place)
    stream.query.awaitTermination()
    assert rows(stream.latest()) == [("a", 2), ("b", 1)]
    assert len(list((tmp_path / "out").iterdir())) == 2


def test_stream_equals_batch(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.log").write_text("\n".join(LOG[i:]) + "\n")
    streamed = run_stream(running_counts(parse_logs(stream_lines(spark, str(tmp_path), 1))), name())
    assert rows(streamed) == rows(running_counts(parse_logs(read_lines(spark, str(tmp_path)))))


def test_sliding_windows_by_event_time(spark):
    df = spark.createDataFrame([(5, "/a"), (12, "/a"), (12, "/b")], ["s", "endpoint"])
    got = sliding_counts(df, time=F.timestamp_seconds("s")).select(
        F.unix_timestamp("window_start").alias("at"), "endpoint", "n"
    )
    assert got.first().n == 2
    assert rows(got) == [
        (-10, "/a", 2), (-10, "/b", 1), (-20, "/a", 1), (0, "/a", 2), (0, "/b", 1), (10, "/a", 1), (10, "/b", 1),
    ]


def test_sliding_windows_by_the_clock(spark, tmp_path):
    (tmp_path / "a.log").write_text("\n".join(LOG[:3]) + "\n")
    got = run_stream(sliding_counts(parse_logs(stream_lines(spark, str(tmp_path)))), name()).collect()
    assert len({r.window_start for r in got}) == 3
    assert sorted(r.endpoint for r in got) == sorted(["/start", "/a", "/b"] * 3)


def test_stream_of_a_table_in_one_file_or_many(spark, tmp_path):
    table = spark.range(20).withColumn("k", F.col("id") % 3).repartition(3)
    table.write.parquet(str(tmp_path / "many.parquet"))
    table.coalesce(1).write.parquet(str(tmp_path / "part"))
    part = next((tmp_path / "part").glob("part-*.parquet"))
    (tmp_path / "one.parquet").write_bytes(part.read_bytes())
    for source in ("many", "one"):
        counted = run_stream(running_counts(stream_table(spark, str(tmp_path), source), "k"), name())
        assert rows(counted) == [(0, 7), (1, 7), (2, 6)]


def test_watermark_closes_windows(spark, tmp_path):
    """With a watermark closed windows come out once, and late rows for them do not count."""
    folder = tmp_path / "in"
    folder.mkdir()
    time = F.to_timestamp(F.col("value"))
    lines = stream_lines(spark, str(folder), 1).withColumn("k", F.lit("x"))
    counted = sliding_counts(lines, "k", "1 minute", "1 minute", time=time, watermark="1 minute")
    query_name = name()
    query = start_stream(counted, query_name, "memory", output_mode="append")
    try:
        for text in ("2026-01-01 00:00:10\n2026-01-01 00:00:20", "2026-01-01 00:10:00", "2026-01-01 00:00:30", "2026-01-01 00:20:00"):
            (folder / f"{uuid.uuid4().hex}.txt").write_text(text + "\n")
            query.processAllAvailable()
        got = [(str(r.window_start), r.n) for r in spark.table(query_name).orderBy("window_start").collect()]
        assert got[0] == ("2026-01-01 00:00:00", 2)
    finally:
        query.stop()


def files_of(folder):
    return {str(p): p.read_bytes() for p in folder.rglob("part-*")}


def test_upserts_write_changed_keys_and_equal_the_whole_table(spark, tmp_path):
    folder, out = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    place = {"path": str(out), "checkpoint": str(tmp_path / "log"), "once": True}
    expected = {}
    for k, keys in enumerate(["aab", "b", "c", "ca", "d", "d"]):
        (folder / f"{k}.txt").write_text("\n".join(keys) + "\n")
        for key in keys:
            expected[key] = expected.get(key, 0) + 1
        stream = UpsertStream(running_counts(stream_lines(spark, str(folder)), "value"), name(), ["value"], 3, **place)
        stream.query.awaitTermination()
        assert rows(stream.latest()) == sorted(expected.items())
        assert rows(spark.read.parquet(str(out / f"batch-{k}")).select("value")) == sorted((c,) for c in set(keys))
    # Batches 0 to 2 went into the table of batch 2, 3 to 5 into that of batch 5; the former are gone.
    assert sorted(p.name for p in out.iterdir()) == ["batch-3", "batch-4", "batch-5", "table-2", "table-5"]


def test_replayed_upserts_change_nothing(spark, tmp_path):
    folder, out = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    (folder / "a.txt").write_text("a\nb\n")
    counts = running_counts(stream_lines(spark, str(folder)), "value")
    stream = UpsertStream(counts, name(), ["value"], 2, path=str(out), once=True)
    stream.query.awaitTermination()
    batch = spark.createDataFrame([("a", 1), ("b", 1)], "value string, n long")
    stream._write(batch, 0)
    assert rows(stream.latest()) == [("a", 1), ("b", 1)]
    stream._write(spark.createDataFrame([("b", 5)], "value string, n long"), 1)
    assert rows(stream.latest()) == [("a", 1), ("b", 5)] and (out / "table-1").exists()
    before = files_of(out)
    stream._write(batch, 1)
    stream._write(batch, 0)
    assert files_of(out) == before and rows(stream.latest()) == [("a", 1), ("b", 5)]


def test_upserts_keep_nulls_apart(spark, tmp_path):
    (tmp_path / "a.log").write_text("\n".join(LOG[:4]) + "\n")
    counts = running_counts(parse_logs(stream_lines(spark, str(tmp_path))))
    assert rows(run_stream(counts, name(), ["status"])) == rows(run_stream(counts, name()))


def test_closed_windows_come_once_and_late_rows_are_told(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    time = F.to_timestamp(F.col("value"))
    lines = stream_lines(spark, str(folder), 1).withColumn("k", F.lit("x"))
    counted = sliding_counts(lines, "k", "1 minute", "1 minute", time=time, watermark="1 minute")
    place = {"path": str(tmp_path / "out"), "checkpoint": str(tmp_path / "log")}
    stream = AppendStream(counted, name(), **place)
    try:
        for text in ("2026-01-01 00:00:10\n2026-01-01 00:00:20", "2026-01-01 00:10:00", "2026-01-01 00:00:30"):
            (folder / f"{uuid.uuid4().hex}.txt").write_text(text + "\n")
            stream.query.processAllAvailable()
        assert [(str(r.window_start), r.n) for r in stream.closed().collect()] == [("2026-01-01 00:00:00", 2)]
        assert stream.late() == 1
    finally:
        stream.query.stop()
    # After a restart the closed window is still there, and the open one closes.
    (folder / "last.txt").write_text("2026-01-01 01:00:00\n")
    stream = AppendStream(counted, name(), **place, once=True)
    stream.query.awaitTermination()
    got = sorted((str(r.window_start), r.n) for r in stream.closed().collect())
    assert got == [("2026-01-01 00:00:00", 2), ("2026-01-01 00:10:00", 1)]
