"""Streams over the contract tables, run over all the input that is there and then stopped."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallywork.functions.logs import parse_logs
from tallywork.plans.registry import query
from tallywork.plans.texts import STATUS_SQL, event_lines, parse_sql
from tallywork.session import materialise, scratch_path
from tallywork.sinks import AppendStream, UpsertStream, run_stream, save, start_stream
from tallywork.sources.files import read_table
from tallywork.sources.streams import stream_lines, stream_table
from tallywork.streaming.counts import running_counts, sliding_counts


def _log_folder(spark, folder):
    path = scratch_path(spark, "logs")
    save(event_lines(spark, folder).select("value"), path, fmt="text")
    return path


@query("stream_status_counts", STATUS_SQL)
def stream_status_counts(spark, folder):
    """Text folder to the in-memory table: one row per status code, so the driver can hold it."""
    lines = stream_lines(spark, _log_folder(spark, folder))
    name = f"counts_{uuid.uuid4().hex}"
    start_stream(running_counts(parse_logs(lines)), name, "memory", once=True).awaitTermination()
    return spark.table(name)


@query("stream_status_table", STATUS_SQL)
def stream_status_table(spark, folder):
    """The same counts in two files per batch, to a table the executors write."""
    lines = stream_lines(spark, _log_folder(spark, folder), files_per_trigger=2)
    return run_stream(running_counts(parse_logs(lines)), f"status_{uuid.uuid4().hex}")


@query("stream_status_upsert", STATUS_SQL)
def stream_status_upsert(spark, folder):
    """The same counts as a log of changed rows, merged into a table every other batch."""
    counts = running_counts(parse_logs(stream_lines(spark, _log_folder(spark, folder), files_per_trigger=2)))
    stream = UpsertStream(counts, f"changes_{uuid.uuid4().hex}", ["status"], compact_every=2, once=True)
    stream.query.awaitTermination()
    return stream.latest()


#: Arrivals: a quarter of the time span each, every 40th event three quarters late.
ARRIVALS = 4
_ARRIVED_SQL = f"""
    SELECT ts, event_type,
           least({ARRIVALS - 1}, span * {ARRIVALS} // (last + 1) + CASE WHEN event_id % 40 = 0 THEN 3 ELSE 0 END) AS arrival
    FROM (
        SELECT *, epoch(date_trunc('second', ts))::BIGINT - min(epoch(date_trunc('second', ts))::BIGINT) OVER () AS span,
               max(epoch(date_trunc('second', ts))::BIGINT) OVER () - min(epoch(date_trunc('second', ts))::BIGINT) OVER () AS last
        FROM events
    )
"""


def arrived(spark, folder):
    """(ts, event_type, arrival) of each event."""
    events = read_table(spark, folder, "events").select("event_id", "ts", "event_type")
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    ends = events.agg(F.min(at).alias("first"), (F.max(at) - F.min(at)).alias("last")).first()
    late = F.when(F.col("event_id") % 40 == 0, 3).otherwise(0)
    quarter = F.expr(f"(unix_seconds(cast(ts as timestamp)) - {ends.first}) * {ARRIVALS} div {ends.last + 1}")
    return events.select("ts", "event_type", F.least(F.lit(ARRIVALS - 1), quarter + late).alias("arrival"))


@query(
    "stream_closed_windows",
    f"""
    WITH arrived AS ({_ARRIVED_SQL}),
    marks AS (
        -- The watermark when an arrival is read: an hour behind the latest time of the arrivals before it.
        SELECT a.arrival, max(b.ts) - INTERVAL 1 HOUR AS mark
        FROM (SELECT DISTINCT arrival FROM arrived) a LEFT JOIN arrived b ON b.arrival < a.arrival GROUP BY a.arrival
    ),
    rows AS (
        SELECT event_type, arrival, time_bucket(INTERVAL 10 MINUTE, ts) - back * INTERVAL 10 MINUTE AS window_start
        FROM arrived, (SELECT unnest([0, 1, 2]) AS back)
    )
    SELECT window_start, window_start + INTERVAL 30 MINUTE AS window_end, event_type, count(*) AS n
    FROM rows JOIN marks USING (arrival)
    WHERE (mark IS NULL OR window_start + INTERVAL 30 MINUTE > mark)
      AND window_start + INTERVAL 30 MINUTE <= (SELECT max(ts) - INTERVAL 1 HOUR FROM arrived)
    GROUP BY window_start, event_type
    """,
)
def stream_closed_windows(spark, folder):
    """Event-time windows that the watermark has closed, of events that come in four arrivals, some of them too late."""
    events, path = arrived(spark, folder), scratch_path(spark, "arrivals")
    rows = materialise(events, "arrived")
    stream = None
    for arrival in range(ARRIVALS):
        rows.where(F.col("arrival") == arrival).drop("arrival").write.mode("append").parquet(path)
        if stream is None:
            source = spark.readStream.schema(rows.drop("arrival").schema).parquet(path)
            time = F.col("ts").cast("timestamp")  # a watermark needs a point in time
            counts = sliding_counts(source, "event_type", "30 minutes", "10 minutes", time, watermark="1 hour")
            stream = AppendStream(counts, f"closed_{uuid.uuid4().hex}")
        stream.query.processAllAvailable()
    stream.query.stop()
    ends = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    return stream.closed().withColumns(ends)


@query(
    "stream_sliding_counts",
    """
    SELECT window_start, window_start + INTERVAL 30 MINUTE AS window_end, event_type, count(*) AS n
    FROM (
        SELECT event_type, time_bucket(INTERVAL 10 MINUTE, ts) - back * INTERVAL 10 MINUTE AS window_start
        FROM events, (SELECT unnest([0, 1, 2]) AS back)
    ) GROUP BY window_start, event_type
    """,
)
def stream_sliding_counts(spark, folder):
    events = stream_table(spark, folder, "events").select("ts", "event_type")
    counts = sliding_counts(events, "event_type", "30 minutes", "10 minutes", F.col("ts"))
    return run_stream(counts, f"windows_{uuid.uuid4().hex}")


@query("stream_processing_time_window")
def stream_processing_time_window(spark, folder):
    """Endpoint counts in 30 s windows by 10 s of processing time, as the clock has it."""
    lines = stream_lines(spark, _log_folder(spark, folder))
    return run_stream(sliding_counts(parse_logs(lines)), f"endpoints_{uuid.uuid4().hex}")


@query(
    "stream_processing_time_totals",
    f"SELECT endpoint, CAST(3 * count(*) AS BIGINT) AS n FROM ({parse_sql(False)}) GROUP BY endpoint",
)
def stream_processing_time_totals(spark, folder):
    """The same windows added up per endpoint: each line is in three, whatever the clock says."""
    windows = stream_processing_time_window(spark, folder)
    return windows.groupBy("endpoint").agg(F.sum("n").alias("n"))
