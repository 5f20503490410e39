"""Streams.  Each query works off a table as a stream and returns what was written."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace import scratch
from millrace.operators.aggregates import dedupe
from millrace.operators.versioned import VersionedTable
from millrace.plans.multi_hop import HopPaths, run_hops
from millrace.queries.registry import query, table
from millrace.sources import files, sinks, topics
from millrace.streaming import runs, tables
from millrace.streaming.changes import apply_changes
from millrace.streaming.windows import naive_times, sliding_activity

_EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


def _written(stream, label: str, **options):
    """Run the stream to its end into a new parquet folder; read that back."""
    spark = stream.sparkSession
    path = scratch.new_path(spark, label)
    runs.to_parquet(stream, path, runs.new_checkpoint(stream, label), **options)
    return spark.read.schema(stream.schema).parquet(path)


def _events(spark, sf_dir):
    return files.stream_table(spark, f"{sf_dir}/events.parquet")


def _timed(stream):
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query("stream_file_source", _EVENTS)
def stream_file_source(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = scratch.new_path(spark, "arriving")
    sinks.write_csv(events.repartition(5, "event_id"), path)
    stream = files.stream_csv(spark, path, events.schema, files_per_trigger=2)
    return _written(stream, "file-stream")


@query("stream_parquet_sink", "SELECT event_id, ts, CAST(ts AS DATE) AS day, value FROM events")
def stream_parquet_sink(spark, sf_dir):
    stream = _events(spark, sf_dir).select(
        "event_id", "ts", F.to_date("ts").alias("day"), "value"
    )
    return _written(stream, "parquet-sink", partition_by=("day",))


def _topic(spark, sf_dir):
    """The events as topic messages in files: key, value (bytes of JSON), timestamp."""
    events = table(spark, sf_dir, "events")
    fields = ["event_id", "user_id", "event_type", "value"]
    messages = topics.encode(events.select(*fields, "ts"), "event_id", fields, time="ts")
    path = scratch.new_path(spark, "topic")
    messages.write.parquet(path)
    return spark.readStream.schema(messages.schema).parquet(path), events.select(*fields).schema


@query("stream_topic_parse", """
    SELECT event_id, user_id, event_type, value, ts AS "EventTime" FROM events""")
def stream_topic_parse(spark, sf_dir):
    messages, schema = _topic(spark, sf_dir)
    return naive_times(_written(topics.decode(messages, schema), "topic-parse"), "EventTime")


@query("stream_ingest_once", """
    SELECT event_id, user_id, event_type, value, ts AS "EventTime", CAST(ts AS DATE) AS "EventDate"
    FROM events""")
def stream_ingest_once(spark, sf_dir):
    messages, schema = _topic(spark, sf_dir)
    dated = topics.decode(messages, schema).withColumn("EventDate", F.to_date("EventTime"))
    return naive_times(_written(dated, "ingest"), "EventTime")


_WINDOWS = """
    SELECT time_bucket(INTERVAL 10 MINUTE, {ts}) - i * INTERVAL 10 MINUTE AS window_start,
           time_bucket(INTERVAL 10 MINUTE, {ts}) - i * INTERVAL 10 MINUTE + INTERVAL 30 MINUTE AS window_end,
           event_type, max({ts}) AS last_time, count(*) AS n
    FROM events, (SELECT unnest(range(3)) AS i)
    GROUP BY 1, 2, 3"""
_CLOSED = """
    SELECT * FROM ({windows})
    WHERE window_end <= (SELECT date_trunc('millisecond', max({ts})) FROM events) - INTERVAL 1 MINUTE"""
_TIMES = ("window_start", "window_end", "last_time")


@query("sliding_window", _WINDOWS.format(ts="ts"))
def sliding_window(spark, sf_dir):
    activity = sliding_activity(
        _timed(table(spark, sf_dir, "events")), "ts", "event_type", "30 minutes", "10 minutes",
        delay=None,
    )
    return naive_times(activity, *_TIMES)


@query("stream_sliding_append", _CLOSED.format(windows=_WINDOWS.format(ts="ts"), ts="ts"))
def stream_sliding_append(spark, sf_dir):
    activity = sliding_activity(
        _timed(_events(spark, sf_dir)), "ts", "event_type", "30 minutes", "10 minutes"
    )
    return naive_times(_written(activity, "sliding"), *_TIMES)


@query("stream_memory_complete", """
    SELECT event_type, count(*) AS n, max(ts) AS last_time FROM events GROUP BY event_type""")
def stream_memory_complete(spark, sf_dir):
    """Totals of the whole stream, read from its state."""
    totals = _timed(_events(spark, sf_dir)).groupBy("event_type").agg(
        F.count("*").alias("n"), F.max("ts").alias("last_time")
    )
    checkpoint = runs.new_checkpoint(totals, "totals")
    runs.to_state(totals, checkpoint)
    return naive_times(runs.state_rows(spark, checkpoint, ["n", "last_time"]), "last_time")


_MINUTE = "date_trunc('minute', ts)"


@query("multi_hop", _CLOSED.format(windows=_WINDOWS.format(ts=_MINUTE), ts=_MINUTE))
def multi_hop(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.date_format("ts", "dd/M/yy HH:mm").alias("event_date")
    )
    arriving = scratch.new_path(spark, "arriving")
    sinks.write_csv(events, arriving)
    raw = files.stream_csv(spark, arriving, events.schema)
    activity = run_hops(
        spark, raw, HopPaths(scratch.new_path(spark, "hops")), "event_date", "event_type",
        size="30 minutes", slide="10 minutes",
    )
    return naive_times(activity, *_TIMES)


@query("batch_plus_stream", f"{_EVENTS} UNION ALL {_EVENTS} UNION ALL {_EVENTS} WHERE value > 50")
def batch_plus_stream(spark, sf_dir):
    """A batch load and two streams, each with its own checkpoint, in one table."""
    target = VersionedTable(spark, scratch.new_path(spark, "vt"))
    target.create(table(spark, sf_dir, "events"))
    for stream in (_events(spark, sf_dir), _events(spark, sf_dir).where("value > 50")):
        tables.append_stream(stream, target, runs.new_checkpoint(stream))
    return target.read()


@query("stream_upsert", """
    WITH stale AS (
      SELECT * FROM events WHERE event_type = 'view'
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1),
    fresh AS (
      SELECT * FROM events WHERE event_type <> 'view'
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
    SELECT user_id, event_id, ts, event_type, value FROM fresh
    UNION ALL
    SELECT user_id, event_id, ts, event_type, value FROM stale
    WHERE user_id NOT IN (SELECT user_id FROM fresh)""")
def stream_upsert(spark, sf_dir):
    columns = ["user_id", "event_id", "ts", "event_type", "value"]
    views = table(spark, sf_dir, "events").where("event_type = 'view'").select(*columns)
    target = VersionedTable(spark, scratch.new_path(spark, "vt"), keys=["user_id"])
    target.create(dedupe(views, ["user_id"], ["ts", "event_id"]))
    stream = _events(spark, sf_dir).where("event_type <> 'view'").select(*columns)
    tables.upsert_stream(
        stream, target, ["user_id"], ["ts", "event_id"], runs.new_checkpoint(stream)
    )
    return target.read()


@query("stream_late_changes", """
    SELECT user_id, event_id, ts, event_type, value FROM events WHERE event_id % 10 > 0
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    UNION ALL
    SELECT user_id, event_id, ts, event_type, value FROM events WHERE event_id % 10 = 0 AND user_id NOT IN (
      SELECT user_id FROM events WHERE event_id % 10 > 0)
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""")
def stream_late_changes(spark, sf_dir):
    """Changes in four batches that know no order of time, into a table of older rows."""
    columns = ["user_id", "event_id", "ts", "event_type", "value"]
    events = table(spark, sf_dir, "events").select(*columns)
    target = VersionedTable(spark, scratch.new_path(spark, "vt"), keys=["user_id"])
    target.create(dedupe(events.where("event_id % 10 = 0"), ["user_id"], ["ts", "event_id"]))
    changes = events.where("event_id % 10 > 0")
    arriving = scratch.new_path(spark, "changes")
    for i in (2, 0, 3, 1):
        changes.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == i).coalesce(1).write.mode("append").parquet(arriving)
    stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 1).parquet(arriving)
    apply_changes(stream, target, ["user_id"], ["ts", "event_id"], runs.new_checkpoint(stream))
    return target.read()
