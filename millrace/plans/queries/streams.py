"""Operators on streams: the tables are read as a stream to their end, with the same answers as in batch."""

from pyspark.sql import functions as F

from millrace.operators.meters import counter, throughput
from millrace.operators.posts import dedup_recent
from millrace.operators.split import split_messages
from millrace.plans.queries.groups import CONTENT_SQL, COUNT_SQL, EITHER_SQL, PARTIAL_SQL
from millrace.plans.queries.registry import query, table
from millrace.session import scratch_path
from millrace.operators.aggregate import collect_groups
from millrace.streaming.aggregate import aggregate_stream, open_groups
from millrace.streaming.batches import aggregate_batches, open_rows, reassemble_batches
from millrace.streaming.runs import run_available, run_batches, use_rocksdb


def _stream(spark, sf_dir, name):
    # A pattern of one name: Spark follows folders and patterns, but no single file.
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{{{name}}}.parquet")


def _result(spark, stream):
    out = scratch_path(spark, "stream")
    run_available(stream, out, scratch_path(spark, "checkpoint"))
    return spark.read.schema(stream.schema).parquet(out)


def _with_open(spark, groups):
    """What a stream of groups emits, and the groups it still holds at its end."""
    out, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "checkpoint")
    run_available(groups, out, checkpoint)
    return spark.read.schema(groups.schema).parquet(out).unionByName(open_groups(spark, checkpoint, payload_type="bigint"))


def _released(spark, stream, *how, **options):
    """What :func:`aggregate_batches` writes over the stream, and its store."""
    out, store = scratch_path(spark, "groups"), scratch_path(spark, "open")
    run_batches(stream, aggregate_batches(out, store, *how, **options), scratch_path(spark, "checkpoint"))
    return spark.read.parquet(out).drop("batch"), store


def _listed():
    return F.array_join(F.col("payloads").cast("array<string>"), ",").alias("payloads")


@query(COUNT_SQL)
def stream_aggregate_by_count(spark, sf_dir):
    """A1"""
    groups, _ = _released(spark, _stream(spark, sf_dir, "events"), "event_type", ["ts", "event_id"], release_size=3, payload="event_id")
    return groups.select("event_type", "group_no", _listed())


@query(CONTENT_SQL)
def stream_aggregate_by_content(spark, sf_dir):
    """A2"""
    groups, _ = _released(spark, _stream(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], release_expr="event_type = 'purchase'", payload="event_type")
    return groups.select("user_id", "group_no", _listed())


@query(EITHER_SQL)
def stream_aggregate_by_count_or_content(spark, sf_dir):
    """A1 with A2: three messages or a purchase, whichever comes first"""
    groups, _ = _released(spark, _stream(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], 3, "event_type = 'purchase'", "event_id")
    return groups.select("user_id", "group_no", _listed())


@query("""
WITH m AS (SELECT *, lag(event_type) OVER w = 'purchase' OR ts - lag(ts) OVER w > INTERVAL 2 HOUR AS starts FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
     g AS (SELECT *, coalesce(sum(starts::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0)::BIGINT AS group_no FROM m)
SELECT user_id, group_no, count(*)::INT AS size, bool_or(event_type = 'purchase') AS closed, string_agg(event_id::VARCHAR, ',' ORDER BY ts, event_id) AS payloads
FROM g GROUP BY 1, 2
""")
def stream_idle_groups(spark, sf_dir):
    """A4: a purchase closes a group, two idle hours end it as a partial one; with the groups open when the stream stopped"""
    use_rocksdb(spark)
    stream = _stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "1 minute")
    groups = aggregate_stream(stream, "user_id", ["ts", "event_id"], None, "event_type = 'purchase'", "event_id", 2 * 3_600_000, True, True)
    return _with_open(spark, groups).select("user_id", "group_no", "size", "closed", _listed())


@query(PARTIAL_SQL)
def stream_partial_groups(spark, sf_dir):
    """A4: released groups, and those still open when the stream stopped"""
    groups, store = _released(spark, _stream(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], release_size=7, payload="event_id")
    both = groups.unionByName(collect_groups(open_rows(spark, store, ["user_id"]), ["user_id"]))
    return both.select("user_id", "group_no", "size", "closed", _listed())


@query("SELECT doc_id, text FROM documents")
def stream_reassemble_documents(spark, sf_dir):
    """A3 after P6"""
    docs = _stream(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("payload"))
    out = scratch_path(spark, "whole")
    pieces = split_messages(docs, delimiter="\n", correlation="doc_id")
    run_batches(pieces, reassemble_batches(out, scratch_path(spark, "open")), scratch_path(spark, "checkpoint"))
    return spark.read.parquet(out).select(F.col("correlation").alias("doc_id"), F.array_join("payloads", "\n").alias("text"))


@query("SELECT 'events' AS name, event_type AS type, count(*) AS value FROM events GROUP BY event_type")
def stream_counters(spark, sf_dir):
    """A5 in update mode: the last value of each meter"""
    out = scratch_path(spark, "meters")

    def write(batch, batch_id):
        batch.withColumn("batch", F.lit(batch_id)).write.mode("append").parquet(out)

    meters = counter(_stream(spark, sf_dir, "events"), "events", {"type": "event_type"}, "1L")
    run_batches(meters.select("name", F.col("tags")["type"].alias("type"), "value"), write, scratch_path(spark, "checkpoint"), "update")
    return spark.read.parquet(out).groupBy("name", "type").agg(F.max_by("value", "batch").alias("value"))


@query("""
SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS start, messages, bytes
FROM (SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01') AS h, count(*) AS messages, sum(length(props))::BIGINT AS bytes FROM events GROUP BY 1)
""")
def stream_throughput(spark, sf_dir):
    """A7 in update mode: the last figures of every interval, those that end after the stream's last message too"""
    stream = _stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "1 hour")
    out = scratch_path(spark, "intervals")

    def write(batch, batch_id):
        batch.withColumn("batch", F.lit(batch_id)).write.mode("append").parquet(out)

    run_batches(throughput(stream, "ts", "6 hours", "props", running=False), write, scratch_path(spark, "checkpoint"), "update")
    latest = spark.read.parquet(out).groupBy("start").agg(F.max_by(F.struct("messages", "bytes"), "batch").alias("f"))
    return latest.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "f.messages", "f.bytes")


@query("SELECT event_id, props FROM events")
def stream_dedup(spark, sf_dir):
    """Every event arrives twice"""
    stream = _stream(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "props")
    return _result(spark, dedup_recent(stream.union(stream), "event_id", "ts", "30 days")).select("event_id", "props")
