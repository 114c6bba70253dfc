"""Tables, topics, generated messages, syslog and change events."""

import hashlib
import itertools

from pyspark.sql import functions as F

from millrace.messages import to_messages
from millrace.plans.queries.registry import query, table, text_of
from millrace.session import scratch_path
from millrace.sources.changes import unparsed_changes, unwrap_changes
from millrace.operators.numbering import number_rows
from millrace.sources.generate import fill_payload, generate_messages, time_spine, zero_fill
from millrace.sources.syslog import parse_syslog
from millrace.sources.tables import TablePoller, poll_chunks, read_table, row_lists
from millrace.sources.topics import topic_messages

ORDER_ROW = "o_orderkey bigint, o_custkey bigint, o_orderpriority string"


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 200000")
def rows_of_a_query(spark, sf_dir):
    """S3: one message per row"""
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders_to_read")
    return read_table(spark, "select o_orderkey, o_custkey, o_orderstatus from orders_to_read where o_totalprice > 200000")


@query("""
SELECT poll, count(*)::INT AS n, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderdate, o_orderkey) AS keys
FROM (SELECT *, ((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 500 + 1)::BIGINT AS poll FROM orders) GROUP BY poll
""")
def row_lists_of_a_table(spark, sf_dir):
    """S3 with split=False: one list per poll"""
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey")
    lists = row_lists(orders, ["o_orderdate", "o_orderkey"], 500)
    keys = F.array_join(F.transform("payload", lambda r: r["o_orderkey"].cast("string")), ",")
    return lists.select("poll", F.size("payload").alias("n"), keys.alias("keys"))


@query("""
SELECT poll, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM (SELECT o_orderkey, ((row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 + 1)::BIGINT AS poll FROM orders) GROUP BY poll
""")
def polls_of_a_table(spark, sf_dir):
    """Which poll of 1000 rows reads which keys"""
    polls = poll_chunks(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 1000)
    return polls.groupBy("poll").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


@query("""
SELECT ((rn - 1) // greatest(400, (n + 5) // 6) + 1)::INT AS poll, o_orderkey
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn, count(*) OVER () AS n FROM orders)
""")
def committed_polls(spark, sf_dir):
    """Polls of a sixth of the table (400 rows at least) until nothing is left, the position kept between them"""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    state, out = scratch_path(spark, "position"), scratch_path(spark, "polled")
    size = max(400, -(-orders.count() // 6))
    for poll in itertools.count(1):
        poller = TablePoller(spark, state, "o_orderkey", size)
        poller.poll(orders).withColumn("poll", F.lit(poll)).write.mode("append").parquet(out)
        polled = spark.read.parquet(out).filter(F.col("poll") == poll)
        if polled.isEmpty():
            return spark.read.parquet(out)
        poller.commit(polled)


@query("""
SELECT 'events-0-' || event_id AS msg_id, event_type AS key, props AS payload, 'contentType=application/json;user=' || user_id AS headers, 'application/json' AS content_type
FROM events
""")
def topic_rows(spark, sf_dir):
    """The projection of a topic's rows, on a table of the topic's schema"""
    e = table(spark, sf_dir, "events")

    def header(name, value):
        return F.struct(F.lit(name).alias("key"), F.encode(value, "UTF-8").alias("value"))

    user = F.col("user_id").cast("string")
    rows = e.select(
        F.col("event_type").cast("binary").alias("key"), F.col("props").cast("binary").alias("value"), F.lit("events").alias("topic"),
        F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"), F.lit(0).alias("timestampType"),
        F.array(header("user", F.lit("older")), header("contentType", F.lit("application/json")), header("user", user)).alias("headers"),
    )
    m = topic_messages(rows)
    return m.select("msg_id", "key", F.decode("payload", "UTF-8").alias("payload"), text_of("headers").alias("headers"), "content_type")


@query(f"""
SELECT event_id, i AS producer, i * n + rn - 1 AS message, md5(rpad(((i * n + rn - 1)::VARCHAR || ':' || props), 100, '.')) AS content, '{hashlib.md5(bytes(100)).hexdigest()}' AS sent
FROM (SELECT *, row_number() OVER (ORDER BY event_id) AS rn, count(*) OVER () AS n FROM events), (VALUES (0::BIGINT), (1::BIGINT)) p(i)
""")
def generated_load(spark, sf_dir):
    """Two producers, each sending one message of 100 zero bytes per event; and the same with the message's number and the event's properties in front"""
    numbered = number_rows(table(spark, sf_dir, "events").select("event_id", "props", F.lit(0).alias("all")), ["all"], ["event_id"], "rn")
    per_producer = table(spark, sf_dir, "events").count()
    load = generate_messages(spark, producers=2, count=per_producer, size=100).withColumn("sent", F.md5("payload"))
    message = F.col("producer") * F.lit(per_producer) + F.col("sequence_number")
    sent = load.join(numbered, F.col("sequence_number") == F.col("rn") - 1)
    filled = sent.withColumn("message", message).withColumn("payload", fill_payload(F.concat(F.col("message").cast("string"), F.lit(":"), "props"), 100))
    return filled.select("event_id", F.col("producer").cast("bigint").alias("producer"), "message", F.md5("payload").alias("content"), "sent")


@query("""
WITH hours AS (SELECT unnest(generate_series(min(date_trunc('hour', ts)), max(date_trunc('hour', ts)), INTERVAL 1 HOUR)) AS h FROM events),
     types AS (SELECT DISTINCT event_type FROM events),
     n AS (SELECT date_trunc('hour', ts) AS h, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT strftime(h, '%m/%d/%y %H:%M:%S') AS payload, event_type, coalesce(n, 0)::BIGINT AS n
FROM (SELECT h, event_type FROM hours, types) LEFT JOIN n USING (h, event_type)
""")
def hours_without_gaps(spark, sf_dir):
    """Events per hour and type, 0 for hours without any"""
    e = table(spark, sf_dir, "events").select("event_type", F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("tick"))
    ends = e.agg(F.min("tick").alias("a"), F.max("tick").alias("b")).first()
    spine = time_spine(spark, ends.a, ends.b, "1 hour", e.select("event_type").distinct())
    counts = e.groupBy("tick", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return zero_fill(spine, counts, ["tick", "event_type"], ["n"]).select("payload", "event_type", "n")


@query("""
SELECT event_id, CASE event_type WHEN 'view' THEN NULL ELSE (event_id % 192 // 8)::INT END AS facility,
       CASE event_type WHEN 'view' THEN NULL ELSE (event_id % 8)::INT END AS severity,
       CASE event_type WHEN 'view' THEN NULL ELSE 'host-' || user_id END AS host, CASE event_type WHEN 'view' THEN NULL ELSE event_type END AS app,
       CASE event_type WHEN 'view' THEN NULL ELSE event_id::VARCHAR END AS proc_id,
       CASE WHEN event_type IN ('error', 'click') THEN 1 END AS version,
       CASE WHEN event_type IN ('error', 'click') THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN event_type <> 'view' THEN strftime(ts, '%b %d %H:%M:%S') END AS timestamp_text,
       CASE WHEN event_type <> 'view' THEN CASE event_id % 7 WHEN 0 THEN props || chr(30) || 'x' ELSE props END END AS message,
       CASE WHEN event_type IN ('error', 'click') THEN CASE event_id % 500 WHEN 0 THEN 100012 ELSE 11 END END AS sd_chars, CASE event_type WHEN 'view' THEN '<1 ' || props END AS undecoded
FROM events
""")
def syslog_fields(spark, sf_dir):
    """Lines of both formats, and lines of none (views), made from events"""
    pri = F.concat(F.lit("<"), F.col("event_id") % 192, F.lit(">"))
    # Some lines hold 100,000 characters of structured data, with escapes; some hold a control character.
    long = F.when(F.col("event_id") % 500 == 0, F.concat(F.lit('"'), F.repeat(F.lit("x\\]y"), 25_000), F.lit('\\\\"'))).otherwise(F.lit('"c"'))
    text = F.when(F.col("event_id") % 7 == 0, F.concat("props", F.lit("\x1ex"))).otherwise(F.col("props"))
    host, at = F.concat(F.lit("host-"), "user_id"), F.col("ts").cast("timestamp")
    line = (
        F.when(F.col("event_type") == "view", F.concat(F.lit("<1 "), "props"))
        .when(
            F.col("event_type").isin("error", "click"),
            F.concat(pri, F.lit("1 "), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(" "), host, F.lit(" "), "event_type", F.lit(" "), "event_id", F.lit(" ID1 [a@1 b="), long, F.lit("] "), text),
        )
        .otherwise(F.concat(pri, F.date_format(at, "MMM dd HH:mm:ss"), F.lit(" "), host, F.lit(" "), "event_type", F.lit("["), "event_id", F.lit("]: "), text))
    )
    lines = table(spark, sf_dir, "events").select("event_id", line.alias("payload"))
    sd = F.length("structured_data").alias("sd_chars")
    return parse_syslog(lines).select("event_id", "facility", "severity", "host", "app", "proc_id", "version", "timestamp_text", "message", sd, "undecoded")


def _change_events(spark, sf_dir):
    """Orders as change events: F inserted, O updated, P deleted (with a tombstone each)."""
    orders = table(spark, sf_dir, "orders")
    row = F.struct("o_orderkey", "o_custkey", "o_orderpriority")
    op = F.when(F.col("o_orderstatus") == "F", "c").when(F.col("o_orderstatus") == "O", "u").otherwise("d")
    source = F.struct(F.lit("shop").alias("name"), F.lit("sales").alias("db"), F.lit("orders").alias("table"), F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts_ms"))
    event = F.struct(F.when(op != "c", row).alias("before"), F.when(op != "d", row).alias("after"), source.alias("source"), op.alias("op"))
    payload = F.array(F.to_json(event), F.lit("null"))
    deleted = F.slice(payload, 1, F.when(op == "d", 2).otherwise(1))
    rows = orders.select("o_orderkey", F.explode(deleted).alias("p")).withColumnRenamed("o_orderkey", "k")
    return to_messages(rows, "p", {"row_key": "concat('{\"o_orderkey\":', k, '}')"}, "application/json")


def _flat(spark, sf_dir, mode, drop, extra=()):
    out = unwrap_changes(_change_events(spark, sf_dir), ORDER_ROW, ("op", "name", "db", "source.ts_ms"), mode, drop)
    return out.select(
        F.col("headers")["row_key"].alias("key"), "o_orderkey", "o_custkey", "o_orderpriority",
        F.col("__op").alias("added_op"), F.col("__name").alias("added_name"), F.col("__db").alias("added_db"), F.col("__source_ts_ms").alias("added_ts"), "op",
        *extra,
    )


_KEY = "'{\"o_orderkey\":' || o_orderkey || '}' AS key"
_ADDED = "CASE o_orderstatus WHEN 'F' THEN 'c' WHEN 'O' THEN 'u' ELSE 'd' END AS added_op, 'shop' AS added_name, 'sales' AS added_db, epoch_ms(o_orderdate) AS added_ts, CASE o_orderstatus WHEN 'F' THEN 'c' WHEN 'O' THEN 'u' ELSE 'd' END AS op"
_NO_ROW = "NULL::BIGINT AS o_orderkey, NULL::BIGINT AS o_custkey, NULL::VARCHAR AS o_orderpriority, NULL::VARCHAR AS added_op, NULL::VARCHAR AS added_name, NULL::VARCHAR AS added_db, NULL::BIGINT AS added_ts"


@query(f"SELECT {_KEY}, o_orderkey, o_custkey, o_orderpriority, {_ADDED} FROM orders WHERE o_orderstatus <> 'P'")
def changes_without_deletes(spark, sf_dir):
    """Deletes and tombstones dropped"""
    return _flat(spark, sf_dir, "drop", True)


@query(f"""
SELECT {_KEY}, o_orderkey, o_custkey, o_orderpriority, {_ADDED} FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT {_KEY}, {_NO_ROW}, 'd' AS op FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT {_KEY}, {_NO_ROW}, 'tombstone' AS op FROM orders WHERE o_orderstatus = 'P'
""")
def changes_with_null_rows(spark, sf_dir):
    """Deletes and tombstones as rows of NULLs"""
    return _flat(spark, sf_dir, "none", False)


@query(f"""
SELECT {_KEY}, o_orderkey, o_custkey, o_orderpriority, {_ADDED}, (o_orderstatus = 'P')::VARCHAR AS deleted FROM orders
UNION ALL SELECT {_KEY}, {_NO_ROW}, 'tombstone' AS op, NULL AS deleted FROM orders WHERE o_orderstatus = 'P'
""")
def changes_with_delete_marks(spark, sf_dir):
    """Deletes rewritten to the old row with a mark, tombstones kept"""
    return _flat(spark, sf_dir, "rewrite", False, [F.col("__deleted").alias("deleted")])


@query("""
SELECT '{"o_orderkey":' || o_orderkey || '}' AS key, CASE o_orderkey % 20 WHEN 0 THEN '{"before":' WHEN 10 THEN '{"other":1}' END AS payload,
       CASE o_orderkey % 20 WHEN 0 THEN 'payload is not JSON' ELSE 'neither a row change nor a schema change' END AS error_message
FROM orders WHERE o_orderkey % 10 = 0
""")
def changes_that_do_not_parse(spark, sf_dir):
    """Every tenth event broken off, or of another kind; the others and the tombstones are no errors"""
    events = _change_events(spark, sf_dir).withColumn("k", F.get_json_object(F.col("headers")["row_key"], "$.o_orderkey").cast("bigint"))
    broken = F.when(F.col("k") % 20 == 0, '{"before":').when(F.col("k") % 20 == 10, '{"other":1}')
    mixed = events.withColumn("payload", F.when(F.col("payload") == "null", F.col("payload")).otherwise(F.coalesce(broken, "payload")))
    return unparsed_changes(mixed).select(F.col("headers")["row_key"].alias("key"), "payload", "error_message")
