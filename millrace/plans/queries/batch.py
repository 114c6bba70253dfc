"""Filter, transform, headers, user code, lookup, meters and routing."""

from pyspark.sql import functions as F

from millrace.functions.expressions import load_variables
from millrace.messages import decode_json, decode_text, normalise_content_type, to_messages
from millrace.operators.basic import bridge, filter_messages, to_request_json, transform_payload
from millrace.operators.headers import enrich_headers, filter_headers
from millrace.operators.lookup import enrich_lookup, with_request
from millrace.operators.meters import counter, gauge, metric_lines, throughput
from millrace.operators.route import route
from millrace.operators.scripts import apply_udf
from millrace.plans.compose import compose, compose_named
from millrace.plans.queries.registry import event_messages, query, table, text_of
from millrace.session import scratch_path
from millrace.sinks.files import write_routed


@query("""
SELECT 'activity' AS name, event_type AS type, user_id::VARCHAR AS "user", sum(json_extract_string(props, '$.k')::BIGINT)::BIGINT AS value
FROM events WHERE event_type IN ('error', 'purchase') GROUP BY event_type, user_id
""")
def activity_by_type_and_user(spark, sf_dir):
    """Decode, filter, enrich and count: the activity of each user by event type."""
    steps = compose(
        decode_text,
        lambda d: filter_messages(d, "headers['type'] in ('error', 'purchase')"),
        lambda d: enrich_headers(d, {"k": "get_json_object(text, '$.k')"}),
        lambda d: counter(d, "activity", {"type": "headers['type']", "user": "headers['user']"}, "cast(headers['k'] as bigint)"),
    )
    out = steps(event_messages(spark, sf_dir))
    return out.select("name", F.col("tags")["type"].alias("type"), F.col("tags")["user"].alias("user"), "value")


@query("SELECT event_id, props AS payload, 'type=' || event_type || ';user=' || user_id AS headers FROM events")
def bridge_events(spark, sf_dir):
    """P1"""
    m = bridge(event_messages(spark, sf_dir))
    return m.select("event_id", F.decode("payload", "UTF-8").alias("payload"), text_of("headers").alias("headers"))


@query("""
SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE props END AS text FROM events
""")
def decode_text_payloads(spark, sf_dir):
    """P2, with one kind of message that is binary"""
    kind = F.when(F.col("headers")["type"] == "view", "application/octet-stream").when(F.col("headers")["type"] == "click", "text/plain").otherwise("application/json")
    return decode_text(event_messages(spark, sf_dir).withColumn("content_type", kind)).select("event_id", "text")


@query("""
SELECT event_id, CASE WHEN event_type NOT IN ('error', 'view') THEN json_extract_string(props, '$.k')::INT END AS k,
       CASE WHEN event_type = 'error' THEN replace(props, '}', '') ELSE props END AS payload
FROM events
""")
def decode_json_payloads(spark, sf_dir):
    """P3, with one kind of message that does not parse and one that is not JSON"""
    m = event_messages(spark, sf_dir)
    broken = F.when(F.col("headers")["type"] == "error", F.encode(F.replace(F.decode("payload", "UTF-8"), F.lit("}"), F.lit("")), "UTF-8")).otherwise(F.col("payload"))
    kind = F.when(F.col("headers")["type"] == "view", "application/octet-stream").otherwise("application/json")
    m = m.withColumns({"payload": broken, "content_type": kind})
    return decode_json(m, "k int").select("event_id", F.col("data.k").alias("k"), F.decode("payload", "UTF-8").alias("payload"))


@query("SELECT event_id, json_extract_string(props, '$.k')::INT AS k FROM events")
def decode_json_variants(spark, sf_dir):
    """P3 without a schema"""
    return decode_json(event_messages(spark, sf_dir)).select("event_id", F.variant_get("data", "$.k", "int").alias("k"))


@query("SELECT event_id, event_type AS payload FROM events WHERE length(event_type) > 5 AND value >= 10")
def filter_by_expression(spark, sf_dir):
    """P4"""
    m = to_messages(table(spark, sf_dir, "events"), "event_type", {}, "text/plain", keep=("event_id", "value"))
    return filter_messages(m, "length(payload) > 5 and value >= least_value", {"least_value": 10.0}).select("event_id", "payload")


@query("SELECT event_id, upper(event_type) AS payload, user_id::VARCHAR AS \"user\" FROM events")
def transform_by_expression(spark, sf_dir):
    """P5"""
    m = to_messages(table(spark, sf_dir, "events"), "event_type", {"user": "user_id"}, "text/plain", keep=("event_id",))
    return transform_payload(m, "upper(payload)").select("event_id", "payload", F.col("headers")["user"].alias("user"))


@query("""
SELECT event_id, 'bean=beanValue;k=' || json_extract_string(props, '$.k') || ';type=' || event_type || ';user=' || user_id AS kept,
       'bean=beanValue;k=' || json_extract_string(props, '$.k') || ';type=fiz;user=' || user_id AS replaced
FROM events
""")
def enrich_with_headers(spark, sf_dir):
    """P8"""
    m = decode_text(event_messages(spark, sf_dir))
    new = "k=get_json_object(text, '$.k')\ntype='fiz'\nbean=bean_value\nnone=nullif(1, 1)"
    variables = {"bean_value": "beanValue"}
    kept = enrich_headers(m.withColumn("given", F.col("headers")), new, variables=variables).withColumn("kept", text_of("headers"))
    again = kept.withColumn("headers", F.col("given"))
    return enrich_headers(again, new, overwrite=True, variables=variables).select("event_id", "kept", text_of("headers").alias("replaced"))


@query("""
SELECT event_id, 'foo-bar=' || props || ';user=' || user_id AS named, '' AS none, 'application/json' AS content_type FROM events
""")
def filter_by_header_name(spark, sf_dir):
    """P9"""
    m = enrich_headers(event_messages(spark, sf_dir), {"foo": "'1'", "foo-bar": "decode(payload, 'UTF-8')", "pf-a": "'2'", "pf-b": "'3'"})
    named = filter_headers(m, "foo, type pf-*").withColumn("named", text_of("headers"))
    return filter_headers(named, delete_all=True).select("event_id", "named", text_of("headers").alias("none"), "content_type")


@query("SELECT event_id, user_id * 5 AS payload FROM events")
def user_code(spark, sf_dir):
    """P10"""
    m = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("payload"))
    return apply_udf(m, lambda payload, limit: payload * limit, "long", {"limit": 5})


@query("SELECT event_id, substr(event_type, 1, 3) || ' WORLD' AS payload FROM events")
def text_with_variables(spark, sf_dir):
    """A script that is a plain expression, its variables from a file and inline"""
    variables = load_variables({"size": "9", "foo": " WORLD"}, ["size=3"])
    m = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("payload"))
    return transform_payload(m, "concat(substring(payload, 1, cast(size as int)), foo)", variables)


@query("""
SELECT event_id, 'GET' AS method, '/customers/' || user_id AS url, c_name || ' (' || c_mktsegment || ')' AS payload
FROM events LEFT JOIN customer ON c_custkey = user_id
""")
def lookup_responses(spark, sf_dir):
    """P12"""
    m = event_messages(spark, sf_dir)
    asked = with_request(m, "concat('/customers/', headers['user'])", headers="map('Accept','text/plain')")
    answered = enrich_lookup(
        asked, table(spark, sf_dir, "customer"), {"c_custkey": "cast(headers['user'] as bigint)"}, "concat(c_name, ' (', c_mktsegment, ')')"
    )
    return answered.select("event_id", "request.method", "request.url", "payload")


@query("""
SELECT event_id, '{"args":["k=' || json_extract_string(props, '$.k') || '"],"deploymentProps":{"user":"' || user_id || '"},"name":"task-' || event_type || '"}' AS request
FROM events
""")
def task_requests(spark, sf_dir):
    """P13"""
    m = decode_text(event_messages(spark, sf_dir))
    request = to_request_json("concat('task-', headers['type'])", ["concat('k=', get_json_object(text, '$.k'))"], {"user": "headers['user']"})
    return m.select("event_id", request.alias("request"))


@query("SELECT event_id, upper(event_type) || '!' AS payload FROM events WHERE event_type <> 'view'")
def composed_by_name(spark, sf_dir):
    """P14"""
    registry = {
        "notViews": lambda d: filter_messages(d, "payload <> 'view'"),
        "upper": lambda d: transform_payload(d, "upper(payload)"),
        "shout": lambda d: transform_payload(d, "concat(payload, '!')"),
    }
    m = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("payload"))
    return m.transform(compose_named("'notViews|upper,shout'", registry))


@query("""
SELECT event_id, CASE WHEN event_type = 'view' THEN 'text/html' WHEN event_type = 'click' THEN 'application/octet-stream' ELSE 'application/json' END AS content_type
FROM events
""")
def content_types(spark, sf_dir):
    """P15"""
    m = event_messages(spark, sf_dir)
    m = m.withColumn("content_type", F.when(F.col("headers")["type"] != "click", F.col("content_type")))
    m = enrich_headers(m, {"originalContentType": "case when headers['type'] = 'view' then 'text/html' end"})
    return normalise_content_type(m).select("event_id", "content_type")


@query("SELECT 'chars-' || event_type AS name, user_id::VARCHAR AS \"user\", sum(length(props))::BIGINT AS value FROM events GROUP BY event_type, user_id")
def counters(spark, sf_dir):
    """A5 with a computed name"""
    m = decode_text(event_messages(spark, sf_dir))
    out = counter(m, F.concat(F.lit("chars-"), F.col("headers")["type"]), {"user": "headers['user']"}, "length(text)")
    return out.select("name", F.col("tags")["user"].alias("user"), "value")


@query("SELECT 'value' AS name, 'type=' || event_type AS tags, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY event_type")
def gauges(spark, sf_dir):
    """A6"""
    out = gauge(event_messages(spark, sf_dir), "value", {"type": "headers['type']"}, "value", ["ts", "event_id"])
    return out.select("name", text_of("tags").alias("tags"), "value")


@query("""
SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS start, messages, bytes, round(messages / 3600.0, 6) AS messages_per_s,
       round(bytes / 1048576.0 / 3600.0, 9) AS mb_per_s,
       (sum(messages) OVER o)::BIGINT AS total_messages, (sum(bytes) OVER o)::BIGINT AS total_bytes,
       round((sum(messages) OVER o) / (date_diff('second', min(h) OVER o, h) + 3600)::DOUBLE, 6) AS total_messages_per_s
FROM (SELECT date_trunc('hour', ts) AS h, count(*) AS messages, sum(length(props))::BIGINT AS bytes FROM events GROUP BY 1)
WINDOW o AS (ORDER BY h)
""")
def throughput_per_hour(spark, sf_dir):
    """A7"""
    out = throughput(event_messages(spark, sf_dir), "ts", "1 hour")
    return out.select(
        F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "messages", "bytes",
        F.round("messages_per_s", 6).alias("messages_per_s"), F.round("mb_per_s", 9).alias("mb_per_s"),
        "total_messages", "total_bytes", F.round("total_messages_per_s", 6).alias("total_messages_per_s"),
    )


@query("SELECT 'orders' AS name, 'application=loader;status=' || o_orderstatus || ';stream=orders' AS tags, count(*) AS value FROM orders GROUP BY o_orderstatus")
def common_tags(spark, sf_dir):
    """A8"""
    orders = table(spark, sf_dir, "orders")
    out = counter(orders, "orders", {"status": "o_orderstatus"}, "1", {"stream": "orders", "application": "loader"})
    return out.select("name", text_of("tags").alias("tags"), F.col("value").cast("long").alias("value"))


@query("""
SELECT event_id, '"event-k" ' || json_extract_string(props, '$.k') || ' ' || (epoch_us(ts) // 1000) || ' source=events type="' || event_type || '" user="' || user_id || '"' AS payload
FROM events
""")
def metric_text(spark, sf_dir):
    """K12"""
    m = decode_text(event_messages(spark, sf_dir))
    tags = {"user": "headers['user']", "type": "headers['type']", "absent": "get_json_object(text, '$.absent')"}
    ts = "unix_millis(cast(ts as timestamp))"
    return metric_lines(m, "event-k", "get_json_object(text, '$.k')", ts, "events", tags).select("event_id", "payload")


@query("""
SELECT event_id, CASE event_type WHEN 'error' THEN 'alerts' WHEN 'purchase' THEN 'sales' ELSE 'discards' END AS destination FROM events
""")
def route_with_default(spark, sf_dir):
    """Mapped keys, the rest to the default"""
    m = event_messages(spark, sf_dir)
    return route(m, "headers['type']", "error=alerts\npurchase=sales", default="discards").select("event_id", "destination")


@query("""
SELECT event_id, CASE event_type WHEN 'error' THEN 'alerts' ELSE event_type END AS destination FROM events
""")
def route_to_new_destinations(spark, sf_dir):
    """Unmapped keys name their destination"""
    return route(event_messages(spark, sf_dir), "headers['type']", {"error": "alerts"}).select("event_id", "destination")


@query("""
SELECT event_id, CASE event_type WHEN 'error' THEN 'alerts' WHEN 'view' THEN 'view' END AS destination,
       CASE WHEN event_type NOT IN ('error', 'view') THEN 'no destination for key ' || event_type END AS route_error
FROM events
""")
def route_with_required_resolution(spark, sf_dir):
    """Only mapped or declared destinations"""
    m = event_messages(spark, sf_dir)
    out = route(m, "headers['type']", {"error": "alerts"}, default="unused", required=True, declared=["view"], on_error="keep")
    return out.select("event_id", "destination", "route_error")


@query("""
SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN event_type ELSE 'other' END AS destination FROM events
UNION ALL SELECT event_id, 'audit' FROM events WHERE event_type = 'error'
""")
def route_to_several(spark, sf_dir):
    """A list of allowed destinations, and messages that go to two"""
    keys = "case when headers['type'] = 'error' then array('error', 'audit') else array(headers['type']) end"
    out = route(event_messages(spark, sf_dir), keys, default="other", allowed=["error", "view", "audit", "other"])
    return out.select("event_id", "destination")


@query("""
SELECT CASE event_type WHEN 'error' THEN 'alerts' ELSE event_type END AS destination, count(*) AS messages, sum(length(props))::BIGINT AS bytes
FROM events GROUP BY 1
""")
def write_by_destination(spark, sf_dir):
    """One pass that writes every destination, read back by destination"""
    path = scratch_path(spark, "routed")
    write_routed(route(decode_text(event_messages(spark, sf_dir)), "headers['type']", {"error": "alerts"}), path)
    back = spark.read.parquet(path)
    return back.groupBy("destination").agg(F.count(F.lit(1)).alias("messages"), F.sum(F.length("text")).alias("bytes"))
