"""Bulk loads, entities, table columns, upserts, broker rows, text files."""

import uuid

from pyspark.sql import functions as F

from millrace.messages import decode_text, to_messages
from millrace.operators.bulk import bulk_load
from millrace.operators.entities import json_entities
from millrace.plans.queries.registry import event_messages, query, table
from millrace.session import scratch_path
from millrace.sinks.broker import to_broker
from millrace.sinks.files import write_text
from millrace.sinks.tables import column_types, load_lines, table_rows, write_table
from millrace.sinks.upsert import read_documents, upsert

ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


def _csv_lines(spark, sf_dir):
    """Orders as CSV lines: quoted priorities, status P left empty, F quoted and empty."""
    orders = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "P", "").when(F.col("o_orderstatus") == "F", '""').otherwise(F.col("o_orderstatus"))
    line = F.concat_ws(",", "o_orderkey", "o_custkey", status, F.concat(F.lit('"'), "o_orderpriority", F.lit(', ""x"""')))
    return orders.select("o_orderkey", "o_orderpriority", line.alias("payload"))


@query("""
SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey,
       CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN '' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority || ', "x"' AS o_orderpriority
FROM orders
""")
def bulk_load_csv(spark, sf_dir):
    """K4"""
    return bulk_load(_csv_lines(spark, sf_dir), "orders", ORDER_COLUMNS, "csv")[0]


@query("""
SELECT o_orderkey::VARCHAR AS o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderstatus = 'F' THEN chr(92) || 'N' ELSE 'a' || chr(9) || 'b' || chr(92) || o_orderpriority END AS note
FROM orders
""")
def bulk_load_text(spark, sf_dir):
    r"""K4: tab-separated text with \N and escapes"""
    status = F.when(F.col("o_orderstatus") == "P", r"\N").otherwise(F.col("o_orderstatus"))
    note = F.when(F.col("o_orderstatus") == "F", r"\\N").otherwise(F.concat(F.lit("a\\\tb\\\\"), "o_orderpriority"))
    lines = table(spark, sf_dir, "orders").select(F.concat_ws("\t", "o_orderkey", status, note).alias("payload"))
    return bulk_load(lines, "orders", ("o_orderkey", "o_orderstatus", "note"), "text")[0]


@query("""
SELECT o_orderkey::VARCHAR AS o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus, '' AS empty,
       CASE o_orderstatus WHEN 'F' THEN 'null' WHEN 'O' THEN 'a|null||b''' ELSE o_orderpriority END AS note
FROM orders
""")
def bulk_load_dialect(spark, sf_dir):
    """K4: own delimiter, quote and null string"""
    status = F.when(F.col("o_orderstatus") == "P", "null").otherwise(F.col("o_orderstatus"))
    note = F.when(F.col("o_orderstatus") == "F", "'null'").when(F.col("o_orderstatus") == "O", "'a|null||b'''").otherwise(F.col("o_orderpriority"))
    lines = table(spark, sf_dir, "orders").select(F.concat_ws("|", "o_orderkey", status, F.lit(""), note).alias("payload"))
    return bulk_load(lines, "orders", ("o_orderkey", "o_orderstatus", "empty", "note"), "csv", delimiter="|", quote="'", null_string="null")[0]


@query("""
SELECT 'orders' AS table_name, CASE o_orderpriority WHEN '1-URGENT' THEN 'missing data for a column' ELSE 'extra data after last expected column' END AS error_message,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'GARBAGE ' || o_orderkey ELSE o_orderkey || ',1,2,3,4' END AS payload
FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')
""")
def bulk_load_errors(spark, sf_dir):
    """K5: two priorities' lines are broken"""
    broken = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("GARBAGE "), "o_orderkey"))
        .when(F.col("o_orderpriority") == "5-LOW", F.concat("o_orderkey", F.lit(",1,2,3,4")))
        .otherwise(F.col("payload"))
    )
    return bulk_load(_csv_lines(spark, sf_dir).withColumn("payload", broken), "orders", ORDER_COLUMNS, "csv")[1]


@query("""
SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey,
       CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN '' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority || ', "x"' AS o_orderpriority
FROM orders
""")
def bulk_load_into_new_table(spark, sf_dir):
    """K6: a catalog table made anew with text columns, twice, loaded and read back; a broken line goes to the error table"""
    name = f"loaded_{uuid.uuid4().hex}"
    where = {"path": scratch_path(spark, "loaded")}
    lines = _csv_lines(spark, sf_dir).select("payload")
    load_lines(lines.limit(3), name, ORDER_COLUMNS, "csv", initialize=True, options=where)
    # one broken line per order that is urgent, beside the good ones
    broken = _csv_lines(spark, sf_dir).filter("o_orderpriority = '1-URGENT'").select(F.concat(F.lit("GARBAGE "), "o_orderkey").alias("payload"))
    load_lines(lines.unionByName(broken), name, ORDER_COLUMNS, "csv", error_table=f"{name}_errors", initialize=True, options=where)
    return spark.table(name)


@query("SELECT 'orders' AS table_name, 'missing data for a column' AS error_message, 'GARBAGE ' || o_orderkey AS payload FROM orders WHERE o_orderpriority = '1-URGENT'")
def bulk_load_error_table(spark, sf_dir):
    """K5: the error table of a load that wrote good and bad rows"""
    name = f"errors_{uuid.uuid4().hex}"
    orders = _csv_lines(spark, sf_dir)
    broken = F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("GARBAGE "), "o_orderkey")).otherwise(F.col("payload"))
    load_lines(orders.select(broken.alias("payload")), name, ORDER_COLUMNS, "csv", error_table=f"{name}_errors", initialize=True, options={"path": scratch_path(spark, "loaded")})
    return spark.table(f"{name}_errors").withColumn("table_name", F.replace("table_name", F.lit(name), F.lit("orders")))


@query("""
SELECT o_orderkey AS id, o_orderstatus AS status, o_custkey AS second, NULL::VARCHAR AS missing, o_orderkey || '/' || o_orderstatus AS label, 'json' AS kind FROM orders
""")
def columns_of_unknown_json(spark, sf_dir):
    """K3: paths, a list position and a missing path in JSON without a schema, written to a catalog table whose types count, and read back"""
    orders = table(spark, sf_dir, "orders")
    doc = F.to_json(F.struct("o_orderkey", F.struct(F.array(F.lit(0), "o_custkey").alias("keys"), F.col("o_orderstatus").alias("state")).alias("who")))
    m = to_messages(orders.select(doc.alias("d")), "d", {"kind": "'json'"}, "application/json")
    name = f"columns_{uuid.uuid4().hex}"
    kinds = "id bigint, status string, second bigint, missing string, label string, kind string"
    write_table(spark.createDataFrame([], kinds), name, options={"path": scratch_path(spark, "columns")})
    mapping = "id:o_orderkey,status:who.state,second:payload.who.keys[1],missing:who.none.at_all,label:concat(payload.o_orderkey, '/', payload.who.state),kind:headers['kind']"
    write_table(table_rows(m, mapping, types=column_types(spark, name)), name)
    return spark.table(name)


@query("""
SELECT o_orderkey AS id, o_orderstatus AS status, o_custkey AS customer, o_orderkey || '/' || o_custkey AS label FROM orders
""")
def columns_of_json(spark, sf_dir):
    """K3: columns from paths into a nested JSON payload"""
    orders = table(spark, sf_dir, "orders")
    doc = F.to_json(F.struct("o_orderkey", F.struct(F.col("o_custkey").alias("key"), F.col("o_orderstatus").alias("state")).alias("who")))
    m = to_messages(orders.select(doc.alias("d")), "d", {}, "application/json")
    schema = "o_orderkey bigint, who struct<key:bigint,state:string>"
    return table_rows(m, "id:o_orderkey,status:who.state,customer:payload.who.key,label:concat(o_orderkey, '/', who.key)", schema)


@query("""
SELECT event_id, json_extract_string(props, '$.k')::INT AS k FROM events WHERE event_type <> 'error'
UNION ALL SELECT event_id, json_extract_string(props, '$.k')::INT + 1000 FROM events WHERE event_type = 'view'
""")
def json_lists_to_rows(spark, sf_dir):
    """K7: objects, lists of objects (views) and broken text (errors)"""
    other = F.regexp_replace("props", r"(\d+)", "1000")
    payload = (
        F.when(F.col("event_type") == "view", F.concat(F.lit(" ["), "props", F.lit(', {"k": 1000, "add": '), F.regexp_extract("props", r"\d+", 0), F.lit("}]")))
        .when(F.col("event_type") == "error", F.lit('{"k": '))
        .otherwise(F.col("props"))
    )
    m = table(spark, sf_dir, "events").select("event_id", payload.alias("payload"))
    good, _ = json_entities(m, "k int, add int")
    return good.select("event_id", (F.col("k") + F.coalesce("add", F.lit(0))).alias("k"))


@query("SELECT event_id, '{\"k\": ' AS payload FROM events WHERE event_type = 'error'")
def json_lists_errors(spark, sf_dir):
    """K7: the messages that are not JSON"""
    payload = F.when(F.col("event_type") == "error", F.lit('{"k": ')).otherwise(F.col("props"))
    return json_entities(table(spark, sf_dir, "events").select("event_id", payload.alias("payload")), "k int")[1]


@query("""
SELECT CASE WHEN event_type IN ('error', 'view') THEN event_type ELSE 'events' END AS "index", user_id::VARCHAR AS id,
       arg_max(props, event_id) AS document
FROM events GROUP BY 1, 2
""")
def upsert_documents(spark, sf_dir):
    """K8: two rounds of upserts, the index from a header or the option; the older half comes last"""
    e = table(spark, sf_dir, "events")
    named = F.expr("case when event_type in ('error', 'view') then event_type end")
    m = to_messages(e, "props", {"INDEX_NAME": named}, "application/json", keep=("event_id", "user_id"))
    half = e.agg((F.max("event_id") / 2).alias("m")).first().m
    path = scratch_path(spark, "documents")
    for part in (m.filter(F.col("event_id") > half), m.filter(F.col("event_id") <= half)):
        upsert(spark, part, path, "user_id", "event_id", index="events")
    return read_documents(spark, path).select("index", "id", "document")


@query("""
SELECT 'events-' || event_type AS topic, user_id::VARCHAR AS key, props AS value, 'contentType=application/json;type=' || event_type AS headers, count(*) AS n
FROM events GROUP BY ALL
""")
def broker_rows(spark, sf_dir):
    """K10"""
    out = to_broker(event_messages(spark, sf_dir), "concat('events-', headers['type'])", "headers['user']", "type, other", require_key=True)
    headers = F.array_join(F.transform("headers", lambda h: F.concat(h["key"], F.lit("="), F.decode(h["value"], "UTF-8"))), ";")
    text = out.select("topic", F.decode("key", "UTF-8").alias("key"), F.decode("value", "UTF-8").alias("value"), headers.alias("headers"))
    return text.groupBy("topic", "key", "value", "headers").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_type || '.json' AS file_key, props AS value, count(*) AS n FROM events GROUP BY ALL")
def text_files_by_name(spark, sf_dir):
    """K1: files named by an expression, read back"""
    path = scratch_path(spark, "text")
    write_text(event_messages(spark, sf_dir), path, "headers['type']", "json")
    return spark.read.text(path).groupBy("file_key", "value").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT strftime(ts, '%Y-%m-%d') AS object, count(*) AS lines, sum(length(props))::BIGINT AS chars FROM events GROUP BY 1")
def objects_by_header(spark, sf_dir):
    """K2: object names from the header file_name"""
    path = scratch_path(spark, "objects")
    m = to_messages(table(spark, sf_dir, "events"), "props", {"file_name": "date_format(ts, 'yyyy-MM-dd')"}, "text/plain")
    write_text(m, path, "headers['file_name']", compact=True)
    back = spark.read.text(path).withColumn("object", F.col("file_key").cast("string"))
    return back.groupBy("object").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("value")).alias("chars"))
