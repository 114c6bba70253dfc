"""Split, reassemble, aggregate, push to lists."""

from pyspark.sql import functions as F

from millrace.messages import to_messages
from millrace.operators.aggregate import aggregate
from millrace.operators.lists import push_batches
from millrace.operators.split import reassemble, split_messages
from millrace.plans.queries.registry import query, table
from millrace.session import scratch_path

COUNT_SQL = """
SELECT event_type, ((rn - 1) // 3)::BIGINT AS group_no, string_agg(event_id::VARCHAR, ',' ORDER BY rn) AS payloads
FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events)
GROUP BY 1, 2 HAVING count(*) = 3
"""

CONTENT_SQL = """
SELECT user_id, group_no, string_agg(event_type, ',' ORDER BY ts, event_id) AS payloads
FROM (SELECT *, (coalesce(sum((event_type = 'purchase')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS group_no,
             sum((event_type = 'purchase')::INT) OVER (PARTITION BY user_id) AS closers FROM events)
WHERE group_no < closers GROUP BY 1, 2
"""


PARTIAL_SQL = """
SELECT user_id, ((rn - 1) // 7)::BIGINT AS group_no, count(*)::INT AS size, count(*) = 7 AS closed, string_agg(event_id::VARCHAR, ',' ORDER BY rn) AS payloads
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
GROUP BY 1, 2
"""

EITHER_SQL = """
WITH s AS (SELECT *, coalesce(sum((event_type = 'purchase')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg FROM events),
     p AS (SELECT *, event_type = 'purchase' OR row_number() OVER (PARTITION BY user_id, seg ORDER BY ts, event_id) % 3 = 0 AS closes FROM s),
     g AS (SELECT *, coalesce(sum(closes::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS group_no,
                  sum(closes::INT) OVER (PARTITION BY user_id) AS closers FROM p)
SELECT user_id, group_no, string_agg(event_id::VARCHAR, ',' ORDER BY ts, event_id) AS payloads FROM g WHERE group_no < closers GROUP BY 1, 2
"""


@query("""
SELECT doc_id, i AS sequence_number, len(parts)::INT AS sequence_size, parts[i] AS payload
FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1))::INT AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))
""")
def split_documents(spark, sf_dir):
    """P6 by delimiter"""
    m = to_messages(table(spark, sf_dir, "documents"), "text", {}, "text/plain", keep=("doc_id",))
    return split_messages(m, delimiter="\n").select("doc_id", "sequence_number", "sequence_size", "payload")


@query("""
SELECT event_id, i AS sequence_number, 2 AS sequence_size, CASE i WHEN 1 THEN event_type ELSE props END AS payload
FROM events, (VALUES (1), (2)) v(i)
""")
def split_by_expression(spark, sf_dir):
    """P6 by expression"""
    m = to_messages(table(spark, sf_dir, "events"), "struct(event_type, props)", {}, "application/json", keep=("event_id",))
    out = split_messages(m, "array(payload.event_type, payload.props)")
    return out.select("event_id", "sequence_number", "sequence_size", "payload")


@query("SELECT doc_id, len(string_split(text, chr(10)))::BIGINT AS size, text FROM documents")
def reassemble_documents(spark, sf_dir):
    """A3: undoes P6"""
    m = to_messages(table(spark, sf_dir, "documents"), "text", {}, "text/plain", keep=("doc_id",))
    whole = reassemble(split_messages(m, delimiter="\n", correlation="doc_id"))
    return whole.select(F.col("correlation").alias("doc_id"), "size", F.array_join("payloads", "\n").alias("text"))


@query("""
SELECT l_orderkey, max(l_linenumber)::BIGINT AS size, string_agg(part::VARCHAR, ',' ORDER BY l_linenumber) AS parts
FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS part FROM lineitem GROUP BY 1, 2)
GROUP BY l_orderkey HAVING count(*) = max(l_linenumber)
""")
def reassemble_orders(spark, sf_dir):
    """A3: orders without a gap below their highest line number; some lines arrive repeatedly"""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    sizes = lines.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("of"))
    whole = reassemble(lines.join(sizes, "l_orderkey"), "l_orderkey", "l_linenumber", "of", "l_partkey")
    return whole.select(F.col("correlation").alias("l_orderkey"), "size", F.array_join(F.col("payloads").cast("array<string>"), ",").alias("parts"))


def _listed(df):
    return F.array_join(F.col("payloads").cast("array<string>"), ",").alias("payloads")


@query(COUNT_SQL)
def aggregate_by_count(spark, sf_dir):
    """A1"""
    out = aggregate(table(spark, sf_dir, "events"), "event_type", ["ts", "event_id"], release_size=3, payload="event_id")
    return out.select("event_type", "group_no", _listed(out))


@query(CONTENT_SQL)
def aggregate_by_content(spark, sf_dir):
    """A2: a purchase closes the group of its user"""
    out = aggregate(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], release_expr="event_type = 'purchase'", payload="event_type")
    return out.select("user_id", "group_no", _listed(out))


@query(EITHER_SQL)
def aggregate_by_count_or_content(spark, sf_dir):
    """A1 with A2: three messages or a purchase, whichever comes first"""
    out = aggregate(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], 3, "event_type = 'purchase'", "event_id")
    return out.select("user_id", "group_no", _listed(out))


@query(PARTIAL_SQL)
def aggregate_with_partial_groups(spark, sf_dir):
    """A4: the incomplete group at the end of each key as well"""
    out = aggregate(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], release_size=7, payload="event_id", send_partial=True)
    return out.select("user_id", "group_no", "size", "closed", _listed(out))


@query("""
SELECT key, row_number() OVER (PARTITION BY key ORDER BY conv_id, turn, i) AS seq, parts[i] AS value
FROM (SELECT role AS key, conv_id, turn, parts, unnest(range(1, len(parts) + 1)) AS i
      FROM (SELECT *, string_split(text, '. ') AS parts FROM conversations))
""")
def push_to_lists(spark, sf_dir):
    """K9: the sentences of each role, in order; the later conversations are pushed onto the earlier ones, and those twice"""
    turns = table(spark, sf_dir, "conversations").withColumn("payload", F.split("text", r"\. "))
    half = turns.agg((F.max("conv_id") / 2).alias("m")).first().m
    out = scratch_path(spark, "lists")
    push = push_batches(out, scratch_path(spark, "tops"), "role", ["conv_id", "turn"])
    early, late = turns.filter(F.col("conv_id") <= half), turns.filter(F.col("conv_id") > half)
    for batch_id, part in ((0, early), (0, early), (1, late)):
        push(part, batch_id)
    return spark.read.parquet(out).select("key", "seq", "value")
