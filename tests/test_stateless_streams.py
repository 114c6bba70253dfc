"""Operators without state give the same rows on a stream as in batch."""

import pytest
from pyspark.sql import functions as F

from millrace.messages import decode_json, decode_text, normalise_content_type, to_messages
from millrace.operators.basic import filter_messages, to_request_json, transform_payload
from millrace.operators.bulk import bulk_load
from millrace.operators.entities import json_entities
from millrace.operators.headers import enrich_headers, filter_headers
from millrace.operators.lookup import enrich_lookup
from millrace.operators.meters import metric_lines
from millrace.operators.posts import filter_any, stable_sample
from millrace.operators.route import route
from millrace.operators.scripts import apply_udf
from millrace.operators.split import split_messages
from millrace.sinks.broker import to_broker
from millrace.sinks.files import write_text
from millrace.sinks.tables import table_rows
from millrace.sources.changes import unwrap_changes
from millrace.sources.syslog import parse_syslog
from millrace.streaming.runs import run_available

K = "get_json_object(decode(payload, 'UTF-8'), '$.k')"


def _text(d):
    return decode_text(d).withColumn("payload", F.col("text")).drop("text")


def _lookup(d):
    ref = d.sparkSession.range(200).select("id", F.concat(F.lit("u"), "id").alias("name"))
    return enrich_lookup(d, ref, {"id": "cast(headers['user'] as bigint)"}, "name")


OPERATORS = {
    "decode": lambda d: decode_json(d, "k int").select("event_id", "data.k"),
    "filter": lambda d: filter_messages(d, "headers['type'] = 'view'"),
    "transform": lambda d: transform_payload(_text(d), "upper(payload)"),
    "split": lambda d: split_messages(_text(d), delimiter=":", correlation="event_id"),
    "enrich": lambda d: enrich_headers(d, {"k": K, "type": "'x'"}, overwrite=True),
    "headers": lambda d: filter_headers(d, "u*"),
    "types": lambda d: normalise_content_type(enrich_headers(d, {"originalContentType": "'text/plain'"})),
    "code": lambda d: apply_udf(_text(d), lambda s: s.str.len(), "long"),
    "lookup": _lookup,
    "request": lambda d: d.select("event_id", to_request_json("headers['type']").alias("j")),
    "bulk": lambda d: bulk_load(_text(d), "t", ("a",), "csv", delimiter=":")[1],
    "loaded": lambda d: bulk_load(_text(d), "t", ("a", "b"), "csv", delimiter=":", quote="'")[0],
    "entities": lambda d: json_entities(d, "k int")[0].select("event_id", "k"),
    "columns": lambda d: table_rows(d, "k,twice:k*2", "k int"),
    "broker": lambda d: to_broker(d, "'t'", "headers['user']"),
    "route": lambda d: route(d, "headers['type']", {"view": "v"}, default="d"),
    "metric": lambda d: metric_lines(d, "m", K, "event_id", "s", {"type": "headers['type']"}),
    "syslog": lambda d: parse_syslog(_text(d).withColumn("payload", F.concat(F.lit("<34>1 - h a - - - "), "payload"))),
    "posts": lambda d: filter_any(_text(d), "payload", ["69"], user="event_id", follow=[1, 2]),
    "sample": lambda d: stable_sample(d, "event_id", 20),
    "changes": lambda d: unwrap_changes(d.withColumn("payload", F.lit('{"op":"c","after":{"id":7}}')), "id int", ["op"]),
}


@pytest.fixture(scope="module")
def folder(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("events") / "in")
    e = spark.read.parquet(f"{sf}/events.parquet").drop("ts")
    to_messages(e, "encode(props, 'UTF-8')", {"type": "event_type", "user": "user_id"}, "application/json", keep=("event_id",)).repartition(3).write.parquet(path)
    return path


def _plain(df):
    """Rows as comparable text."""
    columns = [F.to_json(F.struct(F.map_entries(c))) if t.startswith("map") else F.col(c).cast("string") for c, t in df.dtypes]
    return sorted(str(tuple(r)) for r in df.select(*columns).collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_same_rows(spark, folder, tmp_path, name):
    batch = spark.read.parquet(folder)
    stream = spark.readStream.schema(batch.schema).parquet(folder)
    out = str(tmp_path / "out")
    run_available(OPERATORS[name](stream), out, str(tmp_path / "check"))
    want = _plain(OPERATORS[name](batch))
    assert want and _plain(spark.read.parquet(out)) == want


def test_text_files(spark, folder, tmp_path):
    batch = spark.read.parquet(folder)
    stream = spark.readStream.schema(batch.schema).parquet(folder)
    write_text(stream, str(tmp_path / "s"), "headers['type']", checkpoint=str(tmp_path / "check")).awaitTermination()
    write_text(batch, str(tmp_path / "b"), "headers['type']")
    assert _plain(spark.read.text(str(tmp_path / "s"))) == _plain(spark.read.text(str(tmp_path / "b")))
