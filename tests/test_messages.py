"""Envelope, decoders, one-row operators and headers, on the literal messages of the golden cases."""

from pyspark.sql import functions as F

from millrace.functions.expressions import load_variables
from millrace.messages import decode_json, decode_text, normalise_content_type, to_messages
from millrace.operators.basic import bridge, filter_messages, to_request_json, transform_payload
from millrace.operators.headers import enrich_headers, filter_headers
from millrace.plans.compose import channel_name, compose, compose_named, definition_names


def _messages(spark, payloads, headers=None, content_type="text/plain"):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "i int, p string")
    return to_messages(df, "p", headers or {}, content_type, keep=("i",))


def _payloads(df):
    return [r.payload for r in df.orderBy("i").collect()]


def test_bridge_filter_transform(spark):
    df = _messages(spark, ["hello world message", "foo", None])
    assert bridge(df) is df
    assert _payloads(filter_messages(df, "length(payload) > 5")) == ["hello world message"]
    assert _payloads(filter_messages(df, "length(payload) > cut", {"cut": 2}))[:2] == ["hello world message", "foo"]
    assert _payloads(transform_payload(df, "upper(payload)")) == ["HELLO WORLD MESSAGE", "FOO", None]


def test_decoders(spark):
    df = spark.createDataFrame(
        [(0, b"plain", "text/plain"), (1, b'{"a":1}', "application/json;charset=UTF-8"), (2, b"{bad", "application/json"),
         (3, b"\x00\x01", "application/octet-stream"), (4, b'{"a":2}', "text/plain")],
        "i int, p binary, c string",
    )
    m = to_messages(df, "p", {}, F.col("c"), keep=("i",))
    assert [r.text for r in decode_text(m).orderBy("i").collect()] == ["plain", '{"a":1}', "{bad", None, '{"a":2}']
    rows = decode_json(m, "a int").orderBy("i").collect()
    assert [r.data.a if r.data else None for r in rows] == [None, 1, None, None, None]
    assert bytes(rows[2].payload) == b"{bad"
    variants = decode_json(m).select("i", F.try_variant_get("data", "$.a", "int").alias("a")).orderBy("i").collect()
    assert [r.a for r in variants] == [None, 1, None, None, None]


def test_content_type(spark):
    df = spark.range(3).select(
        F.col("id").alias("i"), F.lit("x").alias("payload"),
        F.when(F.col("id") == 0, F.create_map(F.lit("originalContentType"), F.lit("application/json"))).alias("headers"),
        F.when(F.col("id") < 2, F.lit("text/plain")).alias("content_type"),
    )
    got = [r.content_type for r in normalise_content_type(df).orderBy("i").collect()]
    assert got == ["application/json", "text/plain", "application/octet-stream"]


def test_enrich_headers(spark):
    df = _messages(spark, ["hello"], {"baz": "'qux'"})
    new = "foo='bar'\nbaz='fiz'\nbuz=payload\njaz=bean"
    got = enrich_headers(df, new, overwrite=True, variables={"bean": "beanValue"})
    assert got.columns == df.columns
    assert got.first().headers == {"foo": "bar", "baz": "fiz", "buz": "hello", "jaz": "beanValue"}
    kept = enrich_headers(df, new, variables={"bean": "beanValue"}).first().headers
    assert kept == {"foo": "bar", "baz": "qux", "buz": "hello", "jaz": "beanValue"}
    assert enrich_headers(df, {"none": "nullif('a','a')"}).first().headers == {"baz": "qux"}


def test_filter_headers(spark):
    df = _messages(spark, ["x"], {"bar": "'1'", "foo": "'2'", "foo-bar": "'3'", "pf-a": "'4'"})
    assert set(filter_headers(df, "foo,bar").first().headers) == {"foo-bar", "pf-a"}
    assert set(filter_headers(df, "pf-* foo").first().headers) == {"bar", "foo-bar"}
    row = filter_headers(df, delete_all=True).first()
    assert row.headers == {} and row.content_type == "text/plain"
    assert len(filter_headers(df, "").first().headers) == 4


def test_request_json(spark):
    df = _messages(spark, ["07/26/21 22:08:35"])
    sized = transform_payload(df, "length(payload)")
    named = enrich_headers(sized, {"task-id": "payload * 2"})
    got = named.select(to_request_json("concat('task-', headers['task-id'])").alias("j")).first().j
    assert got == '{"args":[],"deploymentProps":{},"name":"task-34"}'
    args = df.select(to_request_json("'t'", ["concat('f=', payload)"], {"k": "'v'"}).alias("j")).first().j
    assert args == '{"args":["f=07/26/21 22:08:35"],"deploymentProps":{"k":"v"},"name":"t"}'


def test_compose(spark):
    assert definition_names("'first|second'") == definition_names("first,second") == ["first", "second"]
    assert channel_name("first,second") == "firstsecond"
    registry = {"upper": lambda d: transform_payload(d, "upper(payload)"), "long": lambda d: filter_messages(d, "length(payload)>3")}
    df = _messages(spark, ["abc", "abcd"])
    assert _payloads(compose_named("upper|long", registry)(df)) == ["ABCD"]
    assert _payloads(compose(registry["long"], registry["upper"])(df)) == ["ABCD"]


def test_variables_of_a_file_win():
    assert load_variables({"limit": "3", "a": "b"}, ["# comment", "limit=5", "foo=\\ WORLD", ""]) == {"limit": "5", "a": "b", "foo": "\\ WORLD"}
