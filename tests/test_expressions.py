"""The expressions users write over a message."""

import pytest
from pyspark.sql import functions as F

from millrace.functions.expressions import is_object, json_path
from millrace.messages import to_messages
from millrace.operators.basic import filter_messages, transform_payload

DOC = '{"name":"Fred","address":{"city":"Port Ellery"},"n":[1,2]}'


@pytest.fixture(scope="module")
def message(spark):
    return to_messages(spark.createDataFrame([("hello,wörld 07", DOC)], "p string, doc string"), "p", {"route": "'a'", "task-id": "34"}, "text/plain", keep=("doc",))


@pytest.mark.parametrize("expression, want", [
    ("length(payload) > 5", True),
    ("upper(payload)", "HELLO,WÖRLD 07"),
    ("concat(payload, '!')", "hello,wörld 07!"),
    ("split(payload, ',')", ["hello", "wörld 07"]),
    ("split('a.b', '\\\\.')", ["a", "b"]),
    ("try_cast(right(payload, 2) as int) * 2", 14),
    ("try_cast(payload as int)", None),
    ("concat('task-', headers['task-id'])", "task-34"),
    ("headers['absent']", None),
    ("from_json(doc, 'address struct<city:string>').address.city", "Port Ellery"),
    ("variant_get(parse_json(doc), '$.address.city', 'string')", "Port Ellery"),
    ("get_json_object(doc, '$.n[1]')", "2"),
    ("case when contains(payload, 'w') then 'foo' else 'bar' end", "foo"),
    ("map('Accept', 'text/plain')", {"Accept": "text/plain"}),
    ("substring(payload, 1, cut)", "hello"),
])
def test_values(message, expression, want):
    got = transform_payload(message, expression, {"cut": 5}).first().payload
    assert got == want


def test_functions(message):
    row = message.select(json_path("doc", "$.address.city").alias("c"), is_object(F.parse_json("doc")).alias("o"), is_object(F.parse_json(F.lit("[1]"))).alias("a")).first()
    assert tuple(row) == ("Port Ellery", True, False)


def test_variables_must_not_hide_columns(message):
    with pytest.raises(ValueError):
        filter_messages(message, "true", {"payload": 1})
