"""Splitting, reassembling, aggregating and list pushes."""

import pytest
from pyspark.sql import functions as F

from millrace.messages import to_messages
from millrace.operators.aggregate import aggregate
from millrace.operators.lists import push_batches, push_list
from millrace.operators.split import reassemble, split_messages


def test_split_by_delimiter_and_expression(spark):
    df = spark.createDataFrame([(1, "hello,world,message"), (2, "a.b")], "id int, p string")
    m = to_messages(df, "p", {}, "text/plain", keep=("id",))
    rows = split_messages(m, delimiter=",", correlation="id").orderBy("id", "sequence_number").collect()
    assert [(r.correlation_id, r.sequence_number, r.sequence_size, r.payload) for r in rows] == [
        (1, 1, 3, "hello"), (1, 2, 3, "world"), (1, 3, 3, "message"), (2, 1, 1, "a.b")]
    # the delimiter is literal, not a pattern
    assert split_messages(m, delimiter=".").filter("id = 2").count() == 2
    pairs = split_messages(m, "map('k', payload)").orderBy("id").first().payload
    assert (pairs.key, pairs.value) == ("k", "hello,world,message")


@pytest.mark.parametrize("part_rows", [100, 2])
def test_reassemble(spark, part_rows):
    rows = [("a", 2, 3, "y"), ("a", 1, 3, "x"), ("a", 3, 3, "z"), ("a", 2, 3, "y"), ("b", 1, 2, "only"), ("c", 1, 1, "one"),
            ("d", 1, 2, "p"), ("d", 1, 2, "p"), ("d", 1, 2, "p")]
    df = spark.createDataFrame(rows, "correlation_id string, sequence_number int, sequence_size int, payload string")
    got = {}
    for r in reassemble(df, part_rows=part_rows).orderBy("correlation", "part").collect():
        assert len(r.payloads) <= part_rows
        got.setdefault(r.correlation, []).extend(r.payloads)
    assert got == {"a": ["x", "y", "z"], "c": ["one"]}


@pytest.mark.parametrize("hot_rows", [10**6, 2])
def test_aggregate_by_count_in_arrival_order(spark, hot_rows):
    df = spark.createDataFrame([("c", 1, "2"), ("c", 2, "1"), ("c", 3, "9"), ("d", 1, "7")], "k string, at int, payload string")
    full = aggregate(df, "k", "at", release_size=2, hot_rows=hot_rows).collect()
    assert [(r.k, r.group_no, r.payloads, r.closed) for r in full] == [("c", 0, ["2", "1"], True)]
    every = aggregate(df, "k", "at", release_size=2, send_partial=True, hot_rows=hot_rows).collect()
    assert sorted((r.k, r.group_no, tuple(r.payloads), r.closed) for r in every) == [
        ("c", 0, ("2", "1"), True), ("c", 1, ("9",), False), ("d", 0, ("7",), False)]
    # lists longer than a part are cut, and still known to be closed
    cut = aggregate(df, "k", "at", release_size=2, part_rows=1, hot_rows=hot_rows).collect()
    assert sorted((r.k, r.group_no, r.part, r.payloads[0]) for r in cut) == [("c", 0, 0, "2"), ("c", 0, 1, "1")]


@pytest.mark.parametrize("part_rows", [100, 2])
def test_aggregate_by_content(spark, part_rows):
    df = spark.createDataFrame(
        [("u", i, p) for i, p in enumerate(["a", "b", "c", "!", "!", "d"])] + [("v", 0, "e")], "k string, at int, payload string")
    rows = aggregate(df, "k", "at", release_expr="payload = '!'", send_partial=True, part_rows=part_rows).orderBy("k", "group_no", "part").collect()
    groups = {}
    for r in rows:
        assert r.size == len(r.payloads) <= part_rows
        groups.setdefault((r.k, r.group_no, r.closed), []).extend(r.payloads)
    assert groups == {("u", 0, True): ["a", "b", "c", "!"], ("u", 1, True): ["!"], ("u", 2, False): ["d"], ("v", 0, False): ["e"]}
    assert aggregate(df, "k", "at", release_expr="payload = '!'").count() == 2


def test_release_on_map_payload(spark):
    df = spark.createDataFrame([("g", 1, '{"name":"First1 Last1","address":"St. #1"}'), ("g", 2, "text")], "k string, at int, payload string")
    is_map = "schema_of_variant(try_parse_json(payload)) like 'OBJECT%'"
    got = aggregate(df, "k", "at", release_expr=is_map).collect()
    assert [r.payloads for r in got] == [['{"name":"First1 Last1","address":"St. #1"}']]


def test_push_list(spark):
    df = spark.createDataFrame([(1, ["Manny", "Moe", "Jack"]), (2, ["x"])], "at int, payload array<string>")
    first = push_list(df, "'foo'", "at")
    rows = first.orderBy("seq").collect()
    assert [(r.key, r.seq, r.value) for r in rows] == [("foo", 1, "Manny"), ("foo", 2, "Moe"), ("foo", 3, "Jack"), ("foo", 4, "x")]
    more = push_list(df, "'foo'", "at", current=first, hot_rows=2).orderBy("seq").collect()
    assert [r.seq for r in more] == [5, 6, 7, 8]


def test_arguments(spark):
    df = spark.createDataFrame([("c", 1, "2")], "k string, at int, payload string")
    for bad in ({}, {"release_size": 0}):
        with pytest.raises(ValueError):
            aggregate(df, "k", "at", **bad)
    with pytest.raises(ValueError):
        aggregate(df, "k", None, release_size=2)
    with pytest.raises(ValueError):
        push_list(df, "k", [])


def test_size_or_content_whichever_comes_first(spark):
    rows = [("k", i, p) for i, p in enumerate("aabaaaabbaaaa")]
    df = spark.createDataFrame(rows, "k string, at int, payload string")
    got = aggregate(df, "k", "at", release_size=3, release_expr="payload = 'b'", send_partial=True).orderBy("group_no").collect()
    assert ["".join(r.payloads) for r in got] == ["aab", "aaa", "ab", "b", "aaa", "a"] and [r.closed for r in got] == [True] * 5 + [False]


def test_groups_of_maps_and_variants(spark):
    df = spark.sql("select 'k' as k, id, map('n', id) as m, parse_json('{\"n\": ' || id || '}') as v from range(6)")
    assert [[x["n"] for x in r.payloads] for r in aggregate(df, "k", "id", release_size=4, payload="m", send_partial=True).orderBy("group_no").collect()] == [[0, 1, 2, 3], [4, 5]]
    got = aggregate(df, "k", "id", release_size=2, release_expr="m['n'] = 0", payload="v").selectExpr("transform(payloads, x -> to_json(x)) as p").collect()
    assert sorted(tuple(r.p) for r in got) == [('{"n":0}',), ('{"n":1}', '{"n":2}'), ('{"n":3}', '{"n":4}')]


def test_pushing_a_batch_twice_changes_nothing(spark, tmp_path):
    out = str(tmp_path / "lists")
    push = push_batches(out, str(tmp_path / "tops"), "k", "at", hot_rows=3, compact_every=2)
    batches = [[("a", 1, ["x", "y"]), (None, 2, ["n"])], [("a", 3, ["z"]), ("b", 4, ["q"])], [(None, 5, ["m"]), ("a", 6, ["w"])]]
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "k string, at int, payload array<string>")
        push(df, i)
        push(df, i)
    got = sorted(((r.key, r.seq, r.value) for r in spark.read.parquet(out).collect()), key=str)
    assert got == sorted([("a", 1, "x"), ("a", 2, "y"), ("a", 3, "z"), ("a", 4, "w"), ("b", 1, "q"), (None, 1, "n"), (None, 2, "m")], key=str)
