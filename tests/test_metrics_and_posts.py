"""Meters, metric lines, routing, and the post operators."""

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from millrace.messages import to_messages
from millrace.operators.lookup import enrich_lookup, with_request
from millrace.operators.meters import counter, gauge, metric_lines, throughput, watched
from millrace.operators.posts import closest, dedup_recent, filter_any, search, stable_sample, trending
from millrace.operators.route import route
from millrace.operators.scripts import apply_udf
from millrace.sinks.files import write_routed


def test_counter_and_gauge(spark):
    df = spark.createDataFrame([("hello world message", 1, 5.0), ("hello", 2, 7.0)], "payload string, at int, v double")
    first = df.limit(1)
    row = counter(first, "counter666", {"foo": "'bar'"}, "length(payload)", {"stream": "s", "foo": "common"}).first()
    assert (row.name, row.tags, row.value) == ("counter666", {"foo": "bar", "stream": "s"}, 19)
    named = counter(df, F.concat(F.lit("c-"), F.length("payload")), None).orderBy("name").collect()
    assert [(r.name, r.tags, r.value) for r in named] == [("c-19", {}, 1), ("c-5", {}, 1)]
    assert gauge(df, "g", {"t": "'x'"}, "v", ["at"]).first().value == 7.0
    with pytest.raises(ValueError):
        gauge(df, "g", {}, "v", [])


def test_throughput(spark):
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(base, "é"), (base + dt.timedelta(seconds=1), "ab"), (base + dt.timedelta(seconds=12), "c")], "ts timestamp, payload string")
    rows = throughput(df, "ts", "10 seconds").orderBy("start").collect()
    assert [(r.messages, r.bytes, r.total_messages, r.total_bytes) for r in rows] == [(2, 4, 2, 4), (1, 1, 3, 5)]
    assert rows[0].messages_per_s == 0.2 and rows[1].total_messages_per_s == 3 / 20
    assert rows[0].mb_per_s == 4 / 1024 / 1024 / 10
    assert throughput(df.select("ts", F.lit(1).alias("payload")), "ts", "10 seconds").first().bytes is None


def test_watched_messages(spark):
    seen = Observation()
    df = watched(spark.createDataFrame([("é",), ("ab",)], "payload string").repartition(2), seen)
    assert df.count() == 2 and seen.get == {"messages": 2, "bytes": 4}


def test_metric_line(spark):
    doc = '{"mileage":1.5,"receivedAt":1471466076564,"vin":"test-vin","location":{"latitude":4.53,"longitude":2.89}}'
    df = spark.createDataFrame([(doc,), ("{}",)], "payload string")
    path = "get_json_object(payload, '$.{}')".format
    tags = {"vin": path("vin"), "latitude": path("location.latitude"), "none": path("none")}
    rows = metric_lines(df, "vehicle-location", path("mileage"), path("receivedAt"), "vehicle-api", tags).collect()
    assert [r.payload for r in rows] == ['"vehicle-location" 1.5 1471466076564 source=vehicle-api latitude="4.53" vin="test-vin"']


def _routes(spark, keys, **options):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    m = to_messages(df, "k", {"routeTo": "k"}, "text/plain")
    return {r.payload: r.destination for r in route(m, **options).collect()}


@pytest.mark.parametrize("options, want", [
    ({"mappings": "foo=foo\nbar=bar", "default": "discards"}, {"foo": "foo", "bar": "bar", "baz": "discards"}),
    ({"mappings": {"foo": "baz", "bar": "qux"}}, {"foo": "baz", "bar": "qux", "baz": "baz"}),
    ({"default": "d", "allowed": ["foo", "d"], "mappings": {"foo": "foo", "bar": "x"}}, {"foo": "foo", "bar": "d", "baz": "d"}),
    ({"required": True, "mappings": {"foo": "f"}, "declared": ["bar"], "on_error": "keep", "default": "d"}, {"foo": "f", "bar": "bar", "baz": None}),
    ({}, {"foo": "foo", "bar": "bar", "baz": "baz"}),
])
def test_routes(spark, options, want):
    assert _routes(spark, ["foo", "bar", "baz"], **options) == want


def test_routing_errors_arrays_and_null_keys(spark, tmp_path):
    with pytest.raises(Exception, match="no destination for key foo"):
        _routes(spark, ["foo"], required=True)
    assert _routes(spark, [None], default="d") == {None: "d"}
    df = to_messages(spark.createDataFrame([("a",), (None,)], "k string"), "k", {}, "text/plain")
    both = route(df, "case when payload = 'a' then array('x', 'y') end", on_error="keep")
    assert sorted((r.payload or "", r.destination or "", r.route_error or "") for r in both.collect()) == [
        ("", "", "no routing key"), ("a", "x", ""), ("a", "y", "")]
    script = "case when contains(payload, word) then 'foo' else 'bar' end"
    assert [r.destination for r in route(df.filter("payload = 'a'"), script, variables={"word": "a"}).collect()] == ["foo"]
    write_routed(both.drop("headers", "route_error"), str(tmp_path / "out"))
    assert {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()} == {"destination=x", "destination=y", "destination=_unroutable"}


def test_user_code(spark):
    df = spark.createDataFrame([(6,), (9,)], "payload long")
    assert [r.payload for r in apply_udf(df, lambda s, limit: s * limit, "long", {"limit": 5}).orderBy("payload").collect()] == [30, 45]
    text = spark.createDataFrame([("hello world",)], "payload string")
    assert apply_udf(text, lambda s, limit, foo: s.str[:limit] + foo, "string", {"limit": 5, "foo": " WORLD"}).first().payload == "hello WORLD"
    headed = to_messages(text, "payload", {"a": "'1'"}, "text/plain")
    got = apply_udf(headed, lambda p, h: h.map(lambda x: dict(x)["a"]) + p, "string", with_headers=True).first().payload
    assert got == "1hello world"


def test_lookup(spark):
    df = to_messages(spark.createDataFrame([('{"name":"Fred","myMethod":"POST"}',), ('{"name":"Ann"}',)], "p string"), "p", {}, "application/json")
    asked = with_request(df, "'/greet'", "coalesce(get_json_object(payload,'$.myMethod'),'GET')", "payload")
    ref = spark.createDataFrame([("POST", "/greet", "echo")], "verb string, url string, body string")
    got = enrich_lookup(asked, ref, {"verb": "request.method", "url": "request.url"}, "body", out="reply")
    assert {r.request.method: r.reply for r in got.collect()} == {"POST": "echo", "GET": None}


def test_dedup_recent(spark):
    rows = [(1, "2024-01-31", "a"), (2, "2024-01-30", "b"), (1, "2024-01-31", "a"), (3, "2023-12-01", "old")]
    df = spark.createDataFrame(rows, "id int, d string, text string").withColumn("ts", F.to_timestamp("d")).withColumn("h", F.create_map(F.lit("k"), F.lit("v")))
    got = dedup_recent(df, "id", "ts", "30 days", now="timestamp'2024-02-01'").collect()
    assert [(r.id, r.text, r.h) for r in got] == [(1, "a", {"k": "v"}), (2, "b", {"k": "v"})]


def test_filter_any(spark):
    rows = [(1, "Big Data, now", "u1", 0.0, 0.0), (2, "database", "u2", 0.0, 0.0), (3, "x", "u3", 40.0, 179.5), (4, None, "u4", None, None), (5, "data so big", "u5", 0.0, 0.0)]
    df = spark.createDataFrame(rows, "id int, text string, user string, lat double, lon double")
    def ids(**kw):
        return sorted(r.id for r in filter_any(df, "text", user="user", lat="lat", lon="lon", **kw).collect())
    assert ids(track=["data"]) == [1, 5]
    assert ids(track=["big data"], follow=["u2"]) == [1, 2, 5]
    assert ids(boxes=[(170.0, 30.0, -170.0, 50.0)]) == [3]
    assert ids(track=["now"], follow=["u4"], boxes=[(170.0, 30.0, -170.0, 50.0)]) == [1, 3, 4]
    assert len(ids()) == 5
    assert ids(track=["data", *(f"absent{i}" for i in range(200))]) == [1, 5]


def test_sample_is_the_same_for_every_reader(spark):
    df = spark.range(20_000)
    a = {r.id for r in stable_sample(df.repartition(7), "id", 5).collect()}
    b = {r.id for r in stable_sample(df.coalesce(1), "id", 5).collect()}
    assert a == b and 800 < len(a) < 1200


def test_search_trending_closest(spark):
    rows = [(i, "Spark stream" if i % 2 else "spark batch", "en" if i < 8 else "de", 50.0 + i, 10.0) for i in range(10)]
    df = spark.createDataFrame(rows, "id int, text string, lang string, lat double, lon double").withColumn("ts", F.timestamp_seconds(F.col("id") * 3600))
    got = search(df, "STREAM spark", lang="en", since="timestamp'1970-01-01 01:30:00'", order=[F.desc("ts")], count=2, page=2).orderBy(F.desc("id")).collect()
    assert [(r.id, r.page) for r in got] == [(7, 1), (5, 1), (3, 2)]
    near = search(df, lat="lat", lon="lon", near=(52.0, 10.0, 120.0), order=["id"]).orderBy("id").collect()
    assert [r.id for r in near] == [1, 2, 3]
    with pytest.raises(ValueError):
        search(df, "x")
    top = trending(df, "text", "ts", "4 hours", 1).orderBy("window_start").collect()
    assert [(r.topic, r.n) for r in top] == [("Spark stream", 2), ("Spark stream", 2), ("Spark stream", 1)]
    around = trending(df, "text", "ts", "1 day", 5, "lat", "lon", near=(52.0, 10.0, 120.0)).collect()
    assert sorted((r.topic, r.n) for r in around) == [("Spark stream", 2), ("spark batch", 1)]
    assert [r.id for r in closest(df, "lat", "lon", (53.1, 10.0), 2, "id").collect()] == [3, 4]


@pytest.mark.parametrize("others", [0, 99, 100, 499])
def test_keywords_keep_their_meaning_in_any_company(spark, others):
    texts = ["I like C++ a lot", "c++17", "a new-york minute", "new-yorker", "plain words", None, "abc", "ab"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    track = [f"neverseen{k}" for k in range(others)] + ["c++", "new-york", "ab"]
    assert {r.i for r in filter_any(df, "text", track).collect()} == {0, 2, 7}


def test_samples_of_any_percentage(spark):
    df = spark.range(400_000)
    for percent in (0.004, 0.5, 33.3, 100):
        n = stable_sample(df, "id", percent).count()
        assert abs(n - 4000 * percent) <= 5 * (4000 * percent) ** 0.5
    assert stable_sample(df, "id", 0).count() == 0


def test_messages_without_an_id_all_stay(spark):
    df = spark.createDataFrame([(None, "2024-01-01 00:00:00", "a"), (None, "2024-01-01 00:00:00", "a"), (1, "2024-01-01 00:00:00", "b"), (1, "2024-01-01 00:00:01", "c")], "id int, ts string, text string").withColumn("ts", F.col("ts").cast("timestamp"))
    got = dedup_recent(df, "id", "ts", "9 days", now="timestamp'2024-01-02 00:00:00'").collect()
    assert sorted((r.id or 0, r.text) for r in got) == [(0, "a"), (0, "a"), (1, "b")]


def test_long_and_nested_keywords(spark):
    long, nested = "x" * 2000 + "y", ["a" * n for n in range(1, 400)]
    texts = [f"has {long} in it", "has " + "x" * 2000 + " in it", "b" + "a" * 5, "a" * 399, "a" * 400, "cat.s", "cats", "c a t"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = lambda words: {r.i for r in filter_any(df, "t", words).collect()}
    assert found([long]) == {0}
    assert found(nested) == {3, 7}
    assert found(["cat", "catalog", "car", "cats"]) == {5, 6} and found(["cats", "cat.s"]) == {5, 6}


def test_a_lookup_table_with_a_repeated_key(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    ref = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "x"), (None, "y")], "id int, v string")
    with pytest.raises(Exception, match="several answers"):
        enrich_lookup(df, ref, {"id": "k"}, "v", out="r").collect()
    assert sorted((r.k, r.r or "") for r in enrich_lookup(df, ref, {"id": "k"}, "v", out="r", repeated="all").collect()) == [(1, "a"), (2, "b"), (2, "c"), (3, "")]
    once = ref.filter("v <> 'c'")
    assert sorted((r.k, r.r or "") for r in enrich_lookup(df, once, {"id": "k"}, "v", out="r").collect()) == [(1, "a"), (2, "b"), (3, "")]
