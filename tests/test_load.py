"""Bulk loading, entities, table columns, upserts, broker rows and text files."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.messages import to_messages
from millrace.operators.bulk import parse_lines, bulk_load, check_error_table, empty_target
from millrace.operators.entities import json_entities
from millrace.sinks.broker import to_broker
from millrace.sinks.files import write_text
from millrace.sinks.tables import load_lines, parse_columns, table_rows, write_bulk
from millrace.sinks.upsert import DocumentTable, read_documents, upsert

NAMES = ("id", "name", "age")


def _load(spark, lines, fmt="csv", **dialect):
    df = spark.createDataFrame([(x,) for x in lines], "payload string").coalesce(1)
    good, bad = bulk_load(df, "names", NAMES, fmt, **dialect)
    return [tuple(r) for r in good.collect()], [tuple(r) for r in bad.collect()]


# The dialects' golden cases, with names of our own.
@pytest.mark.parametrize("lines, fmt, dialect, want", [
    (["123\tOttoline\t25", "124\tBrunhild\t21"], "text", {}, [("123", "Ottoline", "25"), ("124", "Brunhild", "21")]),
    (["1\t\\N\t", "2\ta\\tb\\\\n\t\\\\N", "3\tx\\\ty\t3"], "text", {}, [("1", None, ""), ("2", "a\tb\\n", "\\N"), ("3", "x\ty", "3")]),
    (['123,"Ottoline",25', "124,,21", '125,"",22'], "csv", {}, [("123", "Ottoline", "25"), ("124", None, "21"), ("125", "", "22")]),
    (['123,"Ottoline",25', "124,null,21", '125,"null",', '1,"a,null,,b",2'], "csv", {"null_string": "null"},
     [("123", "Ottoline", "25"), ("124", None, "21"), ("125", "null", ""), ("1", "a,null,,b", "2")]),
    (['123|"Ottoline"|25'], "csv", {"delimiter": "|"}, [("123", "Ottoline", "25")]),
    (['123\t"Ottoline"\t25'], "csv", {"delimiter": "\\t"}, [("123", "Ottoline", "25")]),
    (["124,'Brunhild',21"], "csv", {"quote": "'"}, [("124", "Brunhild", "21")]),
    (['124,"Brunhild\\"",21'], "csv", {"escape": "\\"}, [("124", 'Brunhild"', "21")]),
    (['124,"An""na", 21 '], "csv", {}, [("124", 'An"na', " 21 ")]),
    (["1|a|\\N"], "text", {"delimiter": "|"}, [("1", "a", None)]),
])
def test_dialects(spark, lines, fmt, dialect, want):
    good, bad = _load(spark, lines, fmt, **dialect)
    assert good == want and bad == []


def test_bad_rows_are_set_aside(spark):
    good, bad = _load(spark, ["123,Ottoline,25", "GARBAGE", "125,Casimir,22", "1,2,3,4"])
    assert good == [("123", "Ottoline", "25"), ("125", "Casimir", "22")]
    assert bad == [("names", "missing data for a column", "GARBAGE"), ("names", "extra data after last expected column", "1,2,3,4")]
    good, bad = _load(spark, ["123\tOttoline\t25", "GARBAGE", "1\t2\t3\t4", None], "text")
    assert len(good) == 1 and [b[2] for b in bad] == ["GARBAGE", "1\t2\t3\t4", None]


def test_load_options_are_checked(spark):
    df = spark.createDataFrame([("x",)], "payload string")
    for bad in ({"fmt": "text", "quote": "'"}, {"fmt": "csv", "delimiter": "||"}, {"fmt": "xml"}):
        with pytest.raises(ValueError):
            bulk_load(df, "t", NAMES, **bad)
    with pytest.raises(ValueError):
        check_error_table(T.StructType.fromDDL("table_name string, payload string"))
    assert empty_target(["id", "name"]) == "id VARCHAR(2000), name VARCHAR(2000)"


def test_table_columns(spark):
    assert parse_columns("name,city:address.city, x:concat(a, b)") == [("name", "name"), ("city", "address.city"), ("x", "concat(a, b)")]
    doc = '{"name":"Ida Quill","address":{"city":"Port Ellery","street":"Tin Lane"}}'
    df = to_messages(spark.createDataFrame([(doc,)], "p string"), "p", {"h": "'v'"}, "application/json")
    schema = "name string, address struct<city:string,street:string>"
    row = table_rows(df, "name,city:address.city,street:payload.address.street,h:headers['h']", schema).first()
    assert tuple(row) == ("Ida Quill", "Port Ellery", "Tin Lane", "v")
    assert table_rows(df).first().payload == doc


def test_write_bulk(spark, tmp_path):
    df = spark.createDataFrame([("1,a",), ("bad",)], "payload string")
    good, errors = bulk_load(df, "t", ("id", "name"), "csv")
    spark.sql(f"create database if not exists loads location '{tmp_path}/db'")
    write_bulk(good, errors, "loads.names", "loads.errors", initialize=True)
    assert spark.table("loads.names").dtypes == [("id", "string"), ("name", "string")]
    assert (spark.table("loads.names").count(), spark.table("loads.errors").count()) == (1, 1)
    write_bulk(good, errors, "loads.names", "loads.errors")
    assert spark.table("loads.errors").count() == 2
    lines = spark.createDataFrame([("1,a",), ("2,b",), ("bad",)], "payload string").repartition(3)
    assert load_lines(lines, "loads.more", ("id", "name"), "csv", "loads.errors", initialize=True) == (2, 1)
    assert load_lines(lines.filter("payload <> 'bad'"), "loads.more", ("id", "name"), "csv", "loads.none") == (2, 0)
    assert (spark.table("loads.more").count(), spark.table("loads.errors").count()) == (4, 3)
    assert not spark.catalog.tableExists("loads.none")
    with pytest.raises(ValueError, match="error_message"):
        load_lines(lines, "loads.more", ("id", "name"), "csv", error_table="loads.names")
    assert spark.table("loads.more").count() == 4
    spark.sql("drop database loads cascade")


def test_json_entities(spark):
    rows = [(1, '{"a":1,"b":"x"}'), (2, ' [{"a":2},{"a":3,"b":"y"}]'), (3, "{oops"), (4, "7"), (5, '[{"a":1},7]'), (6, None), (7, '[{"a":1},{')]
    good, bad = json_entities(spark.createDataFrame(rows, "m int, payload string"), "a int, b string")
    assert sorted(tuple(r) for r in good.collect()) == [(1, 1, "x"), (2, 2, None), (2, 3, "y")]
    assert sorted(r.m for r in bad.collect()) == [3, 4, 5, 6, 7]


def test_upsert(spark, tmp_path):
    target = str(tmp_path / "docs")
    doc = '{"kind":"lamp","made":1999,"colour":"green"}'
    one = spark.createDataFrame([("1", 1, doc, "foo"), ("1", 2, "newer", "bar"), ("2", 1, "x", None)], "id string, at int, payload string, ix string")
    messages = to_messages(one, "payload", {"INDEX_NAME": "ix"}, "application/json", keep=("id", "at"))
    upsert(spark, messages, target, "id", "at", index="foo")
    upsert(spark, messages.filter("id = '2'").withColumn("at", F.lit(5)).withColumn("payload", F.lit("y")), target, "id", "at", index="foo")
    upsert(spark, messages.filter("id = '2'").withColumn("at", F.lit(3)).withColumn("payload", F.lit("late")), target, "id", "at", index="foo")
    got = {(r["index"], r.id): r.document for r in read_documents(spark, target).collect()}
    assert got == {("foo", "1"): doc, ("bar", "1"): "newer", ("foo", "2"): "y"}
    # without an index, the documents still replace each other
    for at in (1, 2):
        upsert(spark, messages.filter("id = '2'").withColumn("at", F.lit(at)).withColumn("id", F.concat(F.lit("n"), F.lit(at))), target, "id", "at")
    assert read_documents(spark, target).filter("index is null").count() == 2


def test_one_changed_document_rewrites_one_bucket(spark, tmp_path):
    target = tmp_path / "docs"
    df = spark.range(2000).selectExpr("id", "1 as at", "cast(id as string) as payload")
    upsert(spark, df, str(target), "id", "at", index="x", buckets=16)
    first = json.loads((target / "manifest" / "0").read_text())
    assert len(first["places"]) == 16 == first["buckets"]
    upsert(spark, df.filter("id = 7").selectExpr("id", "2 as at", "'new' as payload"), str(target), "id", "at", index="x")
    second = json.loads((target / "manifest" / "1").read_text())
    changed = [b for b, v in second["places"].items() if first["places"][b] != v]
    assert len(changed) == 1 and second["buckets"] == 16
    (version,) = {second["places"][b] for b in changed}
    assert [p.name for p in (target / "data" / version).iterdir() if p.is_dir()] == [f"bucket={changed[0]}"]
    got = {r.id: r.document for r in read_documents(spark, str(target)).collect()}
    assert got == {str(i): "new" if i == 7 else str(i) for i in range(2000)}
    upsert(spark, df.limit(0), str(target), "id", "at", index="x")
    assert not (target / "manifest" / "2").exists()


def test_a_crash_before_the_switch_leaves_the_old_documents(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "docs")
    df = spark.range(100).selectExpr("id", "1 as at", "'old' as payload")
    upsert(spark, df, target, "id", "at")
    with monkeypatch.context() as patch:
        patch.setattr(DocumentTable, "_switch", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            upsert(spark, df.selectExpr("id", "2 as at", "'new' as payload"), target, "id", "at")
    assert read_documents(spark, target).filter("document = 'old'").count() == 100
    for at in (2, 3, 4):
        upsert(spark, df.selectExpr("id", f"{at} as at", f"'new {at}' as payload"), target, "id", "at")
    assert {r.document for r in read_documents(spark, target).collect()} == {"new 4"}
    assert sorted(p.name for p in (tmp_path / "docs" / "manifest").iterdir() if p.name.isdigit()) == ["2", "3"]
    # two writers: the one that comes last is told
    table = DocumentTable(spark, target)
    with pytest.raises(RuntimeError):
        table._switch(3, {})
    with pytest.raises(ValueError):
        read_documents(spark, str(tmp_path / "none"))


def test_broker_rows(spark):
    df = to_messages(spark.createDataFrame([("hi",)], "p string"), "p", {"mapped": "'yes'", "not mapped": "'no'", "contentType": "'own/type'", "amqp_type": "'t'"}, "text/plain")
    def sent(**kw):
        return {h.key: bytes(h.value).decode() for h in to_broker(df, "'topic'", "'k'", **kw).first().headers}
    assert sent(mapped_headers="mapped") == {"mapped": "yes", "contentType": "text/plain"}
    assert sent(mapped_headers="STANDARD,mapped") == {"mapped": "yes", "amqp_type": "t", "contentType": "text/plain"}
    assert sent(headers_last=True)["contentType"] == "own/type"
    with pytest.raises(ValueError):
        to_broker(df, "'t'", require_key=True)


def test_write_text(spark, tmp_path):
    df = to_messages(spark.createDataFrame([("hello", "test"), ("bye", "other")], "p string, n string"), "p", {"file_name": "n"}, "text/plain")
    write_text(df, str(tmp_path / "plain"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "plain")).collect()) == ["bye", "hello"]
    write_text(df, str(tmp_path / "plain"))
    assert spark.read.text(str(tmp_path / "plain")).count() == 4
    write_text(df, str(tmp_path / "plain"), replace=True)
    assert spark.read.text(str(tmp_path / "plain")).count() == 2
    write_text(df, str(tmp_path / "named"), "headers['file_name']", "txt", compact=True)
    files = list((tmp_path / "named" / "file_key=test.txt").glob("part-*"))
    assert [f.read_text() for f in files] == ["hello\n"]


def test_quotes_are_read_as_copy_does(spark):
    lines = ['1,"abc', '2,a"b', '3,"abc"d', '4,"a""b"', '5,""', '6,', '7,"x,y"', '8,a"b"c"d"', '9,x\ue002y', '10,"' + "z" * 200_000 + '"']
    df = spark.createDataFrame([(t,) for t in lines], "payload string")
    rows = {r.payload.split(",")[0]: r for r in parse_lines(df, ["id", "v"], "csv").collect()}
    assert {k: r.v for k, r in rows.items() if k != "10"} == {"1": None, "2": None, "3": "abcd", "4": 'a"b', "5": "", "6": None, "7": "x,y", "8": "abcd", "9": "x\ue002y"}
    assert {k for k, r in rows.items() if r.error_message} == {"1", "2"} and len(rows["10"].v) == 200_000


def test_escapes_of_the_text_format(spark):
    lines = ["\\101\t\\x41", "\\303\\251\ta\\\tb", "a\\\\\t\\N", "\\N\tx\\n\ue003", "a\\qb\t\\", "\\377\tx"]
    rows = parse_lines(spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, payload string"), ["a", "b"], "text").collect()
    got = {r.payload: (r.a, r.b) for r in rows}
    assert [got[t] for t in lines] == [("A", "A"), ("é", "a\tb"), ("a\\", None), (None, "x\n\ue003"), ("aqb", "\\"), (None, None)]
    assert {r.error_message for r in rows if r.payload == lines[5]} == {"invalid byte sequence"}


@pytest.mark.parametrize("fmt, lines", [("text", ["a\\x00b\tc", "a\\0\tc", "a\0b\tc"]), ("csv", ["a\0b,c", '"a\0b",c'])])
def test_no_text_holds_nul(spark, fmt, lines):
    rows = parse_lines(spark.createDataFrame([(t,) for t in lines], "payload string"), ["a", "b"], fmt).collect()
    assert [(r.a, r.error_message) for r in rows] == [(None, "invalid byte sequence")] * len(lines)


def test_a_load_parses_its_input_once(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def seen(rows):
        for batch in rows:
            reads.add(batch.num_rows)
            yield batch

    lines = spark.createDataFrame([(f"{i},a" if i % 3 else "bad",) for i in range(60)], "payload string").mapInArrow(seen, "payload string")
    spark.sql(f"create database if not exists once location '{tmp_path}/db'")
    assert load_lines(lines, "once.t", ("id", "name"), "csv", "once.e", initialize=True) == (40, 20)
    assert reads.value == 60 and (spark.table("once.t").count(), spark.table("once.e").count()) == (40, 20)
    assert load_lines(lines.filter("payload = 'bad'"), "once.n", ("id", "name"), "csv", "once.e", initialize=True) == (0, 20)
    assert (spark.table("once.n").count(), spark.table("once.e").count()) == (0, 40)
    spark.sql("drop database once cascade")


def test_json_of_no_known_schema(spark):
    doc = '{"name":"N","n":7,"list":[{"x":1.5},{"x":2}],"odd key":{"a.b":true},"payload":"own"}'
    df = spark.createDataFrame([(doc, {"h": "v"})], "payload string, headers map<string,string>")
    types = {"n": "int", "x": "double", "flag": "boolean"}
    row = table_rows(df, "name,n,x:list[1].x,flag:payload['odd key']['a.b'],gone:list[9].x,both:concat(payload.name, ' payload.n ', payload.n),h:headers['h']", types=types).first()
    assert tuple(row) == ("N", 7, 2.0, True, None, "N payload.n 7", "v")
    assert table_rows(df.select(F.parse_json("payload").alias("payload")), "n", types=types).first().n == 7
    assert table_rows(df.select(F.encode("payload", "UTF-8").alias("payload")), ["name"]).first().name == "N"


def test_typed_targets(spark):
    lines = ["1,ok,2024-02-29", "x,ok,2024-02-28", "2,too long,2024-02-28", "3,ok,2024-02-30", ",ok,2024-02-28", "4,,"]
    rows = parse_lines(spark.createDataFrame([(t,) for t in lines], "payload string"), ["i", "t", "d"], "csv", types=["int not null", "varchar(5)", "date"]).collect()
    assert {r.payload: r.error_message for r in rows} == {
        lines[0]: None, lines[1]: "invalid input syntax for type int", lines[2]: "value too long for type varchar(5)", lines[3]: "invalid input syntax for type date",
        lines[4]: "null value in a column that allows none", lines[5]: None,
    }
    assert {type(r.i) for r in rows if not r.error_message} == {int}
