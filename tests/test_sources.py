"""Files, tables, topics, generated messages, syslog and change events."""

import itertools
import json

import pytest
from pyspark.sql import functions as F

from millrace.messages import to_messages
from millrace.sources.changes import read_changes, row_json, unwrap_changes
from millrace.sources import files
from millrace.sources.files import line_messages, number_lines, read_files, stream_files
from millrace.sources.generate import generate_messages, generate_stream, tick_stream, time_spine, zero_fill
from millrace.sources.syslog import parse_syslog
from millrace.sources.tables import TablePoller, poll_chunks, read_table, row_lists, unconsumed
from millrace.sources.topics import TOPIC_SCHEMA, topic_messages, topic_options
from millrace.streaming.runs import run_available, run_batches


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("files")
    (d / "one.txt").write_text("Ida Quillson\n")
    (d / "many.txt").write_text("".join(f"line {i} {'x' * 90}\n" for i in range(1, 3001)))
    (d / "empty.txt").write_text("")
    return d


def test_contents_and_references(spark, folder):
    rows = {r.headers["file_name"]: r for r in read_files(spark, str(folder)).collect()}
    assert bytes(rows["one.txt"].payload) == b"Ida Quillson\n" and rows["one.txt"].content_type == "application/octet-stream"
    refs = read_files(spark, str(folder), "ref", pattern="one*")
    (ref,) = refs.collect()
    assert rows["empty.txt"].payload == b""
    (hollow,) = read_files(spark, str(folder), "ref", pattern="empty*").collect()
    assert hollow.size == 0 and hollow.payload.endswith("/empty.txt") and hollow.modified is not None
    assert ref.size == 13 and ref.payload.endswith("/one.txt")
    schemas = [line.split("ReadSchema")[1] for line in refs._jdf.queryExecution().executedPlan().toString().splitlines() if "ReadSchema" in line]
    assert schemas and not any("content" in schema for schema in schemas)


@pytest.mark.parametrize("max_splits", [500_000, 0])
def test_lines_are_numbered_over_many_splits(spark, folder, monkeypatch, max_splits):
    monkeypatch.setattr(files, "MAX_SPLITS", max_splits)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        df = read_files(spark, str(folder), "lines", with_markers=True)
        rows = df.orderBy("path", "line").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    many = [r for r in rows if r.path.endswith("/many.txt")]
    assert [r.line for r in many] == list(range(3002))
    assert all(r.payload.startswith(f"line {r.line} ") and r.headers["sequenceNumber"] == str(r.line) for r in many[1:-1])
    assert (many[0].marker, many[-1].marker) == ("START", "END")
    assert json.loads(many[-1].payload)["lineCount"] == 3000
    assert len({r.headers["correlationId"] for r in many[1:-1]}) == 1
    assert [(r.line, r.marker, json.loads(r.payload).get("lineCount")) for r in rows if r.path.endswith("/empty.txt")] == [(0, "START", None), (1, "END", 0)]
    assert [r.payload for r in rows if r.path.endswith("/one.txt")][1] == "Ida Quillson"


@pytest.mark.parametrize("name, data", [
    ("crlf", b"a\r\nb\r\n"), ("lf", b"a\nb\n"), ("nul", b"a\0b\0"), ("stxetx", b"\x02a\x03\x02b\x03"),
])
def test_record_separators(spark, tmp_path, name, data):
    (tmp_path / "f").write_bytes(data)
    assert [r.payload for r in read_files(spark, str(tmp_path), "lines", record_separator=name).orderBy("line").collect()] == ["a", "b"]


def test_lines_do_not_move(spark, folder):
    text = read_files(spark, str(folder), "lines")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(value" not in text and "Exchange rangepartitioning" not in text
    # the only shuffle is that of the splits' counts
    assert all("value" not in line for line in text.splitlines() if "Exchange" in line) and "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_markers_as_text_and_odd_names(spark, tmp_path):
    (tmp_path / "a b+c%.txt").write_text("x\n")
    (tmp_path / "d e+f%.txt").write_text("")
    rows = read_files(spark, str(tmp_path), "lines", with_markers=True, marker_format="text").orderBy("path", "line").collect()
    assert [(r.headers["file_name"], r.line, r.payload.split(" ")[0]) for r in rows] == [
        ("a b+c%.txt", 0, "START"), ("a b+c%.txt", 1, "x"), ("a b+c%.txt", 2, "END"), ("d e+f%.txt", 0, "START"), ("d e+f%.txt", 1, "END")]
    with pytest.raises(ValueError):
        read_files(spark, str(tmp_path), "lines", with_markers=True, marker_format="xml")


def test_followed_lines_have_headers_and_markers(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    (src / "a.txt").write_text("1\n2\n")
    (src / "b.txt").write_text("3\n")

    def write(batch, batch_id):
        line_messages(batch, with_markers=True).write.mode("append").parquet(out)

    run_batches(stream_files(spark, str(src), "lines"), write, str(tmp_path / "check"))
    rows = spark.read.parquet(out).orderBy("path", "line").collect()
    assert [(r.headers["file_name"], r.line, r.marker) for r in rows] == [
        ("a.txt", 0, "START"), ("a.txt", 1, None), ("a.txt", 2, None), ("a.txt", 3, "END"), ("b.txt", 0, "START"), ("b.txt", 1, None), ("b.txt", 2, "END")]
    assert [r.headers["sequenceNumber"] for r in rows if r.marker is None] == ["1", "2", "1"]


def test_a_followed_folder_gives_each_file_once(spark, tmp_path):
    src, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    src.mkdir()
    (src / "a.txt").write_text("1\n2\n")

    def write(batch, batch_id):
        number_lines(batch).select("payload", "file_name", "line").write.mode("append").parquet(out)

    run_batches(stream_files(spark, str(src), "lines"), write, check)
    (src / "b.txt").write_text("3\n")
    run_batches(stream_files(spark, str(src), "lines"), write, check)
    run_batches(stream_files(spark, str(src), "lines"), write, check)
    rows = spark.read.parquet(out).orderBy("file_name", "line").collect()
    assert [(r.file_name, r.line, r.payload) for r in rows] == [("a.txt", 1, "1"), ("a.txt", 2, "2"), ("b.txt", 1, "3")]
    refs = str(tmp_path / "refs")
    run_available(stream_files(spark, str(src), "ref", pattern="b*"), refs, refs + "-check")
    assert spark.read.parquet(refs).count() == 1
    for bad in ({"after": "burn"}, {"after": "archive"}, {"mode": "x"}):
        with pytest.raises(ValueError):
            stream_files(spark, str(src), **{"mode": "ref", **bad})


def test_table_polls(spark, tmp_path):
    df = spark.createDataFrame([(1, "Bob"), (2, "Jane"), (3, "John")], "id long, name string")
    df.createOrReplaceTempView("people_t")
    assert read_table(spark, "select id, name from people_t order by id").count() == 3
    assert [(r.id, r.poll) for r in poll_chunks(df, "id", 2).orderBy("id").collect()] == [(1, 1), (2, 1), (3, 2)]
    lists = row_lists(df, "id", 2).orderBy("poll").collect()
    assert [[x.name for x in r.payload] for r in lists] == [["Bob", "Jane"], ["John"]]
    state = str(tmp_path / "state")
    seen = []
    for _ in range(3):
        poller = TablePoller(spark, state, "id", 2)  # a new one each time, as after a restart
        rows = poller.poll(df)
        seen.append([r.id for r in rows.collect()])
        poller.commit(rows)
    assert seen == [[1, 2], [3], []]
    assert [r.id for r in TablePoller(spark, state, "id", 2).poll(df.union(spark.createDataFrame([(9, "New")], df.schema))).collect()] == [9]
    assert unconsumed(df, df.filter("id < 3"), "id").count() == 1


def test_polls_are_ranges_of_a_stored_plan(spark, tmp_path):
    state = str(tmp_path / "plan")
    rows = [(i // 3, chr(97 + i % 2), i) for i in range(60)]
    df = spark.createDataFrame(rows, "a int, b string, n int").repartition(5)
    seen = []
    for _ in range(60):
        poll = TablePoller(spark, state, ["a", "b"], 7, hot_rows=4).poll(df)
        text = poll._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrdered" not in text and "Sort" not in text and "GlobalLimit" not in text
        got = poll.collect()
        assert sorted(TablePoller(spark, state, ["a", "b"], 7).poll(df).collect()) == sorted(got)
        if not got:
            break
        seen.append(got)
        TablePoller(spark, state, ["a", "b"], 7).commit(poll)
    assert sorted(r.n for poll in seen for r in poll) == list(range(60)) and all(len(poll) <= 9 for poll in seen)
    keys = [sorted({(r.a, r.b) for r in poll}) for poll in seen]
    assert all(x[-1] < y[0] for x, y in zip(keys, keys[1:]))
    late = df.union(spark.createDataFrame([(100, "z", 60), (None, "z", 61)], df.schema))
    assert [r.n for r in TablePoller(spark, state, ["a", "b"], 7).poll(late).collect()] == [60]


def test_topics(spark):
    assert topic_options("b:1", ["x", "y"], "g", "earliest") == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "x,y", "startingOffsets": "earliest", "includeHeaders": "true", "kafka.group.id": "g"}
    assert "subscribePattern" in topic_options("b:1", "x.*")
    rows = [(b"k", b"v", "t", 0, 7, None, 0, [("a", b"1"), ("a", b"2"), ("contentType", b"text/plain")]), (None, b"w", "t", 1, 8, None, 0, None)]
    got = topic_messages(spark.createDataFrame(rows, TOPIC_SCHEMA)).orderBy("msg_id").collect()
    assert got[0].headers == {"a": "2", "contentType": "text/plain"} and got[0].content_type == "text/plain" and got[0].msg_id == "t-0-7"
    assert got[1].content_type == "application/octet-stream"


def test_generated_messages(spark):
    df = generate_messages(spark, producers=3, count=50, size=20)
    assert df.rdd.getNumPartitions() == 3
    row = df.agg(F.count("*").alias("n"), F.sum(F.octet_length("payload")).alias("b"), F.countDistinct("producer").alias("p")).first()
    assert (row.n, row.b, row.p) == (150, 3000, 3)
    assert generate_messages(spark).agg(F.count("*").alias("n"), F.max(F.octet_length("payload")).alias("s")).first() == (1000, 1000)


def test_time_spine(spark):
    spine = time_spine(spark, "2024-01-01 00:00:00", "2024-01-01 02:00:00", "1 hour")
    assert [r.payload for r in spine.orderBy("tick").collect()] == ["01/01/24 00:00:00", "01/01/24 01:00:00", "01/01/24 02:00:00"]
    metrics = spine.filter("hour(tick) = 1").withColumn("n", F.lit(5))
    assert [r.n for r in zero_fill(spine, metrics, ["tick"], ["n"]).orderBy("tick").collect()] == [0, 5, 0]


def test_syslog(spark):
    # The first line is the golden case of the old format, the others follow the new one's description.
    lines = [
        "<157>JUL 26 22:08:35 WEBERN TESTING[70729]: TEST SYSLOG MESSAGE",
        '<165>1 2003-10-11T22:14:15.003Z host.example.com app - ID47 [x@1 a="b"] An event',
        "<34>1 2003-10-11T22:14:15Z h su 12 - -",
        "no syslog at all",
    ]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, payload string")
    rows = parse_syslog(df).orderBy("i").collect()
    assert (rows[0].host, rows[0].app, rows[0].proc_id, rows[0].message, rows[0].facility, rows[0].severity) == (
        "WEBERN", "TESTING", "70729", "TEST SYSLOG MESSAGE", 19, 5)
    assert (rows[1].host, rows[1].version, rows[1].proc_id, rows[1].msg_id, rows[1].structured_data, rows[1].message) == (
        "host.example.com", 1, None, "ID47", '[x@1 a="b"]', "An event")
    assert (rows[2].app, rows[2].proc_id, rows[2].structured_data) == ("su", "12", None)
    assert [r.undecoded for r in rows] == [None, None, None, "no syslog at all"]


ROW = "id int, name string, weight double"


def _change(op, before=None, after=None):
    return json.dumps({"before": before, "after": after, "source": {"name": "my-topic", "db": "inventory", "ts_ms": 5}, "op": op, "ts_ms": 9, "transaction": None})


def test_change_flattening(spark):
    hammer = {"id": 106, "name": "hammer", "weight": 1.0}
    df = spark.createDataFrame([(_change("r", None, hammer),), (_change("u", hammer, {**hammer, "name": "axe"}),), ('{"ddl":"drop table x"}',)], "p string")
    m = to_messages(df, "p", {"row_key": "'k'"}, "application/json")
    rows = unwrap_changes(m, ROW, ["name", "db", "op", "ts_ms", "source.ts_ms"]).orderBy("op").collect()
    assert [r.name for r in rows] == ["hammer", "axe"]
    assert (rows[0]["__name"], rows[0]["__db"], rows[0]["__op"], rows[0]["__ts_ms"], rows[0]["__source_ts_ms"]) == ("my-topic", "inventory", "r", 9, 5)
    assert rows[0].headers == {"row_key": "k"}
    flat = row_json(unwrap_changes(m, ROW, ["op"]), ["id", "name", "weight", "__op"]).orderBy("op").first().payload
    assert json.loads(flat) == {**hammer, "__op": "r"}
    assert read_changes(m, ROW).filter("op is null").count() == 1


# What one DELETE (delete event + tombstone) leaves, by mode and by whether tombstones are dropped.
DELETE_RESULTS = {
    ("none", True): [("null", None)], ("none", False): [("null", None), ("null", "key")],
    ("drop", True): [], ("drop", False): [("null", "key")],
    ("rewrite", True): [("deleted", None)], ("rewrite", False): [("deleted", None), ("null", "key")],
}


@pytest.mark.parametrize("mode, dropped", list(itertools.product(["none", "drop", "rewrite"], [True, False])))
def test_deletes(spark, mode, dropped):
    gone = {"id": 7, "name": "x", "weight": 1.0}
    df = spark.createDataFrame([(_change("d", gone), None), (None, "key")], "p string, k string")
    m = to_messages(df, "p", {"row_key": "k"}, "application/json")
    out = row_json(unwrap_changes(m, ROW, [], mode, dropped), ["id", "name", "weight"] + (["__deleted"] if mode == "rewrite" else []))
    got = []
    for r in out.orderBy("op").collect():
        body = "null" if r.payload is None else ("deleted" if json.loads(r.payload).get("__deleted") == "true" else "row")
        got.append((body, r.headers["row_key"]))
    assert got == DELETE_RESULTS[mode, dropped]


def test_files_are_deleted_or_archived_after_reading(spark, tmp_path):
    for after in ("delete", "archive"):
        src, kept = tmp_path / after, tmp_path / f"{after}-kept"
        src.mkdir()
        out, check = str(tmp_path / f"{after}-out"), str(tmp_path / f"{after}-check")
        for i in range(3):
            (src / f"{i}.txt").write_text(f"{i}\n")
            stream = stream_files(spark, str(src), "contents", after=after, archive_dir=str(kept))
            run_available(stream.select("path", F.decode("payload", "UTF-8").alias("t")), out, check)
        assert sorted(r.t for r in spark.read.parquet(out).collect()) == ["0\n", "1\n", "2\n"]
        # a file goes once the batch after its own has been planned
        assert not (src / "0.txt").exists()
        assert after == "delete" or list(kept.rglob("0.txt"))


def test_generated_streams(spark, tmp_path):
    rows = []
    stream = generate_stream(spark, rows_per_batch=40, size=7, producers=2)
    query = stream.writeStream.foreachBatch(lambda b, i: rows.append(b.agg(F.count("*"), F.max(F.octet_length("payload"))).first())).option("checkpointLocation", str(tmp_path / "c")).start()
    while not rows:
        query.awaitTermination(1)
    query.stop()
    assert tuple(rows[0]) == (40, 7)
    assert tick_stream(spark).isStreaming and tick_stream(spark).columns == ["tick", "payload"]


def test_long_syslog_lines_and_separators(spark):
    sd = "[a@1 b=\"" + "x\\]y" * 250_000 + "\"]"
    lines = [f"<13>1 2024-01-01T00:00:00Z host app 1 ID {sd} text", "<13>1 - ho\x1est app - - - a\x1eb\x1d0c", "<999>1 - h a - - - x", "<192>1 - h a - - - x", "<191>1 - h a - - - x"]
    rows = parse_syslog(spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, payload string")).orderBy("i").collect()
    assert rows[0].structured_data == sd and rows[0].message == "text"
    assert (rows[1].host, rows[1].app, rows[1].message) == ("ho\x1est", "app", "a\x1eb\x1d0c")
    assert [r.undecoded is None for r in rows] == [True, True, False, False, True] and rows[4].facility == 23


def test_an_inserted_row_of_nulls_is_a_row(spark):
    df = spark.createDataFrame([(None, "c"), (None, "d"), (1, "u")], "a int, op string")
    assert [r.payload for r in row_json(df, ["a"]).collect()] == ['{"a":null}', None, '{"a":1}']
