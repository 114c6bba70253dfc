import base64
import gzip
import hashlib
import io
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import warc

SCHEMA = "page_id bigint, url string, html string"


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(rows, least=0):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        size = len((html or "").encode())
        keep = first.get(html or "") if size >= least else None
        again = keep is not None and keep != i
        out.append((i, size, sha(html), "revisit" if again else "response", keep if again else None, True))
    return Counter(out)


@pytest.fixture
def odd_pages():
    long = "".join(f"<p>{i} {i * i}</p>\r\n\r\n" for i in range(200_000))
    return [
        (1, "http://a/", "<html>x</html>"), (2, None, None), (3, "", ""), (4, "http://b/\r\nWARC-Type: x", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
        (5, "http://ü/ x", long), (6, "http://c", long), (7, "u", "\r\n\r\n"), (8, "u", "\r\n"), (9, "u", "漢字 😀 \x00 \x1c"), (10, "u", "<html>x</html>"), (None, "u", "alone"), (None, "u", "<html>x</html>"),
        (11, "u", "again"), (11, "u", "again"), (12, "u", "again"), (0, "u", "<html>x</html>"),
    ]


def trip(spark, rows, tmp_path, parts=3):
    pages = spark.createDataFrame(rows, SCHEMA).withColumn("first", F.lit("x")).withColumn("payload", F.lit(1)).repartition(parts)
    return warc.round_trip(pages, f"file://{tmp_path}")


def test_odd_rows(spark, odd_pages, tmp_path):
    assert Counter(map(tuple, trip(spark, odd_pages, tmp_path).collect())) == brute(odd_pages)


def test_small_pieces(spark, odd_pages, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "PIECE", 37)
    rows = [r for r in odd_pages if len(r[2] or "") < 1000]
    plain = io.BytesIO(gzip.compress(b"WARC/1.1\r\nContent-Length: 4\r\nX: a\r\n b\r\n\r\nbody\r\n\r\n" * 50) * 3)
    out = io.BytesIO()
    index = list(warc.rewrite(warc.inflated(plain), out.write))
    assert len(index) == 150 and index[-1][0] + index[-1][1] == len(out.getvalue())
    for offset, length, *_ in index:
        assert zlib.decompress(out.getvalue()[offset:offset + length], 31) == b"WARC/1.1\r\nContent-Length: 4\r\nX: a\r\n b\r\n\r\nbody\r\n\r\n"
    assert Counter(map(tuple, trip(spark, rows, tmp_path).collect())) == brute(rows)


def test_a_stream_a_file_then_a_member_a_record(spark, odd_pages, tmp_path):
    trip(spark, odd_pages, tmp_path, parts=2).count()
    streams = [f.read_bytes() for f in (tmp_path / "streams").glob("*.gz")]
    whole = b""
    for data in streams:
        engine = zlib.decompressobj(31)
        whole += engine.decompress(data) + engine.flush()
        assert engine.eof and not engine.unused_data  # one member
    records = 0
    for f in (tmp_path / "archives").glob("*.warc.gz"):
        for line in (tmp_path / "archives" / f"{f.name}.idx").read_text().splitlines():
            offset, length, kind, record = line.split("\t")
            member = zlib.decompress(f.read_bytes()[int(offset):int(offset) + int(length)], 31)
            assert member in whole and member.endswith(b"\r\n\r\n") and kind.encode() in member and record.encode() in member
            records += 1
        assert gzip.decompress(f.read_bytes()).startswith(b"WARC/1.1\r\n")
    assert records == len(odd_pages)


def test_payloads_and_single_records(spark, odd_pages, tmp_path):
    trip(spark, odd_pages, tmp_path).count()
    index = warc.read_index(spark, f"file://{tmp_path}/archives")
    assert index.count() == len(odd_pages)
    read = warc.read_records(spark, f"file://{tmp_path}/archives", with_payload=True).filter("type = 'response'").collect()
    texts = {(i, h or "") for i, _, h in odd_pages}
    assert all((None if r.page_key is None else int(r.page_key), r.payload.decode()) in texts for r in read)
    one = index.filter("type = 'revisit'").limit(1)
    assert [r.payload_bytes for r in warc.read_records(spark, f"file://{tmp_path}/archives", one).collect()] == [None]


def test_line_ends_stay_in_their_header(spark, odd_pages, tmp_path):
    trip(spark, odd_pages, tmp_path).count()
    found = {r.page_key: r.target_uri for r in warc.read_records(spark, f"file://{tmp_path}/archives").collect()}
    assert found["4"] == "http://b/%0D%0AWARC-Type: x" and found["2"] is None and found["5"] == "http://ü/ x"


def test_least_bytes(spark, tmp_path):
    rows = [(i, "u", "same") for i in range(5)] + [(i, "u", "long " * 20) for i in range(5, 9)]
    folder = f"file://{tmp_path}"
    warc.write_archives(spark.createDataFrame(rows, SCHEMA), f"{folder}/streams", least=50)
    assert warc.normalise(spark, f"{folder}/streams", f"{folder}/archives") == 9
    got = warc.resolve(warc.read_records(spark, f"{folder}/archives"))
    got = got.select(F.col("page_key").cast("long"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long"), "intact")
    assert Counter(map(tuple, got.collect())) == brute(rows, least=50)


def test_hot_payload(spark, tmp_path):
    rows = [(i, "u", "hot" if i % 2 else f"page {i // 4}") for i in range(5000)]
    assert Counter(map(tuple, trip(spark, rows, tmp_path).collect())) == brute(rows)


def test_a_broken_stream_is_an_error():
    data = gzip.compress(b"WARC/1.1\r\nContent-Length: 4\r\n\r\nbody\r\n\r\n")
    with pytest.raises(ValueError):
        list(warc.rewrite(warc.inflated(io.BytesIO(data[:-12])), lambda b: len(b)))


def test_a_missing_response_shows(spark):
    found = spark.createDataFrame([("<r2>", "revisit", "2", "<gone>", None, "ABC", None, None, None)], warc.RECORDS)
    assert [tuple(r) for r in warc.resolve(found).collect()] == [("2", "revisit", None, None, None, False)]


def test_empty(spark, tmp_path):
    assert trip(spark, [], tmp_path, parts=1).count() == 0
