"""WARC archives: written as one gzip stream a file, normalised to a member a record with an offset index, read back by offset.

Writing is Spark's own text writer: records are rows, the separator is the empty line pair that ends a WARC record, and the
codec makes the whole file one gzip stream. Such a file can only be read from its start. :func:`normalise`
inflates each file once, in pieces, and writes every record again as a member of its own beside a sidecar index. From then on
:func:`read_records` deals slices of archives to tasks, however long an archive is.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import column, join_groups
from millrace.session import stage

#: Bytes that are read, inflated or deflated at a time.
PIECE = 1 << 20
#: A header block longer than this is no WARC header.
MAX_HEADER = 1 << 20
#: Bytes of an archive that one slice of a reading task covers, by the place where its records start.
SLICE = 32 << 20
#: Bytes of payload in one batch that a reading task hands back; a single longer payload is a batch of its own.
BATCH = 8 << 20
#: Records in one written archive at most.
RECORDS_PER_FILE = 100_000
#: Tasks that normalise archives at most; a task takes several archives, one after the other, where there are more.
MAX_TASKS = 10_000

# Fixed values of the format.
END = "\r\n\r\n"
VERSION = "WARC/1.1"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

INDEX = "offset long, length long, type string, record_id string"
RECORDS = (
    "record_id string, type string, page_key string, refers_to_id string, target_uri string, declared_digest string, "
    "payload_bytes long, payload_digest string, payload binary"
)


def base32_sha1(data: Column) -> Column:
    """The bare upper-case base32 SHA-1 of binary data: 5 hex digits are 20 bits are 4 letters."""
    sha = F.sha1(data)
    groups = (F.conv(F.substring(sha, 5 * k + 1, 5), 16, 10).cast("int") for k in range(8))
    letters = (F.substring(F.lit(BASE32), F.shiftright(g, s).bitwiseAND(31) + 1, F.lit(1)) for g in groups for s in (15, 10, 5, 0))
    return F.concat(*letters)


def _header_value(value: Column) -> Column:
    """A value on one line: line ends are percent-encoded."""
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _record_id(key: Column, digest: Column) -> Column:
    sha = F.sha2(F.concat_ws("\n", key, digest), 256)
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(sha, a, n) for a, n in cuts)), F.lit(">"))


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0) -> DataFrame:
    """(page_id, url, payload, digest, sha, first): ``first`` is the smallest id with an equal payload, NULL for payloads of fewer than ``least`` bytes.

    Equal payloads are told by SHA-256. A payload may have any number of copies: they are counted with a map side and joined back by
    :func:`~millrace.llm.common.join_groups`; payloads themselves do not take part in the aggregate.
    """
    payload = F.coalesce(column(pages, payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(column(pages, id_col).alias("page_id"), column(pages, url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.select("*", base32_sha1(F.col("payload")).alias("digest"), F.unhex(F.sha2("payload", 256)).alias("sha"))
    prints = rows.filter(F.octet_length("payload") >= least).select("sha", "page_id")
    groups = stage(prints.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("copies")), "warc-payloads")
    total = groups.agg(F.sum("copies")).first()[0] or 0
    repeated = groups.filter("copies > 1")
    return join_groups(rows, repeated, ["sha"], "copies", total).drop("copies")


def records(marked: DataFrame, date: str) -> DataFrame:
    """(value): the records of :func:`with_revisits` as text without the closing lines, ready for a writer whose separator is ``END``."""
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    key = F.coalesce(_header_value(F.col("page_id").cast("string")), F.lit(""))
    body = F.when(revisit, F.lit(HTTP_HEAD)).otherwise(F.concat(F.lit(HTTP_HEAD), F.col("payload").cast("string")))
    refers = F.when(revisit, F.concat(
        F.lit(f"WARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: "), _record_id(_header_value(F.col("first").cast("string")), F.col("digest")), F.lit("\r\n"))).otherwise("")
    target = F.coalesce(F.concat(F.lit("WARC-Target-URI: "), _header_value(F.col("url")), F.lit("\r\n")), F.lit(""))
    # A NULL id has no key line at all.
    page = F.coalesce(F.concat(F.lit("X-Page-Key: "), _header_value(F.col("page_id").cast("string")), F.lit("\r\n")), F.lit(""))
    return marked.select(F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), _record_id(key, F.col("digest")),
        F.lit(f"\r\nWARC-Date: {date}\r\n"), target, page, refers,
        F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit(END), body).alias("value"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write every row of ``pages`` as a record below ``folder``, each file one gzip stream. Of equal payloads the smallest id is the response.

    NULL payload: empty. NULL id: larger than any other, and without a key line. Rows that share the smallest id and the payload are all
    responses. NULL url: no target line; line ends in ids and urls are percent-encoded. Empty table: no records. Other columns are not read.
    """
    out = records(with_revisits(pages, id_col, url_col, payload_col, least), date)
    out.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder)


def inflated(source) -> Iterator[bytes]:
    """The bytes of a gzip stream of any number of members, at most ``PIECE`` at a time. A stream that ends early is an error."""
    engine, packed, open_member = zlib.decompressobj(31), b"", False
    while packed or (packed := source.read(PIECE)):
        if engine.eof:
            engine = zlib.decompressobj(31)
        found = engine.decompress(packed, PIECE)
        packed = engine.unused_data if engine.eof else engine.unconsumed_tail
        open_member = not engine.eof
        if found:
            yield found
    if open_member:
        rest = engine.flush()
        if not engine.eof:
            raise ValueError("the gzip stream ends early")
        yield rest


class Stream:
    """Headers and bodies out of pieces of bytes; holds one piece, or one header, at a time."""

    def __init__(self, pieces: Iterable[bytes]) -> None:
        self._pieces, self._held, self._at = iter(pieces), b"", 0

    def _more(self) -> bool:
        piece = next(self._pieces, None)
        if piece is not None:
            self._held, self._at = self._held[self._at:] + piece, 0
        return piece is not None

    def head(self) -> bytes | None:
        """A header block up to and with the empty line that ends it; None at the end. Line ends before it are passed over."""
        while True:
            while self._held[self._at:self._at + 1] in (b"\r", b"\n"):
                self._at += 1
            if self._at < len(self._held):
                break
            if not self._more():
                return None
        while (end := self._held.find(b"\r\n\r\n", self._at)) < 0:
            if len(self._held) - self._at > MAX_HEADER or not self._more():
                raise ValueError("a record's header has no end")
        found, self._at = self._held[self._at:end + 4], end + 4
        return found

    def take(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes, in pieces."""
        while n:
            if self._at == len(self._held) and not self._more():
                raise ValueError("a record ends early")
            piece = self._held[self._at:self._at + n]
            self._at += len(piece)
            n -= len(piece)
            yield piece

    def rest(self) -> Iterator[bytes]:
        """All that is left, in pieces."""
        while self._at < len(self._held) or self._more():
            piece, self._at = self._held[self._at:], len(self._held)
            yield piece


def fields(head: bytes) -> dict[str, str]:
    """The named fields of a header, names in lower case; lines that go on are put together, the first of a repeated name counts."""
    out: dict[str, str] = {}
    last = None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            last = name.strip().lower()
            out.setdefault(last, value.strip())
    return out


def rewrite(pieces: Iterable[bytes], write) -> Iterator[tuple[int, int, str, str]]:
    """Pass every record on to ``write`` as a gzip member of its own; yields its (offset, length, type, id)."""
    stream, offset = Stream(pieces), 0
    while (head := stream.head()) is not None:
        named = fields(head)
        engine, length = zlib.compressobj(6, zlib.DEFLATED, 31), 0
        length += write(engine.compress(head))
        for piece in stream.take(int(named["content-length"])):
            length += write(engine.compress(piece))
        length += write(engine.compress(END.encode()) + engine.flush())
        yield offset, length, named.get("warc-type", ""), named.get("warc-record-id", "")
        offset += length


def _name(path: str) -> str:
    base = path.rsplit("/", 1)[-1]
    for tail in (".gz", ".txt", ".warc"):
        base = base.removesuffix(tail)
    return f"{base}-{hashlib.sha256(path.encode()).hexdigest()[:12]}.warc.gz"


def normalise(spark: SparkSession, folder: str, out: str) -> int:
    """Rewrite every archive below ``folder`` to ``out`` with a gzip member per record and a sidecar ``….idx``; returns the number of records.

    An archive may hold any number of members, and records of any length: it is read once, front to back, a piece at a time. A task that is run
    again writes the same files: they are written under another name and moved, the index last. Both folders are read and
    written by pyarrow's file systems, so they need a URI that those know. Index lines: offset, length, type, record id, tab-separated. An empty file: an archive without records. A stream that breaks off is an error.
    """
    target, root = fs.FileSystem.from_uri(out)
    target.create_dir(root, recursive=True)
    archives = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(folder).select("path")
    archives = stage(archives, "warc-list")
    n = archives.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(out)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                source, place = fs.FileSystem.from_uri(path)
                name, attempt, count = f"{top}/{_name(path)}", uuid.uuid4().hex, 0
                with source.open_input_stream(place, compression=None) as packed, store.open_output_stream(f"{name}.{attempt}", compression=None) as data, \
                        store.open_output_stream(f"{name}.idx.{attempt}", compression=None) as index:
                    for offset, length, kind, record in rewrite(inflated(packed), data.write):
                        index.write(f"{offset}\t{length}\t{kind}\t{record}\n".encode())
                        count += 1
                store.move(f"{name}.{attempt}", name)
                store.move(f"{name}.idx.{attempt}", f"{name}.idx")
                yield pa.RecordBatch.from_pydict({"records": pa.array([count], pa.int64())})

    done = archives.repartition(max(1, min(n, MAX_TASKS))).mapInArrow(run, "records long")
    return done.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """(archive, offset, length, type, record_id) of the sidecars below ``folder``."""
    lines = spark.read.schema(INDEX).option("sep", "\t").option("quote", "").option("pathGlobFilter", "*.idx").csv(folder)
    return lines.select(F.regexp_replace("_metadata.file_path", r"\.idx$", "").alias("archive"), "*")


class _Cut:
    """The next ``n`` bytes of an open file."""

    def __init__(self, file, n: int) -> None:
        self._file, self._left = file, n

    def read(self, n: int) -> bytes:
        found = self._file.read(min(n, self._left))
        self._left -= len(found)
        return found


def _record(file, offset: int, length: int, with_payload: bool) -> dict:
    file.seek(offset)
    stream = Stream(inflated(_Cut(file, length)))
    named = fields(stream.head())
    row = {
        "record_id": named.get("warc-record-id"), "type": named.get("warc-type"), "page_key": named.get("x-page-key"), "refers_to_id": named.get("warc-refers-to"),
        "target_uri": named.get("warc-target-uri"), "declared_digest": named.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "payload_bytes": None, "payload_digest": None, "payload": None,
    }
    if row["type"] == "response":
        block = stream.take(int(named["content-length"]))
        if named.get("content-type", "").startswith("application/http"):
            inner = Stream(block)
            inner.head()
            block = inner.rest()
        sha, size, whole = hashlib.sha1(), 0, []
        for piece in block:
            sha.update(piece)
            size += len(piece)
            if with_payload:
                whole.append(piece)
        row |= {"payload_bytes": size, "payload_digest": base64.b32encode(sha.digest()).decode(), "payload": b"".join(whole) if with_payload else None}
    return row


def read_records(spark: SparkSession, folder: str, index: DataFrame | None = None, with_payload: bool = False) -> DataFrame:
    """The records below ``folder`` by their sidecars: :data:`RECORDS`. ``index`` may be a part of :func:`read_index`, so that only some records are read.

    The size and SHA-1 are those of the payload that was read, the body of the HTTP response; both are NULL for records without a payload of
    their own, such as revisits (see :func:`resolve`). A task reads slices of archives, record by record.
    """
    index = read_index(spark, folder) if index is None else index
    slices = index.withColumn("slice", F.floor(F.col("offset") / SLICE)).repartition("archive", "slice").sortWithinPartitions("archive", "offset")
    schema = spark.createDataFrame([], RECORDS).schema
    kinds = pa.schema([(f.name, pa.int64() if f.name == "payload_bytes" else pa.binary() if f.name == "payload" else pa.string()) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file, rows, held = None, None, [], 0
        for batch in batches:
            for archive, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
                if archive != name:
                    if file:
                        file.close()
                    store, place = fs.FileSystem.from_uri(archive)
                    name, file = archive, store.open_input_file(place)
                rows.append(_record(file, offset, length, with_payload))
                held += len(rows[-1]["payload"] or b"") + 500
                if held > BATCH:
                    yield pa.RecordBatch.from_pylist(rows, kinds)
                    rows, held = [], 0
        if file:
            file.close()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, kinds)

    return slices.select("archive", "offset", "length").mapInArrow(run, schema)


def resolve(found: DataFrame) -> DataFrame:
    """Of :func:`read_records`: (page_key, record_type, payload_bytes, payload_digest, refers_to, intact); revisits have size and digest of the response they refer to.

    ``intact``: the digest of the payload is the declared one. A response may have any number of revisits. A revisit whose response is not
    there has NULL size and is not intact.
    """
    found = stage(found.drop("payload"), "warc-records")
    visits = found.filter("type = 'revisit'").select("page_key", "declared_digest", F.col("refers_to_id").alias("of"))
    counts = visits.groupBy("of").agg(F.count("*").alias("visits"))
    # Rows that shared an id and a payload when they were written have the same record id and content.
    first = found.filter("type = 'response'").select(F.col("record_id").alias("of"), "page_key", "payload_bytes", "payload_digest").join(counts, "of").groupBy("of").agg(
        F.max("visits").alias("visits"), *(F.min(c).alias(f"of_{c}") for c in ("page_key", "payload_bytes", "payload_digest")))
    total = counts.agg(F.sum("visits")).first()[0] or 0
    again = join_groups(visits, first, ["of"], "visits", total).select(
        "page_key", F.lit("revisit").alias("record_type"), F.col("of_payload_bytes").alias("payload_bytes"), F.col("of_payload_digest").alias("payload_digest"),
        F.col("of_page_key").alias("refers_to"), F.coalesce(F.col("of_payload_digest") == F.col("declared_digest"), F.lit(False)).alias("intact"))
    own = found.filter("type = 'response'").select(
        "page_key", F.lit("response").alias("record_type"), "payload_bytes", "payload_digest", F.lit(None).cast("string").alias("refers_to"),
        F.coalesce(F.col("payload_digest") == F.col("declared_digest"), F.lit(False)).alias("intact"))
    return own.unionByName(again)


def round_trip(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` below ``folder``, normalise, read back and resolve: page_id, payload_bytes, payload_digest, record_type, refers_to, intact."""
    spark = pages.sparkSession
    write_archives(pages, f"{folder}/streams")
    normalise(spark, f"{folder}/streams", f"{folder}/archives")
    back = resolve(read_records(spark, f"{folder}/archives"))
    kind = pages.schema["page_id"].dataType
    return back.select(F.col("page_key").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"), "intact")
