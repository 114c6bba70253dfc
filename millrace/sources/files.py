"""Files as contents, lines or references, read once or followed as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.messages import header_map
from millrace.session import stage

# Record separators by name.
SEPARATORS = {"crlf": "\r\n", "lf": "\n", "nul": "\0", "stxetx": "\x03"}

# The table of splits, some 100 bytes each, goes to every task up to this number of them; beyond it is joined by shuffle.
MAX_SPLITS = 500_000
MARKER_FORMATS = ("json", "text")


def read_files(
    spark: SparkSession,
    path: str,
    mode: str = "contents",
    with_markers: bool = False,
    record_separator: str | None = None,
    pattern: str | None = None,
    marker_format: str = "json",
) -> DataFrame:
    """``contents`` (one message per file), ``lines`` (one per line) or ``ref`` (metadata only).

    Lines carry ``path`` and ``line`` (from 1), and the headers ``correlationId`` (a hash
    of the path), ``sequenceNumber`` and ``sequenceSize`` 0.  With markers each file also
    gets a START row (line 0) and an END row (last line + 1); their payload is JSON or, as ``text``, the mark and the path.

    Empty files are messages too: empty contents, a reference, or START and END without lines. Spark lists them but does not
    read them, so they are what the listing has more than what was read.
    """
    if mode == "contents":
        files = _listing(spark, path, pattern)
        return _contents(files.selectExpr("content", *_FILE).unionByName(_empty_files(files).withColumn("content", F.lit(b"")).select("content", "path", "file_name")))
    if mode == "ref":
        files = _listing(spark, path, pattern)
        return _references(files).unionByName(_empty_references(_empty_files(files)))
    if mode != "lines":
        raise ValueError(f"unknown mode {mode!r}")
    lines = _raw_lines(_text_reader(spark.read, record_separator, pattern).text(path), record_separator)
    empty = _empty_files(_listing(spark, path, pattern)) if with_markers else None
    return line_messages(lines, with_markers, marker_format, empty)


def line_messages(lines: DataFrame, with_markers: bool = False, marker_format: str = "json", empty: DataFrame | None = None) -> DataFrame:
    """Numbered messages, and markers, of lines as :func:`stream_files` gives them, inside ``foreachBatch``.

    ``empty`` names files without lines (``path``, ``file_name``) that get markers as well; a stream does not know of them.
    """
    if marker_format not in MARKER_FORMATS:
        raise ValueError(f"unknown marker format {marker_format!r}")
    rows, splits = _numbered(lines)
    messages = _line_messages(rows)
    if not with_markers:
        return messages
    files = splits.groupBy("path", "file_name").agg(F.sum("n").alias("lines"))
    if empty is not None:
        files = files.unionByName(empty.withColumn("lines", F.lit(0).cast("long")))
    return _add_markers(messages, files, marker_format)


# SQL text, since columns cannot be made before there is a session.  Spark gives both in the form of a URL.
_FILE = ("_metadata.file_path AS path", "url_decode(replace(_metadata.file_name, '+', '%2B')) AS file_name")


def _listing(spark, path, pattern) -> DataFrame:
    reader = spark.read.format("binaryFile")
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).load(path)


def _empty_files(files: DataFrame) -> DataFrame:
    """(path, file_name) of the listed files that have nothing to read. The listing is the one that Spark's driver already holds."""
    spark = files.sparkSession
    listed = spark.createDataFrame([(p,) for p in files.inputFiles()], "path string")
    listed = listed.select(F.regexp_replace("path", "^file:/+", "file:/").alias("path"))
    read = files.select(F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("path"))
    return listed.join(read, "path", "left_anti").select("path", F.expr("url_decode(replace(regexp_extract(path, '[^/]*$', 0), '+', '%2B'))").alias("file_name"))


def _empty_references(empty: DataFrame) -> DataFrame:
    """Their times are looked up one by one, so this is for folders with a moderate number of empty files."""
    spark = empty.sparkSession
    jvm, rows = spark.sparkContext._jvm, []
    for row in empty.collect():
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row.path))
        rows.append((row.path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).getModificationTime()))
    found = spark.createDataFrame(rows, "path string, at bigint")
    return found.select(
        F.col("path").alias("payload"), header_map({}).alias("headers"), F.lit("text/plain").alias("content_type"), "path",
        F.lit(0).cast("long").alias("size"), F.timestamp_millis("at").alias("modified"),
    )


def _text_reader(reader, separator, pattern):
    if separator is not None:
        reader = reader.option("lineSep", SEPARATORS[separator])
    return reader.option("pathGlobFilter", pattern) if pattern else reader


def _file_headers():
    return {"file_name": F.col("file_name"), "file_originalFile": F.col("path")}


def _contents(files: DataFrame) -> DataFrame:
    return files.select(
        F.col("content").alias("payload"),
        header_map(_file_headers()).alias("headers"),
        F.lit("application/octet-stream").alias("content_type"),
        "path",
    )


def _references(files: DataFrame) -> DataFrame:
    # The content column is not selected, so no file is opened.
    return files.select(
        F.col("_metadata.file_path").alias("payload"),
        header_map({}).alias("headers"),
        F.lit("text/plain").alias("content_type"),
        F.col("_metadata.file_path").alias("path"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def _raw_lines(text: DataFrame, separator: str | None) -> DataFrame:
    value = F.regexp_replace("value", "^\\s*\x02", "") if separator == "stxetx" else F.col("value")
    return text.select(
        value.alias("payload"),
        *[F.expr(c) for c in _FILE],
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def number_lines(lines: DataFrame) -> DataFrame:
    """Add ``line``, the position of each line in its file, without a shuffle of the lines.

    Rows come as read, with ``path`` and ``block_start``; also usable on the batches of :func:`stream_files`. They must not
    have been filtered or moved, since a line's place in its split is told by its row id.
    """
    return _numbered(lines)[0]


def _numbered(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered lines, and (path, file_name, block_start, n, …) of the splits they come from.

    A first pass reads no text but counts the lines of each split; sums over the splits before give the number of its first line. Splits are cut from
    the listing that the frame holds, so both passes see the same ones, and row ids go up by one within a split.
    """
    lines = lines.withColumn("row_id", F.monotonically_increasing_id())
    counted = stage(lines.groupBy("path", "file_name", "block_start").agg(F.count(F.lit(1)).alias("n"), F.min("row_id").alias("low")), "splits")
    before = Window.partitionBy("path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counted.select("path", "block_start", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low") + 1).alias("shift"))
    if counted.count() <= MAX_SPLITS:
        firsts = F.broadcast(firsts)
    rows = lines.join(firsts, ["path", "block_start"]).withColumn("line", F.col("row_id") + F.col("shift")).drop("shift")
    return rows, counted


def _line_messages(numbered: DataFrame) -> DataFrame:
    headers = {
        **_file_headers(),
        "correlationId": F.md5("path"),
        "sequenceNumber": F.col("line"),
        "sequenceSize": F.lit(0),
    }
    return numbered.select(
        "payload", header_map(headers).alias("headers"), F.lit("text/plain").alias("content_type"), "path", "line"
    )


def _add_markers(messages: DataFrame, files: DataFrame, marker_format: str) -> DataFrame:
    marks = F.array(
        F.struct(F.lit("START").alias("mark"), F.lit(0).cast("long").alias("line"), F.lit(None).cast("long").alias("count")),
        F.struct(F.lit("END").alias("mark"), (F.col("lines") + 1).alias("line"), F.col("lines").alias("count")),
    )
    as_json = F.to_json(F.struct(F.col("path").alias("filePath"), F.col("m.mark").alias("mark"), F.col("m.count").alias("lineCount")))
    as_text = F.concat_ws(" ", "m.mark", "path", "m.count")
    markers = files.withColumn("m", F.explode(marks)).select(
        (as_json if marker_format == "json" else as_text).alias("payload"),
        header_map(_file_headers()).alias("headers"),
        F.lit("application/json" if marker_format == "json" else "text/plain").alias("content_type"),
        "path",
        F.col("m.line").alias("line"),
        F.col("m.mark").alias("marker"),
    )
    return messages.withColumn("marker", F.lit(None).cast("string")).unionByName(markers)


def stream_files(
    spark: SparkSession,
    path: str,
    mode: str = "contents",
    after: str = "keep",
    archive_dir: str | None = None,
    record_separator: str | None = None,
    pattern: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Follow a directory; the checkpoint of the query remembers which files were read.

    ``after`` keeps, archives or deletes a file once it has been processed.  In mode
    ``lines`` the rows come unnumbered; call :func:`line_messages` (headers, numbers, markers) or :func:`number_lines` inside
    ``foreachBatch``, where a file is always complete.  A stream does not see empty files.
    """
    reader = spark.readStream
    if after not in ("keep", "archive", "delete"):
        raise ValueError(f"unknown value {after!r} for after")
    if after != "keep":
        reader = reader.option("cleanSource", after)
    if after == "archive":
        if not archive_dir:
            raise ValueError("archive needs archive_dir")
        reader = reader.option("sourceArchiveDir", archive_dir)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if mode == "lines":
        return _raw_lines(_text_reader(reader, record_separator, pattern).text(path), record_separator)
    if mode not in ("contents", "ref"):
        raise ValueError(f"unknown mode {mode!r}")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.format("binaryFile").schema(_BINARY_FILE).load(path)
    return _references(files) if mode == "ref" else _contents(files.selectExpr("content", *_FILE))


_BINARY_FILE = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])
