"""Files: the documents written as text, one folder per source, and read back in every mode."""

from pyspark.sql import functions as F

from millrace.plans.queries.registry import query, table
from millrace.session import scratch_path
from millrace.sinks.files import write_text
from millrace.sources.files import line_messages, read_files, stream_files
from millrace.streaming.runs import run_batches


def _folder(spark, sf_dir) -> str:
    path = scratch_path(spark, "files")
    write_text(table(spark, sf_dir, "documents").select("source", F.col("text").alias("payload")), path, "source")
    return path


def _source():
    return F.regexp_extract("path", "file_key=([^/]+)/", 1).alias("source")


@query("SELECT source, sum(strlen(text) + 1)::BIGINT AS bytes FROM documents GROUP BY source")
def file_contents(spark, sf_dir):
    """S1a"""
    files = read_files(spark, _folder(spark, sf_dir) + "/*", "contents").select(_source(), F.octet_length("payload").alias("b"))
    return files.groupBy("source").agg(F.sum("b").alias("bytes"))


@query("SELECT source, unnest(string_split(text, chr(10))) AS payload FROM documents")
def file_lines(spark, sf_dir):
    """The lines"""
    return read_files(spark, _folder(spark, sf_dir) + "/*", "lines").select(_source(), "payload")


@query("SELECT source, count(*) AS lines, 0 AS gaps FROM (SELECT source, unnest(string_split(text, chr(10))) FROM documents) GROUP BY source")
def file_line_numbers(spark, sf_dir):
    """The numbers of each file run from 1 to the number of its lines, with one correlation id"""
    lines = read_files(spark, _folder(spark, sf_dir) + "/*", "lines")
    per_file = lines.groupBy("path").agg(
        F.count(F.lit(1)).alias("n"), F.max("line").alias("top"), F.sum("line").alias("total"),
        F.max(F.col("headers")["correlationId"]).alias("last"), F.min(F.col("headers")["correlationId"]).alias("first"),
    )
    gap = (F.col("n") != F.col("top")) | (F.col("total") * 2 != F.col("n") * (F.col("n") + 1)) | (F.col("first") != F.col("last"))
    return per_file.groupBy(_source()).agg(F.sum("n").alias("lines"), F.sum(gap.cast("int")).cast("int").alias("gaps"))


@query("SELECT source, count(*) AS lines, 0 AS open_files FROM (SELECT source, unnest(string_split(text, chr(10))) FROM documents) GROUP BY source")
def file_markers(spark, sf_dir):
    """As many END as START markers, whose counts add up to the lines"""
    rows = read_files(spark, _folder(spark, sf_dir) + "/*", "lines", with_markers=True)
    ends = F.when(F.col("marker") == "END", F.get_json_object("payload", "$.lineCount").cast("long"))
    open_files = F.sum(F.when(F.col("marker") == "START", 1).when(F.col("marker") == "END", -1).otherwise(0))
    return rows.groupBy(_source()).agg(F.sum(ends).alias("lines"), open_files.cast("int").alias("open_files"))


@query("SELECT source, sum(strlen(text) + 1)::BIGINT AS bytes FROM documents GROUP BY source")
def file_references(spark, sf_dir):
    """S1d: sizes from the file listing alone"""
    return read_files(spark, _folder(spark, sf_dir) + "/*", "ref").groupBy(_source()).agg(F.sum("size").alias("bytes"))


@query("""
SELECT source, (count(*) + 1)::BIGINT AS contents, (count(*) + 1)::BIGINT AS refs, 2 * (count(*) + 1)::BIGINT AS markers, sum(lines)::BIGINT AS lines
FROM (SELECT coalesce(source, '') AS source, coalesce(lang, '') AS lang, sum(len(string_split(text, chr(10)))) AS lines FROM documents GROUP BY ALL) GROUP BY source
""")
def empty_files(spark, sf_dir):
    """S1a, S1c, S1d: a file per source and language, and an empty one beside them; how many files each mode sees"""
    path = scratch_path(spark, "hollow")
    docs = table(spark, sf_dir, "documents").select(F.coalesce("source", F.lit("")).alias("s"), F.coalesce("lang", F.lit("")).alias("l"), F.col("text").alias("payload"))
    write_text(docs.withColumn("name", F.concat_ws("-", "s", "l")), path, "name", replace=True, compact=True)
    listed = read_files(spark, path + "/*", "ref").select("path").collect()
    jvm = spark.sparkContext._jvm
    for folder in {r.path.rsplit("/", 1)[0].rsplit("-", 1)[0] for r in listed}:
        target = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder + "-none/empty.txt"))
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target).close()
    source = F.regexp_extract("path", "file_key=(.*)-[^-/]*/", 1).alias("source")
    contents, refs = (read_files(spark, path + "/*", mode).groupBy(source).agg(F.countDistinct("path").alias(name)) for mode, name in (("contents", "contents"), ("ref", "refs")))
    rows = read_files(spark, path + "/*", "lines", with_markers=True).groupBy(source).agg(F.count("marker").alias("markers"), F.sum(F.col("marker").isNull().cast("long")).alias("lines"))
    return contents.join(refs, "source").join(rows, "source")


@query("SELECT text AS payload, count(*) AS n FROM documents GROUP BY text")
def records_between_nul(spark, sf_dir):
    """S1e: records that may hold line feeds, ended by NUL"""
    path = scratch_path(spark, "nul")
    table(spark, sf_dir, "documents").select("text").write.option("lineSep", "\0").text(path)
    return read_files(spark, path, "lines", record_separator="nul").groupBy("payload").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT text AS payload, count(*) AS n FROM documents GROUP BY text")
def records_between_stx_and_etx(spark, sf_dir):
    """S1e: records framed by STX and ETX"""
    path = scratch_path(spark, "stx")
    table(spark, sf_dir, "documents").select(F.concat(F.lit("\x02"), "text")).write.option("lineSep", "\x03").text(path)
    return read_files(spark, path, "lines", record_separator="stxetx").groupBy("payload").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT source, count(*) AS lines, sum(length(payload))::BIGINT AS chars FROM (SELECT source, unnest(string_split(text, chr(10))) AS payload FROM documents) GROUP BY source")
def followed_files(spark, sf_dir):
    """A folder that fills in two steps, each file read once over three runs of the stream"""
    docs = table(spark, sf_dir, "documents").select("source", F.col("text").alias("payload"))
    src, out, checkpoint = (scratch_path(spark, n) for n in ("followed", "seen", "checkpoint"))

    def write(batch, batch_id):
        line_messages(batch).select("path", "line", "payload").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    write_text(docs.filter("lang = 'en'"), src, "source")
    run_batches(stream_files(spark, src + "/*", "lines"), write, checkpoint)
    write_text(docs.filter("lang <> 'en'"), src, "source")
    run_batches(stream_files(spark, src + "/*", "lines"), write, checkpoint)
    run_batches(stream_files(spark, src + "/*", "lines"), write, checkpoint)
    seen = spark.read.parquet(out)
    return seen.groupBy(_source()).agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("payload")).alias("chars"))
