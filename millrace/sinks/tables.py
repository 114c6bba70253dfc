"""K3, K5, K6: rows written to tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.bulk import VARCHAR_LENGTH, check_error_table, error_rows, good_rows, parse_lines
from millrace.session import scratch_path


def parse_columns(mapping: str | Sequence[str]) -> list[tuple[str, str]]:
    """``COL[:expression]`` items, comma-separated; a bare COL stands for the field of that name."""
    items = mapping if not isinstance(mapping, str) else _top_level_split(mapping)
    pairs = []
    for item in items:
        name, colon, expression = item.strip().partition(":")
        pairs.append((name.strip(), expression.strip() if colon else name.strip()))
    return pairs


def _top_level_split(text: str) -> list[str]:
    """Split at commas that are not inside parentheses."""
    parts, depth, start = [], 0, 0
    for i, char in enumerate(text):
        depth += (char == "(") - (char == ")")
        if char == "," and depth == 0:
            parts.append(text[start:i])
            start = i + 1
    return parts + [text[start:]]


# A path into the payload: names, list positions and quoted names.
_STEP = r"(?:\.[A-Za-z_]\w*|\[\d+\]|\['[^']*'\])"
_PATH = re.compile(rf"(?:payload(?={_STEP})|(?!(?:payload|headers)\b)[A-Za-z_]\w*){_STEP}*")
_INNER_PATH = re.compile(rf"('(?:[^'\\]|\\.)*')|\bpayload({_STEP}+)")


def _json_path(path: str) -> str:
    steps = path.removeprefix("payload") if path.startswith(("payload.", "payload[")) else "." + path
    return "$" + steps


def json_expression(expression: str, kind: str = "string") -> str:
    """``COL:expression`` over JSON of no known schema, as SQL over the variant ``payload``.

    A plain path gives a value of type ``kind``. In any other expression, paths that start with ``payload.`` give text, and ``headers`` and functions
    are as usual. A path that is not there gives NULL, a value that its type refuses is an error.
    """
    if _PATH.fullmatch(expression):
        return f"variant_get(payload, {_quoted(_json_path(expression))}, '{kind}')"

    def replaced(found: re.Match) -> str:
        return found[1] if found[1] is not None else f"variant_get(payload, {_quoted('$' + found[2])}, 'string')"

    return _INNER_PATH.sub(replaced, expression)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _json_rows(df: DataFrame, columns: str | Sequence[str], types: dict[str, str]) -> DataFrame:
    text = F.decode("payload", "UTF-8") if isinstance(df.schema["payload"].dataType, T.BinaryType) else F.col("payload")
    payload = text if df.schema["payload"].dataType.typeName() == "variant" else F.parse_json(text)
    opened = df.select(payload.alias("payload"), *[c for c in ("headers",) if c in df.columns])
    return opened.select(*[F.expr(json_expression(expression, types.get(name, "string"))).alias(name) for name, expression in parse_columns(columns)])


def column_types(spark: SparkSession, table: str, url: str | None = None, options: dict | None = None) -> dict[str, str]:
    """The types of a target's columns, for :func:`table_rows`; none of a table that is not there yet."""
    known = _stored_schema(spark, table, url, options)
    return {} if known is None else {f.name: f.dataType.simpleString() for f in known}


def table_rows(
    df: DataFrame, columns: str | Sequence[str] | None = None, schema: str | T.StructType | None = None, types: dict[str, str] | None = None
) -> DataFrame:
    """K3: the columns of the target table, each from an expression over the payload.

    Paths such as ``address.city`` start at the payload.  A JSON text payload is read by its
    ``schema``; without one, paths reach into it as it is (:func:`json_expression`), and ``types`` says what the values become, such as those
    that :func:`column_types` reads from the target.  Without columns the table gets one column ``payload`` with the payload's text.
    """
    kind = df.schema["payload"].dataType
    if columns is None:
        if isinstance(kind, T.BinaryType):
            return df.select(F.decode("payload", "UTF-8").alias("payload"))
        if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
            return df.select(F.to_json("payload").alias("payload"))
        return df.select(F.col("payload").cast("string").alias("payload"))
    if schema is not None:
        text = F.decode("payload", "UTF-8") if isinstance(kind, T.BinaryType) else F.col("payload")
        df = df.withColumn("payload", F.from_json(text, schema))
    elif isinstance(kind, (T.StringType, T.BinaryType)) or kind.typeName() == "variant":
        return _json_rows(df, columns, types or {})
    opened = df.select("payload", *[c for c in ("headers",) if c in df.columns], "payload.*")
    return opened.select(*[F.expr(expression).alias(name) for name, expression in parse_columns(columns)])


def write_table(
    df: DataFrame,
    table: str,
    url: str | None = None,
    batch_size: int = 1000,
    connections: int | None = None,
    initialize: bool = False,
    options: dict | None = None,
) -> None:
    """K3, K6: append rows to a JDBC table, or to a table of Spark's catalog without ``url``.

    ``initialize`` drops the table and makes it anew with text columns only.
    ``connections`` limits the parallel connections to the database. ``options`` are the writer's own, such as ``path``
    for a catalog table at a place of its own.
    """
    if initialize:
        df = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    if url is None:
        df.write.options(**(options or {})).mode("overwrite" if initialize else "append").saveAsTable(table)
        return
    writer = df.write.format("jdbc").options(url=url, dbtable=table, batchsize=batch_size, **(options or {}))
    if connections:
        writer = writer.option("numPartitions", connections)
    if initialize:
        writer = writer.option("createTableColumnTypes", ", ".join(f"{c} VARCHAR({VARCHAR_LENGTH})" for c in df.columns))
    writer.mode("overwrite" if initialize else "append").save()


# Fixed value: the default batch of a bulk load.
BULK_BATCH = 10_000


def write_bulk(good: DataFrame, errors: DataFrame | None, table: str, error_table: str | None = None, error_schema=None, **target) -> None:
    """K4, K5: load the good rows and keep the bad ones; without an error table they are left out.

    The error table is checked before anything is written.
    """
    target.setdefault("batch_size", BULK_BATCH)
    if error_table is not None and errors is not None:
        check_error_table(error_schema if error_schema is not None else errors.schema)
    write_table(good, table, **target)
    if error_table is not None and errors is not None:
        write_table(errors, error_table, **{k: v for k, v in target.items() if k != "initialize"})


def _stored_schema(spark, table: str, url: str | None, options: dict | None) -> T.StructType | None:
    """The schema of a target; None for a catalog table that the first write will make."""
    if url is not None:
        return spark.read.format("jdbc").options(url=url, dbtable=table, **(options or {})).load().schema
    return spark.table(table).schema if spark.catalog.tableExists(table) else None


def load_lines(
    df: DataFrame,
    table: str,
    columns: Sequence[str] = ("payload",),
    fmt: str = "text",
    error_table: str | None = None,
    initialize: bool = False,
    url: str | None = None,
    batch_size: int = BULK_BATCH,
    connections: int | None = None,
    options: dict | None = None,
    **dialect,
) -> tuple[int, int]:
    """K4 to K6 in one call: load the lines, keep the bad ones, return how many there were of each.

    The input is read and parsed once. With an error table, good and bad rows are first stored side by side in the shared folder, and
    then published from there, the bad ones last; without one, good rows go straight to the table.
    """
    if not table:
        raise ValueError("a table name is required")
    if error_table is not None:
        known = _stored_schema(df.sparkSession, error_table, url, options)
        if known is not None:
            check_error_table(known)
    names = [f"_mr_c{i}" for i in range(len(columns))]
    seen = Observation()
    parsed = parse_lines(df, names, fmt, **dialect)
    bad = F.col("error_message").isNotNull()
    watched = parsed.observe(seen, F.count(F.lit(1)).alias("lines"), F.coalesce(F.sum(bad.cast("long")), F.lit(0)).alias("bad"))
    target = {"url": url, "batch_size": batch_size, "connections": connections, "options": options}
    if error_table is None:
        write_table(good_rows(watched, names, columns), table, initialize=initialize, **target)
        return _counted(seen)
    path = scratch_path(df.sparkSession, "parsed")
    watched.withColumn("_mr_bad", bad).write.partitionBy("_mr_bad").parquet(path)
    counts = _counted(seen)
    stored = df.sparkSession.read.schema(parsed.schema)
    if counts[0]:
        write_table(good_rows(stored.parquet(f"{path}/_mr_bad=false"), names, columns), table, initialize=initialize, **target)
    elif initialize:
        write_table(good_rows(parsed.limit(0), names, columns), table, initialize=True, **target)
    if counts[1]:
        where = {**(options or {}), "path": f"{options['path'].rstrip('/')}_errors"} if url is None and "path" in (options or {}) else options
        write_table(error_rows(stored.parquet(f"{path}/_mr_bad=true"), table), error_table, **target | {"options": where})
    return counts


def _counted(seen: Observation) -> tuple[int, int]:
    counts = seen.get
    return counts["lines"] - counts["bad"], counts["bad"]


def once_per_batch(write: Callable[[DataFrame, int], None], done_path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that skips batches already written.

    After a batch was written its number is stored below ``done_path``.  A crash between
    the two repeats the batch, so a target that cannot replace a batch gets it
    at least once.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{done_path.rstrip('/')}/batch-{batch_id}")
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if files.exists(path):
            return
        write(batch, batch_id)
        files.create(path, True).close()

    return run
