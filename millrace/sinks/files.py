"""Messages written to files, by name or by destination."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.messages import as_column

UNROUTABLE = "_unroutable"


def text_rows(df: DataFrame, name: str | Column | None = None, suffix: str = "") -> DataFrame:
    """The payload as text in ``value``, and the target file's name in ``file_key`` when one is given."""
    payload = F.col("payload")
    if isinstance(df.schema["payload"].dataType, T.BinaryType):
        payload = F.decode(payload, "UTF-8")
    elif isinstance(df.schema["payload"].dataType, (T.ArrayType, T.MapType, T.StructType)):
        payload = F.to_json(payload)
    value = payload.cast("string").alias("value")
    if name is None:
        return df.select(value)
    key = F.concat(as_column(name).cast("string"), F.lit(f".{suffix}" if suffix else ""))
    return df.select(value, key.alias("file_key"))


def write_text(
    df: DataFrame,
    path: str,
    name: str | Column | None = None,
    suffix: str = "",
    replace: bool = False,
    compact: bool = False,
    checkpoint: str | None = None,
):
    """K1, K2: one line per message below ``path`` (any Hadoop path, such as ``s3a://``).

    With a ``name`` expression, e.g. ``headers['file_name']``, each name is a directory
    ``file_key=<name>.<suffix>`` of part files.  ``compact`` rebalances rows by name first,
    for fewer files; Spark splits a name that is too large for one task.
    A stream needs a ``checkpoint`` and returns its query.
    """
    rows = text_rows(df, name, suffix)
    if df.isStreaming:
        writer = rows.writeStream.format("text").option("checkpointLocation", checkpoint).trigger(availableNow=True)
        return (writer.partitionBy("file_key") if name is not None else writer).start(path)
    if name is not None and compact:
        rows = rows.hint("rebalance", "file_key")
    writer = rows.write.mode("overwrite" if replace else "append")
    (writer.partitionBy("file_key") if name is not None else writer).text(path)
    return None


def write_routed(df: DataFrame, path: str, fmt: str = "parquet", compact: bool = False, mode: str = "append") -> None:
    """All destinations in one pass, one directory ``destination=<name>`` each.

    Messages without a destination are kept below ``destination=_unroutable``.
    """
    rows = df.withColumn("destination", F.coalesce(F.nullif("destination", F.lit("")), F.lit(UNROUTABLE)))
    if compact:
        rows = rows.hint("rebalance", "destination")
    rows.write.mode(mode).partitionBy("destination").format(fmt).save(path)
