"""The message envelope: payload, headers, content type, and the decoders for it.

A message is one row.  ``payload`` may have any type, ``headers`` is a
``MAP<STRING,STRING>`` and ``content_type`` a string; other columns ride along.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.expressions import compute_once

DEFAULT_CONTENT_TYPE = "application/octet-stream"
# Content types whose bytes are text.
TEXT_TYPES = r"(?i)^\s*(text/.*|application/(.*\+)?json)\s*(;.*)?$"
JSON_TYPES = r"(?i)^\s*application/(.*\+)?json\s*(;.*)?$"

HEADERS_TYPE = "map<string,string>"


def as_column(value: str | Column) -> Column:
    """Strings are Spark SQL expressions."""
    return F.expr(value) if isinstance(value, str) else value


def header_map(headers: Mapping[str, str | Column]) -> Column:
    if not headers:
        return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    pairs = [c for name, value in headers.items() for c in (F.lit(name), as_column(value).cast("string"))]
    return F.create_map(*pairs)


def to_messages(
    df: DataFrame,
    payload: str | Column,
    headers: Mapping[str, str | Column] | None = None,
    content_type: str | Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Wrap rows in the envelope; ``content_type`` is a column or a literal type name."""
    kind = F.lit(content_type) if isinstance(content_type, str) else content_type
    return df.select(
        *keep,
        as_column(payload).alias("payload"),
        header_map(headers or {}).alias("headers"),
        (kind if kind is not None else F.lit(DEFAULT_CONTENT_TYPE)).alias("content_type"),
    )


def decode_text(df: DataFrame, out: str = "text") -> DataFrame:
    """Bytes become text when the content type says text or JSON; otherwise NULL."""
    payload = F.col("payload")
    if isinstance(df.schema["payload"].dataType, T.BinaryType):
        payload = F.decode(payload, "UTF-8")
    return df.withColumn(out, F.when(F.col("content_type").rlike(TEXT_TYPES), payload))


def decode_json(df: DataFrame, schema: T.StructType | str | None = None, out: str = "data") -> DataFrame:
    """JSON payloads parsed into ``out``; the payload itself stays as it was.

    With a schema the result is that struct, without one a VARIANT.  ``out`` is NULL
    where the content type is not JSON or the text does not parse.
    """
    text = F.col("payload")
    if isinstance(df.schema["payload"].dataType, T.BinaryType):
        text = F.decode(text, "UTF-8")
    is_json = F.col("content_type").rlike(JSON_TYPES)
    if schema is None:
        return compute_once(df, out, F.when(is_json, F.try_parse_json(text)))
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    checked = T.StructType(schema.fields + [T.StructField("_mr_bad", T.StringType())])
    parsed = F.from_json(text, checked, {"columnNameOfCorruptRecord": "_mr_bad"})
    fields = F.struct(*[F.col("_mr_json")[f.name].alias(f.name) for f in schema.fields])
    good = F.col("_mr_json").isNotNull() & F.col("_mr_json")["_mr_bad"].isNull()
    return compute_once(df, "_mr_json", F.when(is_json, parsed)).withColumn(out, F.when(good, fields)).drop("_mr_json")


def normalise_content_type(df: DataFrame, default: str = DEFAULT_CONTENT_TYPE) -> DataFrame:
    """``originalContentType`` wins over the content type; a missing type gets the default."""
    return df.withColumn(
        "content_type",
        F.coalesce(F.col("headers")["originalContentType"], F.col("content_type"), F.lit(default)),
    )
