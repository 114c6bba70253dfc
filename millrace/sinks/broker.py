"""Messages as rows for a broker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.messages import as_column
from millrace.operators.headers import name_list, name_test

# The headers that the token STANDARD stands for.
STANDARD_HEADERS = (
    "amqp_appId", "amqp_clusterId", "amqp_contentEncoding", "amqp_contentLength", "amqp_contentType",
    "amqp_correlationId", "amqp_deliveryMode", "amqp_expiration", "amqp_messageId", "amqp_priority",
    "amqp_replyTo", "amqp_timestamp", "amqp_type", "amqp_userId",
)


def mapped_names(names: str | list[str]) -> list[str]:
    """The names (or patterns) of the headers that pass; ``STANDARD`` may be one of them."""
    return [s for n in name_list(names) for s in (STANDARD_HEADERS if n == "STANDARD" else (n,))]


def to_broker(
    df: DataFrame,
    topic: str | Column,
    key: str | Column | None = None,
    mapped_headers: str | list[str] = "*",
    require_key: bool = False,
    headers_last: bool = False,
) -> DataFrame:
    """Rows ``(topic, key, value, headers)`` as Spark's Kafka writer takes them.

    ``topic`` and ``key`` are expressions (quote literals).  ``require_key`` is for brokers that
    route by key.  The content type is sent as header ``contentType``; a message header
    of that name replaces it only with ``headers_last``.
    """
    if require_key and key is None:
        raise ValueError("a routing key or routing key expression is required")
    mapped = name_test(mapped_names(mapped_headers))
    payload = F.col("payload")
    if not isinstance(df.schema["payload"].dataType, (T.BinaryType, T.StringType)):
        payload = F.to_json(payload) if isinstance(df.schema["payload"].dataType, (T.StructType, T.ArrayType, T.MapType)) else payload.cast("string")
    passed = F.map_filter("headers", lambda k, _: mapped(k))
    own = F.create_map(F.lit("contentType"), F.col("content_type"))
    if headers_last:
        merged = F.map_concat(F.map_filter(own, lambda k, _: ~F.map_contains_key(passed, k)), passed)
    else:
        merged = F.map_concat(F.map_filter(passed, lambda k, _: k != "contentType"), own)
    entries = F.transform(
        F.array_sort(F.map_entries(merged)),
        lambda e: F.struct(e["key"].alias("key"), F.encode(e["value"], "UTF-8").alias("value")),
    )
    return df.select(
        as_column(topic).cast("string").alias("topic"),
        (as_column(key).cast("string") if key is not None else F.lit(None).cast("string")).cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        entries.alias("headers"),
    )


def publish(df: DataFrame, servers: str, checkpoint: str | None = None):
    """Write broker rows with Spark's Kafka connector, which must be on the class path."""
    options = {"kafka.bootstrap.servers": servers, "includeHeaders": "true"}
    if df.isStreaming:
        return df.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint).start()
    df.write.format("kafka").options(**options).save()
    return None
