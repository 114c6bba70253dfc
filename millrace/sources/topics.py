"""Topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.messages import DEFAULT_CONTENT_TYPE

# The schema of Spark's Kafka reader with headers included.
TOPIC_SCHEMA = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, "
    "timestampType int, headers array<struct<key:string,value:binary>>"
)


def topic_options(servers: str, topics: str | list[str], group: str | None = None, reset: str = "latest") -> dict[str, str]:
    """Reader options: topic names (or a ``*`` pattern), consumer group, offset reset."""
    if reset not in ("earliest", "latest"):
        raise ValueError(f"unknown offset reset {reset!r}")
    names = topics if isinstance(topics, str) else ",".join(topics)
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribePattern" if "*" in names else "subscribe": names,
        "startingOffsets": reset,
        "includeHeaders": "true",
    }
    if group:
        options["kafka.group.id"] = group
    return options


def topic_messages(df: DataFrame) -> DataFrame:
    """Rows of :data:`TOPIC_SCHEMA` as messages; a repeated header keeps its last value."""
    pairs = F.coalesce(F.col("headers"), F.array().cast("array<struct<key:string,value:binary>>"))
    last = F.filter(
        pairs, lambda h, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda later: later["key"] == h["key"])
    )
    headers = F.map_from_entries(F.transform(last, lambda h: F.struct(h["key"], F.decode(h["value"], "UTF-8"))))
    return df.withColumn("headers", headers).select(
        F.col("value").alias("payload"),
        "headers",
        F.coalesce(F.col("headers")["contentType"], F.lit(DEFAULT_CONTENT_TYPE)).alias("content_type"),
        F.decode("key", "UTF-8").alias("key"),
        "topic",
        F.concat_ws("-", "topic", "partition", "offset").alias("msg_id"),
        F.col("timestamp").alias("ts"),
    )


def read_topic(spark: SparkSession, servers: str, topics, group=None, reset="latest", stream: bool = True) -> DataFrame:
    """Needs Spark's Kafka connector on the class path."""
    options = topic_options(servers, topics, group, reset)
    reader = spark.readStream if stream else spark.read
    if not stream:
        options["startingOffsets"] = "earliest"
    return topic_messages(reader.format("kafka").options(**options).load())
