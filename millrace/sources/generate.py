"""Generated messages, and the time spine."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The generator's defaults.
PRODUCERS, MESSAGE_COUNT, MESSAGE_SIZE = 1, 1000, 1000

ROWS_PER_PARTITION = 1_000_000
# A spine is made in runs of this many ticks, so that no array grows with the range.
TICKS_PER_RUN = 10_000


def generate_messages(
    spark: SparkSession,
    producers: int = PRODUCERS,
    count: int = MESSAGE_COUNT,
    size: int = MESSAGE_SIZE,
    ts: bool = False,
) -> DataFrame:
    """``producers`` x ``count`` messages of ``size`` zero bytes, made in parallel.

    A producer gets a partition, or several when it sends many messages.
    """
    partitions = producers * max(1, -(-count // ROWS_PER_PARTITION))
    rows = spark.range(0, producers * count, 1, partitions).select(
        F.floor(F.col("id") / count).alias("producer"),
        (F.col("id") % count).alias("sequence_number"),
        F.repeat(F.lit("\0"), size).cast("binary").alias("payload"),
    )
    return rows.withColumn("ts", F.current_timestamp()) if ts else rows


def fill_payload(start: str | Column, size: int, fill: str = ".") -> Column:
    """A payload of ``size`` characters that begins with the row's own text."""
    return F.rpad(start, size, fill).cast("binary")


def generate_stream(spark: SparkSession, rows_per_batch: int, size: int = MESSAGE_SIZE, producers: int = PRODUCERS) -> DataFrame:
    """S8 as a stream: a fixed number of messages per micro-batch."""
    source = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch).option("numPartitions", producers)
    return source.load().select(
        F.col("timestamp").alias("ts"), F.col("value").alias("sequence_number"),
        F.repeat(F.lit("\0"), size).cast("binary").alias("payload"),
    )


# Fixed value: the text form of the time source.
TICK_FORMAT = "MM/dd/yy HH:mm:ss"


def tick_stream(spark: SparkSession, per_second: int = 1, pattern: str = TICK_FORMAT) -> DataFrame:
    """S8b live: the current time as text, some times a second."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
    return ticks.select(F.col("timestamp").alias("tick"), F.date_format("timestamp", pattern).alias("payload"))


def time_spine(spark: SparkSession, start, end, every: str, keys: DataFrame | None = None) -> DataFrame:
    """One row per interval from ``start`` up to and including ``end``, per row of ``keys``.

    ``start`` and ``end`` are timestamps or text; the tick's text form is the payload.
    """
    bounds = spark.range(1) if keys is None else keys
    names = [] if keys is None else keys.columns
    first, last = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    step = F.expr(f"interval {every}")
    if re.search("month|year|quarter", every, re.IGNORECASE):
        # Few ticks, and months have no fixed length.
        spine = bounds.select(*names, F.explode(F.sequence(first, last, step)).alias("tick"))
    else:
        run = F.expr(f"interval {every} * {TICKS_PER_RUN}")
        runs = bounds.select(*names, F.explode(F.sequence(first, last, run)).alias("_mr_run"))
        until = F.least(last, F.col("_mr_run") + F.expr(f"interval {every} * {TICKS_PER_RUN - 1}"))
        spine = runs.select(*names, F.explode(F.sequence("_mr_run", until, step)).alias("tick"))
    return spine.withColumn("payload", F.date_format("tick", TICK_FORMAT))


def zero_fill(spine: DataFrame, metrics: DataFrame, on: list[str], values: list[str]) -> DataFrame:
    """A value for every interval of the spine: the metric's, or 0 where there is none."""
    joined = spine.join(metrics.select(*on, *values), on, "left")
    return joined.withColumns({v: F.coalesce(F.col(v), F.lit(0)) for v in values})
