"""Counters, gauges, throughput and metric lines."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.expressions import compute_once
from millrace.messages import as_column

MEBIBYTE = 1024.0 * 1024.0


def _label(name: str | Column) -> Column:
    """A meter's name: a literal, or a column for a computed one."""
    return F.lit(name) if isinstance(name, str) else name


def _tagged(df: DataFrame, name, tags, common_tags) -> tuple[DataFrame, list[str], dict[str, Column]]:
    tags = dict(tags or {})
    columns = {f"tag_{t}": as_column(v).cast("string") for t, v in tags.items()}
    return df.withColumns({"name": _label(name), **columns}), ["name", *columns], {t: F.lit(v) for t, v in (common_tags or {}).items()}


def _with_tag_map(df: DataFrame, tags: Mapping | None, common: Mapping[str, Column]) -> DataFrame:
    """The fixed tag columns as one map, built last because a map cannot be a grouping key.

    A meter's own tag wins over a common tag of the same name.
    """
    own = {t: F.col(f"tag_{t}") for t in tags or {}}
    pairs = [c for t, v in {**common, **own}.items() for c in (F.lit(t), v)]
    merged = F.create_map(*pairs) if pairs else F.from_json(F.lit("{}"), "map<string,string>")
    return df.withColumn("tags", merged.cast("map<string,string>")).drop(*[f"tag_{t}" for t in tags or {}])


def counter(
    df: DataFrame,
    name: str | Column,
    tags: Mapping[str, str | Column] | None = None,
    amount: str | Column = "1",
    common_tags: Mapping[str, str] | None = None,
    window: Column | None = None,
) -> DataFrame:
    """A5: the sum of ``amount`` per name and tags: ``name``, ``tags``, ``value``.

    Sums are combined before the shuffle, so a hot meter costs one row per task.
    On a stream use update mode, or pass ``window`` (an event-time window) with a watermark.
    """
    rows, groups, common = _tagged(df.withColumn("_mr_amount", as_column(amount)), name, tags, common_tags)
    by = [F.col(g) for g in groups] + ([window.alias("window")] if window is not None else [])
    return _with_tag_map(rows.groupBy(*by).agg(F.sum("_mr_amount").alias("value")), tags, common)


def gauge(
    df: DataFrame,
    name: str | Column,
    tags: Mapping[str, str | Column] | None,
    value: str | Column,
    order,
    common_tags: Mapping[str, str] | None = None,
) -> DataFrame:
    """The latest value per name and tags, by ``order`` (the last column breaks ties)."""
    order = [order] if isinstance(order, (str, Column)) else list(order or [])
    if not order:
        raise ValueError("a gauge needs an order column")
    latest = as_column(order[0])
    if len(order) > 1:
        latest = F.struct(*[as_column(c).alias(f"o{i}") for i, c in enumerate(order)])
    rows, groups, common = _tagged(
        df.withColumns({"_mr_value": as_column(value), "_mr_at": latest}), name, tags, common_tags
    )
    return _with_tag_map(rows.groupBy(*groups).agg(F.max_by("_mr_value", "_mr_at").alias("value")), tags, common)


def throughput(df: DataFrame, ts: str, every: str, payload: str = "payload", running: bool = True) -> DataFrame:
    """Messages and bytes per interval, and since the start, with rates per second and MB/s.

    Bytes are counted when the payload is binary or text.  ``running=False`` leaves out
    the totals since the start, as needed on a stream.  The totals run over
    the aggregated intervals, first within each day and then over the days.
    """
    kind = df.schema[payload].dataType
    size = F.octet_length(payload) if isinstance(kind, (T.BinaryType, T.StringType)) else F.lit(None)
    intervals = (
        df.groupBy(F.window(F.col(ts), every).alias("w"))
        .agg(F.count(F.lit(1)).alias("messages"), F.sum(size.cast("long")).alias("bytes"))
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "messages", "bytes")
    )
    seconds = F.unix_micros(F.col("end").cast("timestamp")) / 1e6 - F.unix_micros(F.col("start").cast("timestamp")) / 1e6
    out = intervals.withColumn("messages_per_s", F.col("messages") / seconds).withColumn(
        "mb_per_s", F.col("bytes") / F.lit(MEBIBYTE) / seconds
    )
    if not running:
        return out
    # Declared never NULL: an inferred NULL check would set the two sides of the join apart, and Spark
    # would aggregate the messages twice instead of using one shuffle for both.
    out = out.withColumn("_mr_day", F.coalesce(F.to_date("start"), F.lit("1970-01-01").cast("date")))
    # One row per day, so this window without partitions stays small.
    earlier = Window.partitionBy(F.lit(0)).orderBy("_mr_day").rowsBetween(Window.unboundedPreceding, -1)
    days = (
        out.groupBy("_mr_day").agg(F.sum("messages").alias("m"), F.sum("bytes").alias("b"), F.min("start").alias("s"))
        .select(
            "_mr_day", F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("_mr_m"),
            F.coalesce(F.sum("b").over(earlier), F.lit(0)).alias("_mr_b"),
            F.coalesce(F.min("s").over(earlier), F.col("s")).alias("_mr_first"),
        )
    )
    so_far = Window.partitionBy("_mr_day").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    elapsed = F.unix_micros(F.col("end").cast("timestamp")) / 1e6 - F.unix_micros(F.col("_mr_first").cast("timestamp")) / 1e6
    return (
        out.join(days, "_mr_day")
        .withColumn("total_messages", F.col("_mr_m") + F.sum("messages").over(so_far))
        .withColumn("total_bytes", F.col("_mr_b") + F.sum("bytes").over(so_far))
        .withColumn("total_messages_per_s", F.col("total_messages") / elapsed)
        .withColumn("total_mb_per_s", F.col("total_bytes") / F.lit(MEBIBYTE) / elapsed)
        .drop("_mr_day", "_mr_m", "_mr_b", "_mr_first")
    )


def watched(df: DataFrame, observation: Observation | str, payload: str = "payload") -> DataFrame:
    """A7 in flight: the same messages, counted (``messages``, ``bytes``) as they pass.

    The numbers come with the query that reads the frame, at no extra pass: from the
    Observation in batch, from ``observedMetrics`` of the progress on a stream.
    """
    kind = df.schema[payload].dataType
    size = F.octet_length(payload) if isinstance(kind, (T.BinaryType, T.StringType)) else F.lit(None)
    return df.observe(observation, F.count(F.lit(1)).alias("messages"), F.sum(size.cast("long")).alias("bytes"))


def metric_line(
    name: str,
    value: str | Column,
    ts: str | Column,
    source: str,
    tags: Mapping[str, str | Column] | None = None,
) -> Column:
    """``"name" value ts source=S tag="v" …`` with the tags sorted by name; NULL tags are left out."""
    shown = [
        F.concat(F.lit(f'{tag}="'), F.replace(as_column(v).cast("string"), F.lit('"'), F.lit('\\"')), F.lit('"'))
        for tag, v in sorted((tags or {}).items())
    ]
    head = F.concat(F.lit(f'"{name}" '), as_column(value).cast("string"), F.lit(" "), as_column(ts).cast("string"), F.lit(f" source={source}"))
    # concat_ws leaves out NULL tags, concat makes the line NULL without a value or a time.
    return F.concat(head, F.concat_ws("", *[F.concat(F.lit(" "), tag) for tag in shown]))


def metric_lines(df: DataFrame, name, value, ts, source, tags=None) -> DataFrame:
    """K12 as an operator: the payload becomes the metric line; messages without a value are dropped."""
    rows = df
    if not (isinstance(value, str) and value in df.columns):
        # Needed by the filter and by the line; a plain column is filtered in the scan instead.
        rows, value = compute_once(df, "_mr_value", as_column(value)), "_mr_value"
    line = metric_line(name, value, ts, source, tags)
    return rows.filter(as_column(value).isNotNull()).withColumn("payload", line).drop("_mr_value")
