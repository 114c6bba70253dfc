"""A1 to A4 on streams, grouped by the batch operators: a micro-batch is a table like any other.

Between micro-batches a versioned table holds, per key, two counters and the messages of the open group. A key may have any share of a
micro-batch: its messages are numbered in ranges over many tasks, and no task holds a whole key or group. A micro-batch writes only what it
adds; a message is read back once, when its group closes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.messages import as_column
from millrace.operators.aggregate import collect_groups, group_rows
from millrace.operators.split import PART_ROWS, bit_words, reassemble, whole_groups
from millrace.session import stage
from millrace.sinks.versions import COMPACT_EVERY, OpenTable, write_batch

def aggregate_batches(
    out: str,
    store: str,
    key: str | Sequence[str],
    order,
    release_size: int | None = None,
    release_expr: str | Column | None = None,
    payload: str | Column = "payload",
    part_rows: int = PART_ROWS,
    hot_rows: int | None = None,
    compact_every: int = COMPACT_EVERY,
) -> Callable[[DataFrame, int], None]:
    """A1, A2: a ``foreachBatch`` function that writes released groups below ``out`` and keeps open ones below ``store``.

    Like :func:`millrace.streaming.aggregate.aggregate_stream` without idle times, with the columns of the batch ``aggregate``: messages are taken in ``order``
    within a micro-batch and micro-batches in turn. Each group comes out once, also when a micro-batch runs again.
    :func:`open_rows` reads what is still open.
    """
    keys = [key] if isinstance(key, str) else list(key)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        orders = [order] if isinstance(order, (str, Column)) else list(order or [])
        closes = as_column(release_expr) if release_expr is not None else F.lit(False)
        named = {f"_mr_o{i}": as_column(o) for i, o in enumerate(orders)}
        # The batch is read from its source once.
        arrived = stage(batch.select(*keys, as_column(payload).alias("payload"), F.coalesce(closes, F.lit(False)).alias("_mr_ends"), *(c.alias(n) for n, c in named.items())), "arrived")
        row = T.StructType([T.StructField("seq", T.LongType()), arrived.schema["payload"]])
        table = OpenTable(spark, store, T.StructType([arrived.schema[k] for k in keys]), "open bigint, released bigint", tail=row)
        gid = F.struct(*keys).alias("_mr_gid")
        touched = arrived.groupBy(*keys).agg(F.count(F.lit(1)).alias("arrived"))
        known = table.counters(batch_id).select(gid, "open", "released", "since")
        begun = touched.select(*keys, "arrived", gid).join(known, "_mr_gid", "left").drop("_mr_gid").fillna({"open": 0, "released": 0, "since": batch_id})
        begun = stage(begun, "begun")
        rows = stage(group_rows(arrived, keys, list(named), release_size, None if release_expr is None else F.col("_mr_ends"), "payload", begun, hot_rows), "grouped")
        last = rows.groupBy(*keys).agg((F.max(F.when(F.col("closed"), F.col("group_no"))) + 1).alias("_mr_next"), F.max(F.when(~F.col("closed"), F.col("seq"))).alias("_mr_left"))
        after = stage(begun.select("*", gid).join(last.select(gid, "_mr_next", "_mr_left"), "_mr_gid").drop("_mr_gid"), "ended")
        # What was open before belongs to the first group that now closes.
        closing = after.filter("_mr_next is not null and open > 0")
        held = table.live("tail", batch_id, closing).select("*", gid).join(closing.select(gid, F.col("released").alias("group_no")), "_mr_gid")
        full = rows.filter("closed").unionByName(held.select(*keys, "group_no", "seq", F.lit(True).alias("closed"), "payload"))
        write_batch(collect_groups(full, keys, part_rows), out, batch_id)
        table.write(
            batch_id, tail=rows.filter("not closed"),
            counters=after.select(
                *keys, F.when(F.col("_mr_next").isNull(), F.coalesce("_mr_left", "open")).otherwise(F.coalesce("_mr_left", F.lit(0))).alias("open"),
                F.coalesce("_mr_next", "released").alias("released"), F.when(F.col("_mr_next").isNull(), F.col("since")).otherwise(batch_id).cast("long").alias("since")))
        if (batch_id + 1) % compact_every == 0:
            table.compact(batch_id)

    return run


def reassemble_batches(
    out: str,
    store: str,
    correlation: str = "correlation_id",
    seq: str = "sequence_number",
    size: str = "sequence_size",
    payload: str = "payload",
    part_rows: int = PART_ROWS,
    compact_every: int = COMPACT_EVERY,
) -> Callable[[DataFrame, int], None]:
    """A3: a ``foreachBatch`` function that writes whole groups below ``out``, with the columns of the batch ``reassemble``, and keeps the rest below ``store``.

    Which numbers have arrived is kept as bitmaps, 64 numbers a row. Payloads are appended, and read back only for groups that
    the bitmaps say are whole. A number that comes again after its group was written begins another group.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        arrived = stage(batch.select(
            F.col(correlation).alias("correlation"), F.col(seq).cast("long").alias("seq"), F.col(size).cast("long").alias("size"), F.col(payload).alias("payload"),
        ).filter("seq between 1 and size and correlation is not null"), "arrived")
        table = OpenTable(
            spark, store, arrived.select("correlation").schema, "",
            tail=T.StructType(arrived.schema.fields[1:]), marks=T.StructType.fromDDL("word bigint, bits bigint, size bigint"))
        touched = arrived.select("correlation").distinct()
        known = table.counters(batch_id)
        begun = stage(touched.join(known, "correlation", "left").fillna({"since": batch_id}), "begun")
        new = stage(bit_words(arrived), "marks")
        marks = new.unionByName(table.live("marks", batch_id, begun))
        whole = stage(whole_groups(marks), "whole")
        held = table.live("tail", batch_id, begun.join(whole, "correlation", "left_semi"))
        full = arrived.unionByName(held).join(whole.select("correlation"), "correlation", "left_semi")
        write_batch(reassemble(full, "correlation", "seq", "size", "payload", part_rows), out, batch_id)
        done = begun.join(whole.select("correlation", F.lit(1).alias("_mr_done")), "correlation", "left")
        table.write(
            batch_id, tail=arrived.join(whole, "correlation", "left_anti"), marks=new.join(whole, "correlation", "left_anti"),
            counters=done.select(
                "correlation", F.when(F.col("_mr_done").isNull(), F.col("since")).otherwise(batch_id + 1).cast("long").alias("since")))
        if (batch_id + 1) % compact_every == 0:
            table.compact(batch_id, "marks")

    return run


def open_rows(spark: SparkSession, store: str, keys: Sequence[str]) -> DataFrame:
    """A4 at shutdown: the messages that :func:`aggregate_batches` still holds, as rows (key…, ``group_no``, ``seq``, ``closed``, ``payload``).

    :func:`millrace.operators.aggregate.collect_groups` makes lists of them, like those of the stream's own output.
    """
    tail = spark.read.parquet(f"{store.rstrip('/')}/tail/*").schema
    kinds = T.StructType([tail[k] for k in keys]), T.StructType([tail["seq"], tail["payload"]])
    table = OpenTable(spark, store, kinds[0], "open bigint, released bigint", tail=kinds[1])
    last = 1 << 62
    counters = table.counters(last)
    gid = F.struct(*keys).alias("_mr_gid")
    return table.live("tail", last, counters).select("*", gid).join(counters.select(gid, F.col("released").alias("group_no")), "_mr_gid").select(
        *keys, "group_no", "seq", F.lit(False).alias("closed"), "payload")
