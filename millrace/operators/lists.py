"""K9: list payloads appended, element by element, to named lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.messages import as_column
from millrace.operators.numbering import number_rows, order_columns
from millrace.session import stage
from millrace.sinks.versions import COMPACT_EVERY, OpenTable, write_batch


def push_list(
    df: DataFrame,
    key: str | Column,
    order,
    payload: str | Column = "payload",
    current: DataFrame | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Rows ``(key, seq, value)``, ``seq`` going on after the highest one in ``current``.

    A payload that is not a list is one element.  Read a list back by ``ORDER BY seq``.
    """
    item = as_column(payload)
    if df.select(item.alias("p")).schema["p"].dataType.typeName() != "array":
        item = F.array(item)
    orders = order_columns(order)
    names = [f"_mr_o{i}" for i in range(len(orders))]
    pushed = df.select(
        as_column(key).cast("string").alias("key"),
        *[o.alias(n) for o, n in zip(orders, names)],
        F.posexplode(item).alias("_mr_pos", "value"),
    )
    rows = number_rows(pushed, ["key"], [*names, "_mr_pos"], "seq", hot_rows).select("key", "seq", "value")
    if current is None:
        return rows
    return _after(rows, current.groupBy("key").agg(F.max("seq").alias("top")))


def _after(rows: DataFrame, tops: DataFrame) -> DataFrame:
    tops = tops.select(F.col("key").alias("_mr_key"), F.col("top").alias("_mr_top"))
    moved = rows.join(tops, F.col("key").eqNullSafe(F.col("_mr_key")), "left")
    return moved.withColumn("seq", F.col("seq") + F.coalesce("_mr_top", F.lit(0))).drop("_mr_key", "_mr_top")


def push_batches(
    out: str, store: str, key: str | Column, order, payload: str | Column = "payload", hot_rows: int | None = None, compact_every: int = COMPACT_EVERY
) -> Callable[[DataFrame, int], None]:
    """K9: a ``foreachBatch`` function that appends to the lists below ``out`` (``key, seq, value``, and the ``batch`` that pushed it).

    How long each list is stands below ``store``, with the batch that made it so: stored lists are never read, and a batch that is
    pushed again replaces what it pushed before. Batches come in turn, numbered from 0.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = stage(push_list(batch, key, order, payload, hot_rows=hot_rows), "pushed")
        table = OpenTable(batch.sparkSession, store, T.StructType([rows.schema["key"]]), "top bigint")
        known = stage(table.counters(batch_id).select("key", "top"), "tops")
        write_batch(_after(rows, known), out, batch_id)
        pushed = _after(rows.groupBy("key").agg(F.max("seq").alias("seq")), known)
        table.write(batch_id, counters=pushed.select("key", F.col("seq").alias("top"), F.lit(batch_id).cast("long").alias("since")))
        if (batch_id + 1) % compact_every == 0:
            table.compact(batch_id)

    return run
