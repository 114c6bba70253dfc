"""A1, A2, A4 in batch: groups of messages released by count or by content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.messages import as_column
from millrace.operators.numbering import mark_rows, number_rows
from millrace.operators.split import PART_ROWS


def aggregate(
    df: DataFrame,
    key: str | Sequence[str],
    order,
    release_size: int | None = None,
    release_expr: str | Column | None = None,
    payload: str | Column = "payload",
    send_partial: bool = False,
    part_rows: int = PART_ROWS,
    hot_rows: int | None = None,
) -> DataFrame:
    """Lists of payloads per key, in the given arrival order.

    ``release_size`` closes a group with its n-th message; ``release_expr`` closes it
    with the first message for which the expression holds, that message included; with both,
    whichever comes first does.
    A group is forgotten once released, the next message starts a new one.
    ``send_partial`` also emits the open group at the end of each key.

    Columns: the key, ``group_no`` (from 0), ``part``, ``size``, ``closed``, ``payloads``.
    A group released by content has no size limit; beyond ``part_rows`` messages it
    continues in the next ``part``, so that every list is bounded.

    On a stream this is :func:`millrace.streaming.aggregate.aggregate_stream` without
    idle time: open groups stay in state, so there ``send_partial`` is an error.
    """
    if release_size is None and release_expr is None:
        raise ValueError("give release_size, release_expr or both")
    if release_size is not None and release_size < 1:
        raise ValueError("release_size must be positive")
    if df.isStreaming:
        if send_partial:
            raise ValueError("a stream has no end: use aggregate_stream with timeout_ms, or open_groups after it stopped")
        from millrace.streaming.aggregate import aggregate_stream

        return aggregate_stream(df, key, order, release_size, release_expr, payload, part_rows=part_rows)
    keys = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, (str, Column)) else list(order or [])
    closes = as_column(release_expr) if release_expr is not None else F.lit(False)
    narrow = df.withColumns({"_mr_item": as_column(payload), "_mr_closes": closes})
    if all(isinstance(o, str) for o in order):
        # Hot keys are stored on the way, so nothing else should go along.
        narrow = narrow.select(*dict.fromkeys([*keys, *order, "_mr_item", "_mr_closes"]))
    if release_size is not None and release_expr is None:
        rows = number_rows(narrow, keys, order, "rn", hot_rows)
        rows = rows.withColumn("group_no", F.expr(f"(rn - 1) div {release_size}"))
        rows = rows.withColumn("_mr_seq", (F.col("rn") - 1) % release_size + 1)
        grouped = _collect(rows, keys, part_rows, F.lit(None).cast("boolean"))
        if release_size <= part_rows:
            grouped = grouped.withColumn("closed", F.col("size") == release_size)
        else:
            sizes = grouped.groupBy(*keys, "group_no").agg((F.sum("size") == release_size).alias("closed"))
            grouped = _join_null_safe(grouped.drop("closed"), sizes, [*keys, "group_no"])
    else:
        rows = mark_rows(narrow, keys, order, F.col("_mr_closes"), hot_rows)
        if release_size is not None:
            # Within a stretch that ends by content, every n-th message closes a group too.
            full = (F.col("rn") - F.col("last_mark")) % release_size == 0
            again = rows.withColumn("_mr_closes", F.coalesce("_mr_closes", F.lit(False)) | full).select(*narrow.columns)
            rows = mark_rows(again, keys, order, F.col("_mr_closes"), hot_rows)
        rows = rows.withColumn("group_no", F.col("marks_before")).withColumn("_mr_seq", F.col("rn") - F.col("last_mark"))
        if not send_partial:
            rows = rows.filter("marks_before < marks")
        grouped = _collect(rows, keys, part_rows, F.col("marks_before") < F.col("marks"))
    if not send_partial:
        grouped = grouped.filter("closed")
    return grouped.select(*keys, "group_no", "part", "size", "closed", "payloads")


def group_rows(
    df: DataFrame,
    key: str | Sequence[str],
    order,
    release_size: int | None = None,
    release_expr: str | Column | None = None,
    payload: str | Column = "payload",
    begun: DataFrame | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """A1, A2 as rows: (key…, ``group_no``, ``seq`` from 1, ``closed``, ``payload``), a row per message, so a group may be of any size.

    :func:`aggregate` makes lists of them. ``begun`` says what there was before these messages: a row per key with ``open``, how many messages its
    open group has, and ``released``, how many groups it has let go; keys without a row start anew.
    """
    if release_size is None and release_expr is None:
        raise ValueError("give release_size, release_expr or both")
    keys = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, (str, Column)) else list(order or [])
    narrow = df.withColumns({"_mr_item": as_column(payload), "_mr_closes": F.coalesce(as_column(release_expr) if release_expr is not None else F.lit(False), F.lit(False))})
    if all(isinstance(o, str) for o in order):
        narrow = narrow.select(*dict.fromkeys([*keys, *order, "_mr_item", "_mr_closes"]))
    if begun is None:
        narrow = narrow.withColumns({"_mr_open": F.lit(0).cast("long"), "_mr_released": F.lit(0).cast("long")})
    else:
        gid = F.struct(*keys)
        known = begun.select(gid.alias("_mr_gid"), F.col("open").alias("_mr_open"), F.col("released").alias("_mr_released"))
        narrow = narrow.withColumn("_mr_gid", gid).join(known, "_mr_gid", "left").drop("_mr_gid").fillna(0, ["_mr_open", "_mr_released"])
    if release_expr is None:
        rows = number_rows(narrow, keys, order, "rn", hot_rows, total="_mr_in_key")
        place = F.col("_mr_open") + F.col("rn")
        group, seq = F.expr(f"(_mr_open + rn - 1) div {release_size}"), (place - 1) % release_size + 1
        closed = group < F.expr(f"(_mr_open + _mr_in_key) div {release_size}")
    else:
        begins = F.when(F.col("marks_before") == 0, F.col("_mr_open")).otherwise(0) + F.col("rn") - F.col("last_mark")
        rows = mark_rows(narrow, keys, order, F.col("_mr_closes"), hot_rows)
        if release_size is not None:
            # Within a stretch that ends by content, every n-th message closes a group too.
            again = rows.withColumn("_mr_closes", F.col("_mr_closes") | (begins % release_size == 0)).select(*narrow.columns)
            rows = mark_rows(again, keys, order, F.col("_mr_closes"), hot_rows)
        group, seq, closed = F.col("marks_before"), begins, F.col("marks_before") < F.col("marks")
    return rows.select(*keys, (F.col("_mr_released") + group).alias("group_no"), seq.alias("seq"), closed.alias("closed"), F.col("_mr_item").alias("payload"))


def collect_groups(rows: DataFrame, keys: Sequence[str], part_rows: int = PART_ROWS) -> DataFrame:
    """Lists of what :func:`group_rows` gives: the key, ``group_no``, ``part``, ``size``, ``closed``, ``payloads``, as :func:`aggregate` has them."""
    named = rows.withColumnsRenamed({"seq": "_mr_seq", "payload": "_mr_item"})
    return _collect(named, list(keys), part_rows, F.col("closed")).select(*keys, "group_no", "part", "size", "closed", "payloads")


def _collect(rows: DataFrame, keys: list[str], part_rows: int, closed: Column) -> DataFrame:
    rows = rows.select(
        *keys, "group_no", F.expr(f"(_mr_seq - 1) div {part_rows}").alias("part"), closed.alias("closed"),
        F.struct("_mr_seq", "_mr_item").alias("_mr_pair"),
    )
    return (
        rows.groupBy(*keys, "group_no", "part")
        .agg(_in_order(F.collect_list("_mr_pair"), rows.schema["_mr_pair"].dataType["_mr_item"].dataType).alias("_mr_pairs"), F.max("closed").alias("closed"))
        .withColumn("size", F.size("_mr_pairs"))
        .withColumn("payloads", F.transform("_mr_pairs", lambda p: p["_mr_item"]))
        .drop("_mr_pairs")
    )


def _in_order(pairs: Column, kind: T.DataType) -> Column:
    """Pairs by their number.  Maps and variants cannot be compared, so there only the numbers are."""
    if "map<" in kind.simpleString() or "variant" in kind.simpleString():
        return F.array_sort(pairs, lambda a, b: F.when(a["_mr_seq"] < b["_mr_seq"], -1).when(a["_mr_seq"] > b["_mr_seq"], 1).otherwise(0))
    return F.sort_array(pairs)


def _join_null_safe(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    gid = F.struct(*on).alias("_mr_gid")
    return left.withColumn("_mr_gid", gid).join(right.select(gid, *[c for c in right.columns if c not in on]), "_mr_gid").drop("_mr_gid")
