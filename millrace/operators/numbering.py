"""Positions of rows within a key, exact also when one key holds most of the rows.

A plain ``row_number()`` window puts a whole key into one task.  Keys that are too large
for that are therefore found by a sketch and taken out, range-partitioned by (key, order), so that
one key spans many partitions, and numbered per partition; a small table of
per-partition totals then turns local positions into global ones.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import stage

# A key is hot when it exceeds a core's fair share of the rows, within these bounds.
MIN_HOT_ROWS, HOT_ROWS = 250_000, 2_000_000
# The threshold is raised to total / MAX_HOT_KEYS, so no more keys than this can be hot; a sketch of SKETCH_ITEMS counters, whose error is below
# half of that, cannot miss one.
MAX_HOT_KEYS = 4_000
SKETCH_ITEMS = 1 << 15
# Beyond this many range partitions the shuffle's own bookkeeping costs more than larger partitions do.
MAX_SLICES = 20_000

_GID, _ROW, _PART, _LOW = "_mr_gid", "_mr_row", "_mr_part", "_mr_low"
_OFFSET, _MARK, _PAST, _LAST, _TOTAL = "_mr_off", "_mr_mark", "_mr_past", "_mr_last", "_mr_total"


def order_columns(order) -> list[Column]:
    """The order as columns; an operator whose result depends on arrival must be given one."""
    if order is None or (not isinstance(order, (str, Column)) and not len(order)):
        raise ValueError("an order column with a unique tie-break is required")
    if isinstance(order, (str, Column)):
        order = [order]
    return [F.col(c) if isinstance(c, str) else c for c in order]


def number_rows(
    df: DataFrame, keys: Sequence[str], order, out: str = "rn", hot_rows: int | None = None, total: str | None = None
) -> DataFrame:
    """Add ``out`` = 1, 2, … per key in the given order; no keys numbers the whole frame.

    ``hot_rows`` overrides how many rows make a key hot. ``total`` names a column for the number of rows of the key.
    """
    order = order_columns(order)
    keys = list(keys)
    if not keys:
        rows = df.count()
        return number_spread(df, keys, order, _slices(rows, hot_rows or _fair_share(df, rows)), out, total)
    cold, hot, slices = _by_heat(df, keys, hot_rows)
    numbered = number_in_task(cold, keys, order, out, total)
    if hot is None:
        return numbered
    return numbered.unionByName(number_spread(hot, keys, order, slices, out, total))


def number_in_task(df: DataFrame, keys: list[str], order: list[Column], out: str, total: str | None = None) -> DataFrame:
    """Positions by one window; only for keys known to be small enough for a task."""
    by_key = Window.partitionBy(*keys)
    numbered = df.withColumn(out, F.row_number().over(by_key.orderBy(*order)).cast("long"))
    return numbered if total is None else numbered.withColumn(total, F.count(F.lit(1)).over(by_key))


def mark_rows(
    df: DataFrame, keys: Sequence[str], order, mark: Column, hot_rows: int | None = None
) -> DataFrame:
    """Add what a running scan over each key knows about the rows where ``mark`` holds.

    ``rn`` position in the key, ``marks_before`` marked rows strictly before,
    ``last_mark`` position of the latest of them (0 if none), ``marks`` all in the key.
    """
    order = order_columns(order)
    keys = list(keys)
    df = df.withColumn(_MARK, F.coalesce(mark, F.lit(False)).cast("long"))
    cold, hot, slices = _by_heat(df, keys, hot_rows)
    by_key = Window.partitionBy(*keys)
    ordered = by_key.orderBy(*order)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    marked = (
        cold.withColumn("rn", F.row_number().over(ordered).cast("long"))
        .withColumn("marks_before", F.coalesce(F.sum(_MARK).over(before), F.lit(0)))
        .withColumn("last_mark", F.coalesce(F.max(F.when(F.col(_MARK) == 1, F.col("rn"))).over(before), F.lit(0)))
        .withColumn("marks", F.sum(_MARK).over(by_key))
    ).drop(_MARK)
    if hot is None:
        return marked
    return marked.unionByName(_spread_marks(hot, keys, order, slices))


def _slices(rows: int, limit: int) -> int:
    """Range partitions of about half the limit each."""
    return max(1, math.ceil(2 * rows / max(1, limit)))


def _fair_share(df: DataFrame, total: int) -> int:
    share = math.ceil(total / df.sparkSession.sparkContext.defaultParallelism)
    return min(HOT_ROWS, max(MIN_HOT_ROWS, share))


def _by_heat(df: DataFrame, keys: list[str], hot_rows: int | None):
    """Split into (rows of ordinary keys, rows of hot keys or None, slices for the hot rows).

    One pass over the keys alone, with a map side of bounded size, finds keys that may be hot; a key too many does no harm. Both halves
    are filters by a list of at most ``MAX_HOT_KEYS`` numbers, so no row is shuffled or joined for it.
    """
    hashed = df.select(_key_hash(df, keys).alias("_mr_h"))
    top = F.expr(f"approx_top_k(_mr_h, {MAX_HOT_KEYS}, {SKETCH_ITEMS})")
    found = hashed.agg(F.count(F.lit(1)).alias("total"), top.alias("top")).first()
    limit = max(hot_rows or _fair_share(df, found.total), math.ceil(found.total / MAX_HOT_KEYS))
    hot_keys = {r["item"]: r["count"] for r in found.top or () if r["count"] > limit}
    if not hot_keys:
        return df, None, 0
    is_hot = _key_hash(df, keys).isin(list(hot_keys))
    return df.filter(~is_hot), df.filter(is_hot), _slices(min(found.total, sum(hot_keys.values())), limit)


def _key_hash(df: DataFrame, keys: list[str]) -> Column:
    """Equal for equal keys: zeros of either sign are one number to a grouping."""
    plain = [F.col(k) + F.lit(0.0).cast(df.schema[k].dataType) if isinstance(df.schema[k].dataType, (T.DoubleType, T.FloatType)) else F.col(k) for k in keys]
    return F.xxhash64(*plain)


def _lay_out(df: DataFrame, keys: list[str], order: list[Column], slices: int) -> DataFrame:
    """Range-partition by (key, order) and store the rows with their ids in that layout."""
    by = [F.col(k) for k in keys] + order
    laid = (
        df.repartitionByRange(min(slices, MAX_SLICES), *by)
        .sortWithinPartitions(*by)
        .withColumn(_ROW, F.monotonically_increasing_id())
    )
    # The upper 31 bits of the id are the partition number.
    return (
        stage(laid, "numbered")
        .withColumn(_PART, F.shiftright(F.col(_ROW), 33))
        .withColumn(_GID, F.struct(*(keys or [F.lit(0).alias("all")])))
    )


def number_spread(df: DataFrame, keys: list[str], order: list[Column], slices: int, out: str, total: str | None = None) -> DataFrame:
    """Positions over ``slices`` range partitions, whatever the sizes of the keys."""
    rows = _lay_out(df, keys, order, slices)
    by_key = Window.partitionBy(_GID)
    earlier = by_key.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    # Ranges are contiguous, so there are at most slices + hot keys rows here.
    parts = (
        rows.groupBy(_GID, _PART)
        .agg(F.count(F.lit(1)).alias("_mr_n"), F.min(_ROW).alias(_LOW))
        .select(_GID, _PART, _LOW, F.coalesce(F.sum("_mr_n").over(earlier), F.lit(0)).alias(_OFFSET), F.sum("_mr_n").over(by_key).alias(_TOTAL))
    )
    numbered = rows.join(F.broadcast(parts), [_GID, _PART]).withColumn(out, F.col(_OFFSET) + F.col(_ROW) - F.col(_LOW) + 1)
    if total is not None:
        numbered = numbered.withColumn(total, F.col(_TOTAL))
    return numbered.drop(_GID, _PART, _LOW, _OFFSET, _ROW, _TOTAL)


def _spread_marks(df: DataFrame, keys, order, slices: int) -> DataFrame:
    rows = _lay_out(df, keys, order, slices)
    by_key = Window.partitionBy(_GID)
    earlier = by_key.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        rows.groupBy(_GID, _PART)
        .agg(
            F.count(F.lit(1)).alias("_mr_n"),
            F.min(_ROW).alias(_LOW),
            F.sum(_MARK).alias("_mr_m"),
            F.max(F.when(F.col(_MARK) == 1, F.col(_ROW))).alias("_mr_top"),
        )
        .withColumn(_OFFSET, F.coalesce(F.sum("_mr_n").over(earlier), F.lit(0)))
        .withColumn("_mr_top", F.col(_OFFSET) + F.col("_mr_top") - F.col(_LOW) + 1)
        .select(
            _GID, _PART, _LOW, _OFFSET,
            F.coalesce(F.sum("_mr_m").over(earlier), F.lit(0)).alias(_PAST),
            F.coalesce(F.max("_mr_top").over(earlier), F.lit(0)).alias(_LAST),
            F.sum("_mr_m").over(by_key).alias(_TOTAL),
        )
    )
    before = Window.partitionBy(_GID, _PART).orderBy(_ROW).rowsBetween(Window.unboundedPreceding, -1)
    position = F.col(_OFFSET) + F.col(_ROW) - F.col(_LOW) + 1
    return (
        rows.join(F.broadcast(parts), [_GID, _PART])
        .withColumn("rn", position)
        .withColumn("marks_before", F.col(_PAST) + F.coalesce(F.sum(_MARK).over(before), F.lit(0)))
        .withColumn("last_mark", F.greatest(F.col(_LAST), F.coalesce(F.max(F.when(F.col(_MARK) == 1, F.col("rn"))).over(before), F.lit(0))))
        .withColumn("marks", F.col(_TOTAL))
        .drop(_GID, _PART, _LOW, _OFFSET, _ROW, _MARK, _PAST, _LAST, _TOTAL)
    )
