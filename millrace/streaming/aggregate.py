"""A1 to A4 on streams: groups kept in state until they are released."""

from __future__ import annotations

import itertools
import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.messages import as_column
from millrace.operators.split import PART_ROWS

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _tuples(pdf: pd.DataFrame, *columns: str) -> Iterator[tuple]:
    """The rows of a frame, which has few rows for most keys, without making another frame."""
    return zip(*(pdf[c].tolist() for c in columns))


class GroupProcessor(StatefulProcessor):
    """Collects the messages of one key and emits lists whenever a group closes.

    Open messages are appended to state and read back only when their group closes, so a
    group that stays open for long costs no more per micro-batch than its new messages.
    """

    def __init__(self, keys: list[str], size: int | None, timeout_ms: int | None, send_partial: bool, part_rows: int):
        self.keys = keys
        self.size = size
        self.timeout_ms = timeout_ms
        self.send_partial = send_partial
        self.part_rows = part_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", "open bigint, released bigint")
        self.open = handle.getListState("open", "pos bigint, item string")

    def _arrived(self, rows) -> list:
        """The micro-batch's messages of the key as (order, item, closes, …), in order."""
        arrived = [r for pdf in rows for r in _tuples(pdf, "ord", "item", "closes")]
        return sorted(arrived, key=lambda r: r[0])

    def _state(self) -> tuple[int, int]:
        """How many messages are open, and how many groups were released."""
        return self.counts.get() or (0, 0)

    def _items(self, count: int, fresh: list) -> Iterator[str]:
        """The messages of the open group, those in state first."""
        if count > len(fresh):
            for row in self.open.get():
                yield row[1]
        yield from (item for _, item in fresh)

    def _rows(self, group_no: int, items, closed: bool) -> Iterator[tuple]:
        """One group as rows of at most ``part_rows`` messages."""
        items = iter(items)
        for part in itertools.count():
            payloads = list(itertools.islice(items, self.part_rows))
            if not payloads:
                return
            yield group_no, part, len(payloads), closed, payloads

    def _frames(self, key, rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        """Rows gathered into frames; each holds about ``part_rows`` messages."""
        held, messages = [], 0
        for row in rows:
            held.append(row)
            messages += row[2]
            if messages >= self.part_rows:
                yield self._frame(key, held)
                held, messages = [], 0
        if held:
            yield self._frame(key, held)

    def _frame(self, key, rows: list[tuple]) -> pd.DataFrame:
        names = ["group_no", "part", "size", "closed", "payloads"]
        columns = {name: [value] * len(rows) for name, value in zip(self.keys, key)}
        return pd.DataFrame(columns | dict(zip(names, map(list, zip(*rows)))))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self._frames(key, self._take(self._arrived(rows)))
        self._restart_timer(timerValues)

    def _take(self, arrived: list) -> Iterator[tuple]:
        count, released = self._state()
        fresh: list = []
        for _, item, closes in arrived:
            count += 1
            fresh.append((count, item))
            if closes or count == self.size:
                yield from self._rows(released, self._items(count, fresh), True)
                if count > len(fresh):
                    self.open.clear()
                fresh, count, released = [], 0, released + 1
        if fresh:
            self.open.appendList(fresh)
        self.counts.update((count, released))

    def _restart_timer(self, timerValues) -> None:
        if self.timeout_ms is None:
            return
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if self._state()[0]:
            self.handle.registerTimer(self._now(timerValues) + self.timeout_ms)

    def _now(self, timerValues) -> int:
        return timerValues.getCurrentProcessingTimeInMs()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        count, released = self._state()
        if count and self.send_partial:
            yield from self._frames(key, self._rows(released, self._items(count, []), False))
            released += 1
        self.open.clear()
        self.counts.update((0, released))

    def close(self) -> None:
        pass


class EventTimeGroupProcessor(GroupProcessor):
    """The same with idle times measured in event time.

    A group is idle once more than the idle time lies between its latest message and the next one of the key, or the watermark.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.latest = handle.getValueState("latest", "at bigint")

    def _arrived(self, rows) -> list:
        arrived = [r for pdf in rows for r in _tuples(pdf, "ord", "item", "closes", "at")]
        return sorted(arrived, key=lambda r: r[0])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self._frames(key, self._take(self._arrived(rows)))

    def _take(self, arrived: list) -> Iterator[tuple]:
        # State is read once and written once: nearly every message may end an idle group, and those that begin and end here need no state.
        count, released = self._state()
        latest = before = self.latest.get()[0] if count else None
        stored, fresh = count > 0, []
        for _, item, closes, at in arrived:
            if count and at - latest > self.timeout_ms:
                if self.send_partial:
                    yield from self._rows(released, self._items(count, fresh), False)
                    released += 1
                stored, fresh, count = self._emptied(stored), [], 0
            # Only the messages of the open group count for its idle time.
            latest = max(latest, at) if count else at
            count += 1
            fresh.append((count, item))
            if closes or count == self.size:
                yield from self._rows(released, self._items(count, fresh), True)
                stored, fresh, count, released = self._emptied(stored), [], 0, released + 1
        if fresh:
            self.open.appendList(fresh)
        self.counts.update((count, released))
        self._move_timer(before, int(latest) if count else None)

    def _emptied(self, stored: bool) -> bool:
        if stored:
            self.open.clear()
        return False

    def _move_timer(self, before: int | None, latest: int | None) -> None:
        """The latest message of the open group, and its timer; an open group has one timer, set by that message."""
        if latest == before:
            return
        if before is not None:
            self.handle.deleteTimer(before + self.timeout_ms)
        if latest is None:
            self.latest.clear()
        else:
            self.latest.update((latest,))
            self.handle.registerTimer(latest + self.timeout_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from super().handleExpiredTimer(key, timerValues, expiredTimerInfo)
        self.latest.clear()


class SequenceProcessor(GroupProcessor):
    """Collects numbered messages; the group closes when 1..size are all there."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", "open bigint, released bigint")
        self.open = handle.getMapState("open", "seq bigint", "item string")

    def _arrived(self, rows) -> list:
        return [r for pdf in rows for r in _tuples(pdf, "seq", "item", "expected")]

    def _items(self, count, fresh) -> Iterator[str]:
        held = dict(fresh)
        if count > len(held):
            held |= {k[0]: v[0] for k, v in self.open.iterator()}
        yield from (held[seq] for seq in sorted(held))

    def _take(self, arrived: list) -> Iterator[tuple]:
        count, released = self._state()
        fresh: dict = {}
        stored = count > 0
        for seq, item, expected in arrived:
            if seq in fresh or (stored and self.open.containsKey((seq,))):
                continue
            fresh[seq] = item
            count += 1
            if count == expected:
                yield from self._rows(released, self._items(count, fresh), True)
                if stored:
                    self.open.clear()
                fresh, stored, count, released = {}, False, 0, released + 1
        for seq, item in fresh.items():
            self.open.updateValue((seq,), (item,))
        self.counts.update((count, released))


OUTPUT = "group_no bigint, part int, size int, closed boolean, payloads array<string>"


def _group_stream(df, keys, columns, processor, time_mode) -> DataFrame:
    spark = df.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != STATE_PROVIDER:
        raise ValueError(f"set spark.sql.streaming.stateStore.providerClass to {STATE_PROVIDER}")
    # The process that sets the processor up does not see files sent to the workers, so the classes travel with the plan.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    schema = T.StructType([df.schema[k] for k in keys] + T.StructType.fromDDL(OUTPUT).fields)
    return (
        df.select(*columns).groupBy(*keys)
        .transformWithStateInPandas(processor, schema, outputMode="append", timeMode=time_mode)
    )


def _sortable(order) -> Column:
    """The order columns as one text that sorts like them."""
    if order is None or (not isinstance(order, (str, Column)) and not len(order)):
        raise ValueError("an order column with a unique tie-break is required")
    parts = [order] if isinstance(order, (str, Column)) else list(order)
    return F.concat_ws("\x1f", *[as_column(p) for p in parts])


def order_text(df: DataFrame, column: str) -> Column:
    """A column as text whose order is the column's own, NULL first."""
    text = _order_text(df, column)
    return F.when(F.col(column).isNull(), "0").otherwise(F.concat(F.lit("1"), text))


def _order_text(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.date_format(column, "yyyyMMddHHmmssSSSSSS")
    if isinstance(kind, (T.TimestampType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        # Shifted by 2^63, so that negative numbers come first.  Instants count in UTC, where no hour comes twice.
        number = F.unix_micros(column) if isinstance(kind, T.TimestampType) else F.col(column)
        return F.lpad((number.cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")).cast("decimal(20,0)").cast("string"), 20, "0")
    if isinstance(kind, T.StringType):
        return F.col(column)
    raise ValueError(f"cannot order a stream by {column} of type {kind.simpleString()}")


def aggregate_stream(
    df: DataFrame,
    key: str | Sequence[str],
    order: str | Sequence[str],
    release_size: int | None = None,
    release_expr: str | Column | None = None,
    payload: str | Column = "payload",
    timeout_ms: int | None = None,
    send_partial: bool = False,
    event_time: bool = False,
    part_rows: int = PART_ROWS,
    salts: int = 1,
) -> DataFrame:
    """A1, A2, A4 on a stream: the counterpart of the batch ``aggregate``.

    Messages of a key are taken in ``order`` within a micro-batch and micro-batches in
    turn.  An open group stays in state; after ``timeout_ms`` without a message it is
    forgotten, and emitted first with ``send_partial``.  Idle time is processing time, or with
    ``event_time`` the time between the group's latest message and the key's next one or the watermark.

    All messages of a key are handled by one task.  Where order across the whole key does
    not matter, ``salts`` spreads each key over so many groups of its own, told apart
    by the column ``salt``.
    """
    if release_size is None and release_expr is None:
        raise ValueError("give release_size, release_expr or both")
    keys = [key] if isinstance(key, str) else list(key)
    names = [order] if isinstance(order, str) else list(order or [])
    ordered = _sortable([order_text(df, n) for n in names])
    if salts > 1 and names:
        df = df.withColumn("salt", F.pmod(F.xxhash64(*names), F.lit(salts)))
        keys = [*keys, "salt"]
    columns = [
        *keys,
        _as_text(df, as_column(payload)).alias("item"),
        F.coalesce(as_column(release_expr) if release_expr is not None else F.lit(False), F.lit(False)).alias("closes"),
        ordered.alias("ord"),
    ]
    kind = EventTimeGroupProcessor if event_time else GroupProcessor
    processor = kind(keys, release_size, timeout_ms, send_partial, part_rows)
    mode = "none" if timeout_ms is None else ("eventTime" if event_time else "processingTime")
    if event_time:
        columns += [_watermark_column(df), F.unix_millis(F.col(_watermark_column(df)).cast("timestamp")).alias("at")]
    item = df.select(as_column(payload).alias("p")).schema["p"].dataType
    return _group_stream(df, keys, columns, processor, mode).withColumn("payloads", F.transform("payloads", lambda t: _from_text(t, item)))


def reassemble_stream(
    df: DataFrame,
    correlation: str = "correlation_id",
    seq: str = "sequence_number",
    size: str = "sequence_size",
    payload: str = "payload",
    timeout_ms: int | None = None,
    send_partial: bool = False,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """A3 on a stream: a group is emitted when all its sequence numbers have arrived."""
    item = df.schema[payload].dataType
    columns = [
        correlation, F.col(seq).cast("long").alias("seq"), _as_text(df, F.col(payload)).alias("item"),
        F.col(size).cast("long").alias("expected"),
    ]
    processor = SequenceProcessor([correlation], None, timeout_ms, send_partial, part_rows)
    numbered = df.filter(F.col(seq).between(F.lit(1), F.col(size)))
    groups = _group_stream(numbered, [correlation], columns, processor, "none" if timeout_ms is None else "processingTime")
    return groups.withColumn("payloads", F.transform("payloads", lambda t: _from_text(t, item)))


def _as_text(df: DataFrame, payload: Column) -> Column:
    """A payload as the text that state holds; :func:`_from_text` gives it back with its type."""
    kind = df.select(payload.alias("p")).schema["p"].dataType
    if isinstance(kind, T.BinaryType):
        return F.base64(payload)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return payload.cast("timestamp_ntz").cast("string") if isinstance(kind, T.TimestampNTZType) else F.unix_micros(payload).cast("string")
    if isinstance(kind, (T.MapType, T.StructType, T.ArrayType)) or kind.typeName() == "variant":
        return F.to_json(payload, {"ignoreNullFields": "false"})
    return payload.cast("string")


def _from_text(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BinaryType):
        return F.unbase64(text)
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(text.cast("bigint"))
    if kind.typeName() == "variant":
        return F.parse_json(text)
    if isinstance(kind, (T.MapType, T.StructType, T.ArrayType)):
        return F.from_json(text, kind)
    return text.cast(kind)


def open_groups(spark: SparkSession, checkpoint: str, part_rows: int = PART_ROWS, payload_type: str = "string") -> DataFrame:
    """A4 at shutdown: the groups that a stopped stream still holds open, read from its checkpoint.

    The same columns as the stream's own output, ``closed`` being false; ``payload_type`` is the type of its payloads.
    """
    kind = T.StructType.fromDDL(f"p {payload_type}")["p"].dataType

    def state(name):
        return spark.read.format("statestore").option("stateVarName", name).load(checkpoint)

    held = state("open")
    if "list_element" in held.columns:
        held = held.select("key", F.col("list_element.pos").alias("pos"), F.col("list_element.item").alias("item"))
    else:
        held = held.select("key", F.col("user_map_key.seq").alias("pos"), F.col("user_map_value.item").alias("item"))
    parts = (
        held.groupBy("key", F.expr(f"cast((pos - 1) div {part_rows} as int)").alias("part"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "item"))).alias("items"))
    )
    numbers = state("counts").select("key", F.col("value.released").alias("group_no"))
    return parts.join(numbers, "key").select(
        "key.*", "group_no", "part", F.size("items").alias("size"), F.lit(False).alias("closed"),
        F.transform("items", lambda x: _from_text(x["item"], kind)).alias("payloads"),
    )


def _watermark_column(df: DataFrame) -> str:
    for field in df.schema.fields:
        if "spark.watermarkDelayMs" in field.metadata:
            return field.name
    raise ValueError("event time needs a watermark on the stream")
