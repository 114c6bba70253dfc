"""Change events of a database table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.expressions import compute_once

SOURCE_SCHEMA = (
    "version string, connector string, name string, ts_ms bigint, ts_us bigint, ts_ns bigint, snapshot string, "
    "db string, table string, server_id bigint, gtid string, file string, pos bigint, row int, thread bigint, query string"
)
TOMBSTONE = "tombstone"


def envelope_schema(row_schema: str | T.StructType) -> T.StructType:
    row = T.StructType.fromDDL(row_schema) if isinstance(row_schema, str) else row_schema
    return T.StructType([
        T.StructField("before", row),
        T.StructField("after", row),
        T.StructField("source", T.StructType.fromDDL(SOURCE_SCHEMA)),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("ts_us", T.LongType()),
        T.StructField("ts_ns", T.LongType()),
    ])


def _is_tombstone(payload: Column) -> Column:
    return payload.isNull() | (payload == "null")


def read_changes(df: DataFrame, row_schema: str | T.StructType) -> DataFrame:
    """Envelopes as a struct column ``change`` and an ``op`` (``tombstone`` for NULL payloads).

    Schema-change events carry neither row nor op; their ``op`` is NULL.
    """
    payload = F.col("payload")
    if isinstance(df.schema["payload"].dataType, T.BinaryType):
        payload = F.decode(payload, "UTF-8")
    return compute_once(df, "change", F.from_json(payload, envelope_schema(row_schema))).withColumn(
        "op", F.when(_is_tombstone(payload), TOMBSTONE).otherwise(F.col("change.op"))
    )


def unparsed_changes(df: DataFrame) -> DataFrame:
    """The events that :func:`unwrap_changes` cannot read, as they came, with an ``error_message``.

    Row changes, schema changes and tombstones are none of them.
    """
    payload = F.col("payload")
    if isinstance(df.schema["payload"].dataType, T.BinaryType):
        payload = F.decode(payload, "UTF-8")
    parsed = compute_once(df, "_mr_event", F.try_parse_json(payload))
    op, ddl = (F.try_variant_get("_mr_event", f"$.{name}", "string") for name in ("op", "ddl"))
    error = F.when(F.col("_mr_event").isNull(), "payload is not JSON").when(op.isNull() & ddl.isNull(), "neither a row change nor a schema change")
    return parsed.withColumn("error_message", F.when(~F.coalesce(_is_tombstone(payload), F.lit(True)), error)).filter("error_message is not null").drop("_mr_event")


def _added(field: str) -> Column:
    """A metadata field: ``op`` and the event times from the envelope, others from its source."""
    if field.startswith("source."):
        return F.col(f"change.{field}")
    return F.col(f"change.{field}" if field in ("op", "ts_ms", "ts_us", "ts_ns") else f"change.source.{field}")


def unwrap_changes(
    df: DataFrame,
    row_schema: str | T.StructType,
    add_fields: Sequence[str] = (),
    delete_mode: str = "drop",
    drop_tombstones: bool = True,
) -> DataFrame:
    """The changed row as columns, with the asked metadata as ``__name`` columns and ``op``.

    Inserts, updates and snapshot reads give the new row.  A delete gives, by mode,
    a row of NULLs (``none``), nothing (``drop``), or the old row with ``__deleted`` = "true"
    (``rewrite``, where every other row says "false").  A tombstone gives a row of NULLs
    unless dropped.  Headers, with the key of the row, stay.  Events that are not row
    changes are left out; :func:`unparsed_changes` has those that cannot be read.
    """
    if delete_mode not in ("none", "drop", "rewrite"):
        raise ValueError(f"unknown delete mode {delete_mode!r}")
    row = T.StructType.fromDDL(row_schema) if isinstance(row_schema, str) else row_schema
    rest = [c for c in df.columns if c != "payload"]
    events = read_changes(df, row).filter(F.col("op").isNotNull())
    if drop_tombstones:
        events = events.filter(F.col("op") != TOMBSTONE)
    if delete_mode == "drop":
        events = events.filter(F.col("op") != "d")
    new = F.col("change.after")
    if delete_mode == "rewrite":
        new = F.when(F.col("op") == "d", F.col("change.before")).otherwise(new)
    out = [new[f.name].alias(f.name) for f in row.fields]
    hidden = F.col("op") == TOMBSTONE
    if delete_mode == "none":
        hidden = hidden | (F.col("op") == "d")
    if delete_mode == "rewrite":
        out.append(F.when(~hidden, (F.col("op") == "d").cast("string")).alias("__deleted"))
    out += [F.when(~hidden, _added(f)).alias("__" + f.replace(".", "_")) for f in add_fields]
    return events.select(*rest, *out, "op")


def row_json(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The unwrapped row as JSON text in ``payload``; NULL for deletes in mode none and tombstones, which ``op`` tells."""
    body = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    empty = F.forall(F.array(*[F.col(c).isNull() for c in columns]), lambda x: x)
    if "op" in df.columns:
        # An inserted row of NULLs is a row all the same.
        empty = empty & F.coalesce(F.col("op").isin("d", TOMBSTONE), F.lit(False))
    return df.withColumn("payload", F.when(~empty, body))
