"""The list of queries, and how they read the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.messages import to_messages

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON messages: the properties are the payload, type and user the headers."""
    return to_messages(
        table(spark, sf_dir, "events"),
        payload="encode(props, 'UTF-8')",
        headers={"type": "event_type", "user": "user_id"},
        content_type="application/json",
        keep=("event_id", "ts", "value"),
    )


def text_of(headers: str | Column) -> Column:
    """A header map as text, names in order, to compare it across engines."""
    pairs = F.array_sort(F.map_entries(headers))
    return F.array_join(F.transform(pairs, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
