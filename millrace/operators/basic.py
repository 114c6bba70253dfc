"""The one-row-in, one-row-out operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import with_variables
from millrace.messages import as_column


def bridge(df: DataFrame) -> DataFrame:
    """The messages as they are."""
    return df


def filter_messages(df: DataFrame, condition: str | Column, variables: Mapping | None = None) -> DataFrame:
    """Keep the messages for which the condition is true; NULL drops."""
    return with_variables(df, variables, lambda d: d.filter(as_column(condition)))


def transform_payload(df: DataFrame, expression: str | Column, variables: Mapping | None = None) -> DataFrame:
    """P5: replace the payload, leave the headers."""
    return with_variables(df, variables, lambda d: d.withColumn("payload", as_column(expression)))


def to_request_json(
    name: str | Column,
    args: Column | Sequence[str | Column] = (),
    props: Mapping[str, str | Column] | None = None,
) -> Column:
    """A task-launch request as JSON text with keys args, deploymentProps, name."""
    if not isinstance(args, Column):
        args = F.array(*[as_column(a).cast("string") for a in args]).cast("array<string>")
    pairs = [c for k, v in (props or {}).items() for c in (F.lit(k), as_column(v).cast("string"))]
    settings = F.create_map(*pairs) if pairs else F.from_json(F.lit("{}"), "map<string,string>")
    return F.to_json(F.struct(args.alias("args"), settings.alias("deploymentProps"), as_column(name).alias("name")))
