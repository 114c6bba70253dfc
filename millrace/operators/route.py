"""The destination of each message."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import with_variables
from millrace.messages import as_column
from millrace.operators.headers import parse_assignments


def route(
    df: DataFrame,
    expression: str | Column = "headers['routeTo']",
    mappings: str | Mapping[str, str] | None = None,
    default: str | None = None,
    allowed: Sequence[str] | None = None,
    required: bool = False,
    declared: Sequence[str] = (),
    on_error: str = "fail",
    variables: Mapping | None = None,
) -> DataFrame:
    """Add ``destination``, computed from a routing key.

    A mapped key goes to its mapped name.  Otherwise: with ``required``, to the declared
    destination of that name or into an error; without it, to the default if there is
    one, else to the key itself.  ``allowed`` lists the only destinations that may be used;
    others go to the default.  With such a list and no mappings, a key names its destination.  A NULL key goes to the default.  An array of keys sends
    the message to each.

    Messages with no destination: ``on_error="fail"`` stops a query that requires resolution;
    ``"keep"`` leaves ``destination`` NULL and gives the reason in ``route_error``.
    """
    if on_error not in ("fail", "keep"):
        raise ValueError(f"unknown value {on_error!r} for on_error")
    if allowed is not None and default is not None and default not in allowed:
        raise ValueError("the default destination must be in the allowed list")
    table = parse_assignments(mappings) if isinstance(mappings, str) else dict(mappings or {})

    def add(d: DataFrame) -> DataFrame:
        key = as_column(expression)
        kind = d.select(key.alias("k")).schema["k"].dataType.typeName()
        d = d.withColumn("_mr_key", F.explode_outer(key) if kind == "array" else key)
        name = F.col("_mr_key").cast("string")
        if kind == "boolean":
            name = F.lower(name)
        mapped = _lookup(table, name)
        fallback = F.lit(default).cast("string")
        if required:
            own = F.when(name.isin(list(declared)), name) if declared else F.lit(None).cast("string")
            found = F.coalesce(mapped, own)
        elif default is not None and (table or allowed is None):
            found = F.coalesce(mapped, fallback)
        else:
            found = F.coalesce(mapped, name)
        if allowed is not None:
            found = F.when(found.isin(list(allowed)), found).otherwise(fallback)
        problem = F.when(name.isNull(), "no routing key").otherwise(F.concat(F.lit("no destination for key "), name))
        if required and on_error == "fail":
            found = F.coalesce(found, F.raise_error(problem).cast("string"))
        d = d.withColumn("destination", found)
        if on_error == "keep":
            d = d.withColumn("route_error", F.when(F.col("destination").isNull(), problem))
        return d.drop("_mr_key")

    return with_variables(df, variables, add)


def _lookup(table: Mapping[str, str], key: Column) -> Column:
    if not table:
        return F.lit(None).cast("string")
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), key)
