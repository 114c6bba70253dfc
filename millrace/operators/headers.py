"""Adding and removing headers."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import with_variables
from millrace.messages import HEADERS_TYPE, as_column, header_map


def parse_assignments(text: str) -> dict[str, str]:
    """Newline-separated ``name=expression`` lines."""
    pairs = (line.split("=", 1) for line in text.splitlines() if line.strip())
    return {name.strip(): expression.strip() for name, expression in pairs}


def enrich_headers(
    df: DataFrame,
    headers: str | Mapping[str, str | Column],
    overwrite: bool = False,
    variables: Mapping | None = None,
) -> DataFrame:
    """Add headers computed from the message.

    An existing header keeps its value unless ``overwrite``.  An expression that
    yields NULL adds no header.
    """
    wanted = parse_assignments(headers) if isinstance(headers, str) else dict(headers)

    def add(d: DataFrame) -> DataFrame:
        # Columns of their own, so that each expression runs once per message.
        values = {f"_mr_h{i}": as_column(v).cast("string") for i, v in enumerate(wanted.values())}
        d = d.withColumns(values)
        old = F.coalesce(F.col("headers"), header_map({}))
        named = list(zip(wanted, values))
        if overwrite:
            replaced = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.lit(n)) for n, c in named]))
            kept = F.map_filter(old, lambda k, _: ~F.array_contains(replaced, k))
            new = [F.when(F.col(c).isNotNull(), F.create_map(F.lit(n), F.col(c))) for n, c in named]
        else:
            # No lambda here: conditional one-entry maps stay inside generated code.
            kept = old
            new = [
                F.when(F.col(c).isNotNull() & ~F.map_contains_key(old, n), F.create_map(F.lit(n), F.col(c)))
                for n, c in named
            ]
        added = [F.coalesce(m, header_map({})) for m in new]
        return d.withColumn("headers", F.map_concat(kept, *added).cast(HEADERS_TYPE)).drop(*values)

    return with_variables(df, variables, add)


def name_list(names: str | list[str]) -> list[str]:
    """Names separated by commas or white space."""
    return [n for n in (re.split(r"[,\s]+", names) if isinstance(names, str) else names) if n]


def name_test(names: str | list[str]) -> Callable[[Column], Column]:
    """A test for header names: equal to one of the names, in which ``*`` stands for any text."""
    listed = name_list(names)
    if "*" in listed:
        return lambda k: F.lit(True)
    exact = [n for n in listed if "*" not in n]
    patterns = [".*".join(re.escape(piece) for piece in n.split("*")) for n in listed if "*" in n]
    if not patterns:
        return lambda k: k.isin(exact)
    return lambda k: k.isin(exact) | k.rlike("^(" + "|".join(patterns) + ")$")


def filter_headers(df: DataFrame, remove: str | list[str] = "", delete_all: bool = False) -> DataFrame:
    """Drop the named headers, or all of them; content type, id and time are columns and stay."""
    if delete_all:
        return df.withColumn("headers", header_map({}))
    named = name_test(remove)
    return df.withColumn("headers", F.map_filter("headers", lambda k, _: ~named(k)))
