"""Expressions over a message, with named variables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_variables(df: DataFrame, variables: Mapping | None, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Make variables visible to ``build`` as constant columns, and take them away again.

    Catalyst folds the constants into the expressions that use them.
    """
    variables = dict(variables or {})
    taken = set(variables) & set(df.columns)
    if taken:
        raise ValueError(f"variables hide columns: {sorted(taken)}")
    if not variables:
        return build(df)
    bound = df.withColumns({name: F.lit(value) for name, value in variables.items()})
    return build(bound).drop(*variables)


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add an expensive column that is evaluated once per row.

    Spark moves filters below the projection that makes a column, and copies its expression
    there: text parsed for the filter is parsed again for the result.  The output of a
    generator is not copied, and filters on other columns still pass it.
    """
    rest = [c for c in df.columns if c != name]
    return df.select(*rest, F.explode(F.array(value)).alias(name))


def load_variables(inline: Mapping[str, str] | None = None, lines=None) -> dict[str, str]:
    """Variables given inline merged with ``name=value`` lines of a file; the file wins."""
    merged = dict(inline or {})
    for line in lines or ():
        line = line.strip()
        if not line or line[0] in "#!":
            continue
        name, _, value = line.partition("=")
        merged[name.strip()] = value.lstrip()
    return merged


def json_path(payload: str | Column, path: str) -> Column:
    """The value at a JSON path, as text."""
    return F.get_json_object(payload, path)


def is_object(variant: Column) -> Column:
    """Is a VARIANT payload a JSON object?"""
    return F.schema_of_variant(variant).startswith("OBJECT")
