"""Operators chained into one Spark plan."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame

Operator = Callable[[DataFrame], DataFrame]


def compose(*operators: Operator) -> Operator:
    """One operator that applies the given ones in turn; Catalyst sees a single plan."""
    return lambda df: reduce(lambda d, op: d.transform(op), operators, df)


def definition_names(definition: str) -> list[str]:
    """Names in ``a|b|c``; a comma also separates, quotes around the whole are ignored."""
    return [n.strip() for n in definition.strip("'\" ").replace(",", "|").split("|") if n.strip()]


def channel_name(definition: str) -> str:
    """The base name of the composed function's input and output."""
    return "".join(definition_names(definition))


def compose_named(definition: str, registry: Mapping[str, Operator]) -> Operator:
    names = definition_names(definition)
    unknown = [n for n in names if n not in registry]
    if unknown or not names:
        raise ValueError(f"unknown functions {unknown} in {definition!r}")
    return compose(*(registry[n] for n in names))
