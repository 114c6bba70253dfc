"""Helpers of this package: picking columns, joining groups of any size, stored narrow tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A group with more than ``rows / HOT_GROUPS`` rows is hot, so there are fewer than HOT_GROUPS of them.
HOT_GROUPS = 1_000


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores added the first name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def column(df: DataFrame, name: str) -> Column:
    """The column of that very name, whatever characters are in it."""
    return df[f"`{name.replace('`', '``')}`"]


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone; a NULL text is empty. Other columns, whatever their names, are left out."""
    return df.select(column(df, id_col).alias("doc_id"), F.coalesce(column(df, text_col).cast("string"), F.lit("")).alias("text"))


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int, how: str = "left") -> DataFrame:
    """Left (or inner) join of ``rows`` with ``groups`` (one row per key), where a key may hold a large share of the rows.

    ``size`` is the column of ``groups`` that counts the rows of its key, ``total`` the number of all rows.
    Keys with more than ``total / HOT_GROUPS`` rows number less than ``HOT_GROUPS``; those few are broadcast. The
    others are joined by shuffle, where no key holds more than that share.
    """
    limit = max(1_000, total // HOT_GROUPS)
    values = [c for c in groups.columns if c not in keys]
    hot = groups.filter(F.col(size) > limit).select(*keys, F.struct(*values).alias("_hot"))
    cold = groups.filter(F.col(size) <= limit).select(*keys, F.struct(*values).alias("_cold"))
    others = [c for c in rows.columns if c not in keys]
    if how == "inner":
        rest = rows.join(cold, keys).select(*keys, *others, F.col("_cold").alias("_of"))
        both = rows.join(F.broadcast(hot), keys).select(*keys, *others, F.col("_hot").alias("_of")).unionByName(rest)
        return both.select(*rows.columns, *(F.col("_of")[v].alias(v) for v in values))
    marked = rows.join(F.broadcast(hot), keys, "left")
    found = marked.filter("_hot is not null").select(*keys, *others, F.col("_hot").alias("_of"))
    rest = marked.filter("_hot is null").drop("_hot").join(cold, keys, "left").select(*keys, *others, F.col("_cold").alias("_of"))
    return found.unionByName(rest).select(*rows.columns, *(F.col("_of")[v].alias(v) for v in values))
