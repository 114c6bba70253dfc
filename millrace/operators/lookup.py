"""Enrichment of each message from a table of responses."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.messages import as_column


def with_request(
    df: DataFrame,
    url: str | Column,
    method: str | Column = "'GET'",
    body: str | Column | None = None,
    headers: str | Column | None = None,
) -> DataFrame:
    """Per message, the request it stands for: ``request`` struct of url, method, body, headers."""
    return df.withColumn(
        "request",
        F.struct(
            as_column(url).alias("url"),
            as_column(method).alias("method"),
            (as_column(body) if body is not None else F.lit(None).cast("string")).alias("body"),
            (as_column(headers) if headers is not None else F.lit(None).cast("map<string,string>")).alias("headers"),
        ),
    )


def enrich_lookup(
    df: DataFrame,
    ref: DataFrame,
    on: Mapping[str, str | Column],
    reply: str | Column,
    out: str = "payload",
    repeated: str = "error",
) -> DataFrame:
    """Left join: ``on`` maps a key column of ``ref`` to an expression over the message.

    ``reply`` is an expression over the columns of ``ref`` (its "response"); unmatched
    messages get NULL.  ``ref`` holds one row per key: a key that it holds twice ends the job with an error, or, with
    ``repeated="all"``, gives a message per answer.  No broadcast is forced: Spark
    broadcasts ``ref`` when its measured size is below the session's threshold and
    otherwise shuffles both sides, where adaptive execution splits hot keys.
    """
    keys = {name: f"_mr_key{i}" for i, name in enumerate(on)}
    asked = df.withColumns({keys[name]: as_column(expression) for name, expression in on.items()})
    answers = ref.select(*[F.col(name).alias(keys[name]) for name in on], as_column(reply).alias("_mr_reply"))
    if repeated not in ("error", "all"):
        raise ValueError(f"unknown value {repeated!r} for repeated")
    if repeated == "error":
        told = answers.dropna(subset=list(keys.values())).groupBy(*keys.values()).agg(F.any_value("_mr_reply").alias("_mr_reply"), F.count(F.lit(1)).alias("_mr_n"))
        twice = F.raise_error(F.concat_ws(" ", F.lit("several answers for the key"), *[F.col(k).cast("string") for k in keys.values()]))
        answers = told.select(*keys.values(), F.when(F.col("_mr_n") > 1, twice).otherwise(F.col("_mr_reply")).alias("_mr_reply"))
    joined = asked.join(answers, list(keys.values()), "left").drop(*keys.values())
    return joined.withColumn(out, F.col("_mr_reply")).drop("_mr_reply")
