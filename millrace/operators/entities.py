"""K7: JSON objects, or lists of them, as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.expressions import compute_once


def json_entities(df: DataFrame, schema: str | T.StructType, payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """(one row per JSON object, the messages that are neither an object nor a list of objects).

    The fields become columns next to the other columns of ``df``; a field of another type
    than declared is NULL.  A list with an element that is no object is bad as a whole.
    """
    row = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = F.col(payload)
    if isinstance(df.schema[payload].dataType, T.BinaryType):
        text = F.decode(text, "UTF-8")
    # With an array schema Spark also accepts a single object, as a list of one.
    items = F.from_json(text, T.ArrayType(row))
    rest = [c for c in df.columns if c != payload]
    parsed = compute_once(df, "_mr_items", items)
    shaped = F.ltrim(text).rlike(r"^[\[{]")
    fine = shaped & F.col("_mr_items").isNotNull() & F.forall("_mr_items", lambda x: x.isNotNull())
    fine = F.coalesce(fine, F.lit(False))
    good = parsed.filter(fine).select(*rest, F.explode("_mr_items").alias("_mr_e"))
    return good.select(*rest, *[F.col("_mr_e")[f.name].alias(f.name) for f in row.fields]), parsed.filter(~fine).drop("_mr_items")
