"""User code on the payload, as a vectorised Python function."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def apply_udf(
    df: DataFrame,
    fn: Callable,
    returns: str,
    variables: Mapping | None = None,
    with_headers: bool = False,
) -> DataFrame:
    """Replace the payload by ``fn(payload, **variables)``, called on Arrow batches.

    ``fn`` takes and returns a pandas Series, plus the Series of headers when
    ``with_headers``.  Use it only for what no SQL expression can say, as the last step:
    it ends whole-stage code generation.
    """
    bound = dict(variables or {})

    if with_headers:
        def call(payload: pd.Series, headers: pd.Series) -> pd.Series:
            return fn(payload, headers, **bound)

        column = F.pandas_udf(call, returns)(F.col("payload"), F.col("headers"))
    else:
        def call(payload: pd.Series) -> pd.Series:
            return fn(payload, **bound)

        column = F.pandas_udf(call, returns)(F.col("payload"))
    return df.withColumn("payload", column)
