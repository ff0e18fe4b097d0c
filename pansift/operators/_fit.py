"""Fit helpers: one aggregate over all requested columns -> one small Row.

Fitted values are applied as literals (Spark ML estimator style), so a
transform never needs a join with the statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_row(df: DataFrame, exprs: dict) -> dict:
    """Run one aggregate with named expressions; return a plain dict.

    The result is one row whose width is bounded by the number of
    expressions, never by the data.  Very wide requests are chunked to
    stay inside codegen limits.
    """
    if not exprs:
        return {}
    items = list(exprs.items())
    out: dict = {}
    chunk = 200
    for i in range(0, len(items), chunk):
        part = items[i:i + chunk]
        row = df.agg(*[e.alias(k) for k, e in part]).first()
        out.update(row.asDict(recursive=True))
    return out

