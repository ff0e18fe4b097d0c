"""Query registry: one entry per operator, each with a Spark callable
``(spark, sf_dir) -> DataFrame`` and (where SQL can express it) the
equivalent DuckDB SQL over the driver tables.

Float outputs listed in ``floats`` are rounded to the same number of
decimals on both sides so that summation order does not break the value
comparison.  Before rounding to d decimals, 10^-(d+3) is added on both
sides: averages of decimal data often sit exactly on a half-unit, where the
engines' last-bit differences (and their rounding rules) would otherwise
flip the rounded digit; after the nudge both round the same way, while any
real difference larger than 10^-d still shows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    floats: dict = field(default_factory=dict)

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.fn(spark, sf_dir)
        if self.floats:
            df = df.withColumns({c: F.round(F.col(c).cast("double") + F.lit(10.0 ** -(d + 3)), d)
                                 for c, d in self.floats.items() if c in df.columns})
        return df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        if not self.floats:
            return self.sql
        rep = ", ".join(f"round(CAST(\"{c}\" AS DOUBLE) + {10.0 ** -(d + 3)!r}, {d}) AS \"{c}\""
                        for c, d in self.floats.items())
        return f"SELECT * REPLACE ({rep}) FROM (\n{self.sql}\n) _q"


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, floats=None, dec: int = 6):
    """Register a query.  ``floats``: list of names (``dec`` decimals) or dict."""
    if isinstance(floats, (list, tuple)):
        floats = {c: dec for c in floats}

    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, dict(floats or {}))
        return fn
    return deco


def load_all() -> dict[str, Query]:
    """Import every query module (registration happens at import)."""
    from pansift.plans import q_sources, q_columns, q_joins, q_aggregate, q_profile, q_stats  # noqa: F401
    from pansift.plans import q_timeseries, q_reshape, q_features, q_clean, q_pipelines  # noqa: F401
    return REGISTRY
