"""Set operations and reshaping (blueprint 2.7)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pansift.functions.numeric import finite_or_null


def union_sources(dfs: Mapping[str, DataFrame] | Sequence[DataFrame], tag: str | None = "source") -> DataFrame:
    """Stack sources by column name; missing columns become NULL.  With a
    mapping, each frame gets its name in ``tag`` unless it has one."""
    items = list(dfs.items()) if isinstance(dfs, Mapping) else [(None, d) for d in dfs]
    out = None
    for name, d in items:
        if tag and name is not None and tag not in d.columns:
            d = d.withColumn(tag, F.lit(name))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def expand_all(df: DataFrame, col: str, values: Sequence[str], token: str = "ALL") -> DataFrame:
    """A row whose ``col`` is ``token`` becomes one row per value; others are kept.
    ``values`` is a fixed entity domain, so the row growth is bounded."""
    arr = F.array(*[F.lit(v) for v in values])
    return df.withColumn(col, F.explode(F.when(F.col(col) == F.lit(token), arr).otherwise(F.array(F.col(col)))))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Remove duplicate rows (NULLs compare equal)."""
    return df.dropDuplicates()


def stack_long(df: DataFrame, cols: Sequence[str], value: str = "value", kind: str = "type") -> DataFrame:
    """Columns -> (type, value) rows, finite values only."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), kind, value)
    return long.where(finite_or_null(F.col(value)).isNotNull())


def pivot_wide(df: DataFrame, keys: Sequence[str], col: str, values: Sequence, value: str | None = None) -> DataFrame:
    """Long -> wide; absent cells are 0.  ``value`` summed, or rows counted."""
    g = df.groupBy(*keys).pivot(col, list(values))
    wide = g.agg(F.sum(value)) if value else g.agg(F.count(F.lit(1)))
    return wide.fillna(0, subset=[str(v) for v in values])
