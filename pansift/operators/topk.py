"""Sorts, limits and top-k (blueprint 2.6).

A sort is applied at the sink only; ``top_k_*`` use ``orderBy + limit``
which Spark plans as TakeOrderedAndProject (per-partition top-k, then a
merge of K rows per partition), never a full sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pansift.operators.quantiles import with_group_quantiles


def sort_panel(df: DataFrame, keys: Sequence[str] = ("date", "borough")) -> DataFrame:
    return df.orderBy(*keys)


def top_k_values(df: DataFrame, col: str, k: int) -> DataFrame:
    """k most frequent values (ties: value ascending) with their counts."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc(col)).limit(k))


def top_k_rows(df: DataFrame, by: str, k: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """k rows with the largest ``by`` (ties broken by ``tiebreak`` ascending)."""
    return df.orderBy(F.desc_nulls_last(by), *[F.asc(c) for c in tiebreak]).limit(k)


def order_groups_by_median(df: DataFrame, group: str, value: str, approx: bool = False) -> DataFrame:
    """Groups with their median, largest median first (box order)."""
    med = with_group_quantiles(df.select(group).distinct(), df, [group], {"median": (F.col(value), 0.5)}, approx)
    return med.orderBy(F.desc("median"), F.asc(group))
