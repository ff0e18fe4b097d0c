"""Joins (blueprint 2.3).

No side is forced to be broadcast, since callers pass any table.  The
planner checks estimated sizes against ``autoBroadcastJoinThreshold`` and AQE
re-plans with the sizes that shuffles really have; large sides meet in a
sort-merge join.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on_date(panel: DataFrame, daily: DataFrame, on: str = "date") -> DataFrame:
    """Left join of a date-level table (one row per day, bounded by the calendar)."""
    return panel.join(daily, on=on, how="left")


def join_on_entity(panel: DataFrame, attrs: DataFrame, on: str = "entity") -> DataFrame:
    """Left join of entity attributes (one row per entity of a fixed domain)."""
    return panel.join(attrs, on=on, how="left")


def join_on_entity_date(panel: DataFrame, other: DataFrame, keys: Sequence[str] = ("date", "entity"),
                        fill0: Iterable[str] = ()) -> DataFrame:
    """Left join on the composite key; unmatched counts become 0 (int)."""
    out = panel.join(other, on=list(keys), how="left")
    fill0 = list(fill0)
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("int") for c in fill0}) if fill0 else out


def join_majority_map(attrs: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """Attach the mapped entity, dropping rows whose key is unmapped (left + dropna = inner)."""
    return attrs.join(mapping, on=key, how="inner")


def join_quality_flags(features: DataFrame, flags: DataFrame | None, on: str = "date",
                       cols: Sequence[str] = ()) -> DataFrame:
    """Bring date-level 0/1 flags back; missing flags (or no flag table) -> 0."""
    cols = list(cols)
    if flags is None:
        return features.withColumns({c: F.lit(0) for c in cols})
    out = features.join(flags.select(on, *cols), on=on, how="left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("int") for c in cols})


def membership_bucket(df: DataFrame, col: str, top_values, other: str = "OTHER",
                      out: str = "bucket") -> DataFrame:
    """Value if it is in the top set, else ``other``.

    ``top_values`` is a DataFrame of the top values (left join) or a list.
    """
    if isinstance(top_values, DataFrame):
        t = top_values.select(F.col(top_values.columns[0]).alias("_top"))
        j = df.join(t, F.col(col) == F.col("_top"), "left")
        return j.withColumn(out, F.coalesce(F.col("_top"), F.lit(other))).drop("_top")
    return df.withColumn(out, F.when(F.col(col).isin(list(top_values)), F.col(col)).otherwise(F.lit(other)))


def align_concat(dfs: Sequence[DataFrame], key) -> DataFrame:
    """Column-wise concat aligned on a real key (full outer, like index alignment)."""
    keys = [key] if isinstance(key, str) else list(key)
    out = dfs[0]
    for d in dfs[1:]:
        out = out.join(d, on=keys, how="full")
    return out
