"""Sinks (blueprint 2.1): CSV / Parquet writers and a preview."""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


def _write(df: DataFrame, target: str, mode: str, fmt: str, partition_by: Sequence[str]) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(target)
    else:
        w.format(fmt).save(target)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", versioned: bool = False,
              fmt: str = "csv", partition_by: Sequence[str] = ()) -> str:
    """Write with a header (CSV) or in another format.  ``versioned``: when
    the write is refused because the target exists, write to ``<path>_v2``
    (then ``_v3`` ...) instead of failing.  Returns the path written."""
    from pyspark.errors import AnalysisException
    if not versioned:
        _write(df, path, mode, fmt, partition_by)
        return path
    for k in itertools.count(1):
        target = path if k == 1 else f"{path}_v{k}"
        try:
            _write(df, target, "errorifexists", fmt, partition_by)
            return target
        except AnalysisException as e:
            if "PATH_ALREADY_EXISTS" not in str(e) and "already exists" not in str(e):
                raise
    raise AssertionError("unreachable")


def write_outputs(frames: Mapping[str, DataFrame], out_dir: str, fmt: str = "parquet",
                  partition_by: Mapping[str, Sequence[str]] | None = None, mode: str = "overwrite") -> dict:
    """Write every named frame under ``out_dir/<name>``; large frames can be
    partitioned (e.g. by entity).  Returns name -> path."""
    partition_by = partition_by or {}
    return {name: write_csv(df, f"{out_dir.rstrip('/')}/{name}", mode, False, fmt, partition_by.get(name, ()))
            for name, df in frames.items()}


def preview(df: DataFrame, n: int = 20, max_cols: int | None = None, order: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows (of the first ``max_cols`` columns) under an explicit
    order; without one the rows are whatever the scan yields first."""
    cols = df.columns[:max_cols] if max_cols else df.columns
    out = df.select(*cols)
    if order:
        out = out.orderBy(*order)
    return out.limit(n)
