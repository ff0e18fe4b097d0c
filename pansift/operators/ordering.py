"""Row order over a whole table without one task that holds it.

Rows are range-partitioned by their order and written; the rows in each range
give the position at which it starts.  Frames that reach a bounded number of
rows back then run in blocks of consecutive rows, each with the rows before it
that its frames need.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pansift.session import cut_lineage

#: Rows of a block.
BLOCK = 100_000


def numbered(df: DataFrame, order: str | Sequence[str], out: str = "_row") -> DataFrame:
    """``df`` with each row's position (from 0) under ``order``; rows that
    compare equal stand in any order."""
    cols = [order] if isinstance(order, str) else list(order)
    ranged = cut_lineage(df.repartitionByRange(*cols).withColumn("_part", F.spark_partition_id()), "ordered")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)   # one row per range
    starts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")) \
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part").orderBy(*cols)
    return ranged.join(starts, "_part").withColumn(out, F.col("_start") + F.row_number().over(inside) - 1).drop("_part", "_start")


def over_rows(df: DataFrame, order: str | Sequence[str], back: int, columns: Callable, block: int = BLOCK,
              by: Sequence[str] = ()) -> DataFrame:
    """``df`` with the columns ``columns(window)`` gives, as if ``window`` were
    ordered over the whole table (with ``by``: over each group); their frames
    reach ``back`` rows back at most."""
    block, order = max(block, back, 1), [order] if isinstance(order, str) else list(order)
    rows = numbered(df, [*by, *order])
    home = F.floor(F.col("_row") / block)
    blocks = F.when(F.col("_row") % block >= block - back, F.array(home, home + 1)).otherwise(F.array(home))
    rows = rows.withColumn("_block", F.explode(blocks))
    w = Window.partitionBy("_block", *by).orderBy("_row")
    return rows.withColumns(columns(w)).where(F.col("_block") == home).drop("_row", "_block")


def filled_rows(df: DataFrame, order: str | Sequence[str], by: Sequence[str], columns: Sequence[str], backward: bool = False,
                block: int = BLOCK) -> DataFrame:
    """Each of ``columns`` with its last known value in the order of its group
    (``backward``: the next known one, or else the last), for groups of any length.

    Every block finds its own last and first known values; those of the blocks
    before and after a block, one small row per block and group, are what it
    carries in.  No task holds more than a block, or the block rows of a group."""
    order, columns, by = [order] if isinstance(order, str) else list(order), list(columns), list(by)
    rows = cut_lineage(numbered(df, [*by, *order]).withColumn("_block", F.floor(F.col("_row") / block)), "series")
    known = {c: F.when(F.col(c).isNotNull(), F.col("_row")) for c in columns}
    ends = rows.groupBy("_block", *by).agg(*[F.max_by(c, known[c]).alias(f"_last{i}") for i, c in enumerate(columns)],
                                           *[F.min_by(c, known[c]).alias(f"_first{i}") for i, c in enumerate(columns)])
    past = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    future = Window.partitionBy(*by).orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(F.col("_block").alias("_b"), *[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)],
                          *[F.last(f"_last{i}", ignorenulls=True).over(past).alias(f"_past{i}") for i in range(len(columns))],
                          *([F.last(f"_first{i}", ignorenulls=True).over(future).alias(f"_next{i}") for i in range(len(columns))] if backward else []))
    cond = F.col("_block") == F.col("_b")
    for i, c in enumerate(by):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    inside = Window.partitionBy("_block", *by)
    down = inside.orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    up = inside.orderBy(F.desc("_row")).rowsBetween(Window.unboundedPreceding, 0)
    out = {}
    for i, c in enumerate(columns):
        last = F.coalesce(F.last(c, ignorenulls=True).over(down), F.col(f"_past{i}"))
        out[c] = F.coalesce(F.last(c, ignorenulls=True).over(up), F.col(f"_next{i}"), last) if backward else last
    return rows.join(carried, cond).withColumns(out).select(*[F.col(f"`{c}`") for c in df.columns])
