"""Window and time-series operators (blueprint 2.5).

All frames are row-based, as in the reference: no calendar gap filling
before shifting.  Every windowed column built by one call shares one
``Window`` spec, so Spark plans a single exchange + sort for all of them.
Windows are partitioned by the entity, which suits panel-grain data (one
row per entity and day).  With ``block``, lags, rolling means and fills run in blocks
of so many consecutive rows instead (``ordering``), so one entity's series of any
length is dealt to many tasks, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pansift.functions.numeric import safe_div
from pansift.operators.ordering import filled_rows, over_rows


def _spec(entity, date):
    return Window.partitionBy(*_listed(entity)).orderBy(*_listed(date))


def _listed(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x or [])


def _windowed(df: DataFrame, entity, date, back: int, columns, block: int | None) -> DataFrame:
    """``columns(window)`` over each entity, in blocks if ``block`` is given."""
    if block is None:
        return df.withColumns(columns(_spec(entity, date)))
    return over_rows(df, _listed(date), back, columns, block, _listed(entity))


def lag_features(df: DataFrame, entity, date, cols: Iterable[str], lags: Sequence[int] = (1,),
                 block: int | None = None) -> DataFrame:
    """``<col>_lag<k>`` = value k rows earlier inside the entity."""
    cols, lags = list(cols), list(lags)
    return _windowed(df, entity, date, max(lags, default=0),
                     lambda w: {f"{c}_lag{k}": F.lag(F.col(c), k).over(w) for c in cols for k in lags}, block)


def _rolling(c: str, w, lo: int, hi: int, min_periods: int) -> Column:
    frame = w.rowsBetween(lo, hi)
    return F.when(F.count(F.col(c)).over(frame) >= min_periods, F.avg(F.col(c)).over(frame))


def rolling_mean(df: DataFrame, entity, date, cols: Iterable[str], n: int = 7,
                 min_periods: int = 3, suffix: str | None = None, block: int | None = None) -> DataFrame:
    """Trailing n-row mean including the current row; NULL until
    ``min_periods`` non-missing values are in the frame."""
    cols, suffix = list(cols), suffix or f"_ma{n}"
    return _windowed(df, entity, date, n - 1,
                     lambda w: {f"{c}{suffix}": _rolling(c, w, -(n - 1), 0, min_periods) for c in cols}, block)


def rolling_mean_prev(df: DataFrame, entity, date, cols: Iterable[str], n: int = 7,
                      min_periods: int = 3, suffix: str | None = None, block: int | None = None) -> DataFrame:
    """Same as ``rolling_mean`` over the n rows *before* the current one (leak-safe)."""
    cols, suffix = list(cols), suffix or f"_ma{n}_prev"
    return _windowed(df, entity, date, n,
                     lambda w: {f"{c}{suffix}": _rolling(c, w, -n, -1, min_periods) for c in cols}, block)


def rolling_mean_global(daily: DataFrame, date: str, col: str, n: int = 7,
                        min_periods: int = 1, out: str | None = None) -> DataFrame:
    """Rolling mean over all rows in the order of ``date``, in blocks of
    consecutive rows (``ordering.over_rows``), whatever their number."""
    return over_rows(daily, date, n - 1, lambda w: {out or f"{col}_ma{n}": _rolling(col, w, -(n - 1), 0, min_periods)})


def lag_diff(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    return df.withColumn(out, F.col(a) - F.col(b))


def lag_pct_change(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """(a - b) / b with +-inf and 0/0 -> NULL."""
    return df.withColumn(out, safe_div(F.col(a) - F.col(b), F.col(b)))


def ffill(df: DataFrame, entity, date, cols: Iterable[str], block: int | None = None) -> DataFrame:
    """Carry the last known value forward inside the entity."""
    if block is not None:
        return filled_rows(df, _listed(date), _listed(entity), list(cols), block=block)
    w = _spec(entity, date).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(F.col(c), ignorenulls=True).over(w) for c in cols})


def bfill_ffill(df: DataFrame, entity, date, cols: Iterable[str], block: int | None = None) -> DataFrame:
    """Backward fill, then forward fill for the trailing gap.

    The backward fill is a running ``last(ignorenulls)`` over the reversed
    date order: a frame from the partition start to the current row is
    evaluated incrementally, whereas a current-row-to-unbounded-following
    frame is re-aggregated for every row (quadratic in the series length).
    """
    if block is not None:
        return filled_rows(df, _listed(date), _listed(entity), list(cols), backward=True, block=block)
    ents, order = _listed(entity), _listed(date)
    back = Window.partitionBy(*ents).orderBy(*[F.desc(o) for o in order]).rowsBetween(Window.unboundedPreceding, 0)
    fwd = _spec(entity, date).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.coalesce(F.last(F.col(c), ignorenulls=True).over(back),
                                         F.last(F.col(c), ignorenulls=True).over(fwd)) for c in cols})


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None,
                      count: str | None = None) -> DataFrame:
    """First row per key under an explicit ascending total order (``count``: a
    column with the number of rows of its key).

    Implemented as ``min(struct(order..., rest...))`` per key: an aggregate
    with a map-side part (Spark sorts for it, as structs have no hash aggregate),
    so a hot key that holds a large share of the rows is reduced on every mapper
    before the shuffle instead of landing whole in one task.
    """
    keys = list(keys)
    order = [c for c in (order or []) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(c).alias(f"_r{i}") for i, c in enumerate(rest)])
    number = [F.count(F.lit(1)).alias(count)] if count else []
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_first"), *number)
    sel = [F.col(k) for k in keys]
    sel += [F.col(f"_first._o{i}").alias(c) for i, c in enumerate(order)]
    sel += [F.col(f"_first._r{i}").alias(c) for i, c in enumerate(rest)]
    return agg.select(*sel, *([count] if count else [])).select(*df.columns, *([count] if count else []))


def rank_top_per_key(df: DataFrame, key, order: Sequence[Column], k: int,
                     salt_buckets: int | None = None, rank_col: str = "rank") -> DataFrame:
    """Top-k rows per key under ``order`` (a total order), ranked 1..k.

    Two stages: top-k inside (key, salt) sub-groups, then top-k over at most
    ``salt_buckets * k`` survivors per key.  By default the number of salt
    buckets follows the session's shuffle parallelism
    (``spark.sql.shuffle.partitions``, sized to the cluster and data), so a
    key holding a large share of all rows is spread over as many stage-one
    tasks as any shuffle of the job.  The salt is a hash of the row, so
    retried tasks reproduce it; the result is exact.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = df.columns
    if salt_buckets is None:
        salt_buckets = max(32, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(salt_buckets))
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    stage1 = (df.withColumn("_salt", salt)
              .withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= k)
              .drop("_r", "_salt"))
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return stage1.withColumn(rank_col, F.row_number().over(w2)).where(F.col(rank_col) <= k)
