"""Scalar functions and feature engineering (blueprint 2.8).

All are projections (no shuffle) except ``day_index``, which needs the
global minimum date (one small aggregate, applied as a literal).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pansift.functions.numeric import clip_guarded, finite_or_null, safe_div
from pansift.functions.text import strip_symbols_expr


def calendar_features(df: DataFrame, date: str = "date") -> DataFrame:
    """day_of_week (Monday 0), is_weekend (>= 5), month, ISO week_of_year."""
    d = F.to_date(F.col(date))
    return df.withColumns({
        "day_of_week": F.weekday(d),
        "is_weekend": (F.weekday(d) >= 5).cast("int"),
        "month": F.month(d),
        "week_of_year": F.weekofyear(d)})


def day_index(df: DataFrame, date: str = "date", out: str = "day_index") -> DataFrame:
    """Days since the earliest date in the frame."""
    mn = df.agg(F.min(F.to_date(F.col(date)))).first()[0]
    return df.withColumn(out, F.datediff(F.to_date(F.col(date)), F.lit(mn)))


def cyclical_encode(df: DataFrame, col: str, period: float, offset: float = 0.0,
                    prefix: str | None = None) -> DataFrame:
    p = prefix or col
    ang = F.lit(2 * math.pi) * (F.col(col) - F.lit(offset)) / F.lit(period)
    return df.withColumns({f"{p}_sin": F.sin(ang), f"{p}_cos": F.cos(ang)})


def log1p_tx(df: DataFrame, col: str, out: str | None = None, negatives: str = "clamp") -> DataFrame:
    """log(1 + x).  negatives: ``clamp`` -> log1p(max(x, 0)); ``null`` -> NULL
    when x <= -1; ``raw`` -> log1p(x) (NULL where undefined)."""
    x = F.col(col).cast("double")
    if negatives == "clamp":
        e = F.log1p(clip_guarded(x, lo=0.0))
    elif negatives == "null":
        e = F.when(x > -1, F.log1p(x))
    else:
        e = F.when(x > -1, F.log1p(x))
    return df.withColumn(out or f"log1p_{col}", finite_or_null(e))


def sqrt_tx(df: DataFrame, col: str, out: str | None = None, negatives: str = "clamp") -> DataFrame:
    """sqrt: ``clamp`` -> sqrt(max(x, 0)); ``null`` -> NULL below 0; ``abs`` -> sqrt(|x|)."""
    x = F.col(col).cast("double")
    e = {"clamp": F.sqrt(clip_guarded(x, lo=0.0)), "null": F.when(x >= 0, F.sqrt(x)),
         "abs": F.sqrt(F.abs(x))}[negatives]
    return df.withColumn(out or f"sqrt_{col}", e)


def square(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    x = F.col(col).cast("double")
    return df.withColumn(out or f"{col}_sq", x * x)


def zscore_feature(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """(x - mean) / sd (ddof 1) as a new column; NULL when sd is 0 or undefined."""
    st = df.agg(F.avg(F.col(col).cast("double")).alias("m"), F.stddev_samp(F.col(col).cast("double")).alias("s")).first()
    m, s = st["m"], st["s"]
    if m is None or not s:
        return df.withColumn(out or f"{col}_z", F.lit(None).cast("double"))
    return df.withColumn(out or f"{col}_z", (F.col(col).cast("double") - F.lit(m)) / F.lit(s))


def cut_equal_width_expr(x: Column, lo: float, hi: float, k: int) -> Column:
    """1-based, right-closed equal-width bin on [lo, hi] (R ``cut(x, k)`` rule:
    the minimum falls in bin 1)."""
    if hi is None or lo is None:
        return F.lit(None).cast("int")
    if hi == lo:
        return F.when(x.isNotNull(), F.lit(1))
    w = (hi - lo) / k
    return F.when(x.isNull(), None).when(x <= F.lit(lo), 1).otherwise(
        F.least(F.greatest(F.ceil((x - F.lit(lo)) / F.lit(w)), F.lit(1)), F.lit(k)).cast("int"))


def cut_equal_width(df: DataFrame, col: str, k: int = 4, out: str | None = None) -> DataFrame:
    """k equal bins (3..10 in the app, default 4), numbered 1..k."""
    st = df.agg(F.min(finite_or_null(F.col(col).cast("double"))).alias("lo"),
                F.max(finite_or_null(F.col(col).cast("double"))).alias("hi")).first()
    return df.withColumn(out or f"{col}_bin", cut_equal_width_expr(F.col(col).cast("double"), st["lo"], st["hi"], k))


# Fixed values that must match the reference: temperature bin edges and labels.
TEMP_BIN_EDGES = [0, 10, 20, 30]
TEMP_BIN_LABELS = ["<=0C", "0-10C", "10-20C", "20-30C", ">30C"]


def cut_fixed(df: DataFrame, col: str, edges: Sequence[float] = TEMP_BIN_EDGES,
              labels: Sequence[str] = TEMP_BIN_LABELS, out: str | None = None) -> DataFrame:
    """Right-closed bins (-inf, e0], (e0, e1], ..., (e_last, inf) -> labels."""
    x = F.col(col)
    e = F.when(x.isNull(), F.lit(None).cast("string"))
    for edge, lab in zip(edges, labels):
        e = e.when(x <= F.lit(edge), F.lit(lab))
    e = e.otherwise(F.lit(labels[len(edges)]))
    return df.withColumn(out or f"{col}_bin", e)


def interaction(df: DataFrame, a: str, b: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or f"{a}_x_{b}", F.col(a).cast("double") * F.col(b).cast("double"))


def safe_ratio(df: DataFrame, a: str, b: str, out: str | None = None, eps: float = 1e-8) -> DataFrame:
    """a / b only where both are finite and |b| >= eps."""
    x, y = finite_or_null(F.col(a).cast("double")), finite_or_null(F.col(b).cast("double"))
    return df.withColumn(out or f"{a}_div_{b}", F.when(F.abs(y) >= eps, x / y))


def per_capita(df: DataFrame, num: str, pop: str, out: str, per: float = 1000.0) -> DataFrame:
    return df.withColumn(out, safe_div(F.col(num), F.col(pop)) * F.lit(per))


def range_and_flags(df: DataFrame, tmax: str = "temp_max", tmin: str = "temp_min",
                    precip: str = "precipitation_sum", snow: str = "snowfall_sum") -> DataFrame:
    """temp_range, is_freezing (<= 0), is_precip (> 0), is_snow (> 0); a
    missing input gives flag 0, as a pandas comparison does."""
    return df.withColumns({
        "temp_range": F.col(tmax) - F.col(tmin),
        "is_freezing": F.coalesce((F.col(tmin) <= 0).cast("int"), F.lit(0)),
        "is_precip": F.coalesce((F.col(precip) > 0).cast("int"), F.lit(0)),
        "is_snow": F.coalesce((F.col(snow) > 0).cast("int"), F.lit(0))})


def share_columns(df: DataFrame, count_cols: Sequence[str], total: str) -> tuple[DataFrame, list, list]:
    """``*_cnt`` / total -> ``*_share``; returns (df, share columns, shares without OTHER)."""
    shares = {c.replace("_cnt", "_share"): safe_div(F.col(c), F.col(total)) for c in count_cols}
    names = list(shares)
    return df.withColumns(shares), names, [s for s in names if "OTHER" not in s.upper()]


def composition_diversity(df: DataFrame, share_cols: Sequence[str], prefix: str = "complaint") -> DataFrame:
    """Shannon entropy (shares clipped at 1e-12), Herfindahl index and max
    share; missing shares are skipped as pandas row sums do."""
    ent = sum((F.coalesce(-F.greatest(F.col(c), F.lit(1e-12)) * F.log(F.greatest(F.col(c), F.lit(1e-12))), F.lit(0.0))
               for c in share_cols), F.lit(0.0))
    hhi = sum((F.coalesce(F.col(c) * F.col(c), F.lit(0.0)) for c in share_cols), F.lit(0.0))
    top = F.greatest(*[F.col(c) for c in share_cols]) if len(share_cols) > 1 else F.col(share_cols[0])
    return df.withColumns({f"{prefix}_entropy": ent, f"{prefix}_hhi": hhi, f"{prefix}_top_share": top})


def type_flags(df: DataFrame, col: str, values: Mapping[str, str], contains: bool = False) -> DataFrame:
    """0/1 per label (equality), or substring match on the lower-cased text; a missing label gives 0."""
    def hit(v):
        return F.lower(F.col(col).cast("string")).contains(v.lower()) if contains else F.col(col) == F.lit(v)
    return df.withColumns({k: F.coalesce(hit(v).cast("int"), F.lit(0)) for k, v in values.items()})


def strip_symbols(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, strip_symbols_expr(col))


def label_map(df: DataFrame, col: str, mapping: Mapping, out: str | None = None) -> DataFrame:
    e = F.lit(None).cast("string")
    for k, v in mapping.items():
        e = F.when(F.col(col) == F.lit(k), F.lit(v)).otherwise(e)
    return df.withColumn(out or f"{col}_label", e)


def add_named_feature(df: DataFrame, name: str | None, expr: Column,
                      default: str = "engineered_feature") -> DataFrame:
    nm = (name or "").strip() or default
    return df.withColumn(nm, expr)
