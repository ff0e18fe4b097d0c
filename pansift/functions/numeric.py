"""Numeric expressions that keep NULL semantics explicit (ANSI mode safe)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

numeric_types = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    c = _c(c)
    return F.when(~F.isnan(c), c)


def finite_or_null(c) -> Column:
    """NULL for NaN and +-inf; NaN compares above inf so one test covers both."""
    c = _c(c)
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def safe_div(a, b) -> Column:
    """a / b, NULL on zero divisor or non-finite result."""
    return finite_or_null(F.try_divide(_c(a).cast("double"), _c(b).cast("double")))


def clip_guarded(c, lo=None, hi=None) -> Column:
    """Clip that keeps NULL as NULL (``greatest(NULL, 0)`` would give 0)."""
    c = _c(c)
    out = c
    if hi is not None:
        out = F.least(out, hi if isinstance(hi, Column) else F.lit(hi))
    if lo is not None:
        out = F.greatest(out, lo if isinstance(lo, Column) else F.lit(lo))
    return F.when(c.isNotNull(), out)


def skew_adjust_factor(n) -> Column:
    """Population g1 -> adjusted Fisher-Pearson G1 factor sqrt(n(n-1))/(n-2)."""
    n = _c(n).cast("double")
    return F.when(n > 2, F.sqrt(n * (n - 1)) / (n - 2))
