"""Cleaning, imputation, scaling and encoding (blueprint 2.9).

Fit + apply: statistics for *all* requested columns come from one
aggregate (one small row); the apply step is a projection with literals.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pansift.functions.numeric import clip_guarded, finite_or_null, numeric_types
from pansift.operators._fit import fit_row
from pansift.operators.quantiles import quantile_fit
from pansift.operators.timeseries import bfill_ffill, ffill


def _num(df, cols):
    if cols is None:
        return [f.name for f in df.schema.fields if isinstance(f.dataType, numeric_types)]
    return list(cols)


def _fill(df: DataFrame, values: dict) -> DataFrame:
    """coalesce(col, value); an integral column filled with a fractional
    value becomes double (as a pandas column with gaps already is)."""
    ex = {}
    for c, v in values.items():
        if v is None:
            continue
        dt = df.schema[c].dataType
        if isinstance(dt, (T.DoubleType, T.FloatType)):
            ex[c] = F.coalesce(F.col(c), F.lit(float(v)).cast(dt))
        elif isinstance(dt, numeric_types):
            if float(v).is_integer():
                ex[c] = F.coalesce(F.col(c), F.lit(int(v)).cast(dt))
            else:
                ex[c] = F.coalesce(F.col(c).cast("double"), F.lit(float(v)))
        else:
            ex[c] = F.coalesce(F.col(c), F.lit(v).cast(dt))
    return df.withColumns(ex) if ex else df


def impute_mean(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = _num(df, cols)
    st = fit_row(df, {f"m{i}": F.avg(F.col(c).cast("double")) for i, c in enumerate(cols)})
    return _fill(df, {c: st[f"m{i}"] for i, c in enumerate(cols)})


def impute_median(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    cols = _num(df, cols)
    fit = quantile_fit(df, cols, [0.5], approx=approx)
    return _fill(df, {c: v[0] for c, v in fit.items() if v})


def column_modes(df: DataFrame, cols: Sequence[str]) -> dict:
    """Most frequent non-missing value per column, ties -> smallest.

    All columns go through one long-form count: unpivot to (column, value
    as text), count per pair (partial aggregation), keep the best per
    column.  Memory per task does not grow with distinct values the way a
    per-group value map would.
    """
    cols = list(cols)
    if not cols:
        return {}
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                                  F.col(c).cast("string").alias("value"),
                                                  (F.col(c).cast("double") if isinstance(df.schema[c].dataType, numeric_types)
                                                   else F.lit(None).cast("double")).alias("num"))
                                         for c in cols])).alias("kv")).select("kv.*")
    long = long.where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value", "num").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("nn"), F.col("num"), F.col("value"))).alias("b"))
    out = {}
    for r in best.collect():
        out[r["column"]] = r["b"]["value"]
    return out


def impute_mode(df: DataFrame, cols: Sequence[str] | None = None, unknown: str = "UNKNOWN") -> DataFrame:
    """Fill any column with its mode; a text column with no value at all gets ``unknown``."""
    cols = list(cols) if cols is not None else df.columns
    modes = column_modes(df, cols)
    ex = {}
    for c in cols:
        dt = df.schema[c].dataType
        m = modes.get(c)
        if m is None:
            if isinstance(dt, T.StringType):
                ex[c] = F.coalesce(F.col(c), F.lit(unknown))
            continue
        ex[c] = F.coalesce(F.col(c), F.lit(m).cast(dt))
    return df.withColumns(ex) if ex else df


def missing_indicators(df: DataFrame, cols: Sequence[str], suffix: str = "_missing") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": F.col(c).isNull().cast("int") for c in cols})


def impute_ffill_median(df: DataFrame, entity: str, date: str, cols: Sequence[str],
                        approx: bool = False) -> DataFrame:
    """Forward fill inside the entity, then the global median of the filled column."""
    cols = list(cols)
    filled = ffill(df, entity, date, cols)
    num = [c for c in cols if isinstance(df.schema[c].dataType, numeric_types)]
    return impute_median(filled, num, approx)


def impute_eda_view(df: DataFrame, entity: str, date: str, cols: Sequence[str],
                    approx: bool = False) -> DataFrame:
    """Missing indicators; numeric: bfill + ffill in entity, then median; text: mode."""
    cols = list(cols)
    out = missing_indicators(df, cols)
    num = [c for c in cols if isinstance(df.schema[c].dataType, numeric_types)]
    txt = [c for c in cols if c not in num]
    if num:
        out = impute_median(bfill_ffill(out, entity, date, num), num, approx)
    if txt:
        out = impute_mode(out, txt)
    return out


def impute_time_safe(df: DataFrame, entity: str, date: str, cols: Sequence[str]) -> DataFrame:
    """Missing indicators; numeric: forward fill only (leading gaps stay); text: mode."""
    cols = list(cols)
    out = missing_indicators(df, cols)
    num = [c for c in cols if isinstance(df.schema[c].dataType, numeric_types)]
    txt = [c for c in cols if c not in num]
    if num:
        out = ffill(out, entity, date, num)
    if txt:
        out = impute_mode(out, txt)
    return out


def iqr_fit(df: DataFrame, cols: Sequence[str], factor: float = 1.5, approx: bool = False) -> dict:
    """{col: (q1, q3, lo, hi)} of all columns at once; (None, ...) for an empty column."""
    cols = list(cols)
    fit = quantile_fit(df, {c: finite_or_null(F.col(c).cast("double")) for c in cols}, [0.25, 0.75], approx=approx)
    out = {}
    for c in cols:
        q = fit[c]
        if q is None:
            out[c] = (None, None, None, None)
        else:
            q1, q3 = q
            out[c] = (q1, q3, q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
    return out


def outliers_remove_iqr(df: DataFrame, cols: Sequence[str], factor: float = 1.5,
                        sequential: bool = False, keep_missing: bool = True) -> DataFrame:
    """Drop rows outside [Q1 - f IQR, Q3 + f IQR].  Default: every mask is
    computed on the same input and missing values are kept; ``sequential``
    refits after each column and drops missing, like the older variants."""
    cols = list(cols)
    if sequential:
        out = df
        for c in cols:
            b = iqr_fit(out, [c], factor)[c]
            if b[2] is None:
                continue
            out = out.where(F.col(c).between(b[2], b[3]))
        return out
    bounds = iqr_fit(df, cols, factor)
    cond = F.lit(True)
    for c in cols:
        lo, hi = bounds[c][2], bounds[c][3]
        if lo is None:
            continue
        inside = F.col(c).between(lo, hi)
        cond = cond & ((inside | F.col(c).isNull()) if keep_missing else F.coalesce(inside, F.lit(False)))
    return df.where(cond)


def winsorize_pct(df: DataFrame, cols: Sequence[str], lower: float = 0.05, upper: float = 0.95,
                  approx: bool = False) -> DataFrame:
    """Clip at the (type-7) percentiles; missing stays missing."""
    cols = list(cols)
    fit = quantile_fit(df, cols, [lower, upper], approx=approx)
    ex = {}
    for c in cols:
        q = fit[c]
        if q is None:
            continue
        ex[c] = clip_guarded(F.col(c).cast("double"), q[0], q[1])
    return df.withColumns(ex) if ex else df


def winsorize_iqr(df: DataFrame, cols: Sequence[str], factor: float = 1.5,
                  floor_zero: bool = True) -> tuple[DataFrame, dict]:
    """Clip to [max(0, Q1 - f IQR), Q3 + f IQR]; returns (df, {col: treated count})."""
    cols = [c for c in cols if c in df.columns]
    bounds = iqr_fit(df, cols, factor)
    ex, cnt = {}, {}
    for c in cols:
        _, _, lo, hi = bounds[c]
        if lo is None:
            continue
        x = finite_or_null(F.col(c).cast("double"))
        cnt[c] = F.count_if((x < lo) | (x > hi))
        ex[c] = clip_guarded(x, max(0.0, lo) if floor_zero else lo, hi)
    counts = fit_row(df, cnt) if cnt else {}
    return (df.withColumns(ex) if ex else df), counts


def winsorize_rank(df: DataFrame, cols: Sequence[str], limit: float = 0.01, suffix: str = "_wins") -> DataFrame:
    """Rank-based winsorising: with n non-missing values and k = floor(limit n),
    values below the (k+1)-th smallest / above the (k+1)-th largest are
    replaced by those order statistics: discrete quantiles with ranks placed
    mid-bucket.  NULL stays NULL."""
    cols = list(cols)
    values = {c: finite_or_null(F.col(c).cast("double")) for c in cols}
    cnt = fit_row(df, {f"n{i}": F.count(values[c]) for i, c in enumerate(cols)})
    ranks = {}
    for i, c in enumerate(cols):
        n = cnt[f"n{i}"]
        k = int(math.floor(limit * n))
        ranks[c] = [(k + 0.5) / n, (n - k - 0.5) / n] if n else [0.0, 1.0]
    fit = quantile_fit(df, values, ranks, discrete=True)
    ex = {}
    for c in cols:
        x = F.col(c).cast("double")
        ex[f"{c}{suffix}"] = clip_guarded(x, *fit[c]) if fit[c] else x
    return df.withColumns(ex)


def scale_zscore(df: DataFrame, cols: Sequence[str], ddof: int = 1, skip_constant: bool = True) -> DataFrame:
    cols = list(cols)
    sd = F.stddev_samp if ddof == 1 else F.stddev_pop
    st = fit_row(df, {**{f"m{i}": F.avg(F.col(c).cast("double")) for i, c in enumerate(cols)},
                      **{f"s{i}": sd(F.col(c).cast("double")) for i, c in enumerate(cols)}})
    ex = {}
    for i, c in enumerate(cols):
        m, s = st[f"m{i}"], st[f"s{i}"]
        if m is None or s is None or (s == 0 and skip_constant):
            continue
        ex[c] = F.try_divide(F.col(c).cast("double") - F.lit(m), F.lit(s))
    return df.withColumns(ex) if ex else df


def scale_minmax(df: DataFrame, cols: Sequence[str], skip_constant: bool = True) -> DataFrame:
    cols = list(cols)
    st = fit_row(df, {**{f"a{i}": F.min(F.col(c).cast("double")) for i, c in enumerate(cols)},
                      **{f"b{i}": F.max(F.col(c).cast("double")) for i, c in enumerate(cols)}})
    ex = {}
    for i, c in enumerate(cols):
        a, b = st[f"a{i}"], st[f"b{i}"]
        if a is None or (b - a == 0 and skip_constant):
            continue
        ex[c] = F.try_divide(F.col(c).cast("double") - F.lit(a), F.lit(b - a))
    return df.withColumns(ex) if ex else df


def _levels(df: DataFrame, cols: Sequence[str]) -> dict:
    """Sorted distinct non-missing levels per column.  Each level becomes a
    column of the result, so they are brought to the driver after a
    distributed ``distinct`` over (column, level)."""
    cols = list(cols)
    if not cols:
        return {}
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v"))
                                         for c in cols])).alias("kv")).select("kv.*").where(F.col("v").isNotNull())
    got: dict = {c: [] for c in cols}
    for r in long.distinct().collect():
        got[r["column"]].append(r["v"])
    return {c: sorted(v) for c, v in got.items()}


def one_hot_full_rank(df: DataFrame, cols: Sequence[str], keep_others: bool = True,
                      levels: dict | None = None) -> DataFrame:
    """R ``model.matrix(~ . - 1)``: first factor gets every level, later
    factors drop their first level; columns named ``<col><level>``; other
    columns first.  A missing value gives 0 in every dummy (rows are never
    dropped)."""
    cols = list(cols)
    levels = levels or _levels(df, cols)
    dummies = []
    for j, c in enumerate(cols):
        lv = levels[c] if j == 0 else levels[c][1:]
        for v in lv:
            dummies.append(F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}{v}"))
    others = [F.col(c) for c in df.columns if c not in cols] if keep_others else []
    return df.select(*others, *dummies)


def dummies_drop_first(df: DataFrame, cols: Sequence[str], levels: dict | None = None,
                       sep: str = "_") -> DataFrame:
    """pandas ``get_dummies(drop_first=True)``: sorted levels (or the given
    order), first level dropped, ``<col>_<level>`` 0/1 ints; unseen levels
    give all-zero rows; source columns replaced."""
    cols = list(cols)
    lv = dict(levels or {})
    missing = [c for c in cols if c not in lv]
    if missing:
        lv.update(_levels(df, missing))
    out = df
    for c in cols:
        ex = {f"{c}{sep}{v}": F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("int"), F.lit(0))
              for v in lv[c][1:]}
        out = out.withColumns(ex).drop(c)
    return out


def split_binary_continuous(df: DataFrame, cols: Sequence[str]) -> tuple[list, list]:
    """Binary = at most 2 distinct (rounded to 6 places) values, all in {0, 1}."""
    cols = list(cols)
    st = fit_row(df, {**{f"a{i}": F.min(F.round(F.col(c).cast("double"), 6)) for i, c in enumerate(cols)},
                      **{f"b{i}": F.max(F.round(F.col(c).cast("double"), 6)) for i, c in enumerate(cols)},
                      **{f"o{i}": F.count_if(~F.round(F.col(c).cast("double"), 6).isin(0.0, 1.0))
                         for i, c in enumerate(cols)}})
    binary = [c for i, c in enumerate(cols) if st[f"o{i}"] == 0 and st[f"a{i}"] is not None]
    return binary, [c for c in cols if c not in binary]


# --------------------------------------------------------------------------
# Power transforms: lambda by maximum likelihood on a refining grid.
# Each pass is one aggregate with one variance per (column, lambda); no
# data leaves the executors except those sums.
# --------------------------------------------------------------------------

def _bc_expr(x, lam):
    """Box-Cox; ``lam`` is a float or a Column (per-row lambda in the grid search)."""
    lam = F.lit(float(lam)) if not isinstance(lam, Column) else lam
    return F.when(F.abs(lam) < 1e-12, F.log(x)).otherwise((F.pow(x, lam) - 1.0) / lam)


def _yj_expr(x, lam):
    lam = F.lit(float(lam)) if not isinstance(lam, Column) else lam
    pos = F.when(F.abs(lam) < 1e-12, F.log1p(x)).otherwise((F.pow(x + 1.0, lam) - 1.0) / lam)
    neg = F.when(F.abs(lam - 2) < 1e-12, -F.log1p(-x)).otherwise(-(F.pow(1.0 - x, 2.0 - lam) - 1.0) / (2.0 - lam))
    return F.when(x >= 0, pos).otherwise(neg)


def _grid_search(df: DataFrame, cols: Sequence[str], transform, jac_expr, lo=-3.0, hi=3.0,
                 points: int = 21, passes: int = 3, refine_points: int = 11) -> dict:
    """Maximise llf(l) = -n/2 ln var_pop(T_l(x)) + (l - 1) * J(x) per column:
    ``points`` grid values on [lo, hi], widened around the best point for as
    long as that lies on an edge and still gains, then ``refine_points``
    around the best point on each further pass, finished by a parabola through
    the best point and its neighbours.

    Columns are unpivoted to (column id, value) so one pass is a single
    ``groupBy(column)`` with one variance per grid point: the aggregate width
    does not grow with the number of columns, and each column's current grid
    bounds are read from literal arrays by its integer id.
    """
    cols = list(cols)
    # columns are addressed by an integer id: per-row bounds come from O(1)
    # indexing into literal arrays instead of string-keyed map lookups
    long = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("cid"),
                                                  finite_or_null(F.col(c).cast("double")).alias("x"))
                                         for i, c in enumerate(cols)])).alias("kv")).select("kv.*").where(F.col("x").isNotNull())
    base = {cols[r["cid"]]: (r["n"], r["j"] or 0.0) for r in
            long.groupBy("cid").agg(F.count("x").alias("n"), F.sum(jac_expr(F.col("x"))).alias("j")).collect()}
    bounds = {c: (lo, hi) for c in cols}
    best: dict = {c: None for c in cols}
    top: dict = {c: -math.inf for c in cols}
    left = {c: passes - 1 for c in cols}          # refinements still to do; absent: finished
    while left:
        npts = points if any(n == passes - 1 for n in left.values()) else refine_points
        todo = sorted(left, key=cols.index)
        at = {c: i for i, c in enumerate(todo)}
        slot = F.array(*[F.lit(at.get(c, 0)) for c in cols])[F.col("cid")]
        lam_lo = F.array(*[F.lit(float(bounds[c][0])) for c in todo])[slot]
        lam_hi = F.array(*[F.lit(float(bounds[c][1])) for c in todo])[slot]
        exprs = [F.var_pop(transform(F.col("x"), lam_lo + (lam_hi - lam_lo) * F.lit(k / (npts - 1)))).alias(f"v{k}")
                 for k in range(npts)]
        rows = {cols[r["cid"]]: r for r in
                long.where(F.col("cid").isin([cols.index(c) for c in todo])).groupBy("cid").agg(*exprs).collect()}
        for c in todo:
            n, jac = base.get(c, (0, 0.0))
            b0, b1 = bounds[c]
            step = (b1 - b0) / (npts - 1)
            scores = []
            for k in range(npts):
                v, lam = (rows[c][f"v{k}"] if c in rows else None), b0 + step * k
                if v is not None and v > 0 and math.isfinite(v):
                    scores.append((-n / 2.0 * math.log(v) + (lam - 1.0) * jac, lam))
            if not scores:
                del left[c]
                continue
            i_best = max(range(len(scores)), key=lambda i: scores[i][0])
            score, lam = scores[i_best]
            gained, top[c], best[c] = score > top[c], max(top[c], score), lam
            if i_best in (0, len(scores) - 1) and gained:
                # the best point lies on an edge: look on around it, twice as far
                bounds[c] = (lam - (b1 - b0), lam + (b1 - b0))
            elif left[c] > 0:
                left[c] -= 1
                bounds[c] = (lam - step, lam + step)
            else:
                if 0 < i_best < len(scores) - 1:
                    # parabola through the best point and its neighbours
                    (y0, x0), (y1, x1), (y2, x2) = scores[i_best - 1], scores[i_best], scores[i_best + 1]
                    den = y0 - 2 * y1 + y2
                    if den < 0 and abs(x2 - x0 - 2 * step) < 1e-9:
                        best[c] = x1 + 0.5 * step * (y0 - y2) / den
                del left[c]
    return best


def box_cox(df: DataFrame, col: str, eps: float = 1e-3, out: str | None = None,
            lambda_col: str | None = None, passes: int = 3, lam: float | None = None) -> DataFrame:
    """Box-Cox of (missing -> 0) + eps with lambda by maximum likelihood (or
    the given ``lam``); lambda is kept as a constant column."""
    x = F.coalesce(F.col(col).cast("double"), F.lit(0.0)) + F.lit(eps)
    tmp = df.withColumn("_bc_x", x)
    if lam is None:
        lam = _grid_search(tmp, ["_bc_x"], _bc_expr, lambda v: F.log(v), passes=passes)["_bc_x"]
    return tmp.withColumn(out or f"boxcox_{col}", _bc_expr(F.col("_bc_x"), lam)) \
              .withColumn(lambda_col or f"_boxcox_lambda_{col}", F.lit(lam)).drop("_bc_x")


def yeo_johnson_fit(df: DataFrame, cols: Sequence[str], passes: int = 3) -> dict:
    jac = lambda x: F.signum(x) * F.log1p(F.abs(x))
    return _grid_search(df, cols, _yj_expr, jac, passes=passes)


def yeo_johnson(df: DataFrame, cols: Sequence[str], standardize: bool = True, passes: int = 3,
                lambdas: dict | None = None) -> DataFrame:
    """Yeo-Johnson per column (lambda by ML, all columns in one aggregate per
    pass, or the given ``lambdas``), then z-score with ddof 0.  Missing
    stays missing."""
    cols = list(cols)
    lams = dict(lambdas) if lambdas is not None else yeo_johnson_fit(df, cols, passes)
    ex = {c: _yj_expr(F.col(c).cast("double"), lams[c]) for c in cols if lams[c] is not None}
    out = df.withColumns(ex)
    return scale_zscore(out, list(ex), ddof=0, skip_constant=True) if standardize else out


def moments_fit(df: DataFrame, cols: Sequence[str]) -> dict:
    """One aggregate for everything the variance filter, the binary /
    continuous split and the z / min-max scalers need:
    {col: dict(n, mean, sd_pop, sd_samp, var_pop, min, max, nonbinary)}."""
    cols = list(cols)
    ex = {}
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        ex.update({f"n{i}": F.count(x), f"m{i}": F.avg(x), f"sp{i}": F.stddev_pop(x), f"ss{i}": F.stddev_samp(x),
                   f"vp{i}": F.var_pop(x), f"a{i}": F.min(x), f"b{i}": F.max(x),
                   f"o{i}": F.count_if(~F.round(x, 6).isin(0.0, 1.0))})
    st = fit_row(df, ex)
    return {c: {"n": st[f"n{i}"], "mean": st[f"m{i}"], "sd_pop": st[f"sp{i}"], "sd_samp": st[f"ss{i}"],
                "var_pop": st[f"vp{i}"], "min": st[f"a{i}"], "max": st[f"b{i}"], "nonbinary": st[f"o{i}"]}
            for i, c in enumerate(cols)}


def apply_zscore(df: DataFrame, fit: dict, cols: Sequence[str], ddof: int = 0) -> DataFrame:
    """z-scores from a ``moments_fit`` result (constant columns unchanged)."""
    ex = {}
    for c in cols:
        m, s = fit[c]["mean"], fit[c]["sd_pop" if ddof == 0 else "sd_samp"]
        if m is not None and s:
            ex[c] = (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
    return df.withColumns(ex) if ex else df


def apply_minmax(df: DataFrame, fit: dict, cols: Sequence[str]) -> DataFrame:
    """(x - min) / (max - min) from a ``moments_fit`` result (constant columns unchanged)."""
    ex = {}
    for c in cols:
        a, b = fit[c]["min"], fit[c]["max"]
        if a is not None and b - a != 0:
            ex[c] = (F.col(c).cast("double") - F.lit(a)) / F.lit(b - a)
    return df.withColumns(ex) if ex else df
