"""Statistics on Spark aggregates (blueprint 2.4, statistics rows).

Everything data-sized runs as Spark aggregates; only p x p matrices (p =
number of features) reach the driver, where numpy inverts / decomposes
them.  Per-row diagnostics (leverage, residuals, Cook's D, PCA scores) are
column expressions with the fitted matrices as literals.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pansift.functions.numeric import finite_or_null, skew_adjust_factor
from pansift.operators._fit import fit_row
from pansift.operators.moments import pair_moments
from pansift.operators.tallskinny import FLAT, complete, qr_factor


# ---------------------------------------------------------------- helpers --

def t_two_sided_p(t: float, df: float) -> float | None:
    """Two-sided p-value of Student's t with ``df`` degrees of freedom.

    With t = sqrt(df) tan(angle) the tail is the integral of
    cos(phi) ** (df - 1) from that angle to a right angle.  It is taken up to
    where the integrand has fallen by e ** -45, on panels with Gauss-Legendre
    points, relative to its value at the angle, so small p keep their digits.
    """
    if t is None or df is None or df <= 0 or math.isnan(t):
        return None
    if math.isinf(t):
        return 0.0
    angle = math.atan(abs(t) / math.sqrt(df))
    start, power = math.cos(angle), df - 1.0
    end = math.acos(start * math.exp(-45.0 / power)) if power > 0 else math.pi / 2
    points, weights = np.polynomial.legendre.leggauss(32)
    edges = np.linspace(angle, end, 33)
    half = np.diff(edges)[:, None] / 2
    phi = edges[:-1, None] + half * (points + 1)
    tail = float((half * weights * np.exp(power * (np.log(np.cos(phi)) - math.log(start)))).sum())
    scale = math.lgamma((df + 1) / 2) - math.lgamma(df / 2) + power * math.log(start)
    return min(1.0, 2.0 / math.sqrt(math.pi) * math.exp(scale) * tail)


def _x(c) -> Column:
    return finite_or_null(F.col(c).cast("double"))


# ----------------------------------------------------------- correlation --

def corr_matrix(df: DataFrame, cols: Sequence[str], missing: str = "pairwise") -> DataFrame:
    """Pearson r for every ordered pair (x, y), long form.

    ``pairwise``: each pair uses the rows where both are present;
    ``complete``: rows with any gap are dropped first.  A constant column
    gives NULL instead of a division error (ANSI).  All pairs come from one
    pass (``moments.pair_moments``).
    """
    cols = list(cols)
    d = df.select(*[_x(c).alias(c) for c in cols])
    if missing == "complete":
        d = d.dropna()
    r = pair_moments(d, cols).correlation()
    rows = [(a, b, None if math.isnan(r[i, j]) else float(r[i, j])) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "x string, y string, r double")


def corr_pair(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson r over finite pairs; NULL with fewer than 2 pairs."""
    xa, ya = _x(x), _x(y)
    ok = xa.isNotNull() & ya.isNotNull()
    a, b = F.when(ok, xa), F.when(ok, ya)
    return df.agg(F.count(a).alias("n"),
                  F.when(F.count(a) >= 2, F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))).alias("r"))


def pearson_test_fit(df: DataFrame, x: str, y: str, with_p: bool = True) -> DataFrame:
    """r, two-sided p, least-squares slope / intercept and the x range over
    pairs where both are present."""
    xa, ya = _x(x), _x(y)
    ok = xa.isNotNull() & ya.isNotNull()
    a, b = F.when(ok, xa), F.when(ok, ya)
    out = df.agg(F.count(a).alias("n"),
                 F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)).alias("r"),
                 F.try_divide(F.covar_pop(a, b), F.var_pop(a)).alias("slope"),
                 F.avg(b).alias("_my"), F.avg(a).alias("_mx"), F.min(a).alias("x_min"), F.max(a).alias("x_max"))
    out = out.withColumn("intercept", F.col("_my") - F.col("slope") * F.col("_mx")).drop("_my", "_mx")
    if not with_p:
        return out
    row = out.first()
    n, r = row["n"], row["r"]
    p = None
    if r is not None and n is not None and n > 2:
        t = math.inf if abs(r) >= 1 else r * math.sqrt((n - 2) / (1 - r * r))
        p = t_two_sided_p(t, n - 2)
    return out.withColumn("p", F.lit(p).cast("double"))


def skewness_adj(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Adjusted Fisher-Pearson skewness (as pandas ``skew``) per column."""
    cols = list(cols)
    aggs, rows = [], []
    for i, c in enumerate(cols):
        x = _x(c)
        aggs += [F.skewness(x).alias(f"g{i}"), F.count(x).alias(f"n{i}")]
        rows.append(F.struct(F.lit(c).alias("column"),
                             (F.col(f"g{i}") * skew_adjust_factor(F.col(f"n{i}"))).alias("skew")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def acf(series: DataFrame, date: str, value: str, lags: int = 30) -> DataFrame:
    """corr(x_t, x_{t+k}) for k = 1..lags (lag 0 = 1) with the +-1.96/sqrt(n)
    band, over the rows in the order of ``date``, in blocks of consecutive
    rows (``ordering.over_rows``)."""
    from pansift.operators.ordering import over_rows
    rows = series.select(F.col(date).alias("t"), _x(value).alias("x"))
    lagged = over_rows(rows, "t", lags, lambda w: {f"l{k}": F.lag("x", k).over(w) for k in range(1, lags + 1)})
    ex = {"n": F.count("x")}
    for k in range(1, lags + 1):
        a = F.when(F.col(f"l{k}").isNotNull(), F.col("x"))
        b = F.when(F.col("x").isNotNull(), F.col(f"l{k}"))
        ex[f"c{k}"] = F.when(F.count(a) >= 2, F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)))
        ex[f"m{k}"] = F.count(a)
    st = fit_row(lagged, ex)
    n = st["n"] or 0
    band = 1.96 / math.sqrt(n) if n else None
    rows = [(0, 1.0, band)] + [(k, st[f"c{k}"], band) for k in range(1, lags + 1) if (st[f"m{k}"] or 0) >= 2]
    return series.sparkSession.createDataFrame(rows, "lag int, acf double, band double")


# ------------------------------------------------------ linear models --

def vif(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Variance inflation factors (regression with a constant) over complete
    rows: the squared row lengths of the inverse of the scaled triangular
    factor (``tallskinny``); sorted at the sink.  Features that depend on
    each other exactly, or do not vary, give infinity for all."""
    feats = list(features)
    r = qr_factor(df, feats).scaled()
    sizes = np.linalg.svd(r, compute_uv=False) if feats else np.zeros(0)
    if not len(sizes) or sizes[-1] <= FLAT * sizes[0]:
        diag = [float("inf")] * len(feats)
    else:
        diag = [float(x) for x in (np.linalg.inv(r) ** 2).sum(axis=1)]
    rows = sorted([(f, diag[i]) for i, f in enumerate(feats)], key=lambda r: -r[1])
    return df.sparkSession.createDataFrame(rows, "feature string, vif double")


def treatment_dummies(df: DataFrame, categorical: Sequence[str]) -> tuple[DataFrame, list]:
    """Treatment coding: sorted levels, first level dropped, 0/1 columns."""
    from pansift.operators.clean import _levels
    levels = _levels(df, list(categorical))
    names, ex = [], {}
    for c in categorical:
        for k, v in enumerate(levels[c][1:], 2):
            nm = re.sub(r"[^0-9A-Za-z_]", "_", f"{c}_T_{v}")
            if nm in ex or nm in df.columns:   # levels that differ in signs only: the level's number tells them apart
                nm = f"{nm}_{k}"
            ex[nm] = F.when(F.col(c).isNull(), None).otherwise((F.col(c).cast("string") == F.lit(v)).cast("double"))
            names.append(nm)
    return df.withColumns(ex), names


class OLSFit:
    """OLS with intercept from the triangular factor of the centred columns."""

    def __init__(self, df: DataFrame, y: str, xs: Sequence[str]):
        self.y, self.xs = y, list(xs)
        fit = qr_factor(df, [*self.xs, y])
        n, k = fit.n, len(self.xs)
        self.n, self.p, self.mx = n, k + 1, fit.mean[:k]
        length = fit.lengths()
        scale = np.where(length[:k] > 0, length[:k], 1.0)
        u, d, v = np.linalg.svd(np.where(length[:k] > 0, fit.r[:k, :k] / scale, 0.0), full_matrices=False)
        good = d > FLAT * max(d.max(initial=0.0), 1e-300)
        inverse = (v.T[:, good] / d[good]) @ u.T[good] / scale[:, None]   # of r, least lengths if columns depend on each other
        self.sxx_inv = inverse @ inverse.T
        self.beta = inverse @ fit.r[:k, k]
        self.intercept = float(fit.mean[k] - self.beta @ self.mx)
        rest = fit.r[:, k] - fit.r[:, :k] @ self.beta
        self.sse, self.sst = float(rest @ rest), float(fit.r[:, k] @ fit.r[:, k])
        self.dof = n - self.p
        self.s2 = self.sse / self.dof if self.dof > 0 else float("nan")
        self.r2 = 1.0 - self.sse / self.sst if self.sst > 0 else float("nan")
        self.adj_r2 = 1.0 - (1 - self.r2) * (n - 1) / self.dof if self.dof > 0 else float("nan")

    def table(self) -> list:
        se_b = np.sqrt(np.maximum(self.s2 * np.diag(self.sxx_inv), 0.0))
        se_0 = math.sqrt(max(self.s2 * (1.0 / self.n + self.mx @ self.sxx_inv @ self.mx), 0.0))
        rows = []
        for term, coef, se in [("Intercept", self.intercept, se_0)] + list(zip(self.xs, self.beta, se_b)):
            t = coef / se if se > 0 else float("nan")
            pv = t_two_sided_p(float(t), float(self.dof))
            rows.append((term, float(coef), float(se), float(t), None if pv is None else float(pv)))
        return rows


def ols_summary(df: DataFrame, y: str, numeric: Sequence[str], categorical: Sequence[str] = ()) -> DataFrame:
    """Coefficients, standard errors, t, p, R^2 and adjusted R^2 for
    ``y ~ C(cat) + numeric`` over complete rows (present and finite)."""
    d, dummies = treatment_dummies(complete(df, [y, *numeric], categorical), categorical)
    fit = OLSFit(d, y, dummies + list(numeric))
    rows = [r + (float(fit.r2), float(fit.adj_r2), int(fit.n)) for r in fit.table()]
    return df.sparkSession.createDataFrame(
        rows, "term string, coef double, se double, t double, p double, r2 double, adj_r2 double, n bigint")


def influence(df: DataFrame, y: str, numeric: Sequence[str], categorical: Sequence[str] = (),
              keys: Sequence[str] = ()) -> DataFrame:
    """Per row: leverage, residual, internal / external studentised residual,
    Cook's D, DFFITS and DFBETAS, plus the 4/n and 2p/n thresholds.  Rows are
    those of the fit: values present and finite."""
    d, dummies = treatment_dummies(complete(df, [y, *numeric], categorical), categorical)
    xs = dummies + list(numeric)
    fit = OLSFit(d, y, xs)
    n, p, s2, dof = fit.n, fit.p, fit.s2, fit.dof
    A = fit.sxx_inv
    # each row is an array, so the plan has a few expressions whatever the number of regressors
    def times(u, v):
        return F.aggregate(F.zip_with(u, v, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)

    def row(values):
        return F.array(*[F.lit(float(v)) for v in values])
    out = d.select(*keys, *xs, y).withColumn("_x", F.array(*[F.col(c).cast("double") - F.lit(float(m)) for c, m in zip(xs, fit.mx)]))
    out = out.withColumn("_ax", F.transform(F.array(*[row(a) for a in A]), lambda a: times(a, F.col("_x"))))
    out = out.withColumn("leverage", F.lit(1.0 / n) + times(F.col("_ax"), F.col("_x")))
    pred = F.lit(float(fit.intercept + fit.beta @ fit.mx)) + times(row(fit.beta), F.col("_x"))
    out = out.withColumn("resid", F.col(y).cast("double") - pred)
    out = out.withColumn("student_resid_internal", F.col("resid") / F.sqrt(F.lit(s2) * (1 - F.col("leverage"))))
    s2_i = (F.lit(dof * s2) - F.col("resid") * F.col("resid") / (1 - F.col("leverage"))) / F.lit(dof - 1)
    out = out.withColumn("_s_i", F.sqrt(s2_i))
    out = out.withColumn("student_resid_external", F.col("resid") / (F.col("_s_i") * F.sqrt(1 - F.col("leverage"))))
    out = out.withColumn("cooks_d", F.col("student_resid_internal") ** 2 * F.col("leverage") / (F.lit(p) * (1 - F.col("leverage"))))
    out = out.withColumn("dffits", F.col("student_resid_external") * F.sqrt(F.col("leverage") / (1 - F.col("leverage"))))
    out = out.withColumn("dffits_internal",
                         F.col("student_resid_internal") * F.sqrt(F.col("leverage") / (1 - F.col("leverage"))))
    # DFBETAS for slopes: (A x)_j e / (1 - h) / (s_(i) sqrt(A_jj))
    scaled = F.col("resid") / (1 - F.col("leverage")) / F.col("_s_i")
    ex = {f"dfbetas_{c}": F.col("_ax")[j] * scaled / F.lit(math.sqrt(max(A[j, j], 1e-300))) for j, c in enumerate(xs)}
    # intercept: row 0 of (X'X)^-1 x_i is 1/n - m'A (x_i - m); its diagonal entry is 1/n + m'A m
    ax0 = F.lit(1.0 / n) - times(row(fit.mx), F.col("_ax"))
    d00 = 1.0 / n + float(fit.mx @ A @ fit.mx)
    ex["dfbetas_Intercept"] = ax0 * scaled / F.lit(math.sqrt(max(d00, 1e-300)))
    out = out.withColumns(ex).drop("_s_i", "_x", "_ax")
    return out.withColumns({"cooks_threshold": F.lit(4.0 / n), "leverage_threshold": F.lit(2.0 * p / n)})


def top_influential(infl: DataFrame, k: int = 10, by: str = "cooks_d") -> DataFrame:
    """k rows with the largest Cook's distance (a top-k report)."""
    return infl.orderBy(F.desc_nulls_last(by)).limit(k)


def pca_2d(df: DataFrame, cols: Sequence[str], k: int = 2, keys: Sequence[str] = ()) -> tuple[DataFrame, list]:
    """Standardise (ddof 0) over complete rows (present and finite), project on the
    top-k principal axes, the right singular vectors of the scaled triangular
    factor; returns (scores, explained variance ratios).  Each axis
    is signed so its largest-magnitude loading is positive."""
    cols = list(cols)
    fit = qr_factor(df, cols)
    mean, sd = fit.mean, fit.lengths() / math.sqrt(max(fit.n, 1))
    sd[sd == 0] = 1.0
    sizes, axes = np.linalg.svd(fit.scaled())[1:]
    ratios = [float(v) for v in (sizes ** 2 / max((sizes ** 2).sum(), 1e-300))[:k]]
    vecs = axes.T
    d = complete(df, cols)
    ex = {}
    for comp in range(k):
        v = vecs[:, comp]
        if v[np.argmax(np.abs(v))] < 0:
            v = -v
        ex[f"pc{comp + 1}"] = sum((F.lit(float(w)) * (F.col(c).cast("double") - F.lit(float(m))) / F.lit(float(s))
                                   for w, c, m, s in zip(v, cols, mean, sd)), F.lit(0.0))
    return d.select(*keys, *[e.alias(nm) for nm, e in ex.items()]), ratios
