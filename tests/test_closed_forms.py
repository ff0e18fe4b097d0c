"""Closed-form and property checks for the non-SQL operators."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pansift.operators import clean as CL
from pansift.operators import stats as ST
from pansift.operators import viewdata as V


@pytest.fixture(scope="module")
def ols_frame(spark):
    rng = np.random.default_rng(1)
    n = 120
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    g = np.where(np.arange(n) % 3 == 0, "a", np.where(np.arange(n) % 3 == 1, "b", "c"))
    y = 1.5 + 2 * x1 - x2 + (g == "b") * 0.5 + rng.normal(scale=0.5, size=n)
    pdf = pd.DataFrame({"id": np.arange(n), "y": y, "x1": x1, "x2": x2, "g": g})
    return spark.createDataFrame(pdf), pdf


def test_ols_matches_numpy_and_leverages_sum_to_p(spark, ols_frame):
    df, pdf = ols_frame
    X = np.column_stack([np.ones(len(pdf)), (pdf.g == "b").astype(float), (pdf.g == "c").astype(float), pdf.x1, pdf.x2])
    beta, *_ = np.linalg.lstsq(X, pdf.y, rcond=None)
    tab = {r["term"]: r for r in ST.ols_summary(df, "y", ["x1", "x2"], ["g"]).collect()}
    assert abs(tab["Intercept"]["coef"] - beta[0]) < 1e-8
    assert abs(tab["x1"]["coef"] - beta[3]) < 1e-8 and abs(tab["g_T_b"]["coef"] - beta[1]) < 1e-8
    H = X @ np.linalg.inv(X.T @ X) @ X.T
    infl = ST.influence(df, "y", ["x1", "x2"], ["g"], keys=["id"]).orderBy("id").toPandas()
    assert abs(infl["leverage"].sum() - 5) < 1e-8
    assert np.allclose(infl["leverage"], np.diag(H), atol=1e-10)
    resid = pdf.y - X @ beta
    s2 = resid @ resid / (len(pdf) - 5)
    cooks = resid ** 2 / (5 * s2) * np.diag(H) / (1 - np.diag(H)) ** 2
    assert np.allclose(infl["cooks_d"], cooks, atol=1e-9)
    h = np.diag(H)
    resid = np.asarray(resid, dtype=float)
    XtXi = np.linalg.inv(X.T @ X)
    s_i = np.sqrt(((len(pdf) - 5) * s2 - resid ** 2 / (1 - h)) / (len(pdf) - 6))
    dfb = (XtXi @ X.T).T * (resid / (1 - h))[:, None] / (s_i[:, None] * np.sqrt(np.diag(XtXi))[None, :])
    for j, name in enumerate(["Intercept", "g_T_b", "g_T_c", "x1", "x2"]):
        assert np.allclose(infl[f"dfbetas_{name}"], dfb[:, j], atol=1e-9), name


def test_vif_orthogonal_is_one(spark):
    rows = [(1.0, 1.0), (1.0, -1.0), (-1.0, 1.0), (-1.0, -1.0)]
    out = ST.vif(spark.createDataFrame(rows, "a double, b double"), ["a", "b"]).collect()
    assert all(abs(r["vif"] - 1.0) < 1e-12 for r in out)


def test_t_pvalue_known_values():
    # t = 2.0 with 10 dof: two-sided p = 0.07338803477...
    assert abs(ST.t_two_sided_p(2.0, 10) - 0.0733880347707) < 1e-9
    assert abs(ST.t_two_sided_p(0.0, 5) - 1.0) < 1e-12


def test_box_cox_lambda_lognormal_near_zero(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(float(v),) for v in rng.lognormal(size=3000)], "x double")
    lam = CL.box_cox(df, "x", eps=0.0).first()["_boxcox_lambda_x"]
    assert abs(lam) < 0.06


def test_yeo_johnson_symmetric_lambda_near_one(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(float(v),) for v in rng.normal(size=3000)], "x double")
    lam = CL.yeo_johnson_fit(df, ["x"])["x"]
    assert abs(lam - 1.0) < 0.1
    z = CL.yeo_johnson(df, ["x"]).toPandas()["x"]
    assert abs(z.mean()) < 1e-9 and abs(z.std(ddof=0) - 1) < 1e-9


def test_winsorize_rank_order_statistics(spark):
    vals = list(range(1, 201))  # n = 200, k = 2
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,)], "x double")
    out = [r["x_wins"] for r in CL.winsorize_rank(df, ["x"], 0.01).collect()]
    assert min(v for v in out if v is not None) == 3.0 and max(v for v in out if v is not None) == 198.0
    assert out[-1] is None


def test_kde_close_to_exact(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=2000)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = V.kde(df, "x").orderBy("i").toPandas()
    q1, q3 = np.percentile(x, [25, 75])
    bw = 0.9 * min(x.std(ddof=1), (q3 - q1) / 1.34) * len(x) ** -0.2
    g = got["x"].to_numpy()
    exact = np.exp(-0.5 * ((g[:, None] - x[None, :]) / bw) ** 2).sum(axis=1) / (len(x) * bw * math.sqrt(2 * math.pi))
    assert np.max(np.abs(got["density"].to_numpy() - exact)) < 1e-5


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (10.0,)], "x double")
    h = {r["bin"]: r["count"] for r in V.histogram(df, "x", 5).collect()}
    assert h == {0: 2, 1: 1, 4: 1}  # width 2: [0,2) [2,4) ... [8,10]


def test_zscore_and_minmax_properties(spark):
    df = spark.createDataFrame([(float(v), 1.0) for v in [3, 7, 1, 9, 4]], "x double, c double")
    z = CL.scale_zscore(df, ["x", "c"]).toPandas()
    assert abs(z["x"].mean()) < 1e-12 and abs(z["x"].std(ddof=1) - 1) < 1e-12 and (z["c"] == 1.0).all()
    m = CL.scale_minmax(df, ["x"]).toPandas()
    assert m["x"].min() == 0.0 and m["x"].max() == 1.0


def test_ffill_never_changes_present_values(spark):
    from pansift.operators.timeseries import bfill_ffill, ffill
    df = spark.createDataFrame([("A", i, v) for i, v in enumerate([None, 1.0, None, None, 4.0, None])],
                               "e string, d int, x double")
    f = [r["x"] for r in ffill(df, "e", "d", ["x"]).orderBy("d").collect()]
    b = [r["x"] for r in bfill_ffill(df, "e", "d", ["x"]).orderBy("d").collect()]
    assert f == [None, 1.0, 1.0, 1.0, 4.0, 4.0] and b == [1.0, 1.0, 4.0, 4.0, 4.0, 4.0]


def test_lags_do_not_look_ahead(spark):
    """Changing a value at t must not change lag / *_prev values at or before t."""
    from pansift.operators.timeseries import lag_features, rolling_mean_prev
    base = [("A", i, float(i)) for i in range(12)]
    changed = [(e, d, v + (100.0 if d >= 6 else 0.0)) for e, d, v in base]

    def feats(rows):
        df = spark.createDataFrame(rows, "e string, d int, x double")
        return rolling_mean_prev(lag_features(df, "e", "d", ["x"], [1, 2]), "e", "d", ["x"]).orderBy("d").toPandas()
    a, b = feats(base), feats(changed)
    cols = ["x_lag1", "x_lag2", "x_ma7_prev"]
    assert a.loc[a.d <= 6, cols].fillna(-1).equals(b.loc[b.d <= 6, cols].fillna(-1))


def test_rank_top_per_key_exact_with_hot_key(spark):
    from pansift.operators.timeseries import rank_top_per_key
    rows = [("hot", i) for i in range(5000)] + [("cold", i) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, v int")
    out = rank_top_per_key(df, "k", [F.desc("v")], 3).collect()
    got = sorted((r["k"], r["v"]) for r in out)
    assert got == [("cold", 0), ("cold", 1), ("cold", 2), ("hot", 4997), ("hot", 4998), ("hot", 4999)]


def _brute_knn(X, k):
    """Reference brute force: NaN-aware Euclidean, 1/d weights, zero-distance rule."""
    X = np.asarray(X, dtype=float)
    n, p = X.shape
    out = X.copy()
    for i in range(n):
        for j in range(p):
            if not np.isnan(X[i, j]):
                continue
            cands = []
            for m in range(n):
                if m == i or np.isnan(X[m, j]):
                    continue
                both = ~np.isnan(X[i]) & ~np.isnan(X[m])
                if not both.any():
                    continue
                d = math.sqrt(((X[i, both] - X[m, both]) ** 2).sum() * p / both.sum())
                cands.append((d, m, X[m, j]))
            cands.sort()
            top = cands[:k]
            if not top:
                out[i, j] = np.nanmean(X[:, j])
                continue
            if any(d == 0 for d, _, _ in top):
                ws = [1.0 if d == 0 else 0.0 for d, _, _ in top]
            else:
                ws = [1.0 / d for d, _, _ in top]
            out[i, j] = sum(w * v for w, (_, _, v) in zip(ws, top)) / sum(ws)
    return out


def test_knn_matches_brute_force(spark):
    from pansift.operators.knn import impute_knn
    rng = np.random.default_rng(7)
    X = rng.normal(size=(60, 4)).round(3)
    X[rng.random(X.shape) < 0.15] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in X[i]]) for i in range(len(X))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double").repartition(3)
    got = impute_knn(df, ["a", "b", "c", "d"], "id", k=5, chunk=25).orderBy("id").toPandas()
    exp = _brute_knn(X, 5)
    assert np.allclose(got[["a", "b", "c", "d"]].to_numpy(dtype=float), exp, atol=1e-9, equal_nan=True)


def _yj_np(x, lam):
    out = np.empty_like(x)
    pos = x >= 0
    out[pos] = np.log1p(x[pos]) if abs(lam) < 1e-12 else ((x[pos] + 1) ** lam - 1) / lam
    out[~pos] = -np.log1p(-x[~pos]) if abs(lam - 2) < 1e-12 else -((1 - x[~pos]) ** (2 - lam) - 1) / (2 - lam)
    return out


def test_lambda_matches_dense_numpy_search(spark):
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.gamma(2.0, 2.0, size=1500) - 1.0, rng.normal(size=500)])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    lam = CL.yeo_johnson_fit(df, ["x"])["x"]
    grid = np.linspace(-3, 3, 60001)
    jac = (np.sign(x) * np.log1p(np.abs(x))).sum()
    llf = [-len(x) / 2 * np.log(_yj_np(x, g).var()) + (g - 1) * jac for g in grid]
    assert abs(lam - grid[int(np.argmax(llf))]) < 2e-3
    xp = rng.lognormal(size=2000) * 3
    dfp = spark.createDataFrame([(float(v),) for v in xp], "x double")
    bl = CL.box_cox(dfp, "x", eps=0.0).first()["_boxcox_lambda_x"]
    lx = np.log(xp)
    llb = [-len(xp) / 2 * np.log(((xp ** g - 1) / g if abs(g) > 1e-12 else lx).var()) + (g - 1) * lx.sum() for g in grid]
    assert abs(bl - grid[int(np.argmax(llb))]) < 2e-3


def test_dedupe_hot_key_exact(spark):
    """A third of all rows share one key: keep-first still returns its first row."""
    from pansift.operators.timeseries import dedupe_keep_first
    rows = [("hot", 1000 - i, f"v{i}") for i in range(3000)] + [(f"k{i}", i, f"w{i}") for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, o int, v string").repartition(8)
    out = dedupe_keep_first(df, ["k"], ["o"])
    assert out.count() == 6001
    assert out.where("k = 'hot'").first()["v"] == "v2999"  # smallest o = 1000 - 2999


def test_majority_map_ties_smallest_label(spark):
    from pansift.operators.aggregate import majority_map
    rows = [(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, "c"), (2, None), (None, "a")]
    df = spark.createDataFrame(rows, "zip long, borough string")
    got = {r["zip"]: r["borough"] for r in majority_map(df, "zip", "borough").collect()}
    assert got == {1: "A", 2: "C"}


def test_knn_block_by_matches_brute_force_per_block(spark):
    from pansift.operators.knn import impute_knn
    rng = np.random.default_rng(9)
    X = rng.normal(size=(80, 3)).round(3)
    X[rng.random(X.shape) < 0.15] = np.nan
    g = np.where(np.arange(80) % 2 == 0, "A", "B")
    rows = [(i, str(g[i]), *[None if np.isnan(v) else float(v) for v in X[i]]) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, g string, a double, b double, c double").repartition(4)
    got = impute_knn(df, ["a", "b", "c"], "id", k=3, block_by="g").orderBy("id").toPandas()
    exp = np.empty_like(X)
    for blk in ("A", "B"):
        m = g == blk
        exp[m] = _brute_knn(X[m], 3)
    assert np.allclose(got[["a", "b", "c"]].to_numpy(dtype=float), exp, atol=1e-9, equal_nan=True)


def test_knn_ties_go_by_key_whatever_the_partitions(spark):
    from pansift.operators.knn import impute_knn, knn_donor_join
    rows = [(i, 1.0, float(i)) for i in range(40)] + [(100, 1.0, None), (101, None, None)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    for parts in (1, 7, 50):
        d = df.repartition(parts)
        best = [(r["did"], r["rank"]) for r in knn_donor_join(d, ["a", "b"], "id", 5, chunk=9).where("rid = 100").orderBy("rank").collect()]
        assert best == [(i, i + 1) for i in range(5)]
        got = {r["id"]: (r["a"], r["b"]) for r in impute_knn(d, ["a", "b"], "id", 5, chunk=9).where("id >= 100").collect()}
        assert got == {100: (1.0, 2.0), 101: (1.0, 19.5)}   # nothing in common with any row: the mean


@pytest.mark.parametrize("true", [6.0, -5.0])
def test_lambda_search_has_no_bounds(spark, true):
    x = np.random.default_rng(3).normal(10, 1, 2000) ** (1 / true)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = CL.box_cox(df, "x", eps=0.0).first()["_boxcox_lambda_x"]
    grid = np.arange(true - 4, true + 4, 0.001)
    llf = [-len(x) / 2 * np.log(((x ** g - 1) / g if abs(g) > 1e-9 else np.log(x)).var()) + (g - 1) * np.log(x).sum() for g in grid]
    assert abs(got - grid[int(np.argmax(llf))]) < 2e-3


def test_quantiles_are_exact_and_never_gather_a_column(spark):
    from pansift.operators.quantiles import quantile_fit, quantile_table
    from pyspark.sql import functions as F
    rng = np.random.default_rng(5)
    rows = [(int(k % 3) if k % 11 else None, float(np.round(rng.normal(), 2)) if k % 7 else None, float(k % 2 == 0 and k < 3000),
             float(rng.random())) for k in range(6000)]
    df = spark.createDataFrame(rows, "g int, a double, hot double, many double").repartition(5)
    qs = [0.0, 0.05, 0.25, 0.5, 0.9, 1.0]
    want = df.agg(*[F.percentile(c, qs).alias(c) for c in ("a", "hot", "many")]).first()
    got = quantile_fit(df, ["a", "hot", "many"], qs)
    assert all(np.allclose(got[c], want[c], rtol=1e-12) for c in ("a", "hot", "many"))
    by = {r["g"]: r["values"] for r in quantile_table(df, ["a"], qs, ["g"]).collect()}
    assert len(by) == 4
    for r in df.groupBy("g").agg(F.percentile("a", qs).alias("w")).collect():
        assert np.allclose(by[r["g"]], r["w"], rtol=1e-12)
    empty = quantile_fit(df.where("a > 99"), ["a"], [0.5])
    assert empty == {"a": None}


def test_missing_labels_give_zero_flags(spark):
    from pansift.operators.aggregate import event_indicators
    from pansift.operators.features import type_flags
    df = spark.createDataFrame([("x", "2024-01-01", "B", None), ("y", "2024-01-01", "B", None)],
                               "title string, date string, borough string, type string")
    for contains in (False, True):
        assert type_flags(df, "type", {"p": "parade"}, contains).agg({"p": "sum"}).first()[0] == 0
    r = event_indicators(df).first()
    assert (r["event_count"], r["event_has_parade"], r["event_has_holiday"]) == (2, 0, 0)


def test_listing_missing_room_type_counts_as_not_entire(spark):
    from pansift.operators.aggregate import listing_metrics
    rows = [(1, "A", "$100", "Entire home"), (2, "A", "$50", None), (3, "A", "$20,000", "Entire home")]
    df = spark.createDataFrame(rows, "id long, neighbourhood_group string, price string, room_type string")
    r = listing_metrics(df, "borough").first()
    assert r["airbnb_listing_count"] == 2 and r["airbnb_entire_home_pct"] == 0.5 and r["airbnb_price_mean"] == 75.0


def test_approx_switches_close_to_exact(spark):
    from pansift.operators.aggregate import group_summary
    from pansift.operators.viewdata import kde
    rng = np.random.default_rng(12)
    rows = [("g%d" % (i % 3), float(v)) for i, v in enumerate(rng.normal(size=6000))]
    df = spark.createDataFrame(rows, "g string, x double")
    exact = {r["g"]: r["median"] for r in group_summary(df, "g", "x").collect()}
    approx = {r["g"]: r["median"] for r in group_summary(df, "g", "x", approx=True).collect()}
    assert all(abs(exact[g] - approx[g]) < 0.01 for g in exact)
    a = kde(df, "x", approx=True).orderBy("i").toPandas()["density"].to_numpy()
    e = kde(df, "x").orderBy("i").toPandas()["density"].to_numpy()
    assert np.max(np.abs(a - e)) < 1e-2


def test_rolling_and_acf_over_blocks(spark):
    from pyspark.sql import functions as F
    from pansift.operators.ordering import numbered, over_rows
    n = 500
    x = [None if i % 13 == 0 else float((i * 37) % 101) for i in range(n)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "t int, x double").repartition(7)
    assert all(r["_row"] == r["t"] for r in numbered(df, "t").collect())
    want = pd.Series(x, dtype=float).rolling(7, min_periods=3).mean()
    for block in (10, 64, 1000):
        got = over_rows(df, "t", 6, lambda w: {"m": F.when(F.count("x").over(w.rowsBetween(-6, 0)) >= 3, F.avg("x").over(w.rowsBetween(-6, 0)))}, block)
        got = got.orderBy("t").toPandas()
        assert len(got) == n and np.allclose(got["m"], want, equal_nan=True)
