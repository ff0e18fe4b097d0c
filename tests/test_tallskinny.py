"""Linear models from triangular factors against NumPy, on ill-conditioned data and with odd values."""

import numpy as np
import pytest

from pansift.operators import stats as ST
from pansift.operators import tallskinny


def frame(spark, x, y=None, extra=(), parts=6):
    names = [f"x{j}" for j in range(x.shape[1])] + ([] if y is None else ["y"])
    rows = [tuple(map(float, r)) for r in (x if y is None else np.column_stack([x, y]))] + list(extra)
    rows = [(i, *r) for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{n} double" for n in names)).repartition(parts)


@pytest.fixture(scope="module")
def nearly():
    """Columns of which the third is almost the sum of the first two, and a large mean."""
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=400), rng.normal(size=400)
    x = np.column_stack([a, b, a + b + 1e-6 * rng.normal(size=400), 1e6 + rng.normal(size=400)])
    return x, x @ np.array([1.0, -2.0, 0.5, 0.25]) + rng.normal(size=400)


ODD = [(float("inf"), 1.0, 1.0, 1.0, 1.0), (1.0, float("nan"), 1.0, 1.0, 1.0), (1.0, 1.0, None, 1.0, 1.0), (1.0, 1.0, 1.0, 1.0, float("-inf"))]


def test_factor(spark, nearly):
    x, _ = nearly
    got = tallskinny.qr_factor(frame(spark, x), ["x0", "x1", "x2", "x3"])
    centred = x - x.mean(axis=0)
    assert got.n == 400 and np.allclose(got.mean, x.mean(axis=0), rtol=1e-12)
    assert np.allclose(got.r.T @ got.r, centred.T @ centred, rtol=1e-9, atol=1e-7)
    assert np.allclose(np.linalg.svd(got.r, compute_uv=False), np.linalg.svd(centred, compute_uv=False), rtol=1e-6)
    assert tallskinny.qr_factor(frame(spark, x).limit(0), ["x0", "x1"]).n == 0
    few = tallskinny.qr_factor(frame(spark, x[:2]), ["x0", "x1", "x2"])  # fewer rows than columns
    assert few.n == 2 and np.allclose(few.r.T @ few.r, np.cov(x[:2, :3].T, bias=True) * 2)


def test_collinear_columns_keep_their_digits(spark, nearly):
    x, y = nearly
    df = frame(spark, x, y, ODD)
    full = np.column_stack([np.ones(len(x)), x - x.mean(axis=0)])
    beta, *_ = np.linalg.lstsq(full, y, rcond=None)
    fit = {r["term"]: r for r in ST.ols_summary(df, "y", ["x0", "x1", "x2", "x3"]).collect()}
    assert fit["x0"]["n"] == 400
    for j in range(4):
        assert fit[f"x{j}"]["coef"] == pytest.approx(beta[j + 1], rel=1e-8)
    resid = y - full @ beta
    assert fit["x0"]["r2"] == pytest.approx(1 - resid @ resid / ((y - y.mean()) ** 2).sum(), rel=1e-10)
    got = {r["feature"]: r["vif"] for r in ST.vif(frame(spark, x, y, ODD[:3]), ["x0", "x1", "x2", "x3"]).collect()}
    scaled = (x - x.mean(axis=0)) / np.sqrt(((x - x.mean(axis=0)) ** 2).sum(axis=0))
    want = (np.linalg.pinv(scaled) ** 2).sum(axis=1)
    for j in range(4):
        assert got[f"x{j}"] == pytest.approx(want[j], rel=1e-8)


def test_influence_and_axes_are_about_the_rows_of_the_fit(spark, nearly):
    x, y = nearly
    df = frame(spark, x, y, ODD)
    rows = ST.influence(df, "y", ["x0", "x1"], keys=["id"]).orderBy("id").collect()
    assert [r["id"] for r in rows] == [i for i in range(404) if i not in (400, 401, 403)]  # x2 is no regressor
    use = np.vstack([x[:, :2], [[1.0, 1.0]]])
    full = np.column_stack([np.ones(401), use])
    hat = np.einsum("ij,jk,ik->i", full, np.linalg.inv(full.T @ full), full)
    assert np.allclose([r["leverage"] for r in rows], hat, rtol=1e-8)
    scores, ratios = ST.pca_2d(df, ["x0", "x1", "x2", "x3"], 2, keys=["id"])
    got = np.array([(r["pc1"], r["pc2"]) for r in scores.orderBy("id").collect()], float)
    assert got.shape == (401, 2) and np.isfinite(got).all()
    z = np.vstack([x, [[1.0, 1.0, 1.0, 1.0]]])
    z = (z - z.mean(axis=0)) / z.std(axis=0)
    u, s, vt = np.linalg.svd(z, full_matrices=False)
    for c in range(2):
        v = vt[c] * np.sign(vt[c][np.argmax(np.abs(vt[c]))])
        assert np.allclose(got[:, c], z @ v, atol=1e-6)
        assert ratios[c] == pytest.approx(s[c] ** 2 / (s ** 2).sum(), rel=1e-9)
    # scores are uncorrelated, their variances the shares of the whole
    assert abs(np.corrcoef(got.T)[0, 1]) < 1e-9 and np.allclose(got.var(axis=0) / 4, ratios)


def test_dependent_and_constant_columns(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=50)
    x = np.column_stack([a, 2 * a, rng.normal(size=50), np.full(50, 7.0)])
    y = 3 * a + x[:, 2]
    df = frame(spark, x, y)
    assert {r["vif"] for r in ST.vif(df, ["x0", "x1"]).collect()} == {float("inf")}
    assert {r["vif"] for r in ST.vif(df, ["x0", "x3"]).collect()} == {float("inf")}
    fit = {r["term"]: r["coef"] for r in ST.ols_summary(df, "y", ["x0", "x1", "x2", "x3"]).collect()}
    assert fit["x0"] + 2 * fit["x1"] == pytest.approx(3) and fit["x2"] == pytest.approx(1) and fit["x3"] == 0
    scores, ratios = ST.pca_2d(df, ["x0", "x3"], 1, keys=["id"])
    assert ratios == [pytest.approx(1.0)] and scores.count() == 50
