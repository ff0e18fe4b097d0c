"""Pruned KNN against brute force, and how much it prunes."""

import numpy as np
import pandas as pd
import pytest

from pansift.operators import knn


def rows_of(spark, x, blocks=None, parts=5):
    pdf = pd.DataFrame(x, columns=[f"c{j}" for j in range(x.shape[1])]).astype(object).where(lambda d: d.notna(), None)
    pdf.insert(0, "id", np.arange(len(x)))
    pdf["g"] = [None] * len(x) if blocks is None else blocks
    schema = "id long, " + ", ".join(f"c{j} double" for j in range(x.shape[1])) + ", g string"
    return spark.createDataFrame(list(pdf.itertuples(index=False, name=None)), schema).repartition(parts)


def brute(x, k, blocks=None):
    out = set()
    p = x.shape[1]
    for i in range(len(x)):
        for j in np.flatnonzero(np.isnan(x[i])):
            near = []
            for m in np.flatnonzero(~np.isnan(x[:, j])):
                if blocks is not None and blocks[m] != blocks[i]:
                    continue
                both = ~np.isnan(x[i]) & ~np.isnan(x[m])
                if both.any():
                    near.append((float(np.sqrt(((x[i, both] - x[m, both]) ** 2).sum() * p / both.sum())), int(m)))
            out |= {(i, int(j), m, r + 1, round(d, 9)) for r, (d, m) in enumerate(sorted((round(d, 12), m) for d, m in near)[:k])}
    return out


def found(df):
    return {(r.rid, r.col, r.did, r["rank"], round(r.d, 9)) for r in df.collect()}


def clustered(n, p, centres, gaps, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(centres, p))[rng.integers(0, centres, n)] * 100 + rng.normal(size=(n, p))
    x = x.round(4)
    x[rng.random(x.shape) < gaps] = np.nan
    return x


@pytest.mark.parametrize("gaps", [0.02, 0.4])
def test_equal_to_brute_force(spark, monkeypatch, gaps):
    monkeypatch.setattr(knn, "LOT", 3)  # several lots of boxes
    x = clustered(160, 4, 6, gaps)
    x[5] = np.nan  # nothing in common with any row
    x[:, 3] = np.where(np.arange(160) < 3, x[:, 3], np.nan)  # fewer donors than k
    assert found(knn.knn_donor_join(rows_of(spark, x), [f"c{j}" for j in range(4)], "id", 5, chunk=9)) == brute(x, 5)


def test_blocks_scales_and_ties(spark):
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.integers(0, 3, 90), rng.integers(0, 3, 90) * 1e6, rng.random(90) * 1e-3]).astype(float)
    x[rng.random(x.shape) < 0.2] = np.nan
    blocks = [["a", "b", None][k % 3] for k in range(90)]
    got = found(knn.knn_donor_join(rows_of(spark, x, blocks), ["c0", "c1", "c2"], "id", 4, block_by="g", chunk=7))
    assert got == brute(x, 4, ["" if b is None else b for b in blocks])


def test_most_pairs_are_pruned(spark):
    """Clustered rows: few pairs of chunks are met, and none is missed."""
    x = clustered(6000, 3, 40, 0.03)
    report: dict = {}
    df = rows_of(spark, x)
    got = knn.knn_donor_join(df, ["c0", "c1", "c2"], "id", 5, chunk=100, report=report).toPandas()
    assert report["met"] < 0.15 * report["pairs"]
    some = np.flatnonzero(np.isnan(x).any(axis=1))[::25]
    for i in some:
        for j in np.flatnonzero(np.isnan(x[i])):
            both = ~np.isnan(x[i]) & ~np.isnan(x)
            n = both.sum(axis=1)
            with np.errstate(divide="ignore", invalid="ignore"):
                d = np.sqrt(np.where(both, (x - x[i]) ** 2, 0).sum(axis=1) * 3 / n)
            d[(n == 0) | np.isnan(x[:, j])] = np.inf
            mine = got[(got.rid == i) & (got.col == j)].sort_values("rank")
            assert np.allclose(mine.d, np.sort(d)[:5][np.isfinite(np.sort(d)[:5])], rtol=1e-9)


def test_bounds_never_exceed_a_distance():
    rng = np.random.default_rng(1)
    for _ in range(30):
        p = 4
        sets = []
        for _ in range(2):
            x = rng.normal(size=(6, p)) * 5 + rng.normal(size=p) * 10
            x[rng.random(x.shape) < rng.choice([0, 0.3, 0.8])] = np.nan
            sets.append(x)
        with np.errstate(all="ignore"):
            boxes = [knn._Boxes(pd.DataFrame({"of": [0], "n": [6], "held": [(~np.isnan(x)).sum(axis=0)],
                                              "low": [[None if np.isnan(c).all() else np.nanmin(c) for c in x.T]],
                                              "high": [[None if np.isnan(c).all() else np.nanmax(c) for c in x.T]]})) for x in sets]
        low = knn.box_distances(*boxes)[0][0, 0]
        for a in sets[0]:
            for b in sets[1]:
                both = ~np.isnan(a) & ~np.isnan(b)
                if both.any():
                    assert low <= np.sqrt(((a - b)[both] ** 2).sum() * p / both.sum())


def test_empty_and_complete(spark):
    x = clustered(20, 3, 2, 0.0)
    assert knn.knn_donor_join(rows_of(spark, x), ["c0", "c1", "c2"], "id").count() == 0
    assert knn.knn_donor_join(rows_of(spark, x).limit(0), ["c0"], "id").count() == 0
    lost = rows_of(spark, np.full((4, 2), np.nan))
    assert knn.knn_donor_join(lost, ["c0", "c1"], "id").count() == 0
    assert [tuple(r)[1:3] for r in knn.impute_knn(lost, ["c0", "c1"], "id").collect()] == [(None, None)] * 4
