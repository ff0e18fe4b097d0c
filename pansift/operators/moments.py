"""Second moments of many columns in one pass.

Each task keeps p x p sums over its rows, shifted by the column means, and
emits them once; a grouped sum adds them up.  The number of expressions does
not grow with the number of column pairs, and neither do scans.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pansift.operators._fit import fit_row
from pansift.session import ship_package

#: A variance below this share of the second moment is rounding, not spread.
FLAT = 1e-12


@dataclass
class Moments:
    """For columns i and j over the rows that have both: rows ``n``, sums of i
    (``s``), of its squares (``q``) and of the products (``c``); all after
    subtracting ``mean``.  Entry [i, j] of ``s`` and ``q`` is about i."""
    mean: np.ndarray
    flat: np.ndarray
    n: np.ndarray
    s: np.ndarray
    q: np.ndarray
    c: np.ndarray

    def covariance(self) -> np.ndarray:
        """Population covariances; columns of one value have none."""
        with np.errstate(divide="ignore", invalid="ignore"):
            cov = (self.c - self.s * self.s.T / self.n) / self.n
        cov = np.where(self.n > 0, cov, 0.0)
        cov[self.flat, :] = cov[:, self.flat] = 0.0
        return (cov + cov.T) / 2

    def correlation(self) -> np.ndarray:
        """Pearson r of each pair over its own rows; NaN without spread."""
        with np.errstate(divide="ignore", invalid="ignore"):
            spread = self.q - self.s * self.s / self.n
            spread = np.where((spread > FLAT * self.q) & ~self.flat[:, None], spread, np.nan)
            r = (self.c - self.s * self.s.T / self.n) / np.sqrt(spread * spread.T)
        return np.clip(r, -1.0, 1.0)


def pair_moments(df: DataFrame, cols: Sequence[str]) -> Moments:
    """Moments of the (double, NULL if missing) columns ``cols``."""
    ship_package(df.sparkSession)
    cols, p = list(cols), len(cols)
    st = fit_row(df, {**{f"m{i}": F.avg(F.col(f"`{c}`")) for i, c in enumerate(cols)},
                      **{f"a{i}": F.min(F.col(f"`{c}`")) for i, c in enumerate(cols)},
                      **{f"b{i}": F.max(F.col(f"`{c}`")) for i, c in enumerate(cols)}})
    mean = np.array([st[f"m{i}"] or 0.0 for i in range(p)])
    flat = np.array([st[f"a{i}"] is None or st[f"a{i}"] == st[f"b{i}"] for i in range(p)])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q, c = (np.zeros((p, p)) for _ in range(4))
        for batch in batches:
            x = np.column_stack([col.to_numpy(zero_copy_only=False).astype(float) for col in batch.columns]) - mean
            have = ~np.isnan(x)
            x[~have] = 0.0
            ones = have.astype(float)
            n += ones.T @ ones
            s += x.T @ ones
            q += (x * x).T @ ones
            c += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(p * p)), *[pa.array(a.ravel()) for a in (n, s, q, c)]],
                                         names=["cell", "n", "s", "q", "c"])

    sums = (df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)])
            .mapInArrow(blocks, "cell long, n double, s double, q double, c double")
            .groupBy("cell").agg(*[F.sum(x).alias(x) for x in "nsqc"]).collect())
    out = {x: np.zeros(p * p) for x in "nsqc"}
    for r in sums:
        for x in "nsqc":
            out[x][r["cell"]] = r[x]
    return Moments(mean, flat, *[out[x].reshape(p, p) for x in "nsqc"])
