"""QR factors of tall, narrow tables.

Every task reduces its rows to one triangular factor, batch by batch; factors
merge in groups of tasks and then on the driver, which gets at most ``GROUPS``
of them, p x p each, however many rows there are.  Coefficients, leverages, VIF and
axes all follow from the factor of the centred columns, whose condition number is
that of the data; moments would have its square, and lose twice the digits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pansift.functions.numeric import finite_or_null
from pansift.session import ship_package

#: Groups of tasks whose factors merge.
GROUPS = 64
#: Relative size below which a direction is rounding.
FLAT = 1e-13


@dataclass
class Factor:
    """``n`` rows, column ``mean``, and ``r``: upper triangular, with
    ``r.T @ r`` the centred cross products."""
    n: int
    mean: np.ndarray
    r: np.ndarray

    def lengths(self) -> np.ndarray:
        """Centred length of each column; 0 for one that does not vary."""
        length = np.sqrt((self.r ** 2).sum(axis=0))
        return np.where(length > FLAT * np.sqrt(max(self.n, 1)) * np.abs(self.mean), length, 0.0)

    def scaled(self) -> np.ndarray:
        """``r`` with columns of length 1 (0 for those that do not vary)."""
        length = self.lengths()
        return np.divide(self.r, length, out=np.zeros_like(self.r), where=length > 0)


def complete(df: DataFrame, numeric: Sequence[str], others: Sequence[str] = ()) -> DataFrame:
    """Rows whose ``numeric`` columns are present and finite and whose other
    columns are present: the rows that a fit sees and that results are about."""
    cond = F.lit(True)
    for c in numeric:
        cond = cond & finite_or_null(F.col(c).cast("double")).isNotNull()
    for c in others:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def _reduced(blocks: Iterator[np.ndarray], p: int) -> np.ndarray:
    r = np.zeros((0, p))
    for x in blocks:
        r = np.linalg.qr(np.vstack([r, x]), mode="r")
    return r


def qr_factor(df: DataFrame, cols: Sequence[str]) -> Factor:
    """The factor of the complete rows of ``cols``.  Without rows: zeros."""
    ship_package(df.sparkSession)
    cols, p = list(cols), len(cols) + 1
    x = complete(df, cols).select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])

    def factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0

        def rows():
            nonlocal n
            for b in batches:
                n += b.num_rows
                yield np.column_stack([np.ones(b.num_rows), *[c.to_numpy(zero_copy_only=False) for c in b.columns]])
        r = _reduced(rows(), p)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([r.tobytes()], pa.binary())], names=["n", "r"])

    def merge(g: pd.DataFrame) -> pd.DataFrame:
        r = _reduced((np.frombuffer(b, float).reshape(-1, p) for b in g["r"]), p)
        return pd.DataFrame({"n": [int(g["n"].sum())], "r": [r.tobytes()]})

    parts = (x.mapInArrow(factor, "n long, r binary").groupBy(F.pmod(F.xxhash64("r"), F.lit(GROUPS)).alias("g"))
             .applyInPandas(merge, "n long, r binary").orderBy("n", "r").collect())
    if not parts:
        return Factor(0, np.zeros(p - 1), np.zeros((p - 1, p - 1)))
    r = _reduced((np.frombuffer(bytes(x["r"]), float).reshape(-1, p) for x in parts), p)
    full = np.zeros((p, p))
    full[:len(r)] = r
    # the first column is constant: its row holds the means, the rest is orthogonal to it
    return Factor(sum(x["n"] for x in parts), full[0, 1:] / full[0, 0], full[1:, 1:])
