"""Exact k-nearest-neighbour imputation with bounded pruning.

For every row with gaps (a *receiver*) and every missing column, the k
nearest rows that have that column (the *donors*) supply a distance-
weighted mean.  Distance is NaN-aware Euclidean: squared differences over
the coordinates both rows have, scaled by (all coordinates / shared
coordinates).  Weights are 1/d; when some donors are at distance 0 only
those count.  A gap without any donor gets the column's mean.

Rows are put in order by the columns they miss and then by the cell of space
they lie in (a Z-order over the widest columns), and cut to *chunks* of bounded
size; receivers, which are fewer and so farther apart, to smaller *bunches*.  The
box of either (least and largest value per column, and which columns all or some
of its rows have) bounds from below the distance of a bunch's rows to a chunk's.

1. Every bunch meets the chunks with the nearest boxes, as many as hold k
   donors of each missing column.  That gives each receiver k distances, and
   the bunch, per column, a bound that no k-th neighbour lies beyond.
2. Besides, it meets only chunks whose lower bound does not exceed it.

Boxes are compared with each other, ``LOT`` at a time; rows go only to the pairs
that are left.  The bunches that meet a chunk are dealt to lots of about a chunk's
size; each lot is a task of its own, which keeps its k best donors per (receiver,
column) by (distance, donor key), and a salted top-k merges them.  Nothing passes
through the driver, and the result does not depend on how rows were
partitioned or chunks were cut.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pansift.functions.numeric import finite_or_null
from pansift.operators.quantiles import quantile_fit
from pansift.operators.timeseries import rank_top_per_key
from pansift.session import cut_lineage

CAND_SCHEMA = "block string, bunch long, rid long, col int, d double, v double, did long"
#: Rows of a chunk, chunks' rows to a bunch's, and boxes that meet at a time.
CHUNK, FINER, LOT = 2048, 32, 1024
#: Steps of the widest column, as a power of two, and bits of a cell's number.
STEPS, BITS = 12, 62


def best_donors(rx: np.ndarray, rid: np.ndarray, dx: np.ndarray, did: np.ndarray, k: int,
                at_once: int = 256) -> list[np.ndarray]:
    """Columns (rid, col, d, v, did) of each receiver's k nearest donors per
    missing column; equal distances go by donor key."""
    order = np.argsort(did, kind="stable")
    dx, did = dx[order], did[order]
    have, p = ~np.isnan(dx), dx.shape[1]
    out: list[tuple] = []
    for s in range(0, len(rx), at_once):
        r = rx[s:s + at_once]
        # summed column by column, so equal rows are at exactly equal distances
        square, shared = np.zeros((len(r), len(dx))), np.zeros((len(r), len(dx)))
        for j in range(p):
            diff = np.subtract.outer(r[:, j], dx[:, j])
            both = ~np.isnan(diff)
            square += np.where(both, diff * diff, 0.0)
            shared += both
        with np.errstate(divide="ignore", invalid="ignore"):
            dist = np.where(shared > 0, np.sqrt(square * (p / shared)), np.inf)
        for j in range(p):
            need, has = np.flatnonzero(np.isnan(r[:, j])), np.flatnonzero(have[:, j])
            if not len(need) or not len(has):
                continue
            sub = dist[np.ix_(need, has)]
            near = np.argsort(sub, axis=1, kind="stable")[:, :k]  # stable: donors stand in key order
            d = np.take_along_axis(sub, near, axis=1)
            row, c = np.nonzero(np.isfinite(d))
            donor = has[near[row, c]]
            out.append((rid[s + need[row]], np.full(len(row), j), d[row, c], dx[donor, j], did[donor]))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.empty(0)] * 5


def _cell(base: DataFrame, names: list[str]):
    """Number of the cell a row lies in: bits of the columns' steps, the coarsest
    first.  A step is as long in every column, so wide columns have more of them;
    the range of a column is that of its middle 98 %."""
    fit = {n: v for n, v in quantile_fit(base, names, [0.01, 0.99]).items() if v and v[1] > v[0]}
    if not fit:
        return F.lit(0).cast("long")
    unit = max(v[1] - v[0] for v in fit.values()) / (1 << STEPS)
    steps = {n: F.coalesce(F.floor((F.least(F.greatest(F.col(n), F.lit(v[0])), F.lit(v[1])) - F.lit(v[0])) / F.lit(unit)), F.lit(0))
             for n, v in fit.items()}
    widest = sorted(fit, key=lambda n: (fit[n][0] - fit[n][1], n))
    bits = [(n, k) for k in range(STEPS, -1, -1) for n in widest if (fit[n][1] - fit[n][0]) / unit >= 1 << k][:BITS]
    code = F.lit(0).cast("long")
    for at, (n, k) in enumerate(bits):
        code = code + F.shiftleft(F.shiftright(steps[n], k).bitwiseAND(F.lit(1).cast("long")), BITS - 1 - at)
    return code


def _chunks(df: DataFrame, cols: list[str], names: list[str], key: str, block_by: str | None,
            chunk: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows with their chunk and bunch, and the boxes of bunches (of
    receivers only) and of chunks; all written."""
    block = F.coalesce(F.col(block_by).cast("string"), F.lit("")) if block_by else F.lit("")
    gap = F.lit(False)
    for n in names:
        gap = gap | F.col(n).isNull()
    base = df.select(F.col(key).cast("long").alias("rid"), block.alias("block"),
                     *[finite_or_null(F.col(c).cast("double")).alias(n) for c, n in zip(cols, names)])
    base = cut_lineage(base.withColumn("gap", gap), "knn")
    missed = F.concat(*[F.when(F.col(n).isNull(), "1").otherwise("0") for n in names])
    order = base.withColumns({"_missed": missed, "_cell": _cell(base, names)}).repartitionByRange("block", "_missed", "_cell")
    rows = order.sortWithinPartitions("block", "_missed", "_cell", "rid").withColumn("_at", F.monotonically_increasing_id())

    def cut(size):  # numbers of partition and row within it; what is written no longer moves
        return F.shiftright("_at", 33) * (1 << 31) + F.floor(F.col("_at").bitwiseAND((1 << 33) - 1) / size)
    rows = rows.withColumns({"chunk": cut(chunk), "bunch": cut(max(2, chunk // FINER))})
    rows = cut_lineage(rows.drop("_at", "_missed", "_cell"), "knn_rows")

    def boxes(d, of):
        return cut_lineage(d.groupBy("block", F.col(of).alias("of")).agg(
            F.count(F.lit(1)).alias("n"), F.array(*[F.count(n) for n in names]).alias("held"),
            F.array(*[F.min(n) for n in names]).alias("low"), F.array(*[F.max(n) for n in names]).alias("high")), "knn_boxes")
    return rows, boxes(rows.where("gap"), "bunch"), boxes(rows, "chunk")


class _Boxes:
    """Boxes of some bunches or chunks as arrays."""

    def __init__(self, df: pd.DataFrame):
        def matrix(column):
            return np.array([[np.nan if x is None else x for x in row] for row in column], float)
        self.of, self.n, self.held = df["of"].to_numpy(), df["n"].to_numpy(), matrix(df["held"])
        self.low, self.high = matrix(df["low"]), matrix(df["high"])
        self.some, self.every = self.held > 0, self.held == self.n[:, None]


def box_distances(r: _Boxes, d: _Boxes) -> tuple[np.ndarray, np.ndarray]:
    """For each pair of boxes a lower bound of the distance of any two rows
    (infinite: they share no column), and the distance of the boxes' middles.

    Rows of two boxes share at least the columns that all of both have, and at most
    those that some of both have; so the squared gaps of the first, scaled as if
    all of the second were shared, never exceed a squared distance."""
    p = r.low.shape[1]
    gaps, shared, middles = (np.zeros((len(r.of), len(d.of))) for _ in range(3))
    for j in range(p):
        apart = np.maximum(np.maximum(np.subtract.outer(r.low[:, j], d.high[:, j]), -np.subtract.outer(r.high[:, j], d.low[:, j])), 0.0)
        gaps += np.where(np.logical_and.outer(r.every[:, j], d.every[:, j]), apart ** 2, 0.0)
        shared += np.logical_and.outer(r.some[:, j], d.some[:, j])
        middle = np.subtract.outer((r.low[:, j] + r.high[:, j]) / 2, (d.low[:, j] + d.high[:, j]) / 2) ** 2
        middles += np.where(np.isnan(middle), 0.0, middle)
    with np.errstate(divide="ignore", invalid="ignore"):
        scale = np.where(shared > 0, p / shared, np.inf)
        # a little less, as the sums of rows are rounded in their own way
        return np.where(shared > 0, np.sqrt(gaps * scale) * (1 - 1e-9), np.inf), np.sqrt(middles * scale)


def _box_pairs(bunches: DataFrame, chunks: DataFrame, lots: tuple[int, int], bounds: DataFrame | None, k: int) -> DataFrame:
    """Pairs ``block, bunch, chunk`` and their sizes.  Without bounds: for each
    missing column the nearest boxes that hold ``k`` values.  With them: all
    that may hold a nearer donor."""
    left = bunches if bounds is None else bunches.join(bounds, ["block", "of"])

    def dealt(d, own, other, n, m):
        return d.withColumns({own: F.pmod(F.xxhash64("of"), F.lit(n)).cast("int"), other: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))})
    sizes = ["block", "bunch", "chunk", "n_bunch", "n_chunk"]

    def nearest(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(b):
            r, d = _Boxes(a), _Boxes(b)
            low, middle = box_distances(r, d)
            for i in range(len(r.of)):
                order = np.lexsort((d.of, middle[i], low[i]))
                order = order[np.isfinite(low[i][order])]
                for j in np.flatnonzero(~r.every[i]):
                    has = order[d.some[order, j]]
                    before = np.cumsum(d.held[has, j]) - d.held[has, j]
                    for at in has[before < k]:
                        out.append((a["block"].iloc[0], r.of[i], d.of[at], r.n[i], d.n[at], int(j), low[i, at], middle[i, at], d.held[at, j]))
        return pd.DataFrame(out, columns=[*sizes, "col", "low", "middle", "held"])

    def within(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(b):
            r, d = _Boxes(a), _Boxes(b)
            low, _ = box_distances(r, d)
            far = np.array([[-1.0 if x is None else x for x in row] for row in a["bounds"]], float)
            meets = np.zeros(low.shape, bool)
            for j in range(far.shape[1]):
                meets |= (low <= far[:, j, None]) & d.some[:, j] & ~r.every[:, j, None]
            i, at = np.nonzero(meets & np.isfinite(low))
            out = list(zip([a["block"].iloc[0]] * len(i), r.of[i], d.of[at], r.n[i], d.n[at]))
        return pd.DataFrame(out, columns=sizes)

    by, kind = ["block", "lr", "ld"], "block string, bunch long, chunk long, n_bunch long, n_chunk long"
    pairs = dealt(left, "lr", "ld", *lots).groupBy(*by).cogroup(dealt(chunks, "ld", "lr", *lots[::-1]).groupBy(*by))
    if bounds is not None:
        return pairs.applyInPandas(within, kind)
    seeds = pairs.applyInPandas(nearest, kind + ", col int, low double, middle double, held double")
    if lots[1] > 1:  # the nearest of all lots
        order = Window.partitionBy("block", "bunch", "col").orderBy("low", "middle", "chunk").rowsBetween(Window.unboundedPreceding, -1)
        seeds = seeds.withColumn("_before", F.coalesce(F.sum("held").over(order), F.lit(0.0))).where(F.col("_before") < k)
    return seeds.select(*sizes).distinct()


def _met(rows: DataFrame, pairs: DataFrame, names: list[str], k: int, size: int, padded: bool) -> DataFrame:
    """Candidates of all pairs.  ``padded``: k rows per (receiver, column) and
    chunk, those without a donor at an infinite distance."""
    lots = pairs.groupBy("block", "chunk").agg(F.ceil(F.sum("n_bunch") / size).cast("int").alias("lots"))
    asked = pairs.join(lots, ["block", "chunk"]).select(
        "block", "bunch", "chunk", F.pmod(F.xxhash64("bunch"), "lots").cast("int").alias("lot"))
    values = [F.col(c).alias(c) for c in ("rid", *names)]  # columns of their own, since both sides come from one table
    left = (rows.where("gap").drop("chunk").join(asked, ["block", "bunch"])
            .select(F.col("block").alias("block"), F.col("chunk").alias("of"), "lot", F.col("bunch").alias("bunch"), *values))
    right = (rows.drop("bunch").join(lots, ["block", "chunk"])
             .select(F.col("block").alias("block"), F.col("chunk").alias("of"), F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot"), *values))

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        kinds = ("rid", "col", "d", "v", "did")
        if a.empty or b.empty:
            return pd.DataFrame([], columns=["block", "bunch", *kinds])
        x, rid = a[names].to_numpy(float), a["rid"].to_numpy()
        got = pd.DataFrame(dict(zip(kinds, best_donors(x, rid, b[names].to_numpy(float), b["rid"].to_numpy(), k))))
        if padded:
            row, col = np.nonzero(np.isnan(x))
            found = got.groupby(["rid", "col"]).size()
            lack = k - found.reindex(pd.MultiIndex.from_arrays([rid[row], col]), fill_value=0).to_numpy()
            pad = pd.DataFrame({"rid": np.repeat(rid[row], lack), "col": np.repeat(col, lack)})
            got = pd.concat([got, pad.assign(d=np.inf, v=np.nan, did=np.iinfo(np.int64).max)])
        bunch = pd.Series(a["bunch"].to_numpy(), rid).reindex(got["rid"]).to_numpy(np.int64)
        return pd.DataFrame({"block": pd.Series([a["block"].iloc[0]] * len(got), dtype=object), "bunch": bunch,
                             **{c: got[c].to_numpy(np.int64 if c in ("rid", "did", "col") else float) for c in kinds}})

    by = ["block", "of", "lot"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(meet, CAND_SCHEMA)


def knn_donor_join(df: DataFrame, cols: Sequence[str], key: str, k: int = 5, block_by: str | None = None,
                   chunk: int = CHUNK, report: dict | None = None) -> DataFrame:
    """Distance (theta) join with top-k: for every row with a gap and every
    missing column, its k nearest donors as (rid, col, d, v, did, rank),
    where ``col`` indexes ``cols``, ``d`` is the NaN-aware distance, ``v``
    the donor's value and ``did`` the donor key.  Ties: donor key ascending.

    ``block_by``: donors only from the receiver's block (e.g. the entity).
    ``report``: is given the number of ``pairs`` of a receiver and a row of its
    block, and how many were ``met``.
    """
    cols = list(cols)
    names = [f"x{i}" for i in range(len(cols))]
    rows, bunches, chunks = _chunks(df, cols, names, key, block_by, chunk)
    lots = tuple(max(1, -(-(b.groupBy("block").count().agg(F.max("count")).first()[0] or 0) // LOT)) for b in (bunches, chunks))
    seeds = cut_lineage(_box_pairs(bunches, chunks, lots, None, k), "knn_seeds")
    best = ["rid", "col"], [F.asc("d"), F.asc("did")], k
    first = cut_lineage(rank_top_per_key(_met(rows, seeds, names, k, chunk, True), *best), "knn_first")
    # no k-th neighbour of a bunch's rows lies beyond the largest k-th distance found so far
    far = first.where(F.col("rank") == k).groupBy("block", F.col("bunch").alias("of"), "col").agg(F.max("d").alias("d"))
    bounds = far.groupBy("block", "of").agg(F.map_from_entries(F.collect_list(F.struct("col", "d"))).alias("_m")).select(
        "block", "of", F.array(*[F.col("_m")[j] for j in range(len(cols))]).alias("bounds"))
    rest = _box_pairs(bunches, chunks, lots, bounds, k).join(seeds, ["block", "bunch", "chunk"], "left_anti")
    rest = cut_lineage(rest, "knn_pairs")
    if report is not None:
        both = bunches.groupBy("block").agg(F.sum("n").alias("r")).join(chunks.groupBy("block").agg(F.sum("n").alias("d")), "block")
        report["pairs"] = both.agg(F.sum(F.col("r") * F.col("d"))).first()[0] or 0
        report["met"] = seeds.unionByName(rest).agg(F.sum(F.col("n_bunch") * F.col("n_chunk"))).first()[0] or 0
    fields = ["rid", "col", "d", "v", "did"]
    cands = first.select(*fields).where(F.col("d") < float("inf")).unionByName(_met(rows, rest, names, k, chunk, False).select(*fields))
    return rank_top_per_key(cands, *best)


def impute_knn(df: DataFrame, cols: Sequence[str], key: str, k: int = 5, block_by: str | None = None,
               chunk: int = CHUNK) -> DataFrame:
    """Fill gaps in ``cols`` from the k nearest donors (weights 1/d); a gap
    that no donor can fill (nothing in common with any) gets the column's mean.

    ``key`` is a unique, non-null long column identifying rows.
    """
    cols = list(cols)
    best = knn_donor_join(df, cols, key, k, block_by, chunk)
    zero = F.max((F.col("d") == 0).cast("int")).over(Window.partitionBy("rid", "col"))
    w = F.when(F.col("_z") == 1, (F.col("d") == 0).cast("double")).otherwise(1.0 / F.col("d"))
    filled = best.withColumn("_z", zero).groupBy("rid", "col").agg((F.sum(w * F.col("v")) / F.sum(w)).alias("fill"))
    wide = filled.groupBy("rid").agg(*[F.max(F.when(F.col("col") == j, F.col("fill"))).alias(f"_f{j}")
                                       for j in range(len(cols))])
    value = {c: finite_or_null(F.col(c).cast("double")) for c in cols}
    mean = df.agg(*[F.avg(value[c]).alias(f"m{j}") for j, c in enumerate(cols)]).first()
    out = df.join(wide, F.col(key).cast("long") == F.col("rid"), "left")
    return out.withColumns({c: F.coalesce(value[c], F.col(f"_f{j}"), F.lit(mean[j]).cast("double")) for j, c in enumerate(cols)}) \
              .drop("rid", *[f"_f{j}" for j in range(len(cols))])
