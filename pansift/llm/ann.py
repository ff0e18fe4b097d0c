"""Approximate nearest neighbours with learned partitions.

Fit, on a bounded sample (``SAMPLE`` rows, those with the smallest hash of
their id): a neighbour graph, its balanced partitioning (equal median cuts,
then moves to the part that holds most neighbours, within a capacity), and a
small network that predicts how a vector's neighbours spread over the parts.
A second sample of the same size fixes how many parts a query has to visit.

Index: the network deals every vector to its most probable part.  Where ``MOST_PARTS``
parts would hold too many vectors each, every large part is split again, by a
network of its own that a task fits on a sample of the part's rows, and so on: the
number of parts grows with the table, and what a query meets does not.
Search: a query visits its most probable parts, and in them their most
probable parts, and further ones until they hold enough vectors; parts are cut
into blocks of bounded size, and the exact inner products are reranked.  Model, sample
and sizes of the first level's parts are the only things on the driver.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pansift.llm._common import cut_lineage, prepare

#: Rows the model is fitted on, and as many again to choose the visits.
SAMPLE = 4096
#: Vectors that one part should hold, and the limits of how many parts a level has.
PER_PART, LEAST_PARTS, MOST_PARTS = 2500, 8, 256
#: Vectors, and queries, that meet in one task.
BLOCK = 4096
#: Recall aimed at on the second sample.
AIM = 0.95
NEIGHBOURS, HIDDEN, ROUNDS = 10, 128, 30


@dataclass
class Router:
    """Weights of the network and how many parts a query visits."""
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    visits: int = 1

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(unit(x) @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def neighbours(x: np.ndarray, base: np.ndarray, k: int, own: bool) -> np.ndarray:
    """Indices of each row's k largest inner products with ``base`` (``own``:
    both are the same rows, and a row is not its own neighbour)."""
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), 512):
        s = x[at:at + 512] @ base.T
        if own:
            s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out[at:at + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int, spare: float = 1.1) -> np.ndarray:
    """A part for each row: equal cuts along main directions, then moves that
    cut fewer edges of the neighbour graph while no part outgrows its capacity."""
    part, todo = np.zeros(len(x), np.int64), [(np.arange(len(x)), parts)]
    nxt = 1
    while todo:
        rows, n = todo.pop()
        if n < 2 or len(rows) < 2:
            continue
        z = x[rows] - x[rows].mean(axis=0)
        axis = np.linalg.eigh(z.T @ z)[1][:, -1]
        half = n // 2
        right = rows[np.argsort(z @ axis, kind="stable")][len(rows) * (n - half) // n:]
        part[right] = nxt
        nxt += 1
        todo += [(np.setdiff1d(rows, right), n - half), (right, half)]
    both = [[] for _ in x]
    for a, row in enumerate(near.tolist()):
        for b in row:
            both[a].append(b)
            both[b].append(a)
    room = int(np.ceil(spare * len(x) / parts))
    sizes = np.bincount(part, minlength=parts)
    for _ in range(10):
        moved = 0
        for a, friends in enumerate(both):
            votes = np.bincount(part[friends], minlength=parts)
            votes[(sizes >= room) & (np.arange(parts) != part[a])] = -1
            to = int(votes.argmax())
            if votes[to] > votes[part[a]]:
                sizes[part[a]] -= 1
                sizes[to] += 1
                part[a] = to
                moved += 1
        if moved < len(x) // 200:
            break
    return part


def train(x: np.ndarray, aim: np.ndarray, rounds: int = ROUNDS) -> Router:
    """A network with one hidden layer whose output follows ``aim`` (rows of
    shares that sum to one); same weights for the same input."""
    rs = np.random.default_rng(7)
    x = unit(x)
    d, p = x.shape[1], aim.shape[1]
    w = [rs.normal(0, np.sqrt(2 / d), (d, HIDDEN)) * np.sqrt(d), np.zeros(HIDDEN), rs.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, p)),
         np.zeros(p)]
    m, v, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    for _ in range(rounds):
        order = rs.permutation(len(x))
        for at in range(0, len(x), 128):
            rows = order[at:at + 128]
            h = np.maximum(x[rows] @ w[0] + w[1], 0)
            o = h @ w[2] + w[3]
            o = np.exp(o - o.max(axis=1, keepdims=True))
            g = (o / o.sum(axis=1, keepdims=True) - aim[rows]) / len(rows)
            gh = (g @ w[2].T) * (h > 0)
            step += 1
            for k, grad in enumerate((x[rows].T @ gh, gh.sum(0), h.T @ g, g.sum(0))):
                grad = grad + 1e-4 * w[k]
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad * grad
                w[k] = w[k] - 3e-3 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return Router(*w)


def fit(sample: np.ndarray, parts: int, k: int, aim: float = AIM) -> Router:
    """The router of a sample; its second half, if large enough, sets the visits."""
    half = sample[: len(sample) // 2] if len(sample) >= 2 * SAMPLE else sample
    rest = sample[len(half):] if len(half) < len(sample) else sample
    n = min(NEIGHBOURS, len(half) - 1)
    if n < 1 or parts < 2:
        d = sample.shape[1]
        return Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    near = neighbours(half, half, n, own=True)
    part = balanced_parts(half, near, parts)
    shares = (np.eye(parts)[part[near]].sum(axis=1) + np.eye(parts)[part]) / (n + 1)
    router = train(half, shares)
    k = min(k, len(rest) - 1)
    asked = rest[: min(512, len(rest))]
    true = neighbours(asked, rest, min(k + 1, len(rest)), own=False)  # a vector's own row comes along
    home = router.logits(rest).argmax(axis=1)
    rank = np.argsort(np.argsort(-router.logits(asked), axis=1, kind="stable"), axis=1)
    place = np.take_along_axis(rank, home[true], axis=1)
    own = true == np.arange(len(asked))[:, None]
    reached = np.array([(place[~own] < v).mean() for v in range(1, parts + 1)])
    router.visits = int(np.argmax(reached >= aim)) + 1 if (reached >= aim).any() else parts
    return router


def visited(logits: np.ndarray, held: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's parts, the most probable first (all rows in one array), and
    where each row ends: at least ``least`` parts, and as many as hold ``k``
    vectors besides the row's own (``held`` per part), or all."""
    order = np.argsort(-logits, axis=1, kind="stable").astype(np.int32)
    enough = np.cumsum(held[order], axis=1) > k
    n = np.where(enough.any(axis=1), enough.argmax(axis=1) + 1, order.shape[1])
    n = np.maximum(n, least)
    taken = np.arange(order.shape[1]) < n[:, None]
    return order[taken], np.concatenate([[0], np.cumsum(n)]).astype(np.int32)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, vec`` (doubles) of vectors that take part."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    fine = (F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)
            & ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
            & F.exists("vec", lambda x: x != 0))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vec")).where(fine)


def _matrix(column) -> np.ndarray:
    return np.array([np.asarray(x, np.float64) for x in column]).reshape(len(column), -1)


def _arrow_matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def best(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Each query's k largest inner products (query id, vector id, score),
    ties to the smaller id.  Scores are summed in one order for every pair, so
    equal vectors score equally."""
    out = []
    for at in range(0, len(q), 256):
        part, ids = q[at:at + 256], q_ids[at:at + 256]
        s = part @ x.T
        s[ids[:, None] == x_ids[None, :]] = -np.inf
        if len(x) > k:
            floor = np.partition(s, len(x) - k, axis=1)[:, len(x) - k]
        else:
            floor = np.full(len(part), -np.inf)
        slack = 1e-9 * np.maximum(1.0, np.abs(np.where(np.isfinite(floor), floor, 0)))
        rows, cols = np.nonzero((s >= (floor - slack)[:, None]) & (s > -np.inf))
        exact = np.concatenate([np.add.reduce(part[rows[i:i + 65536]] * x[cols[i:i + 65536]], axis=1)
                                for i in range(0, len(rows), 65536)] or [np.empty(0)])
        order = np.lexsort((x_ids[cols], -exact, rows))
        rows, cols, exact = rows[order], cols[order], exact[order]
        first = np.searchsorted(rows, np.arange(len(part)))
        keep = np.arange(len(rows)) - first[rows] < k
        out.append((ids[rows[keep]], x_ids[cols[keep]], exact[keep]))
    return tuple(np.concatenate(a) if out else np.empty(0) for a in zip(*out))


def levels_of(count: int, per_part: int, most_parts: int) -> int:
    """Levels at which no part need hold more than twice ``per_part`` vectors."""
    return max(1, math.ceil(math.log(max(1.0, count / (2 * per_part)), most_parts)))


def split(index: DataFrame, asked: DataFrame, per_part: int, most_parts: int, k: int, aim: float) -> tuple[DataFrame, DataFrame]:
    """One level more.  ``index``: ``cell, vec_id, vec``; ``asked``: ``cell, query_id, vec``.
    A cell of more than ``2 * per_part`` vectors becomes up to ``most_parts``
    cells, and its queries go to the most probable of these.  Both come back written."""
    sizes = cut_lineage(index.groupBy("cell").agg(F.count("*").alias("n")), "cells")
    large = sizes.where(F.col("n") > 2 * per_part)
    # the sample of a cell: the rows with the smallest hashes of their ids
    first = Window.partitionBy("cell").orderBy(F.xxhash64("vec_id"), "vec_id")
    sample = index.join(large, "cell").withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= 2 * SAMPLE).drop("_r")

    def learn(g: pd.DataFrame) -> pd.DataFrame:
        parts = min(most_parts, max(2, round(int(g["n"].iloc[0]) / per_part)), max(1, len(g) // 4))
        router = fit(_matrix(g["vec"]), parts, k, aim)
        return pd.DataFrame({"cell": [int(g["cell"].iloc[0])], "model": [pickle.dumps(router)]})

    models = cut_lineage(sample.groupBy("cell").applyInPandas(learn, "cell long, model binary"), "routers")

    def dealt(rows, id_col, counts):
        """``rows`` of large cells in lots of bounded size, and the models for each lot."""
        lots = counts.select("cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("lots"))
        own = rows.join(lots, "cell").withColumn("lot", F.pmod(F.xxhash64(id_col), "lots").cast("int")).drop("lots")
        return own, lots.withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1))).drop("lots")

    def home(rows: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or model.empty:
            return pd.DataFrame([], columns=["cell", "vec_id", "vec"])
        part = pickle.loads(model["model"].iloc[0]).logits(_matrix(rows["vec"])).argmax(axis=1)
        return pd.DataFrame({"cell": rows["cell"].to_numpy() * most_parts + part, "vec_id": rows["vec_id"], "vec": rows["vec"]})

    rows, lots = dealt(index, "vec_id", large)
    found = rows.groupBy("cell", "lot").cogroup(models.join(lots, "cell").groupBy("cell", "lot")).applyInPandas(
        home, "cell long, vec_id long, vec array<double>")
    small = sizes.where(F.col("n") <= 2 * per_part).select("cell")
    below = F.col("cell") * most_parts
    parts = cut_lineage(found.unionByName(index.join(small, "cell").withColumn("cell", below)), "index")
    held = parts.groupBy("cell").agg(F.count("*").alias("n")).select(
        F.floor(F.col("cell") / most_parts).cast("long").alias("cell"), F.struct((F.col("cell") % most_parts).cast("int").alias("p"), "n").alias("h"))
    routed = models.join(held.groupBy("cell").agg(F.collect_list("h").alias("held")), "cell")
    routed = routed.select("cell", "model", F.transform("held", lambda h: h["p"]).alias("parts"), F.transform("held", lambda h: h["n"]).alias("ns"))

    def route(rows: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or model.empty:
            return pd.DataFrame([], columns=["cell", "query_id", "vec"])
        router = pickle.loads(model["model"].iloc[0])
        n = np.zeros(len(router.b2), np.int64)
        n[np.asarray(model["parts"].iloc[0], int)] = model["ns"].iloc[0]
        to, ends = visited(router.logits(_matrix(rows["vec"])), n, min(router.visits, len(n)), k)
        of = np.repeat(np.arange(len(rows)), np.diff(ends))
        return pd.DataFrame({"cell": rows["cell"].to_numpy()[of] * most_parts + to, "query_id": rows["query_id"].to_numpy()[of],
                             "vec": rows["vec"].to_numpy()[of]})

    queries = asked.join(large.select("cell"), "cell")
    rows, lots = dealt(queries, "query_id", queries.groupBy("cell").agg(F.count("*").alias("n")))
    went = rows.groupBy("cell", "lot").cogroup(routed.join(lots, "cell").groupBy("cell", "lot")).applyInPandas(
        route, "cell long, query_id long, vec array<double>")
    stay = asked.join(small, "cell").withColumn("cell", below)
    return parts, cut_lineage(went.unionByName(stay), "queries")


def search(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           visits: int | None = None, per_part: int = PER_PART, most_parts: int = MOST_PARTS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found by inner
    product for each row whose id is divisible by ``every``, among all other rows.

    Vectors that are null, zero, empty, of another length than the most common
    one, or that hold null or non-finite components take no part, nor do null
    ids.  Rows that repeat an id count as one vector (its best score).  Ties
    go to the smaller id.  A query has fewer than ``k`` rows only if there are
    fewer other vectors.  Other columns are not read; an empty table gives an
    empty result.  ``visits``: least parts per query instead of the learnt number
    (as many as there are parts gives the exact result, on one level).
    """
    spark = vectors.sparkSession
    prepare(spark)
    out_type = "query_id long, rank int, vec_id long, score double"
    rows = cut_lineage(usable(vectors, id_col, vec_col), "vectors")
    lengths = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if lengths is None:
        return spark.createDataFrame([], out_type)
    dim, count = lengths
    rows = rows.where(F.size("vec") == dim)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").select("vec").limit(2 * SAMPLE).toPandas()["vec"]
    parts = min(most_parts, max(LEAST_PARTS, round(count / per_part)))
    levels = levels_of(count, per_part, most_parts)
    aim = AIM ** (1 / levels)  # a neighbour is found if no level loses it
    router = fit(_matrix(sample), min(parts, max(1, len(sample) // 4)), k, aim)
    go_to = min(visits or router.visits, len(router.b2))

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                part = router.logits(_arrow_matrix(b.column(1))).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), b.column(0), b.column(1)],
                                                 names=["part", "vec_id", "vec"])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                to, ends = visited(router.logits(_arrow_matrix(b.column(1))), held, go_to, k)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(ends, to)],
                                                 names=["query_id", "vec", "parts"])

    index = cut_lineage(rows.mapInArrow(home, "part int, vec_id long, vec array<double>"), "index")
    # vectors of a part; an id in several parts counts in one
    held = np.zeros(len(router.b2), np.int64)
    for r in index.groupBy("vec_id").agg(F.min("part").alias("part")).groupBy("part").count().collect():
        held[r["part"]] = r["count"]
    asked = cut_lineage(rows.where(F.col("vec_id") % every == 0)
                        .mapInArrow(route, "query_id long, vec array<double>, parts array<int>"), "queries")
    index = index.select(F.col("part").cast("long").alias("cell"), "vec_id", "vec")
    asked = asked.select(F.explode(F.col("parts").cast("array<bigint>")).alias("cell"), "query_id", "vec")
    for _ in range(levels - 1):
        index, asked = split(index, asked, per_part, most_parts, k, aim)
    # one row per cell: into how many blocks its vectors, and its queries, are dealt
    visits_of = asked.groupBy("cell").agg(F.count("*").alias("q"))
    sizes = cut_lineage(index.groupBy("cell").agg(F.count("*").alias("n")).join(visits_of, "cell").select(
        "cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("q") / BLOCK).cast("int").alias("lots")),
        "parts")
    x = (index.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int"))
         .select("cell", "block", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot"), "vec_id", "vec"))
    q = (asked.join(sizes, "cell").withColumn("lot", F.pmod(F.xxhash64("query_id"), "lots").cast("int"))
         .select("cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "lot", "query_id", "vec"))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids = right["vec_id"].to_numpy()
        most = int(np.unique(ids, return_counts=True)[1].max())  # k ids are among the best k * most rows
        a, b, s = best(_matrix(left["vec"]), left["query_id"].to_numpy(), _matrix(right["vec"]), ids, k * most)
        return pd.DataFrame({"query_id": a, "vec_id": b, "score": s})

    by = ["cell", "block", "lot"]
    found = (q.groupBy(*by).cogroup(x.groupBy(*by)).applyInPandas(meet, "query_id long, vec_id long, score double")
             .groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    return best_of(found, k).select("query_id", "rank", "vec_id", "score")


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query; a query has k rows for each block it met."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
