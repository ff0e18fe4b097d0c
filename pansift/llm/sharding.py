"""Shards of nearly equal bytes: minimax contiguous partition.

Groups of equal texts are atoms, ordered by the 64-bit hash of their text.
The smallest capacity for which a greedy walk over the ordered atoms needs no
more shards than wanted is found by binary search; the cuts of that walk are
the shards.  The walk runs over *cells* (ranges of hashes with the bytes and
groups in them).  Taking cells as atoms gives an upper bound of the capacity,
taking cells as divisible a lower one; cells in which a cut may lie are split
further until both meet.  The driver holds cells only, whose number depends
on the shards and not on the documents.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pansift.llm._common import cut_lineage

FIRST_BITS, MORE_BITS = 12, 6
#: Rows of a shard that are numbered together.
PER_RUN = 50_000


def _walk(edges: np.ndarray, solid: np.ndarray, capacity: int, shards: int) -> list[int]:
    """Byte positions of the greedy cuts; cells that are not solid may be cut
    anywhere.  ``edges``: the bytes before each cell, and all bytes."""
    at, cuts, total = 0, [], int(edges[-1])
    for _ in range(shards):
        to = at + capacity
        if to >= total:
            to = total
        else:
            k = int(np.searchsorted(edges, to, side="right")) - 1
            if solid[k]:
                to = max(at, int(edges[k]))
        at = to
        cuts.append(at)
    return cuts


def _smallest(edges: np.ndarray, solid: np.ndarray, shards: int, low: int, high: int) -> int:
    while low < high:
        mid = (low + high) // 2
        if _walk(edges, solid, mid, shards)[-1] == edges[-1]:
            high = mid
        else:
            low = mid + 1
    return low


def _cell(bits: int) -> Column:
    return F.shiftright("key", 64 - bits)


def _cells(groups: DataFrame, bits: int, wanted: list[int] | None = None, of_bits: int = 0) -> list[tuple]:
    """(first key, bits, bytes, groups) of the cells with ``bits`` bits."""
    if wanted is not None:
        groups = groups.where(_cell(of_bits).isin(wanted))
    got = groups.groupBy(_cell(bits).alias("cell")).agg(F.sum("bytes").alias("b"), F.count("*").alias("n")).collect()
    return [(r.cell << (64 - bits), bits, r.b, r.n) for r in got]


def cut_keys(groups: DataFrame, shards: int) -> list[int]:
    """First keys of shards 1, 2, ...: the smallest largest shard over
    ``groups`` (``key, bytes``, one row per atom)."""
    cells = sorted(_cells(groups, FIRST_BITS))
    if not cells or shards < 2:
        return []
    while True:
        sizes = np.array([c[2] for c in cells], np.int64)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        solid = np.array([c[3] == 1 or c[1] == 64 for c in cells])
        total, every = int(edges[-1]), np.ones(len(cells), bool)
        low = max(-(-total // shards), int(sizes[solid].max()) if solid.any() else 0)
        high = _smallest(edges, every, shards, low, total)
        low = _smallest(edges, solid, shards, low, high)
        if low == high:
            break
        first, last = _walk(edges, every, low, shards), _walk(edges, solid, high, shards)
        split = np.zeros(len(cells), bool)
        for a, b in zip(first, last):
            i, j = int(np.searchsorted(edges, a, side="right")) - 1, int(np.searchsorted(edges, b, side="left"))
            split[max(0, i):max(i + 1, j)] = True
        split &= ~solid
        if not split.any():
            split = ~solid
        finer = []
        for bits in sorted({c[1] for c, s in zip(cells, split) if s}):
            mine = [c[0] >> (64 - bits) for c, s in zip(cells, split) if s and c[1] == bits]
            finer += _cells(groups, min(64, bits + MORE_BITS), mine, bits)
        cells = sorted([c for c, s in zip(cells, split) if not s] + finer)
    starts = np.array([c[0] for c in cells], np.int64)
    cuts = _walk(edges, every, high, shards)
    at = [int(np.searchsorted(edges, c, side="left")) for c in cuts if c < total]
    return [int(starts[k]) for k in at if k < len(cells)]


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, law, shard, slot,
    grown_shard``.

    The law is ``bytes``; equal texts share a shard.  Groups larger than an
    even share get shards of their own, the rest is cut over what is left.
    Null texts count as empty ones with size 8; repeated rows get slots of
    their own; null ids are allowed; other columns are not read; an empty
    table gives an empty result.  Slots run from 0 without gaps.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = cut_lineage(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"), F.xxhash64(text).alias("key")), "rows")
    groups = cut_lineage(rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "groups")
    whole = groups.agg(F.sum("bytes").alias("b"), F.sum("n").alias("n")).first()
    total, count = whole.b or 0, whole.n or 0
    # at most shards - 1 groups exceed an even share; taking one out lowers the share of the rest
    own: list[int] = []
    largest = [(r.key, r.bytes) for r in groups.orderBy(F.desc("bytes"), "key").limit(shards - 1).collect()]
    rest = total
    for key, size in largest:
        if size * (shards - len(own)) <= rest:
            break
        own.append(key)
        rest -= size
    cuts = cut_keys(groups.where(~F.col("key").isin(own)) if own else groups, shards - len(own))
    place = F.lit(0)
    for c in cuts:
        place = place + (F.col("key") >= F.lit(c)).cast("int")
    for k, key in enumerate(own):
        place = F.when(F.col("key") == F.lit(key), F.lit(shards - len(own) + k)).otherwise(place)
    runs = max(4, -(-count // (shards * PER_RUN)))
    placed = rows.withColumn("shard", place).withColumn(
        "run", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(runs)).cast("int"))
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_lineage(
        placed.groupBy("shard", "run").agg(F.count("*").alias("n"))
        .select("shard", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "offsets")
    order = Window.partitionBy("shard", "run").orderBy("doc_id", "key")
    return (placed.join(offsets, ["shard", "run"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("offset") + F.row_number().over(order) - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
