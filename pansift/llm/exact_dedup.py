"""Exact deduplication against a minimal perfect hash of historical digests.

A digest is the SHA-256 of a text without white space.  The distinct digests
of the history are dealt by hash into shards of bounded size.  Each shard gets
a minimal perfect hash: levels of bit maps in which a digest owns the bit that
no other digest of its level hits; its slot is the number of set bits before
it.  A slot holds the whole digest and the locator of the row that stays, so a
lookup ends with a byte-wise comparison, and digests outside the history are
told apart for sure.  Digests of a new batch are first reduced to one row each
(map-side), then looked up; members are repeats, nonmembers form groups of
their own.  Texts are read once and never shuffled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pansift.llm._common import SPACE, cut_lineage, id_and_text, once_each

#: Digests of one shard; what one task holds of the index (about 60 bytes each).
PER_SHARD = 50_000
#: Bits of a level for each digest that is left.
SPARE = 2
_LEVELS = 64
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE + "+", "")


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_points, digest`` of each row (null text: empty)."""
    t = id_and_text(docs, id_col, text_col)
    return t.select("doc_id", F.length("text").cast("long").alias("n_points"),
                    F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"))


def best_rows(rows: DataFrame) -> DataFrame:
    """One row per digest: how many rows and which stays (most code points,
    then smallest id, null ids last)."""
    order = F.struct((-F.col("n_points")).alias("less"), F.col("doc_id").isNull().alias("unnamed"), "doc_id")
    return (rows.groupBy("digest").agg(F.min(order).alias("b"), F.count("*").alias("n"))
            .select("digest", "n", (-F.col("b.less")).alias("n_points"), F.col("b.doc_id").alias("doc_id")))


# -- the perfect hash of one shard -------------------------------------------

def _mix(words: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (words * _ODD).sum(axis=1, dtype=np.uint64) + np.uint64((level * 0xA0761D6478BD642F) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _words(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 4)


def perfect_hash(words: np.ndarray) -> tuple[list[int], bytes, np.ndarray]:
    """Level sizes, their bits, and the slot of each (distinct) digest."""
    left, sizes, bits, base = np.arange(len(words)), [], [], 0
    slots = np.empty(len(words), np.int64)
    for level in range(_LEVELS):
        if not len(left):
            break
        size = -(-SPARE * len(left) // 8) * 8
        at = (_mix(words[left], level) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        mine = alone[at]
        rank = np.cumsum(alone) - 1
        slots[left[mine]] = base + rank[at[mine]]
        base += int(mine.sum())
        sizes.append(size)
        bits.append(np.packbits(alone))
        left = left[~mine]
    if len(left):
        raise ValueError("equal digests in one perfect hash")
    return sizes, b"".join(x.tobytes() for x in bits), slots


def find_slots(words: np.ndarray, sizes: list[int], bits: bytes) -> np.ndarray:
    """The only slot that a digest can have, -1 if none."""
    flags = np.unpackbits(np.frombuffer(bits, np.uint8))
    rank = np.cumsum(flags, dtype=np.int64) - 1
    slots, left, start = np.full(len(words), -1, np.int64), np.arange(len(words)), 0
    for level, size in enumerate(sizes):
        at = start + (_mix(words[left], level) % np.uint64(size)).astype(np.int64)
        hit = flags[at] == 1
        slots[left[hit]] = rank[at[hit]]
        left, start = left[~hit], start + size
    return slots


# -- index and lookup ---------------------------------------------------------

def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int").alias("shard")


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """One row per shard: ``shard, sizes, bits, digests, n, n_points, doc_ids``
    of ``history`` (as ``best_rows`` gives it), the last four in slot order."""
    def build(g: pd.DataFrame) -> pd.DataFrame:
        sizes, bits, slots = perfect_hash(_words(list(g["digest"])))
        g = g.iloc[np.argsort(slots)]
        ids = [None if pd.isna(x) else int(x) for x in g["doc_id"]]
        return pd.DataFrame({"shard": [int(g["shard"].iloc[0])], "sizes": [sizes], "bits": [bits],
                             "digests": [b"".join(g["digest"])], "n": [g["n"].tolist()],
                             "n_points": [g["n_points"].tolist()], "doc_ids": [ids]})

    return (history.select(_shard(shards), "digest", "n", "n_points", _id_text().alias("doc_id")).groupBy("shard")
            .applyInPandas(build, "shard int, sizes array<int>, bits binary, digests binary, n array<long>, "
                                  "n_points array<long>, doc_ids array<long>"))


def _id_text() -> Column:
    """Ids as text on the way through pandas, whose number columns turn ids
    with nulls among them into floats."""
    return F.col("doc_id").cast("string")


def look_up(index: DataFrame, batch: DataFrame, shards: int) -> DataFrame:
    """All groups after ``batch`` (as ``best_rows`` gives it) met the index:
    ``digest, n, n_points, doc_id, known`` (known: the history has it)."""
    def better(a, b):
        key = lambda x: (-x[0], x[1] is None, x[1] or 0)
        return min(a, b, key=key)

    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        new = [(d, int(n), int(p), None if pd.isna(i) else int(i))
               for d, n, p, i in zip(left["digest"], left["n"], left["n_points"], left["doc_id"])]
        if len(right):
            ix = right.iloc[0]
            full, old_n, old_p, old_i = ix["digests"], list(ix["n"]), list(ix["n_points"]), list(ix["doc_ids"])
            old_i = [None if pd.isna(x) else int(x) for x in old_i]
            if new:
                found = find_slots(_words([x[0] for x in new]), list(ix["sizes"]), ix["bits"])
                for (d, n, p, i), s in zip(new, found):
                    if s >= 0 and full[32 * s:32 * s + 32] == d:
                        old_n[s] += n
                        old_p[s], old_i[s] = better((old_p[s], old_i[s]), (p, i))
                    else:
                        rows.append((d, n, p, i, False))
            rows += [(full[32 * s:32 * s + 32], int(old_n[s]), int(old_p[s]), old_i[s], True) for s in range(len(old_n))]
        else:
            rows = [(*x, False) for x in new]
        out = pd.DataFrame(rows, columns=["digest", "n", "n_points", "doc_id", "known"])
        out["doc_id"] = [None if x[3] is None else str(x[3]) for x in rows]
        return out

    cells = batch.select(_shard(shards), "digest", "n", "n_points", _id_text().alias("doc_id"))
    return (cells.groupBy("shard").cogroup(index.groupBy("shard"))
            .applyInPandas(probe, "digest binary, n long, n_points long, doc_id string, known boolean")
            .withColumn("doc_id", F.col("doc_id").cast("long")))


def decide(docs: DataFrame, is_history: Column | None, per_shard: int, id_col: str, text_col: str
           ) -> tuple[DataFrame, DataFrame]:
    """Written tables: the digests of all rows, and the groups of equal ones."""
    rows = cut_lineage(digest_rows(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "digests")
    if is_history is None:
        ends = rows.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).first()
        is_history = F.col("doc_id") <= F.lit((ends.a + ends.b) // 2 if ends.a is not None else 0)
    old = F.coalesce(is_history, F.lit(False))
    history, batch = (cut_lineage(best_rows(rows.where(c)), n) for c, n in ((old, "history"), (~old, "batch")))
    shards = max(1, -(-max(history.count(), batch.count()) // per_shard))
    index = cut_lineage(build_index(history, shards), "index")
    groups = cut_lineage(look_up(index, batch, shards).withColumnsRenamed(
        {"n": "group_size", "doc_id": "keep_id", "n_points": "keep_points"}), "groups")
    return rows, groups


def dedup(docs: DataFrame, is_history: Column | None = None, per_shard: int = PER_SHARD,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept,
    text_sha256, known``.

    ``is_history`` (over ``doc_id``) tells the rows that are archived already
    from the new batch; by default the lower half of the id range is history.
    Null ids are new and lose ties; null texts equal empty ones and texts of
    white space only; of rows with equal id and text exactly one is kept;
    other columns are not read; an empty table gives an empty result.
    """
    rows, groups = decide(docs, is_history, per_shard, id_col, text_col)
    # of rows with equal id and text, and so of any number in one place, the one written first
    stays = rows.join(groups.select("digest", "keep_id", "keep_points"), "digest").where(_stays())
    groups = groups.join(stays.groupBy("digest").agg(F.min("row").alias("first")), "digest")
    return (rows.join(groups, "digest")
            .select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("first")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256"), "known"))


def _stays() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("keep_points"))


def survivors(docs: DataFrame, is_history: Column | None = None, per_shard: int = PER_SHARD,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; cases as in
    ``dedup``.  A row meets the decision by id, code points and digest, so
    rows that share an id, or have none, meet only that on their own text."""
    rows, groups = decide(docs, is_history, per_shard, id_col, text_col)
    ends = groups.select("digest", "keep_id", "keep_points")
    marks = cut_lineage(rows.join(ends, "digest").where(_stays()).groupBy("digest", "keep_id", "keep_points")
                        .agg((F.count("*") > 1).alias("__rep")), "stays")
    marks = marks.select(F.col("digest").alias("__digest"), F.col("keep_id").alias("__id"),
                         F.col("keep_points").alias("__points"), "__rep")
    text = F.coalesce(docs[text_col], F.lit(""))
    dealt = docs.withColumns({"__length": F.length(text).cast("long"), "__sha": F.unhex(F.sha2(normalised(text), 256))})
    hit = dealt.join(marks, F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.col("__length") == F.col("__points"))
                     & (F.col("__sha") == F.col("__digest")))
    return once_each(hit, docs.columns, "__rep", "__digest", bool(marks.where("__rep").head(1)))
