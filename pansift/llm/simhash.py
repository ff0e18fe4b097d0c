"""SimHash near-deduplication with deletion-variant signatures.

A 64-bit fingerprint is cut into the fewest segments of which one must differ
by at most one bit (three for four bits).  Each segment is indexed under its
one-wildcard variants: the segment with one bit struck out.  Two fingerprints
within the bound share a variant, so an equality join on variants finds all
candidates, which are verified on all 64 bits.

Only distinct fingerprints are indexed.  The fingerprints of a variant are
compared in blocks of bounded size; a variant with more is dealt to pairs of
blocks, so no task holds an unbounded group.  A block reports a spanning
forest of its links, never all pairs: once two fingerprints are known to be
connected they need no further comparison.  Components are then joined up by
Spark (``components``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pansift.llm._common import cut_lineage, id_and_text, once_each

BITS = 64
#: Fingerprints of a variant that are compared with each other in one step.
BLOCK = 4096
#: Shingles hashed at a time within one text.
_AT_ONCE = 1 << 16
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


# -- fingerprints ---------------------------------------------------------------

def fingerprint(text: str, shingle: int = 4) -> int:
    """SimHash of the word shingles of a whole text (no words: 0)."""
    import xxhash
    words = text.encode().translate(_LOWER).split()  # bytes split at the six ASCII white-space characters
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate([[0], gaps + 1])[:n].tolist()
    ends = np.concatenate([gaps, [len(joined)]])[len(words) - n:].tolist()
    h = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, _AT_ONCE):
        part = np.array([h(joined[a:b], 42) for a, b in zip(starts[at:at + _AT_ONCE], ends[at:at + _AT_ONCE])], np.uint64)
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.uint32)
    return int(sum(1 << k for k in np.flatnonzero(2 * counts > n).tolist()))


def text_key(text: Column) -> Column:
    """Digest of a text (null text: empty) that tells rows with equal ids apart."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text",
                 keyed: bool = False) -> DataFrame:
    """``doc_id, fp`` (signed 64 bits) per input row, and its ``key`` if
    ``keyed``; null texts count as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                fps = np.array([fingerprint(t, shingle) for t in part.column(1).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps.view(np.int64)), *part.columns[2:]],
                                                 names=["doc_id", "fp", "key"][:part.num_columns])

    rows = id_and_text(docs, id_col, text_col)
    if not keyed:
        return rows.mapInArrow(run, "doc_id long, fp long")
    return rows.withColumn("key", text_key(F.col("text"))).mapInArrow(run, "doc_id long, fp long, key binary")


# -- candidates -------------------------------------------------------------------

def segments(distance: int, bits: int = BITS) -> list[tuple[int, int]]:
    """(first bit, length) of the fewest segments of which one differs by at
    most one bit when ``distance`` bits differ: with m segments one has at
    most floor(distance / m) of them."""
    m = distance // 2 + 1
    edges = [round(k * bits / m) for k in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def variants(fp: Column, distance: int) -> Column:
    """Array of the variant keys of a fingerprint: the bits of a segment
    without one of them, and which segment and bit it is."""
    keys = []
    for s, (first, length) in enumerate(segments(distance)):
        seg = F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << length) - 1 if length < 64 else -1))
        for k in range(length):
            rest = seg.bitwiseAND(F.lit(~(1 << k)))
            keys.append(F.xxhash64(F.lit(s * BITS + k), rest) if length > 52
                        else rest.bitwiseOR(F.lit((s * BITS + k) << 53)))
    return F.array(*keys)


def forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links of a spanning forest over distinct fingerprints, of which those
    within ``distance`` bits are linked.  A fingerprint that was reached is
    compared only with those not reached yet."""
    left, found_links = np.arange(len(fps)), []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(fps[left] ^ fps[at]) <= distance
            if near.any():
                found = left[near]
                found_links += [(fps[at], x) for x in fps[found]]
                queue += found.tolist()
                left = left[~near]
    return found_links


#: Groups up to this size are compared at once, larger ones by ``forest``.
SMALL = 8


def compare_cells(cell: np.ndarray, fp: np.ndarray, distance: int) -> np.ndarray:
    """Links (n, 2) within runs of equal cells."""
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    size = np.diff(np.concatenate([first, [len(cell)]]))
    which = np.repeat(np.arange(len(first)), size)
    small = size[which] <= SMALL
    out = [np.empty((0, 2), np.uint64)]
    for d in range(1, min(SMALL, len(cell))):
        a, b = fp[:-d], fp[d:]
        hit = (which[:-d] == which[d:]) & small[:-d] & (np.bitwise_count(a ^ b) <= distance) & (a != b)
        out.append(np.stack([a[hit], b[hit]], axis=1))
    for k in np.flatnonzero(size > SMALL):
        got = forest(np.unique(fp[first[k]:first[k] + size[k]]), distance)
        out.append(np.array(got, np.uint64).reshape(-1, 2))
    return np.concatenate(out)


def links(fps: DataFrame, distance: int = 4, block: int = BLOCK) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fp``) that
    connect all that are within ``distance`` bits.  Each link is verified;
    links that others imply may be missing."""
    keyed = fps.select("fp", F.explode(variants(F.col("fp"), distance)).alias("key"))
    crowded = cut_lineage(keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block)
                          .select(F.col("key").alias("k"), F.ceil(F.col("n") / F.lit(block)).cast("int").alias("blocks")),
                          "crowded")
    # a block of a crowded variant meets itself and every other block
    dealt = keyed.join(crowded, F.col("key") == F.col("k"), "left")
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    with_mine = dealt.where(F.col("blocks").isNotNull()).withColumn("mine", mine)
    crossed = with_mine.select("fp", "key", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cells = dealt.where(F.col("blocks").isNull()).select(F.col("key").alias("cell"), "fp").unionByName(
        crossed.select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("cell"), "fp"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(c, f):
            got = compare_cells(c, f.view(np.uint64), distance).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(got.min(axis=1, initial=2**63 - 1)),
                                               pa.array(got.max(axis=1, initial=-2**63))], names=["a", "b"])

        held_c, held_f = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            c = np.concatenate([held_c, batch.column(0).to_numpy()])
            f = np.concatenate([held_f, batch.column(1).to_numpy()])
            if not len(c):
                continue
            cut = int(np.searchsorted(c, c[-1]))  # the last cell may go on in the next batch
            if cut:
                yield done(c[:cut], f[:cut])
            held_c, held_f = c[cut:], f[cut:]
        if len(held_c):
            yield done(held_c, held_f)

    dealt_out = cells.repartition("cell").sortWithinPartitions("cell")
    return dealt_out.mapInArrow(compare, "a long, b long").distinct()


# -- components -------------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """``node, root`` (root: smallest node reachable) for nodes with links
    ``a, b``, by alternating large and small stars; each round is written."""
    def signature(e):
        return e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()

    def star(e, small):
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if not small:
            both = both.unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        met = both.join(least, "u")
        out = met.where(F.col("v") != F.col("m") if small else F.col("v") > F.col("u")).select(
            F.col("v").alias("a"), F.col("m").alias("b"))
        if small:
            out = out.unionByName(least.where("u != m").select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.where("a != b").distinct()

    # an edge is kept as (larger, smaller)
    e = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(),
                    "edges")
    before = signature(e)
    while before.n:
        e = cut_lineage(star(star(e, small=False), small=True), "stars")
        after = signature(e)
        if after == before:
            break
        before = after
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def classes_of(rows: DataFrame, distance: int) -> DataFrame:
    """A written table, one row per fingerprint of ``rows`` (``doc_id, fp``):
    ``fp, root`` (the fingerprint that names its component) and
    ``component_id``."""
    least = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    found = components(links(least.select("fp"), distance))
    roots = found.join(least, F.col("node") == F.col("fp")).select("fp", "root", "least")
    ids = roots.groupBy("root").agg(F.min("least").alias("linked"))
    linked = roots.join(ids, "root").select(F.col("fp").alias("f"), "root", "linked")
    return cut_lineage(least.join(linked, F.col("fp") == F.col("f"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("linked", "least").alias("component_id")), "classes")


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, fingerprint`` (16 hex digits)``,
    component_id`` (smallest id reachable over links of at most ``distance``
    differing bits).

    Null texts count as empty; texts without words have fingerprint zero and
    are linked like any other; repeated rows give repeated results; null ids
    are never a component's id unless it has no other; other columns are not
    read; an empty table gives an empty result.
    """
    rows = cut_lineage(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    return rows.join(classes_of(rows, distance), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def survivors(docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """One row of each component of ``near_duplicates``, all columns: that
    with the smallest id, null ids last, and of several rows with this id the
    least.  Each row is decided by its own text, so ids may be null or name
    unlike texts; an empty table gives an empty result.
    """
    rows = cut_lineage(fingerprints(docs, shingle, id_col, text_col, keyed=True), "fingerprints")
    # rows with equal id and text are one until the end
    texts = rows.groupBy("fp", "doc_id", "key").agg(F.count("*").alias("n"))
    texts = cut_lineage(texts.join(classes_of(rows, distance).select("fp", "root"), "fp").select("root", "doc_id", "key", "n"),
                        "texts")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "n")
    heads = (texts.groupBy("root", "doc_id").agg(F.sum("n").alias("n")).groupBy("root").agg(F.min(order).alias("b"))
             .select(F.col("root").alias("r"), F.col("b.doc_id").alias("__id"), (F.col("b.n") > 1).alias("__rep")))
    marks = cut_lineage(texts.join(heads, (F.col("root") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("__id")))
                        .select("__id", F.col("key").alias("__key"), F.col("root").alias("__root"), "__rep"), "kept")
    keyed = docs.withColumn("__text_key", text_key(F.col(text_col)))
    hit = keyed.join(marks, F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.col("__text_key") == F.col("__key")))
    return once_each(hit, docs.columns, "__rep", "__root", bool(marks.where("__rep").head(1)))
