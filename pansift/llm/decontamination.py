"""Benchmark decontamination with a distributed positional inverted index.

Index: the documents' words are stored as postings, in *segments* of about
``SEGMENT`` words of whole documents.  A segment is one row: its terms in
order, and for each the ascending positions at which it occurs.  Documents lie one
free position apart, so no run of neighbouring positions crosses an edge.
Terms are not shuffled: however common a word is, its postings stay spread over the
segments, and any other test set can be asked of the written index.

Search: every window of the test items meets every segment.  A window with a
term that the segment lacks ends at once.  For the others the list of the rarest
term, less its offset, gives the possible starts; they are intersected with the
lists of the other terms, less theirs, from rare to common.  What is left are
exact phrases.  Proximity matches start from the rarest term as well, and ask the
other lists for their places nearby.  A window that several items share is
searched once.

Test items are sent to the tasks in lots of at most about ``LOT_BYTES`` of text; a
larger set takes several passes over the index.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pansift.llm._common import id_and_text, prepare
from pansift.session import scratch_path

#: Words of a segment (a longer document has one of its own): positions take two bytes.
SEGMENT = 1 << 16
#: Text of the test items that goes to the tasks in one pass.
LOT_BYTES = 4 << 20
#: Possible starts that are looked at in one step.
AT_ONCE = 1 << 20
#: Row groups of the index, so that few segments are in memory at a time.
_GROUP_BYTES = 8 << 20

# Words are `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after A-Z became a-z, so of the bytes
# below 128 only digits and letters belong to words, and every byte of other characters does.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

_SEGMENT_TYPE = ("segment long, doc_ids array<long>, starts array<int>, sizes array<int>, terms binary, "
                 "ends binary, positions binary")


def words(text: str | None) -> list[bytes]:
    """The lower-cased words of a text, in UTF-8; null has none."""
    return (text or "").encode().translate(_WORD_BYTES).split()


@dataclass
class Segment:
    """Postings of some whole documents: ``keys`` are the ascending
    ``term * span + position`` of all words, ``ends`` where each term's end."""
    doc_ids: list
    starts: np.ndarray
    sizes: np.ndarray
    terms: list[bytes]
    ends: np.ndarray
    positions: np.ndarray

    def __post_init__(self):
        counts = np.diff(self.ends, prepend=0)
        self.counts = counts
        self.span = int(self.starts[-1]) + int(self.sizes[-1]) + 1
        self.keys = np.repeat(np.arange(len(self.terms), dtype=np.int64) * self.span, counts) + self.positions


def invert(docs: list[tuple[int | None, list[bytes]]]) -> Segment:
    """The segment of ``(doc_id, words)`` pairs."""
    sizes = np.array([len(w) for _, w in docs], np.int32)
    starts = np.concatenate([[0], np.cumsum(sizes[:-1] + 1)]).astype(np.int32)
    flat = [w for _, part in docs for w in part]
    terms = sorted(set(flat))
    number = {t: k for k, t in enumerate(terms)}
    of = np.fromiter(map(number.__getitem__, flat), np.int32, len(flat))
    order = np.argsort(of, kind="stable")
    places = np.arange(len(flat), dtype=np.int64) + np.repeat(np.arange(len(docs)), sizes)
    return Segment([i for i, _ in docs], starts, sizes, terms, np.cumsum(np.bincount(of, minlength=len(terms))), places[order])


def _packed(number: int, docs: list) -> pa.RecordBatch:
    s = invert(docs)
    small = np.uint16 if s.span <= 1 << 16 else np.uint32
    columns = [pa.array([number], pa.int64()), pa.array([s.doc_ids], pa.list_(pa.int64())),
               pa.array([s.starts.tolist()], pa.list_(pa.int32())), pa.array([s.sizes.tolist()], pa.list_(pa.int32())),
               pa.array([b" ".join(s.terms)], pa.binary()), pa.array([s.ends.astype("<u4").tobytes()], pa.binary()),
               pa.array([s.positions.astype(np.dtype(small).newbyteorder("<")).tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["segment", "doc_ids", "starts", "sizes", "terms", "ends", "positions"])


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[int, Segment]]:
    for row in range(batch.num_rows):
        r = {n: batch.column(k)[row] for k, n in enumerate(batch.schema.names)}
        ends = np.frombuffer(r["ends"].as_py(), "<u4").astype(np.int64)
        raw = r["positions"].as_py()
        wide = len(raw) // max(1, int(ends[-1]) if len(ends) else 1)
        yield r["segment"].as_py(), Segment(
            r["doc_ids"].as_py(), np.array(r["starts"].as_py(), np.int64), np.array(r["sizes"].as_py(), np.int64),
            r["terms"].as_py().split(), ends, np.frombuffer(raw, "<u2" if wide == 2 else "<u4").astype(np.int64))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the index of ``docs``; its rows are the segments.

    Every row of ``docs`` is one entry, also rows without an id, without text or
    words, and rows that repeat others.  Other columns are not read; an empty
    table gives an empty index."""
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        # unique in the table that is written: one attempt of each partition gets into it
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                got = words(text.as_py())
                if held and size + len(got) + 1 > SEGMENT:
                    yield _packed(number, held)
                    number, held, size = number + 1, [], 0
                held.append((i, got))
                size += len(got) + 1
        if held:
            yield _packed(number, held)

    path = scratch_path(spark, "positional-index")
    (id_and_text(docs, id_col, text_col).mapInArrow(run, _SEGMENT_TYPE)
     .write.option("parquet.block.size", _GROUP_BYTES).parquet(path))
    return spark.read.schema(_SEGMENT_TYPE).parquet(path)


class Windows:
    """The distinct windows of some test items: ``size`` words in a row, or all
    words of an item that has fewer.  ``grams`` holds word numbers, padded by
    ``len(vocabulary)``; ``held`` / ``items`` say which items hold a window."""

    def __init__(self, items: Iterable[tuple[int | None, str | None]], size: int):
        self.size, self.vocabulary = size, {}
        numbers = [(i, np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in got], np.int32))
                   for i, t in items if (got := words(t))]
        grams = [np.zeros((0, size), np.int32)]
        owner = []
        for i, got in numbers:
            pad = max(0, size - len(got))
            got = np.pad(got, (0, pad), constant_values=len(self.vocabulary))
            grams.append(np.lib.stride_tricks.sliding_window_view(got, size))
            owner += [i] * len(grams[-1])
        self.grams, which = np.unique(np.concatenate(grams), axis=0, return_inverse=True)
        # an item that repeats a window holds it once; items without an id come as one
        ids = sorted({i for i in owner if i is not None})
        place = {i: k for k, i in enumerate(ids)} | {None: len(ids)}
        self.ids = ids + [None]
        pairs = np.unique(which.reshape(-1).astype(np.int64) * len(self.ids) + np.array([place[i] for i in owner], np.int64))
        self.held = np.searchsorted(pairs // len(self.ids), np.arange(len(self.grams) + 1))
        self.items = pairs % len(self.ids)
        self.lengths = (self.grams < len(self.vocabulary)).sum(axis=1)

    def alive(self, s: Segment) -> tuple[np.ndarray, ...]:
        """Windows all of whose terms the segment has; their terms' numbers
        there (padding: -1), and offsets from the rarest term to the most common."""
        local = np.full(len(self.vocabulary) + 1, -1, np.int64)
        for k, t in enumerate(s.terms):
            n = self.vocabulary.get(t)
            if n is not None:
                local[n] = k
        counts = np.append(s.counts, 0)[local]
        counts[-1] = s.span + 1  # padding: after all terms
        left = np.flatnonzero((counts > 0)[self.grams].all(axis=1))
        grams = self.grams[left]
        return left, local[grams], np.argsort(counts[grams], axis=1, kind="stable")

    def _starts(self, s: Segment, terms: np.ndarray, order: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Possible ``(row, place of the rarest term)``, ``AT_ONCE`` rows or so at a time."""
        rarest = terms[np.arange(len(terms)), order[:, 0]]
        counts = s.counts[rarest]
        total = np.cumsum(counts)
        at = 0
        while at < len(terms):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + AT_ONCE, side="right")))
            n = counts[at:to]
            first = (s.ends - s.counts)[rarest[at:to]]
            rows = np.repeat(np.arange(at, to), n)
            yield rows, s.positions[np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))]
            at = to

    def phrases(self, s: Segment) -> tuple[np.ndarray, np.ndarray]:
        """``window, start`` of every occurrence in the segment."""
        left, terms, order = self.alive(s)
        out = []
        for rows, at in self._starts(s, terms, order) if len(left) else ():
            starts = at - order[rows, 0]
            for r in range(1, self.size):
                offset = order[rows, r]
                term = terms[rows, offset]
                key = term * s.span + starts + offset
                found = (s.keys[np.minimum(np.searchsorted(s.keys, key), len(s.keys) - 1)] == key) & (starts + offset < s.span)
                keep = (term < 0) | (found & (starts >= 0))
                rows, starts = rows[keep], starts[keep]
            out.append((left[rows], starts))
        return tuple(map(np.concatenate, zip(*out))) if out else (np.zeros(0, np.int64),) * 2

    def nearby(self, s: Segment, within: int) -> tuple[np.ndarray, ...]:
        """``window, first, last``: for each occurrence of a window's rarest term, the shortest
        stretch (the leftmost of equals) of at most ``within`` words of the document that
        holds it and every other term of the window, in any order."""
        left, terms, order = self.alive(s)
        out = []
        for rows, at in self._starts(s, terms, order) if len(left) else ():
            doc = np.searchsorted(s.starts, at, side="right") - 1
            low = np.maximum(at - within + 1, s.starts[doc])
            high = np.minimum(at + within - 1, s.starts[doc] + s.sizes[doc] - 1)
            for r in range(1, self.size):
                term = terms[rows, order[rows, r]]
                key = np.searchsorted(s.keys, term * s.span + low)
                keep = (term < 0) | (s.keys[np.minimum(key, len(s.keys) - 1)] <= term * s.span + high) & (key < len(s.keys))
                rows, at, low, high = rows[keep], at[keep], low[keep], high[keep]
            for row, p, a, b in zip(rows.tolist(), at.tolist(), low.tolist(), high.tolist()):
                best = _shortest(s, {t for t in terms[row].tolist() if t >= 0}, p, a, b)
                if best and best[1] - best[0] < within:
                    out.append((left[row], *best))
        return tuple(np.array(x, np.int64) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def _shortest(s: Segment, terms: set[int], at: int, low: int, high: int) -> tuple[int, int] | None:
    """The shortest stretch of ``low`` to ``high`` with place ``at`` and all ``terms``."""
    places = sorted((int(k) - t * s.span, t) for t in terms
                    for k in s.keys[np.searchsorted(s.keys, t * s.span + low):np.searchsorted(s.keys, t * s.span + high, side="right")])
    held: dict[int, int] = {}
    best, left = None, 0
    for p, t in places:
        held[t] = held.get(t, 0) + 1
        while held[places[left][1]] > 1 and places[left][0] < at:
            held[places[left][1]] -= 1
            left += 1
        if len(held) == len(terms) and places[left][0] <= at <= p and (best is None or p - places[left][0] < best[1] - best[0]):
            best = places[left][0], p
    return best


def _stretches(s: Segment, w: Windows, window: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """``place of the document, item, first, last`` in the segment, touching stretches of an item joined."""
    at = np.lexsort((last, first))  # by place, so that what a step cuts apart are few stretches
    window, first, last = window[at], first[at], last[at]
    n = w.held[window + 1] - w.held[window]
    total = np.cumsum(n)
    begin = 0
    while begin < len(window):
        end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + AT_ONCE, side="right")))
        k = n[begin:end]
        item = w.items[np.repeat(w.held[window[begin:end]] - np.concatenate([[0], np.cumsum(k)[:-1]]), k) + np.arange(int(k.sum()))]
        a, b = np.repeat(first[begin:end], k), np.repeat(last[begin:end], k)
        order = np.lexsort((a, item))
        item, a, b = item[order], a[order], b[order]
        reach = np.maximum.accumulate(item * (s.span + 2) + b)
        new = np.concatenate([[True], (item[1:] * (s.span + 2) + a[1:]) > reach[:-1] + 1])
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(a)) - 1
        item, a, b = item[heads], a[heads], reach[tails] - item[heads] * (s.span + 2)
        yield np.searchsorted(s.starts, a, side="right") - 1, item, a, b
        begin = end


_MATCH_TYPE = "segment long, place int, doc_id long, item_id long, first int, last int"


def _lots(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """The distinct test items, in lots of about ``LOT_BYTES`` of text."""
    rows = items.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).where(F.col("t").isNotNull()).distinct()
    total = rows.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    lots = -(-int(total) // LOT_BYTES)
    for k in range(lots):
        yield [(r["i"], r["t"]) for r in rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(lots)) == k).collect()]


def search(index: DataFrame, items: DataFrame, size: int = 10, within: int | None = None,
           id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``segment, place, doc_id, item_id, first, last``: stretches of words
    (numbered from 0 in the document) covered by windows of ``size`` words of the item.

    Without ``within``, exact phrases; with it, proximity matches: all terms of
    the window within so many words.  Touching stretches of one item in one
    document are joined.  ``segment`` and ``place`` tell rows of ``docs`` apart
    that share an id.  Items without words give nothing; rows of one ``item_id`` are
    one item; items without an id give rows without one.
    """
    spark = index.sparkSession
    prepare(spark)
    paths = []
    for lot in _lots(items, id_col, text_col):
        asked = spark.sparkContext.broadcast(Windows(lot, size))

        def run(batches: Iterator[pa.RecordBatch], asked=asked) -> Iterator[pa.RecordBatch]:
            w = asked.value
            for batch in batches:
                for number, s in _segments(batch):
                    if within is None:
                        window, first = w.phrases(s)
                        last = first + w.lengths[window] - 1
                    else:
                        window, first, last = w.nearby(s, within)
                    for doc, item, a, b in _stretches(s, w, window, first, last):
                        base = s.starts[doc]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(doc), number)), pa.array(doc, pa.int32()),
                             pa.array([s.doc_ids[d] for d in doc], pa.int64()), pa.array([w.ids[i] for i in item], pa.int64()),
                             pa.array(a - base, pa.int32()), pa.array(b - base, pa.int32())],
                            names=["segment", "place", "doc_id", "item_id", "first", "last"])

        paths.append(scratch_path(spark, "phrase-matches"))
        index.mapInArrow(run, _MATCH_TYPE).write.parquet(paths[-1])
        asked.unpersist()
    return spark.read.schema(_MATCH_TYPE).parquet(*paths) if paths else spark.createDataFrame([], _MATCH_TYPE)


def contamination(docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, items`` (sorted ids).

    A word is hit if it lies in an exact occurrence of a window.  Null and
    empty texts have no words; rows without an id, or that repeat others, get
    their own row; items without an id hit words but are not listed.  An empty
    table gives an empty result, without items nothing is hit."""
    index = build_index(docs, id_col, text_col)
    found = search(index, items, size, None, item_id_col, item_text_col)
    # stretches of several items may overlap: in order, each adds what lies beyond those before it
    hit = F.aggregate(
        F.sort_array("spans"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("reach")),
        lambda acc, x: F.struct((acc["n"] + F.greatest(F.lit(0), x["last"] - F.greatest(acc["reach"], x["first"] - 1))).alias("n"),
                                F.greatest(acc["reach"], x["last"]).alias("reach")), lambda acc: acc["n"])
    hits = (found.groupBy("segment", "place").agg(F.collect_set("item_id").alias("items"),
                                                  F.collect_list(F.struct("first", "last")).alias("spans"))
            .select("segment", "place", F.sort_array("items").alias("items"), hit.alias("n_hit")))
    rows = (index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "sizes")).alias("place", "d"))
            .select("segment", "place", F.col("d.doc_ids").alias("doc_id"), F.col("d.sizes").cast("long").alias("n_words")))
    return rows.join(hits, ["segment", "place"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"))
