"""Cross-tokenizer alignment of whole texts by diagonal run skipping.

Two tokenizers cut the same bytes; where both end a token, a *group* ends.
Along a stretch of one-to-one tokens the two arrays of token ends agree at a
fixed shift, so the arrays are compared at the current shift in probes of
doubling length and whole stretches are jumped.  Where they differ, the group is
resolved token by token, and the shift becomes what the two sides then differ by.

Two token occurrences are *linked* if their bytes overlap.  How often an id pair is
linked in the corpus takes one more pass: documents are packed to *blocks* that
hold each linked pair once, the pairs' counts are summed by pair, and each block
gets its own pairs' totals back.  So a pair travels once per block and not once per
link, and a pair that is everywhere is still one row per block.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pansift.llm import piece_codec
from pansift.llm._common import VOCAB, cut_lineage, id_and_text, prepare, vocabulary
from pansift.llm.piece_codec import MARK

#: Entries (a pair of a document) after which a block ends with its document.
BLOCK = 1 << 20
#: Longer texts are tokenized in parts of about this many characters, cut at spaces.
PART = 1 << 16
#: A part without such a space is left to the tokenizers library beyond this length.
LONG = 1 << 18
#: Documents tokenized at a time, and characters of them.
AT_ONCE, CHARS_AT_ONCE = 500, 1 << 20

# How byte-level vocabularies cut a text before merging, and which
# characters stand for bytes that are not printable.
BYTE_LEVEL_CUT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

#: A space between two characters that are no white space: both tokenizers start a token there.
_SAFE = re.compile(r"(?<=\S) (?=\S)")


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary entry stands for."""
    rest = [b for b in range(256) if b not in set(_PRINTABLE)]
    return {chr(b): b for b in _PRINTABLE} | {chr(256 + k): b for k, b in enumerate(rest)}


def parts(text: str, size: int = PART) -> list[str]:
    """The text in parts of ``size`` characters or more, each but the first beginning with the space it was cut at."""
    if len(text) <= 2 * size:
        return [text]
    out, at = [], 0
    while len(text) - at > 2 * size:
        cut = _SAFE.search(text, at + size)
        if cut is None:
            break
        out.append(text[at:cut.start()])
        at = cut.start()
    return [*out, text[at:]]


class ByteLevel:
    """A byte-level BPE vocabulary file (``.json``), its special tokens off."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, byte = spec["model"], byte_of_char()
        self.special = {t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of = [b""] * (1 + max([*model["vocab"].values(), *self.special]))
        for entry, i in model["vocab"].items():
            if i not in self.special:
                self.bytes_of[i] = bytes(byte[c] for c in entry)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ranks = {b: i for i, b in enumerate(self.bytes_of) if i not in self.special}
        first = len(ranks) - len(pairs)
        if any(ranks[bytes(byte[c] for c in a + b)] != first + k for k, (a, b) in enumerate(pairs)):
            raise ValueError("the ids of the vocabulary do not follow its merges")
        pre = spec.get("pre_tokenizer") or {}
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("not a plain byte-level vocabulary")
        self.lossless = all(bytes([b]) in ranks for b in range(256))
        self.fast = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_CUT, mergeable_ranks=ranks, special_tokens={})
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True

    def encode(self, text: str) -> list[int]:
        out = []
        for part in parts(text):
            out += self.fast.encode_ordinary(part) if len(part) <= LONG else self.library.encode(part, add_special_tokens=False).ids
        return out


class Pieces:
    """A SentencePiece BPE model with byte fallback, encoding plain text."""

    def __init__(self, path: str):
        p = piece_codec.pieces(path)
        self.sp = p.sp
        self.bytes_of = [bytes([p.byte_of[i]]) if i in p.byte_of else t.replace(MARK, " ").encode() for i, t in enumerate(p.texts)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        cut = [parts(t) for t in texts]
        # the library puts a space before what it is given: the one that a later part begins with goes
        got = iter(self.sp.encode([t[1:] if k else t for c in cut for k, t in enumerate(c)], num_threads=1))
        return [next(got) if len(c) == 1 else [i for _ in c for i in next(got)] for c in cut]


def straight(ends_a: list[int], ends_b: list[int], i: int, j: int) -> int:
    """How many tokens from ``i`` and ``j`` on end alike at this shift, in probes of doubling length."""
    run, probe = 0, 4
    while True:
        a, b = ends_a[i + run:i + run + probe], ends_b[j + run:j + run + probe]
        if a != b:
            for x, y in zip(a, b):
                if x != y:
                    break
                run += 1
            return run
        if len(a) < probe:  # both end here
            return run + len(a)
        run += probe
        probe *= 2


def diagonal_runs(ends_a: list[int], ends_b: list[int]) -> Iterator[tuple[int, int, int, int, bool]]:
    """``(a0, a1, b0, b1, straight)``: in order, stretches of one-to-one tokens
    (straight) and single groups of others.  Both arrays ascend to the same last end."""
    i = j = 0
    while i < len(ends_a):
        run = straight(ends_a, ends_b, i, j)
        if run:
            yield i, i + run, j, j + run, True
            i, j = i + run, j + run
            if i >= len(ends_a):
                break
        a, b = i, j
        while ends_a[a] != ends_b[b]:
            if ends_a[a] < ends_b[b]:
                a += 1
            else:
                b += 1
        yield i, a + 1, j, b + 1, False
        i, j = a + 1, b + 1


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.size_a, self.size_b = list(map(len, self.a.bytes_of)), list(map(len, self.b.bytes_of))
        self.name_a, self.name_b = list(map(str, range(len(self.size_a)))), list(map(str, range(len(self.size_b))))

    def tokens(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of both sides per text; both empty if their bytes are not those of space + text."""
        given = [t for t in texts if t]
        pieces = iter(self.b.encode(given))
        for text in texts:
            if not text:
                yield [], []
                continue
            b, raw = next(pieces), (" " + text).encode()
            if b"".join(map(self.b.bytes_of.__getitem__, b)) != raw:
                yield [], []
                continue
            a = self.a.encode(" " + text)
            # with every byte in the vocabulary nothing gets lost on the byte-level side
            yield (a, b) if self.a.lossless or b"".join(map(self.a.bytes_of.__getitem__, a)) == raw else ([], [])

    def ends(self, a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
        """Byte offsets at which the tokens end."""
        return list(accumulate(map(self.size_a.__getitem__, a))), list(accumulate(map(self.size_b.__getitem__, b)))

    def groups(self, a: list[int], b: list[int]) -> list[tuple[list[int], list[int]]]:
        """Ids of each group, in order."""
        out = []
        for i, i2, j, j2, one in diagonal_runs(*self.ends(a, b)):
            out += [([x], [y]) for x, y in zip(a[i:i2], b[j:j2])] if one else [(a[i:i2], b[j:j2])]
        return out

    def links(self, a: list[int], b: list[int]) -> tuple[list[int], list[int], int, str]:
        """Ids of every link (one list per side), the number of groups, and their
        text.  Goes the way of ``diagonal_runs``, and links on it."""
        ends_a, ends_b = self.ends(a, b)
        name_a, name_b = list(map(self.name_a.__getitem__, a)), list(map(self.name_b.__getitem__, b))
        link_a, link_b, n, text, i, j, last = [], [], 0, [], 0, 0, len(a)
        while i < last:
            run = straight(ends_a, ends_b, i, j)
            if run:
                link_a += a[i:i + run]
                link_b += b[j:j + run]
                text += map("|".join, zip(name_a[i:i + run], name_b[j:j + run]))
                n, i, j = n + run, i + run, j + run
                if i >= last:
                    break
            first_a, first_b, x, y = i, j, ends_a[i], ends_b[j]
            link_a.append(a[i])
            link_b.append(b[j])
            while x != y:  # the side that ends first goes on: its next token overlaps the other's
                if x < y:
                    i += 1
                    x = ends_a[i]
                else:
                    j += 1
                    y = ends_b[j]
                link_a.append(a[i])
                link_b.append(b[j])
            n, i, j = n + 1, i + 1, j + 1
            text.append(",".join(name_a[first_a:i]) + "|" + ",".join(name_b[first_b:j]))
        return link_a, link_b, n, ";".join(text)


@functools.lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts, a bounded number at a time."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
            t = t.as_py()
            if texts and (len(texts) == AT_ONCE or size + len(t) > CHARS_AT_ONCE):
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t)
            size += len(t)
        if texts:
            yield ids, texts


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``doc_id, groups`` (array of structs of two id arrays ``a``, ``b``) per row;
    cases as in ``link_counts``."""
    path_a, path_b = path_a or vocabulary("byte_bpe_50k.json"), path_b or vocabulary(VOCAB)
    kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(path_a, path_b)
        for ids, texts in _texts(batches):
            rows = [[{"a": x, "b": y} for x, y in al.groups(a, b)] for a, b in al.tokens(texts)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, kind)], names=["doc_id", "groups"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, groups array<struct<a: array<int>, b: array<int>>>")


# -- blocks ----------------------------------------------------------------------

_DOC = pa.struct([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                  ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("entries", pa.int32())])
_BLOCK_TYPE = ("block long, docs array<struct<doc_id: long, n_a: long, n_b: long, n_groups: long, n_links: long, "
               "groups_sha256: string, entries: int>>, pairs array<long>, counts array<long>, refs binary, times binary")


def _squeezed(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, equal bytes of each together, compressed."""
    import zstandard
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _loosened(data: bytes) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4")


def _block(number: int, docs: list[dict], pairs: list[np.ndarray], times: list[np.ndarray]) -> pa.RecordBatch:
    """Documents, the pairs that they link (each once, with its count), and for
    each document which of them (``refs``: differences, which wrap around) and how often."""
    flat, often = np.concatenate(pairs), np.concatenate(times)
    distinct, refs = np.unique(flat, return_inverse=True)
    counts = np.bincount(refs, weights=often, minlength=len(distinct)).astype(np.int64)
    steps = np.diff(refs.reshape(-1).astype(np.uint32), prepend=np.uint32(0))
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), pa.array([docs], pa.list_(_DOC)),
         pa.ListArray.from_arrays(pa.array([0, len(distinct)], pa.int32()), pa.array(distinct, pa.int64())),
         pa.ListArray.from_arrays(pa.array([0, len(distinct)], pa.int32()), pa.array(counts, pa.int64())),
         pa.array([_squeezed(steps)], pa.binary()), pa.array([_squeezed(often)], pa.binary())],
        names=["block", "docs", "pairs", "counts", "refs", "times"])


def blocks(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str) -> DataFrame:
    """The written blocks of ``docs``: everything that alignment gives, except corpus-wide counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        al = aligner(path_a, path_b)
        # unique in the table that is written: one attempt of each partition gets into it
        number, held, pairs, times, size = TaskContext.get().partitionId() << 32, [], [], [], 0
        for ids, texts in _texts(batches):
            for i, (a, b) in zip(ids, al.tokens(texts)):
                link_a, link_b, n, text = al.links(a, b)
                key, often = np.unique(np.array(link_a, np.int64) << 32 | np.array(link_b, np.int64), return_counts=True)
                held.append({"doc_id": i, "n_a": len(a), "n_b": len(b), "n_groups": n, "n_links": len(link_a),
                             "groups_sha256": hashlib.sha256(text.encode()).hexdigest() if a else "", "entries": len(key)})
                pairs.append(key)
                times.append(often)
                size += len(key)
                if size >= BLOCK:
                    yield _block(number, held, pairs, times)
                    number, held, pairs, times, size = number + 1, [], [], [], 0
        if held:
            yield _block(number, held, pairs, times)

    return cut_lineage(id_and_text(docs, id_col, text_col).mapInArrow(run, _BLOCK_TYPE), "alignment-blocks")


def pair_totals(packed: DataFrame) -> DataFrame:
    """``pair, a, b, links, best`` of every linked id pair: its links in the
    corpus, and whether no other A id has more with the same B id."""
    pairs = packed.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).select("p.pairs", "p.counts")
    total = pairs.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("links"))
    # a B id meets at most as many pairs as A has ids
    total = total.withColumn("b", F.col("pair").bitwiseAND((1 << 32) - 1).cast("int"))
    most = F.max("links").over(Window.partitionBy("b"))
    return total.select("pair", F.shiftright("pair", 32).cast("int").alias("a"), "b", "links", (F.col("links") == most).alias("best"))


_RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _with_totals(totals: pa.Table, packed: pa.Table) -> pa.Table:
    """The documents of one block, their links weighed by the totals of its pairs."""
    at = totals.column("at").to_numpy()
    value = np.empty(len(at), np.int64)
    value[at] = totals.column("value").to_numpy()
    best, links = value & 1, value >> 1
    out = []
    for row in range(packed.num_rows):  # one
        docs = packed.column("docs")[row].values
        refs = np.cumsum(_loosened(packed.column("refs")[row].as_py()), dtype=np.uint32)
        often = _loosened(packed.column("times")[row].as_py()).astype(np.int64)
        ends = np.cumsum(docs.field("entries").to_numpy())

        def by_doc(x):
            sums = np.concatenate([[0], np.cumsum(x)])
            return pa.array(np.diff(sums[np.concatenate([[0], ends])]), pa.int64())
        columns = {n: docs.field(n) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
        columns |= {"n_best": by_doc(best[refs] * often), "count_sum": by_doc(links[refs] * often)}
        out.append(pa.table({n.split()[0]: columns[n.split()[0]] for n in _RESULT.split(", ")}))
    return pa.concat_tables(out)


def link_counts(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    Texts that are null or empty, or that either side does not give back byte
    by byte (with a space before), have no tokens: zeros, and an empty
    ``groups_sha256``.  Rows without an id, or that repeat others, get their own row and
    count each time; other columns are not read; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    packed = blocks(docs, path_a or vocabulary("byte_bpe_50k.json"), path_b or vocabulary(VOCAB), id_col, text_col)
    value = (F.col("links") * 2 + F.col("best").cast("long")).alias("value")
    asked = packed.select(F.col("block").alias("of_block"), F.posexplode("pairs").alias("at", "pair"))
    answered = asked.join(pair_totals(packed).select("pair", value), "pair").select("of_block", "at", "value")
    return (answered.groupBy("of_block").cogroup(packed.select("block", "docs", "refs", "times").groupBy("block"))
            .applyInArrow(_with_totals, _RESULT))
