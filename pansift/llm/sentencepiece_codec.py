"""SentencePiece encoding and decoding of whole texts (merge-type prefix table).

``piece_codec.PrefixCodec`` stores the one last token of each prefix, found by
automaton matches and pair-compatibility tests, and reads the ids backwards.
Nothing of the library's own encoder is used on the way.  One pass, no shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pansift.llm import piece_codec
from pansift.llm._common import id_and_text, vocabulary
from pansift.llm.token_counts import ROWS_AT_ONCE

_IDS = pa.list_(pa.int32())


def encode(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` (array<int>, with begin and end ids) per input row.

    Null texts count as empty (begin and end only); repeated rows give
    repeated results; an empty table gives an empty result.
    """
    model = model or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec.text_codec(model)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                ids = [codec.encode(t) for t in part.column(1).to_pylist()]
                ends = [0]
                for b in ids:
                    ends.append(ends[-1] + len(b) // 4)
                flat = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(ids))])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], names=["doc_id", "ids"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id, text`` of ``doc_id, ids``; null ids decode to an empty text."""
    model = model or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec.text_codec(model)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                texts = [codec.decode(piece_codec.packed(x or [])) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def digests(codec: piece_codec.TextCodec, text: str) -> tuple[int, str, str]:
    """Number and SHA-256 of a text's ids, and SHA-256 of what these ids decode to."""
    got = codec.encode(text)
    return len(got) // 4, hashlib.sha256(got).hexdigest(), hashlib.sha256(codec.decode(got).encode()).hexdigest()


def code_digests(docs: DataFrame, model: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per input row, encoded
    and decoded in one pass without keeping the ids; cases as in ``encode``."""
    model = model or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec.text_codec(model)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                n, ids, back = zip(*(digests(codec, text) for text in part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
