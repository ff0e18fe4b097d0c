"""Token counts of whole texts (whole-token shortcut).

Which vocabulary strings encode alone as exactly one token is proved before
the run's first text (``piece_codec.whole_tokens``: the library encodes each of
them).  A text's pre-tokens that are such strings count one each; only the
rest are merged, and a worker remembers a bounded number of their counts.
No shuffle: one pass over the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from pansift.llm import piece_codec
from pansift.llm._common import id_and_text, vocabulary

#: Rows whose texts are Python strings at the same time.
ROWS_AT_ONCE = 500


def count_tokens(docs: DataFrame, model: str | None = None, limit: int = 4096,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_tokens, over_limit``.

    Null texts count as empty (0 tokens); repeated rows give repeated results;
    null ids stay null; other columns are not read; an empty table gives an
    empty result.  ``model``: path of a SentencePiece BPE model with byte
    fallback, the same on every node.
    """
    model = model or vocabulary()
    if not model.endswith(".model"):
        raise ValueError("token counts need a SentencePiece .model file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = piece_codec.counter(model)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                texts = part.column(1)
                n = [piece_codec.count_tokens(t, counts) for t in texts.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.compute.binary_length(texts).cast(pa.int64()), pa.array(n, pa.int64()),
                     pa.array([x > limit for x in n], pa.bool_())],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
