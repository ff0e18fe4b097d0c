"""The corpus pipeline: from documents to an encoded training mix.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept; its result is written as Parquet and read again.  All but the
last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pansift.llm import exact_dedup, mixing, sentencepiece_codec, simhash, toxicity
from pansift.llm._common import cut_lineage, quoted, table

#: Shingle length and bits of the near-duplicate stage.
SHINGLE, DISTANCE = 4, 4


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 stay.  Labels come from ``labels`` without
    the held-out fold.  Null texts are scored as empty ones, repeated rows
    alike; an empty table stays empty."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return model.with_score(docs, name="__score").where(F.col("__score") < 0.5).select(*quoted(docs.columns))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays: the one with most code
    points, then the smallest id, null ids last.  Null texts equal empty ones;
    of rows with equal id and text the least row stays; an empty table stays
    empty."""
    return exact_dedup.survivors(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group stays, that with the smallest id, null ids
    last; of several rows with this id in the group the least row.  Null texts
    count as empty; rows are decided by their own text, so rows that share an
    id, or have none, stay if their texts are unlike; an empty table stays
    empty."""
    return simhash.survivors(docs, SHINGLE, DISTANCE)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them.  Null sources form one source;
    null texts have no words; an empty table stays empty."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.  Null texts
    count as empty; an empty table stays empty."""
    return sentencepiece_codec.code_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("source mixing", mix_sources),
    ("sentencepiece", encode),
]

#: SQL expresses neither fitted scores nor fingerprints; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
