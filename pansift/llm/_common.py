"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pansift.session import cut_lineage, scratch_path, ship_package  # noqa: F401  (re-exported)

#: What the contracts call white space and a word.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

VOCAB = "piece_bpe_32k.model"

#: Bytes that go to a Python worker at a time, and come back.
BATCH_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """What operators with Python need of a session: the package on the
    executors, and Arrow batches bounded in bytes, since whole texts are long."""
    ship_package(spark)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) != f"{BATCH_BYTES}b":
        spark.conf.set(name, f"{BATCH_BYTES}b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns, ``doc_id`` and ``text``, null text read as empty; other
    columns go, so their names cannot clash."""
    prepare(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def vocabulary(name: str = VOCAB) -> str:
    """Where a public tokenizer file lies (the same place on every node)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def quoted(names: list[str]) -> list[Column]:
    """Columns by name, whatever signs the names hold."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def once_each(rows: DataFrame, columns: list[str], repeated: str, key: str, any_repeated: bool) -> DataFrame:
    """``columns`` of ``rows``; of rows marked ``repeated`` the least of each ``key``,
    or, where a column holds maps, which have no order, that whose JSON has the least hash."""
    own = quoted(columns)
    once = rows.where(~F.col(repeated)).select(*own)
    if not any_repeated:
        return once
    row = F.struct(*own)
    least = F.min(row)
    if "map<" in once.schema.simpleString() or "variant" in once.schema.simpleString():
        least = F.min_by(row, F.sha2(F.to_json(row), 256))
    again = rows.where(F.col(repeated)).groupBy(key).agg(least.alias("__row"))
    return once.unionByName(again.select(*[F.col("__row")[n].alias(n) for n in columns]))
