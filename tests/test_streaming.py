"""Incremental page ingestion: each landed file is processed once."""

from pyspark.sql import functions as F

from pansift.session import scratch_path
from pansift.sources.readers import ingest_pages
from pansift.streaming.pages import ingest_pages_incremental

SF = "/root/testdata/sf0.001"
COLS = ["l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice"]


def test_incremental_matches_batch_and_is_idempotent(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    landing, table, ckpt = (scratch_path(spark, n) for n in ("landing", "table", "ckpt"))
    # two landed "pages"
    li.where(F.col("l_orderkey") % 2 == 0).write.parquet(f"{landing}/page=1")
    li.where(F.col("l_orderkey") % 2 == 1).write.parquet(f"{landing}/page=2")
    schema = li.schema
    for _ in range(2):  # a rerun must not duplicate rows
        q = ingest_pages_incremental(spark, f"{landing}/*", schema, COLS, "l_shipdate", "1996-01-01", "1996-06-30",
                                     table, ckpt)
        q.awaitTermination(120)
    got = spark.read.parquet(table)
    exp = ingest_pages(spark, f"{SF}/lineitem.parquet", COLS, "l_shipdate", "1996-01-01", "1996-06-30")
    assert got.count() == exp.count()
    assert got.exceptAll(exp).count() == 0
