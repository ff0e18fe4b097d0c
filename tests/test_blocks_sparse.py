"""Series in blocks against plain windows, and sparse designs against dense ones."""

import random

from pyspark.sql import functions as F

from pansift.operators import clean as CL
from pansift.operators import timeseries as TS
from pansift.operators.sparse import design_entries, level_dictionary, sparse_design


def series(spark):
    rs = random.Random(6)
    rows = []
    for e, n in (("a", 400), ("b", 1), (None, 30), ("c", 57), ("d", 3)):
        for d in range(n):
            rows.append((e, d, rs.choice([None, None, None, rs.random()]), None if e == "a" and 20 < d < 380 else float(d), None))
    rs.shuffle(rows)
    return spark.createDataFrame(rows, "e string, d int, x double, y double, none double").repartition(6)


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_fills_in_blocks_equal_the_windows(spark):
    df, cols = series(spark), ["x", "y", "none"]
    for block in (1, 16, 10_000):
        same(TS.ffill(df, "e", "d", cols, block=block), TS.ffill(df, "e", "d", cols))
        same(TS.bfill_ffill(df, "e", "d", cols, block=block), TS.bfill_ffill(df, "e", "d", cols))


def test_lags_and_means_in_blocks_equal_the_windows(spark):
    df = series(spark)
    same(TS.lag_features(df, "e", "d", ["x", "y"], [1, 7], block=10), TS.lag_features(df, "e", "d", ["x", "y"], [1, 7]))
    got, want = (TS.rolling_mean(df, "e", "d", ["y"], 7, 3, block=b).withColumn("y_ma7", F.round("y_ma7", 9)) for b in (25, None))
    same(got, want)
    got, want = (TS.rolling_mean_prev(df, "e", "d", ["x"], 5, 2, block=b).withColumn("x_ma5_prev", F.round("x_ma5_prev", 9)) for b in (25, None))
    same(got, want)
    same(TS.ffill(df.limit(0), "e", "d", ["x"], block=5), df.limit(0))


def test_one_long_entity_runs_in_many_tasks(spark):
    df = spark.range(0, 300_000, 1, 8).select(F.lit("one").alias("e"), F.col("id").alias("d"),
                                              F.when(F.col("id") % 1000 == 0, F.col("id").cast("double")).alias("x"))
    got = TS.ffill(df, "e", "d", ["x"], block=20_000)
    assert got.where(F.col("x") != F.floor(F.col("d") / 1000) * 1000).count() == 0 and got.where("x is null").count() == 0
    assert got.rdd.getNumPartitions() > 1


def test_sparse_equals_dense(spark):
    rows = [(1, 2.0, "b", 3), (2, 0.0, "a", 1), (3, None, None, 1), (4, -1.0, "c", None), (5, 7.0, "b", 2), (5, 7.0, "b", 2)]
    df = spark.createDataFrame(rows, "id int, n double, f string, k int")
    got, levels = sparse_design(df, ["n"], ["f", "k"])
    assert [tuple(r) for r in levels.orderBy("column", "level").collect()] == [
        ("f", "a", None), ("f", "b", 1), ("f", "c", 2), ("k", "1", None), ("k", "2", 3), ("k", "3", 4), ("n", None, 0)]
    assert {r.features["size"] for r in got.collect()} == {5}
    dense = CL.dummies_drop_first(df, ["f", "k"])
    for r in dense.distinct().collect():
        mine = got.where(F.col("id") == r.id).first().features
        full = [0.0] * 5
        for i, v in zip(mine["indices"], mine["values"]):
            full[i] = v
        assert (full[0] != full[0] if r.n is None else full[0] == r.n) and full[1:] == [r["f_b"], r["f_c"], r["k_2"], r["k_3"]]
    assert got.columns == [*df.columns, "features"] and got.count() == 6


def test_full_rank_and_empty(spark):
    df = spark.createDataFrame([("x", "p", None), ("y", "q", None)], "f string, k string, none string")
    full = {(r.column, r.level): r["index"] for r in level_dictionary(df, ["f", "none", "k"], full_rank=True).collect()}
    assert full == {("f", "x"): 0, ("f", "y"): 1, ("k", "p"): None, ("k", "q"): 2}
    rows, levels = sparse_design(df.limit(0), [], ["f"])
    assert rows.count() == 0 and levels.count() == 0
    rows, _ = sparse_design(df, [], ["none"])
    assert [tuple(r.features) for r in rows.collect()] == [(0, [], [])] * 2


def test_many_levels(spark):
    """A hundred thousand levels: no column and no expression for each."""
    df = spark.range(200_000).select(F.col("id"), F.concat(F.lit("v"), F.col("id") % 100_000).alias("f"))
    rows, levels = sparse_design(df, [], ["f"])
    assert len(rows.columns) == 3
    assert rows.agg(F.max("features.size")).first()[0] == 99_999
    back = design_entries(rows, levels, ["id"])
    assert back.count() == 200_000 - 2
    assert back.where(F.col("level") != F.concat(F.lit("v"), F.col("id") % 100_000)).count() == 0


def test_entries_that_all_rows_share_do_not_meet_in_one_task(spark):
    df = spark.range(4000, numPartitions=4).select("id", (F.col("id") + 1.0).alias("n"), (F.col("id") % 3).cast("string").alias("f"),
                                                   F.col("id").cast("string").alias("k"))
    rows, levels = sparse_design(df, ["n"], ["f", "k"])
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for c, v in zip(old, ("false", "-1")):
            spark.conf.set(c, v)
        out = design_entries(rows, levels, ["id"]).withColumn("p", F.spark_partition_id())
        shared = [r["count"] for r in out.where("column = 'n'").groupBy("p").count().collect()]
        got = {tuple(r) for r in out.drop("p").collect()}
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert sum(shared) == 4000 and max(shared) < 2000
    want = {(i, "n", None, i + 1.0) for i in range(4000)} | {(i, "f", str(i % 3), 1.0) for i in range(4000) if i % 3}
    assert got == want | {(i, "k", str(i), 1.0) for i in range(1, 4000)}
