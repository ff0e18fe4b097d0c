"""op9 on several levels of parts: recall at two sizes, and what a query meets."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from pansift.llm import ann


def clustered(n, d=16, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n // 60, d))[rng.integers(0, n // 60, n)] + 0.35 * rng.normal(size=(n, d))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def frame(spark, x):
    return spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int").repartition(5)


def recall(rows, x, k):
    best = {}
    for r in rows:
        best.setdefault(r.query_id, []).append(r)
    hit = 0
    for i, got in best.items():
        got.sort(key=lambda r: r["rank"])
        s = x @ x[i]
        s[i] = -np.inf
        assert len(got) == k and [r["rank"] for r in got] == list(range(1, k + 1)) and i not in {r.vec_id for r in got}
        assert np.allclose([r.score for r in got], [x[r.vec_id] @ x[i] for r in got], rtol=1e-12)
        hit += len({r.vec_id for r in got} & set(np.argsort(-s, kind="stable")[:k].tolist()))
    return hit / (k * len(best)), len(best)


def test_levels():
    assert ann.levels_of(0, 2500, 256) == ann.levels_of(1_000_000, 2500, 256) == 1
    assert ann.levels_of(2_000_000, 2500, 256) == 2 and ann.levels_of(10 ** 9, 2500, 256) == 3
    assert ann.levels_of(4000, 50, 6) == 3


@pytest.mark.parametrize("n", [1200, 5000])
def test_recall_over_levels(spark, n):
    """The same small parts at both sizes: more levels, the same recall."""
    x = clustered(n)
    rows = ann.search(frame(spark, x), k=10, per_part=60, most_parts=8).collect()
    found, queries = recall(rows, x, 10)
    assert queries == n // 20 and found >= 0.9


def test_a_split_keeps_every_vector_and_bounds_the_cells(spark):
    x = clustered(4000, seed=9)
    df = frame(spark, x)
    index = df.select(F.lit(5).cast("long").alias("cell"), "vec_id", F.col("embedding").alias("vec")).unionByName(
        spark.createDataFrame([(7, 10_000 + i, [1.0] * 16) for i in range(30)], "cell long, vec_id long, vec array<double>"))
    asked = index.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    parts, went = ann.split(index, asked, 100, 10, 10, 0.95)
    assert parts.count() == parts.select("vec_id").distinct().count() == 4030
    cells = {r.cell: r["count"] for r in parts.groupBy("cell").count().collect()}
    assert cells[70] == 30 and {c // 10 for c in cells} == {5, 7} and max(cells.values()) < 1500
    met = went.join(parts, "cell").groupBy("query_id").agg(F.count("*").alias("n"))
    assert met.count() == asked.count()
    assert met.where("query_id < 10000").agg(F.avg("n")).first()[0] < 0.6 * 4000
    assert went.where("query_id >= 10000").select("cell").distinct().collect()[0].cell == 70


def test_equal_vectors_do_not_split(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0, 3.0], 0) for i in range(400)], "vec_id long, embedding array<double>, label int")
    rows = ann.search(df, k=5, per_part=20, most_parts=4).collect()
    assert len(rows) == 20 * 5
    for r in rows:
        assert r.vec_id == r["rank"] - 1 + (r["rank"] - 1 >= r.query_id)
