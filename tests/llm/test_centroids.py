"""op11 against plain integer loops."""
import hashlib
import math
import random

from pansift.llm.centroids import cluster, integer_vectors
from pansift.llm.queries import cluster_digest

SCHEMA = "vec_id long, embedding array<float>, v string, len2 long, cluster string, label int"


def brute(pairs, k, rounds, dim, scale, salt):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in pairs
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    seeds = sorted((hashlib.sha256(f"{salt}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    cents = [v for _, v in seeds]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents)) for _, v in kept]
    for _ in range(rounds):
        found = assign()
        for n in range(len(cents)):
            mine = [v for (_, v), (_, m) in zip(kept, found) if m == n]
            if mine:
                cents[n] = [sum(x) // len(mine) for x in zip(*mine)]
    return [(i, n, d) for (i, _), (d, n) in zip(kept, assign())], cents


def frame(spark, pairs, parts=3):
    return spark.createDataFrame([(i, v, "x", 1, "y", 0) for i, v in pairs], SCHEMA).repartition(parts)


def key(row):
    return str(row)


def test_equal_to_loops(spark):
    rs = random.Random(5)
    near = [[rs.choice([-1.0, 0.0, 1.0]) + rs.randint(-30, 30) / 256 for _ in range(4)] for _ in range(120)]
    pairs = [(n, v) for n, v in enumerate(near)]
    pairs += [(7, near[7]), (7, near[7]), (None, near[3]), (None, [0.5] * 4), (900, None), (901, []), (902, [1.0] * 3), (903, [1.0] * 5),
              (904, [1.0, None, 0.0, 0.0]), (905, [float("nan"), 0.0, 0.0, 0.0]), (906, [float("-inf"), 0.0, 0.0, 0.0]),
              (-4, [0.0] * 4), (907, [-0.0009765625] * 4), (908, [-0.0001] * 4)]
    for k, rounds in ((5, 4), (8, 10), (1, 1)):
        got = cluster(frame(spark, pairs), k=k, rounds=rounds, dim=4)
        want, cents = brute(pairs, k, rounds, 4, 1024, 3)
        assert got.centroids == cents
        assert sorted(((r.vec_id, r.cluster, r.distance) for r in got.assigned.collect()), key=key) == sorted(want, key=key)
        assert got.sizes == [sum(n == c for _, n, _ in want) for c in range(len(cents))]
        assert got.inertia == [sum(d for _, n, d in want if n == c) for c in range(len(cents))]


def test_ties_and_repeated_rows(spark):
    same = [(1, [1.0, 1.0])] * 9
    got = cluster(frame(spark, same), k=3, rounds=2, dim=2)
    assert [tuple(r) for r in got.assigned.collect()] == [(1, 0, 0)] * 9
    assert got.centroids == [[1024, 1024]] * 3 and got.sizes == [9, 0, 0]
    rows = cluster_digest(got).collect()
    assert {(r.cluster_inertia, r.inertia, r.centroid_sha256) for r in rows} == {(0, 0, hashlib.sha256(b"1024,1024").hexdigest())}


def test_few_none_and_large(spark):
    assert cluster(frame(spark, [(None, [1.0, 2.0])]), dim=2).assigned.count() == 0  # no seed
    none = cluster(spark.createDataFrame([], SCHEMA), dim=2)
    assert none.assigned.count() == 0 and cluster_digest(none).count() == 0
    assert cluster(frame(spark, [(2, [1.0, 2.0]), (3, [5.0, 2.0])]), dim=2).sizes == [1, 1]
    far = [(1, [3e38, 0.0]), (2, [131071.5, -131071.5]), (3, [-131071.5, 131071.5]), (4, [131072.0, 0.0])]
    got = cluster(frame(spark, far), k=1, rounds=3, dim=2)
    assert sorted(r.vec_id for r in got.assigned.collect()) == [2, 3]
    many = cluster(frame(spark, far * 64), k=1, rounds=1, dim=2)
    assert many.sizes == [128] and many.inertia[0] == 128 * 2 * (131071 * 1024 + 512) ** 2
    assert integer_vectors(frame(spark, [(1, [-0.0001, 0.0009])]), dim=2).first().v == [-1, 0]


def test_no_python_in_the_plan(spark):
    from pyspark.sql import functions as F
    from pansift.llm.centroids import nearest
    rows = frame(spark, [(1, [1.0, 2.0])]).select(F.array(F.lit(1).cast("long"), F.lit(2).cast("long")).alias("v"), F.lit(5).cast("long").alias("len2"))
    plan = rows.select(nearest(F.col("v"), F.col("len2"), [[0, 0], [1, 2]]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
