"""Centroid clustering in integers, with JVM expressions only.

Vectors are scaled to integers and written once.  In each round ``zip_with``
and ``aggregate`` compute the distance to every centroid, which are literal
arrays of the plan; ``array_min`` over ``(distance, number)`` structs chooses the
cluster, and one aggregate of plain column sums gives the new centroids.  A
round shuffles one row per task and cluster, and brings ``k`` rows of sums to
the driver, whatever the table's size.  All arithmetic is on whole numbers, so the
result does not depend on how rows are dealt, nor on tasks that run again.

Instead of all of ``(x - c)^2`` the plan has ``x * (-2 c)`` per component: with the
squared lengths of ``x`` (a column) and ``c`` (a literal) that is the same integer.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pansift.llm._common import cut_lineage

#: Components beyond this would not leave room for a squared distance in 64 bits.
LARGEST = 1 << 27


@dataclass
class Clusters:
    """``assigned``: ``vec_id, cluster, distance`` per vector; ``centroids``: lists
    of integers; ``sizes`` and ``inertia`` per cluster (None: beyond 64 bits)."""
    assigned: DataFrame
    centroids: list[list[int]]
    sizes: list[int]
    inertia: list[int | None]


def integer_vectors(vectors: DataFrame, dim: int = 64, scale: int = 1024, id_col: str = "vec_id",
                    vec_col: str = "embedding") -> DataFrame:
    """``vec_id, v`` (array<bigint>, ``floor(scale * x)``) of the vectors with
    exactly ``dim`` components, none null or non-finite."""
    x = F.transform(F.col(vec_col), lambda e: F.floor(F.lit(float(scale)) * e.cast("double")))
    fine = (F.size(vec_col) == dim) & ~F.exists(vec_col, lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double")) >= LARGEST / scale))
    return vectors.where(F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), x.alias("v"))


def _literal(numbers: list[int]) -> Column:
    return F.expr("array(" + ", ".join(f"{n}L" for n in numbers) + ")")


def _dot(v: Column, numbers: list[int]) -> Column:
    return F.aggregate(F.zip_with(v, _literal(numbers), lambda a, b: a * b), F.lit(0).cast("long"), lambda s, p: s + p)


def nearest(v: Column, length: Column, centroids: list[list[int]]) -> Column:
    """Struct ``distance, cluster``: the least squared distance, ties to the smaller number."""
    return F.array_min(F.array(*[
        F.struct((length + F.lit(sum(c * c for c in cent)) + _dot(v, [-2 * c for c in cent])).alias("distance"),
                 F.lit(k).alias("cluster"))
        for k, cent in enumerate(centroids)]))


def first_centroids(rows: DataFrame, k: int, salt: int) -> list[list[int]]:
    """The ``k`` vectors with the smallest SHA-256 of ``salt:id``, in this
    order; vectors without an id are no seeds, equal hashes go by the vector."""
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    seeds = rows.where(F.col("vec_id").isNotNull()).select(key.alias("key"), "v").orderBy("key", "v").limit(k)
    return [list(r["v"]) for r in seeds.collect()]


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, salt: int = 3,
            id_col: str = "vec_id", vec_col: str = "embedding") -> Clusters:
    """``rounds`` of k-means from hashed seeds, then one more assignment.

    A centroid becomes the componentwise ``floor(sum / count)`` of its vectors;
    an empty one stays.  Vectors that are null, of another length, or hold null
    or non-finite components take no part, nor do those with a component beyond
    ``LARGEST / scale`` (131,072 by default), whose distance no 64-bit integer holds.  Rows
    without an id are clustered but are no seeds; repeated rows count each time (and
    may seed several, of which the later stay empty).  Fewer seeds give fewer
    clusters, an empty table (or one without ids) an empty result.  Other columns
    are not read.
    """
    spark = vectors.sparkSession
    rows = integer_vectors(vectors, dim, scale, id_col, vec_col)
    rows = cut_lineage(rows.withColumn("len2", F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x * x)), "integer-vectors")
    centroids = first_centroids(rows, k, salt)
    if not centroids:
        return Clusters(spark.createDataFrame([], "vec_id long, cluster int, distance long"), [], [], [])
    sums = [F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(dim)]
    for _ in range(rounds):
        at = rows.select("v", nearest(F.col("v"), F.col("len2"), centroids).alias("best"))
        for r in at.groupBy("best.cluster").agg(F.count("*").alias("n"), *sums).collect():
            centroids[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(dim)]
    best = rows.select("vec_id", nearest(F.col("v"), F.col("len2"), centroids).alias("best"))
    assigned = cut_lineage(best.select("vec_id", "best.cluster", "best.distance"), "clusters")
    sizes, inertia = [0] * len(centroids), [0] * len(centroids)
    for r in assigned.groupBy("cluster").agg(F.count("*").alias("n"), F.try_sum("distance").alias("d")).collect():
        sizes[r["cluster"]], inertia[r["cluster"]] = r["n"], r["d"]
    return Clusters(assigned, centroids, sizes, inertia)
