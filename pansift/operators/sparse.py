"""Sparse design matrices: level dictionaries as tables.

A column per level, with the levels named in the plan, ends at some thousands of
them.  Here the levels of all categorical columns are a table, numbered by
ranges; rows are joined with it and hold the numbers of the levels they have.
Neither levels nor columns pass through the driver, apart from one row per
categorical column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pansift.operators.ordering import numbered
from pansift.session import cut_lineage


def level_dictionary(df: DataFrame, categorical: Sequence[str], start: int = 0, full_rank: bool = False) -> DataFrame:
    """``column, level, index`` (written): the distinct non-missing levels in
    order, columns as given, indices from ``start`` without holes.

    The first level of a column is the reference, with a NULL index; with
    ``full_rank`` the first column has none, as in an R model matrix without
    intercept.  Levels are compared as text."""
    cols = list(categorical)
    long = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("_c"), F.col(f"`{c}`").cast("string").alias("level"))
                                         for i, c in enumerate(cols)])).alias("_kv")).select("_kv.*")
    levels = cut_lineage(numbered(long.where(F.col("level").isNotNull()).distinct(), ["_c", "level"]), "levels")
    # one row per categorical column
    first = {r["_c"]: r["least"] for r in levels.groupBy("_c").agg(F.min("_row").alias("least")).collect()}
    kept = min(first, default=None) if full_rank and 0 in first else None
    gone, index = 0, F.lit(None).cast("long")
    for c in sorted(first):
        reference = F.lit(None) if c == kept else F.lit(first[c])
        gone += c != kept
        at = F.when(F.col("_row").eqNullSafe(reference), None).otherwise(F.col("_row") - gone + start)
        index = F.when(F.col("_c") == c, at).otherwise(index)
    names = F.array(*[F.lit(c) for c in cols])
    return cut_lineage(levels.select(names[F.col("_c")].alias("column"), "level", index.alias("index")), "dictionary")


def sparse_design(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], out: str = "features",
                  full_rank: bool = False) -> tuple[DataFrame, DataFrame]:
    """``df`` with a sparse vector per row, and the dictionary of its levels.

    The vector is a struct ``size, indices, values``: the numeric columns come
    first (0 is left out, a missing number is NaN), then a 1 for each
    level that the row has.  Reference levels, and missing ones, have no entry; no row is
    dropped.  The dictionary has the numeric columns too (``level`` NULL)."""
    numeric, categorical = list(numeric), list(categorical)
    spark, m = df.sparkSession, len(numeric)
    levels = level_dictionary(df, categorical, m, full_rank) if categorical else spark.createDataFrame([], "column string, level string, index long")
    size = m + levels.where(F.col("index").isNotNull()).count()
    rows = df
    for j, c in enumerate(categorical):
        mine = levels.where(F.col("column") == c).select(F.col("level").alias(f"__level{j}"), F.col("index").alias(f"__index{j}"))
        rows = rows.join(mine, F.col(f"`{c}`").cast("string") == F.col(f"__level{j}"), "left").drop(f"__level{j}")
    number = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in numeric]
    entries = [F.when(x != 0, F.struct(F.lit(i).cast("long").alias("i"), x.alias("v"))) for i, x in enumerate(number)]
    entries += [F.when(F.col(f"__index{j}").isNotNull(), F.struct(F.col(f"__index{j}").alias("i"), F.lit(1.0).alias("v")))
                for j in range(len(categorical))]
    entries = F.array_compact(F.array(*entries)) if entries else F.array().cast("array<struct<i:bigint,v:double>>")
    rows = rows.withColumn("__entries", entries).withColumn(out, F.struct(
        F.lit(size).cast("long").alias("size"), F.transform("__entries", lambda e: e["i"]).alias("indices"),
        F.transform("__entries", lambda e: e["v"]).alias("values")))
    names = spark.createDataFrame([(c, None, i) for i, c in enumerate(numeric)], "column string, level string, index long")
    return rows.drop("__entries", *[f"__index{j}" for j in range(len(categorical))]), names.unionByName(levels)


#: Most frequent entries whose names are sent to every task.
FREQUENT = 256


def design_entries(rows: DataFrame, dictionary: DataFrame, keys: Sequence[str], features: str = "features") -> DataFrame:
    """The entries in long form: ``keys..., column, level, value``.

    A number is an entry of nearly every row, as is a level of a column that has few:
    by index, all of them would meet in one task.  The names of the ``FREQUENT``
    most frequent entries go to the rows instead; any other entry is at most one in
    ``FREQUENT``, and those meet the dictionary by index."""
    flat = rows.select(*keys, F.explode(F.arrays_zip(F.col(features)["indices"].alias("i"), F.col(features)["values"].alias("v"))).alias("_e"))
    flat = cut_lineage(flat.select(*keys, F.col("_e.i").alias("index"), F.col("_e.v").alias("value")), "entries")
    named = dictionary.where(F.col("index").isNotNull())
    count = flat.groupBy("index").agg(F.count(F.lit(1)).alias("n"))
    frequent = F.col("index").isin([r["index"] for r in count.orderBy(F.desc("n"), "index").limit(FREQUENT).collect()])
    few = flat.where(frequent).join(F.broadcast(named.where(frequent)), "index")
    return few.unionByName(flat.where(~frequent).join(named, "index")).select(*keys, "column", "level", "value")
