"""Mixing sources to target weights by hash-threshold histograms.

Every row has a 60-bit hash (the head of an MD5, so any engine can follow).  A source's target is a whole number of passes
over it plus a part of one more pass; the part takes the rows whose hash lies
below a threshold, so budgets are nested: a larger one holds the rows of every
smaller one.  To find the threshold, words are summed by source and hash
bucket; the bucket in which the budget ends is split again, alone, until it
holds one row.  Rows are then filtered by a comparison; nothing is sorted.
Only sums by source and bucket are shuffled, combined map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pansift.llm._common import WORD, cut_lineage, quoted

HASH_BITS = 60
ROUND_BITS = 12
#: A source is taken at most so many times.
MOST_PASSES = 3


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def row_hash(id_col: str, text_col: str) -> Column:
    row = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text_col), F.lit("")))
    return F.conv(F.substring(F.md5(row), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sources: DataFrame) -> DataFrame:
    """``source, source_size, target`` for ``source, source_size`` (one row
    per source): weights 1, 2, 3, repeating by code point, null last; targets
    stop at ``MOST_PASSES`` times the size, the excess goes to the others by
    weight.  Only sums reach the driver."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighed = sources.withColumn("weight", ((rank - 1) % 3 + 1).cast("double"))
    weighed = cut_lineage(weighed.withColumn("cap", (F.col("source_size") * MOST_PASSES).cast("double")), "weights")
    unit, full = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(unit) > F.col("cap")
        s = weighed.agg(F.sum("source_size").alias("all"), F.sum(F.when(over, F.col("cap")).otherwise(0.0)).alias("stopped"),
                        F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("free"),
                        F.sum(over.cast("int")).alias("n")).first()
        if (s.n or 0) == full or not s.free:
            break
        full, unit = s.n, (float(s["all"]) - s.stopped) / s.free
    return weighed.select("source", "source_size", F.least(F.col("weight") * F.lit(unit), F.col("cap")).alias("target"))


def thresholds(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``sources`` (as ``targets`` gives them) with ``passes`` and
    ``threshold``: rows of a source are taken ``passes`` times, those with a
    smaller hash than ``threshold`` once more.  ``rows``: ``source, size, u``."""
    size, target = F.col("source_size"), F.col("target")
    passes = F.when(size == 0, F.lit(0)).otherwise(F.floor(target / F.when(size == 0, 1).otherwise(size))).cast("long")
    state = sources.withColumn("passes", passes).withColumn("need", target - F.col("passes") * size)
    state = cut_lineage(state.withColumn("cell", F.lit(0).cast("long")), "budgets")
    below = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    bits = 0
    while True:
        known, bits = bits, min(HASH_BITS, bits + ROUND_BITS)
        at = state.select(F.col("source").alias("s"), F.col("cell").alias("c"))
        inside = rows.join(at, F.col("source").eqNullSafe(F.col("s"))
                           & (F.shiftright("u", HASH_BITS - known) == F.col("c")))
        sums = (inside.groupBy("source", F.shiftright("u", HASH_BITS - bits).alias("cell"))
                .agg(F.sum("size").alias("words"), F.count("*").alias("n"))
                .withColumn("before", F.coalesce(F.sum("words").over(below), F.lit(0))))
        # the cell in which the budget ends; past the last one if it takes all
        here = state.drop("cell").withColumnRenamed("source", "s")
        ends = (sums.join(here, F.col("source").eqNullSafe(F.col("s")))
                .where((F.col("before") <= F.col("need")) & (F.col("before") + F.col("words") > F.col("need")))
                .select("s", "cell", "words", "n", (F.col("need") - F.col("before")).alias("left")))
        ends = ends.withColumnRenamed("s", "of")
        state = (state.withColumnRenamed("cell", "old").join(ends, F.col("source").eqNullSafe(F.col("of")), "left")
                 .select("source", "source_size", "target", "passes", F.coalesce("left", F.lit(0.0)).alias("need"),
                         F.coalesce("cell", F.shiftleft("old", bits - known)).alias("cell"),
                         F.coalesce("words", F.lit(0)).alias("words"), F.coalesce("n", F.lit(0)).alias("n")))
        state = cut_lineage(state, "boundary")
        if bits == HASH_BITS or (state.agg(F.max("n")).first()[0] or 0) <= 1:
            break
        state = state.drop("words", "n")
    # the last cell goes in if that comes nearer to the budget
    edge = F.col("cell") + (2 * F.col("need") > F.col("words")).cast("long")
    part = target - F.col("passes") * size > 0  # rows without words lie below the first words, too
    return state.select("source", "source_size", "target", "passes",
                        F.when(part, F.shiftleft(edge, HASH_BITS - bits)).otherwise(0).alias("threshold"))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
         ) -> tuple[DataFrame, DataFrame]:
    """Narrow rows (``doc_id, source, size, u``, written once) and the plan of
    their sources."""
    rows = cut_lineage(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        words(F.col(text_col)).alias("size"), row_hash(id_col, text_col).alias("u")), "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    return rows, cut_lineage(thresholds(rows, targets(sources)), "mix")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per input row: ``doc_id, size, source_size, target, taken,
    source, copies``.

    Null sources form one source, the last; null texts have size 0; rows with
    equal id and text share a hash and are taken alike; sources without words
    have target 0; other columns are not read; an empty table gives an empty
    result.  Reruns agree, since hashes depend on ids and texts alone.
    """
    rows, chosen = plan(docs, id_col, text_col, source_col)
    by = chosen.withColumnRenamed("source", "of")
    copies = F.col("passes") + (F.col("u") < F.col("threshold")).cast("long")
    return (rows.join(by, F.col("source").eqNullSafe(F.col("of")))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), "source",
                    copies.alias("copies")))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: rows of ``docs`` with all their columns, as often as taken."""
    _, chosen = plan(docs, id_col, text_col, source_col)
    by = chosen.select(F.col("source").alias("__of"), F.col("passes").alias("__p"), F.col("threshold").alias("__t"))
    copies = F.col("__p") + (row_hash(id_col, text_col) < F.col("__t")).cast("long")
    rows = docs.join(by, docs[source_col].cast("string").eqNullSafe(F.col("__of"))).withColumn("__n", copies.cast("int"))
    rows = rows.where(F.col("__n") > 0).withColumn("__k", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    return rows.select(*quoted(docs.columns))
