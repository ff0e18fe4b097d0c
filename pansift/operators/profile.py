"""Profiling and data-quality summaries (blueprint 2.4, second part).

Per-column summaries are one wide aggregate reshaped to long form with
``inline(array(struct(...)))``; nothing is computed column by column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pansift.functions.numeric import finite_or_null, numeric_types
from pansift.operators._fit import fit_row
from pansift.operators.ordering import numbered
from pansift.operators.quantiles import quantile_fit
from pansift.operators.timeseries import rank_top_per_key
from pansift.session import cut_lineage


def _is_num(df, c):
    return isinstance(df.schema[c].dataType, numeric_types) and not isinstance(df.schema[c].dataType, T.BooleanType)


def _long(agg_df: DataFrame, rows: list) -> DataFrame:
    """One-row aggregate -> one row per struct in ``rows``."""
    return agg_df.select(F.inline(F.array(*rows)))


def describe_numeric(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """count, mean, std (ddof 1), min, 25%, 50%, 75%, max per column."""
    cols = list(cols)
    aggs, rows = [], []
    values = {c: finite_or_null(F.col(c).cast("double")) for c in cols}
    q = _quartiles(df, values, approx)
    for i, c in enumerate(cols):
        x = values[c]
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"a{i}"), F.max(x).alias(f"b{i}")]
        rows.append(F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"m{i}").alias("mean"),
                             F.col(f"s{i}").alias("std"), F.col(f"a{i}").alias("min"),
                             q[c][0].alias("p25"), q[c][1].alias("p50"), q[c][2].alias("p75"),
                             F.col(f"b{i}").alias("max")))
    return _long(df.agg(*aggs), rows)


def _quartiles(df: DataFrame, values: dict, approx: bool) -> dict:
    """{column: literals of its quartiles}."""
    fit = quantile_fit(df, values, [0.25, 0.5, 0.75], approx=approx)
    return {c: [F.lit(x).cast("double") for x in (v or [None] * 3)] for c, v in fit.items()}


def summary_mixed(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """R-style summary: numeric min / Q1 / median / mean / Q3 / max / NA
    count; text columns report length (rows) and NA count, and their levels
    are counted by ``level_counts``."""
    cols = list(cols) if cols is not None else df.columns
    aggs, rows = [F.count(F.lit(1)).alias("_rows")], []
    q = _quartiles(df, {c: F.col(c) for c in cols if _is_num(df, c)}, approx)
    for i, c in enumerate(cols):
        miss = F.count_if(F.col(c).isNull()).alias(f"na{i}")
        aggs.append(miss)
        if _is_num(df, c):
            x = F.col(c).cast("double")
            aggs += [F.min(x).alias(f"a{i}"), F.avg(x).alias(f"m{i}"), F.max(x).alias(f"b{i}")]
            rows.append(F.struct(F.lit(c).alias("column"), F.lit("numeric").alias("kind"),
                                 F.col(f"a{i}").alias("min"), q[c][0].alias("q1"),
                                 q[c][1].alias("median"), F.col(f"m{i}").alias("mean"),
                                 q[c][2].alias("q3"), F.col(f"b{i}").alias("max"),
                                 F.col(f"na{i}").alias("n_missing"), F.col("_rows").alias("length")))
        else:
            nul = F.lit(None).cast("double")
            rows.append(F.struct(F.lit(c).alias("column"), F.lit("text").alias("kind"),
                                 nul.alias("min"), nul.alias("q1"), nul.alias("median"), nul.alias("mean"),
                                 nul.alias("q3"), nul.alias("max"),
                                 F.col(f"na{i}").alias("n_missing"), F.col("_rows").alias("length")))
    return _long(df.agg(*aggs), rows)


def level_counts(df: DataFrame, cols: Sequence[str] | None = None, others: int | None = None) -> DataFrame:
    """(column, level, n) for text columns, as a factor summary lists them;
    ``others``: only so many of the most frequent levels per column (ties by
    level), the rest counted together as ``(Other)``."""
    cols = list(cols) if cols is not None else [c for c in df.columns if not _is_num(df, c)]
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level"))
                                         for c in cols])).alias("kv")).select("kv.*").where(F.col("level").isNotNull())
    counts = long.groupBy("column", "level").agg(F.count(F.lit(1)).alias("n"))
    if others is None:
        return counts
    top = rank_top_per_key(counts, "column", [F.desc("n"), F.asc("level")], others).select("column", "level", "n")
    rest = counts.groupBy("column").agg(F.sum("n").alias("_all")).join(
        top.groupBy("column").agg(F.sum("n").alias("_top")), "column").where("_all > _top")
    return top.unionByName(rest.select("column", F.lit("(Other)").alias("level"), (F.col("_all") - F.col("_top")).alias("n")))


def _examples(pairs: DataFrame, cols: Sequence[str], k: int) -> DataFrame:
    """k smallest distinct non-missing values per column as ``a, b, c``, from
    distinct (column, value) ``pairs``.

    They are ranked with the salted top-k, so a column with many distinct
    values is never sorted in one task.
    """
    top = rank_top_per_key(pairs.where(F.col("column").isin(list(cols))), "column", [F.asc("value")], k)
    return top.groupBy("column").agg(
        F.concat_ws(", ", F.transform(F.array_sort(F.collect_list(F.struct("rank", "value"))),
                                      lambda s: s["value"])).alias("examples"))


def distinct_counts_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact distinct non-missing count per column as (column, unique_n).

    One job for all columns: (column, value) pairs are deduplicated with a
    map-side partial aggregate, then counted per column.  Avoids the
    per-column Expand that several ``count(DISTINCT)`` in one aggregate
    produce.
    """
    return _counted(_pairs(df, cols), cols)


def _pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct non-missing (column, value as text)."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                         for c in cols])).alias("kv")).select("kv.*")
    return long.where(F.col("value").isNotNull()).select("column", "value").distinct()


def _counted(pairs: DataFrame, cols: Sequence[str]) -> DataFrame:
    got = pairs.groupBy("column").agg(F.count(F.lit(1)).alias("unique_n"))
    names = pairs.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return names.join(got, "column", "left").select("column", F.coalesce("unique_n", F.lit(0)).alias("unique_n"))


def data_dictionary(df: DataFrame, examples: int = 5, approx: bool = False,
                    exact_distinct: bool = True) -> DataFrame:
    """Per column: dtype, missing n / %, distinct n, and numeric stats (std
    ddof 0) or example values; sorted by missing % then distinct n (desc)
    at the sink."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_rows")]
    rows = []
    txt_cols = []
    q = _quartiles(df, {c: F.col(c) for c in cols if _is_num(df, c)}, approx)
    for i, c in enumerate(cols):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"na{i}"))
        if not exact_distinct:
            # default precision (rsd 0.05, 512 registers): a tighter rsd multiplies the
            # aggregation buffer per column (16k registers at 0.01)
            aggs.append(F.approx_count_distinct(F.col(c)).alias(f"u{i}"))
        else:
            aggs.append(F.lit(None).cast("long").alias(f"u{i}"))
        dtype = F.lit(df.schema[c].dataType.simpleString()).alias("dtype")
        base = [F.lit(c).alias("column"), dtype, F.col(f"na{i}").alias("missing_n"),
                (F.col(f"na{i}") * 100.0 / F.col("_rows")).alias("missing_pct"), F.col(f"u{i}").alias("unique_n")]
        if _is_num(df, c):
            x = F.col(c).cast("double")
            aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}"), F.min(x).alias(f"a{i}"), F.max(x).alias(f"b{i}")]
            rows.append(F.struct(*base, F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"),
                                 F.col(f"a{i}").alias("min"), q[c][0].alias("p25"),
                                 q[c][1].alias("median"), q[c][2].alias("p75"),
                                 F.col(f"b{i}").alias("max"), F.lit(None).cast("string").alias("examples")))
        else:
            txt_cols.append(c)
            nul = F.lit(None).cast("double")
            rows.append(F.struct(*base, nul.alias("mean"), nul.alias("std"), nul.alias("min"), nul.alias("p25"),
                                 nul.alias("median"), nul.alias("p75"), nul.alias("max"),
                                 F.lit(None).cast("string").alias("examples")))
    out = _long(df.agg(*aggs), rows)
    wanted = cols if exact_distinct else txt_cols
    pairs = cut_lineage(_pairs(df, wanted), "pairs") if wanted else None   # counts and examples read the same pairs
    if exact_distinct:
        u = _counted(pairs, cols).withColumnRenamed("unique_n", "_u")
        out = out.join(F.broadcast(u), "column", "left").withColumn("unique_n", F.col("_u")).drop("_u")
    if txt_cols and examples:
        ex = _examples(pairs, txt_cols, examples).withColumnRenamed("examples", "_ex")
        out = out.join(F.broadcast(ex), "column", "left") \
                 .withColumn("examples", F.coalesce("examples", "_ex")).drop("_ex")
    return out.orderBy(F.desc("missing_pct"), F.desc("unique_n"), F.asc("column"))


def missing_table(df: DataFrame) -> DataFrame:
    """Missing count and % per column, only columns with gaps."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count_if(F.col(c).isNull()).alias(f"na{i}") for i, c in enumerate(cols)]
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"na{i}").alias("missing_n"),
                     (F.col(f"na{i}") * 100.0 / F.col("_rows")).alias("missing_pct")) for i, c in enumerate(cols)]
    return _long(df.agg(*aggs), rows).where(F.col("missing_n") > 0).orderBy(F.desc("missing_pct"), F.asc("column"))


def missing_mask(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Row x column 0/1 mask (1 = missing); ``keys`` are kept as identifiers."""
    keys = list(keys)
    return df.select(*keys, *[F.col(c).isNull().cast("int").alias(c) for c in df.columns if c not in keys])


def row_count(df: DataFrame, label: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(label))


def duplicate_count(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first per key (or per full row); NULLs compare equal."""
    keys = list(subset) if subset else df.columns
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicates"))


def panel_balance(df: DataFrame, date: str = "date", entity: str = "borough") -> DataFrame:
    """Distinct days x distinct entities vs rows, duplicate keys, date range."""
    keyed = df.groupBy(date, entity).agg(F.count(F.lit(1)).alias("_n"))
    return keyed.agg(
        F.count_distinct(date).alias("n_days"), F.count_distinct(entity).alias("n_entities"),
        F.sum("_n").cast("long").alias("n_rows"), F.sum(F.col("_n") - 1).cast("long").alias("duplicate_keys"),
        F.min(date).alias("date_min"), F.max(date).alias("date_max")) \
        .withColumn("expected_rows", F.col("n_days") * F.col("n_entities")) \
        .withColumn("balanced", (F.col("expected_rows") == F.col("n_rows")).cast("int"))


def missing_panel_cells(df: DataFrame, date: str = "date", entity: str = "borough") -> DataFrame:
    """(date, entity) keys absent from the panel, over the days present x the
    entities present (missing keys are neither).

    The days are numbered; an entity's numbers in order, with one before the
    first day, leave *gaps* between neighbours, and only gaps are written out.
    No set of entities or days is held anywhere; a task holds the day
    numbers of one entity."""
    days = numbered(df.where(F.col(date).isNotNull()).select(F.col(date).alias("_day")).distinct(), "_day", "_no")
    keys = df.where(F.col(entity).isNotNull()).select(F.col(date).alias("_date"), F.col(entity).alias("_of")).distinct()
    marks = keys.join(days, F.col("_date") == F.col("_day")).select("_of", "_no")
    marks = marks.unionByName(keys.select("_of", F.lit(-1).cast("long").alias("_no")).distinct())
    after = F.lead("_no").over(Window.partitionBy("_of").orderBy("_no"))
    gaps = marks.withColumn("_next", F.coalesce(after, F.lit(days.count()))).where(F.col("_next") > F.col("_no") + 1)
    missing = gaps.select("_of", F.explode(F.sequence(F.col("_no") + 1, F.col("_next") - 1)).alias("_no"))
    return missing.join(days, "_no").select(F.col("_day").alias(date), F.col("_of").alias(entity))


def consistency_rate(df: DataFrame, parts: Sequence[str], total: str, out: str = "pct") -> DataFrame:
    """% of rows where the sum of ``parts`` equals ``total``."""
    s = sum((F.col(c) for c in parts), F.lit(0))
    return df.agg((F.avg((s == F.col(total)).cast("double")) * 100.0).alias(out))


def domain_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def column_mode(df: DataFrame, col: str) -> DataFrame:
    """Most frequent value (ties -> smallest) with its count; type kept."""
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    best = counts.agg(F.min(F.struct((-F.col("_c")).alias("nn"), F.col("_v").alias("v"))).alias("b"))
    return best.select(F.col("b.v").alias(col), (-F.col("b.nn")).alias("n"))


def iqr_bounds(df: DataFrame, cols: Sequence[str], factor: float = 1.5, approx: bool = False) -> DataFrame:
    """Q1, Q3, IQR, lower / upper fence and outlier count per column."""
    from pansift.operators.clean import iqr_fit
    cols = list(cols)
    b = iqr_fit(df, cols, factor, approx)
    cnt = fit_row(df, {f"o{i}": F.count_if((finite_or_null(F.col(c).cast("double")) < b[c][2]) |
                                           (finite_or_null(F.col(c).cast("double")) > b[c][3]))
                       for i, c in enumerate(cols) if b[c][0] is not None})
    rows = [(c, b[c][0], b[c][1], None if b[c][0] is None else b[c][1] - b[c][0], b[c][2], b[c][3],
             int(cnt.get(f"o{i}", 0) or 0)) for i, c in enumerate(cols)]
    return df.sparkSession.createDataFrame(
        rows, "column string, q1 double, q3 double, iqr double, lower double, upper double, n_outliers bigint")


def robust_z(df: DataFrame, date: str, value: str, prefix: str = "citywide", threshold: float = 3.5,
             approx: bool = False) -> DataFrame:
    """Daily total across entities, 0.6745 (x - median) / MAD (MAD 0 -> 1),
    with |z|, low and high flags at ``threshold``.  Runs on the daily
    aggregate (one row per day)."""
    total = f"{prefix}_{value}"
    daily = df.groupBy(date).agg(F.sum(F.col(value)).alias(total))
    med = (quantile_fit(daily, [total], [0.5], approx=approx)[total] or [None])[0]
    mad = (quantile_fit(daily, {"d": F.abs(F.col(total) - F.lit(med))}, [0.5], approx=approx)["d"] or [None])[0]
    mad = 1.0 if not mad else mad
    z = F.lit(0.6745) * (F.col(total) - F.lit(med)) / F.lit(mad)
    zc = f"{prefix}_robust_z"
    return daily.withColumn(zc, z).withColumns({
        f"is_outlier_{prefix}": (F.abs(F.col(zc)) > threshold).cast("int"),
        f"is_outlier_low_{prefix}": (F.col(zc) < -threshold).cast("int"),
        f"is_outlier_high_{prefix}": (F.col(zc) > threshold).cast("int")})
