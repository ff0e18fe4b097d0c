"""The data behind each plot (blueprint 2.4, view rows).

Plots are not rendered; each operator returns the small aggregated table a
plot is drawn from.  All work is grouped aggregation on Spark; outputs are
bounded by bins, groups or grid points, never by rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pansift.functions.numeric import finite_or_null, numeric_types
from pansift.operators.quantiles import quantile_fit, quantile_table
from pansift.operators.features import cut_equal_width_expr


#: A number with at most so many values counts as a group.
FEW = 8


def _x(c):
    return finite_or_null(F.col(c).cast("double"))


def _is_num(df, c):
    return isinstance(df.schema[c].dataType, numeric_types)


def _attach(df: DataFrame, st: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach per-group statistics: an equi-join on the group keys, or for
    the ungrouped case the single statistics row as literals."""
    if keys:
        return df.join(st, list(keys), "inner")
    row = st.first()
    if row is None:
        return df.where(F.lit(False)).withColumns({c: F.lit(None) for c in st.columns})
    return df.withColumns({c: F.lit(row[c]) for c in st.columns})


def _quantile_columns(df: DataFrame, keys: Sequence[str], x, names: dict, approx: bool) -> DataFrame:
    """Per group: ``n`` values and the named quantiles of ``x``."""
    groups = df.groupBy(*keys).agg(F.count(x).alias("n"))
    if approx:
        q = df.groupBy(*keys).agg(F.percentile_approx(x, list(names.values()), 10_000).alias("values"))
    else:
        q = quantile_table(df, {"x": x}, list(names.values()), keys)
    q = q.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], "values")
    if not keys:
        row = q.first()
        return groups.withColumns({o: F.lit(row["values"][i] if row and row["values"] else None).cast("double")
                                   for i, o in enumerate(names)})
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & groups[k].eqNullSafe(q[f"_g{i}"])
    return groups.join(q, cond, "left").select(*keys, "n", *[F.col("values")[i].alias(o) for i, o in enumerate(names)])


def histogram(df: DataFrame, col: str, bins: int = 30, by: Sequence[str] = (), style: str = "numpy") -> DataFrame:
    """Equal-width counts; only non-empty bins are returned.

    ``numpy``: ``bins`` bins spanning [min, max], each [lo, hi) except the
    last, which is closed.  ``centered``: the plotting-library default,
    width (max - min) / (bins - 1) with the first and last bins centred on
    min and max, bins right-closed (the first also holds its left edge).
    ``by``: group / facet columns.
    """
    by = list(by)
    st = df.agg(F.min(_x(col)).alias("lo"), F.max(_x(col)).alias("hi")).first()
    lo, hi = st["lo"], st["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], ", ".join([f"`{b}` string" for b in by] + ["bin int", "bin_lo double", "bin_hi double", "count bigint"]))
    if style == "centered":
        w = (hi - lo) / (bins - 1) if hi > lo and bins > 1 else 1.0
        start = lo - w / 2
        idx = F.least(F.greatest(F.ceil((_x(col) - F.lit(start)) / F.lit(w)) - 1, F.lit(0)), F.lit(bins - 1)).cast("int")
    else:
        if lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        w = (hi - lo) / bins
        start = lo
        idx = F.least(F.floor((_x(col) - F.lit(lo)) / F.lit(w)), F.lit(bins - 1)).cast("int")
    g = df.where(_x(col).isNotNull()).groupBy(*by, idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return g.withColumns({"bin_lo": F.lit(start) + F.col("bin") * F.lit(w),
                          "bin_hi": F.lit(start) + (F.col("bin") + 1) * F.lit(w)}) \
            .select(*by, "bin", "bin_lo", "bin_hi", "count")


def bar_counts(df: DataFrame, col: str, by: Sequence[str] = (), bins: int = 10,
               max_unique: int = FEW) -> DataFrame:
    """Counts per category (and group / facet).  A continuous numeric x is
    first cut into ``bins`` equal-width, right-closed bins."""
    by = list(by)
    x = F.col(col)
    if _is_num(df, col):
        from pansift.operators.columns import distinct_counts
        nd = distinct_counts(df, [col], cap=max_unique)[col]
        if nd > max_unique:
            st = df.agg(F.min(_x(col)).alias("lo"), F.max(_x(col)).alias("hi")).first()
            x = cut_equal_width_expr(_x(col), st["lo"], st["hi"], bins)
    return df.groupBy(x.cast("string").alias(col), *by).agg(F.count(F.lit(1)).alias("n"))


def box_stats(df: DataFrame, group: str | None, value: str, factor: float = 1.5,
              approx: bool = False, group_bins: int | None = None) -> DataFrame:
    """Per group: Q1 / median / Q3, whisker ends (most extreme values inside
    the 1.5 IQR fences) and outlier count; order by median desc at the sink.
    ``group_bins``: a continuous group column is first cut into that many
    equal-width, right-closed bins (numbered 1..k)."""
    keys = [group] if group else []
    if group and group_bins:
        st0 = df.agg(F.min(_x(group)).alias("lo"), F.max(_x(group)).alias("hi")).first()
        df = df.withColumn(group, cut_equal_width_expr(_x(group), st0["lo"], st0["hi"], group_bins))
    x = _x(value)
    st = _quantile_columns(df, keys, x, {"q1": 0.25, "median": 0.5, "q3": 0.75}, approx)
    st = st.withColumns({"lower_fence": F.col("q1") - factor * (F.col("q3") - F.col("q1")),
                         "upper_fence": F.col("q3") + factor * (F.col("q3") - F.col("q1"))})
    j = _attach(df.select(*keys, x.alias("_v")), st, keys)
    w = j.groupBy(*keys).agg(
        F.min(F.when(F.col("_v") >= F.col("lower_fence"), F.col("_v"))).alias("whisker_low"),
        F.max(F.when(F.col("_v") <= F.col("upper_fence"), F.col("_v"))).alias("whisker_high"),
        F.count_if((F.col("_v") < F.col("lower_fence")) | (F.col("_v") > F.col("upper_fence"))).alias("n_outliers"))
    if not keys:
        return _attach(w, st, [])
    return st.join(w, keys, "left").orderBy(F.desc("median"), *[F.asc(k) for k in keys])


def kde(df: DataFrame, col: str, by: str | None = None, grid: int = 512, fine_bins: int = 4096,
        cut: float = 3.0, approx: bool = False) -> DataFrame:
    """Gaussian kernel density on ``grid`` points from min - 3 bw to max + 3 bw
    with R's default bandwidth 0.9 min(sd, IQR / 1.34) n^-1/5; groups with
    fewer than 2 values are skipped.

    The data are first binned linearly on ``fine_bins`` + 1 nodes per group:
    each value shares its mass between the nodes beside it, by its distance
    to either, so the error is of second order in the node width (tested
    below 1e-5 of the exact sum).  A group's nodes then form one array, and each
    grid point is a fold over it; only the grid is exploded.
    """
    keys = [by] if by else []
    x = _x(col)
    st = df.groupBy(*keys).agg(F.stddev_samp(x).alias("sd"), F.min(x).alias("lo"), F.max(x).alias("hi"))
    q = _quantile_columns(df, keys, x, {"_q1": 0.25, "_q3": 0.75}, approx)
    st = _attach(q, st, keys)
    small = F.least(F.col("sd"), (F.col("_q3") - F.col("_q1")) / 1.34)
    base = F.when(small > 0, small).when(F.col("sd") > 0, F.col("sd")).when(F.abs(F.col("lo")) > 0, F.abs(F.col("lo"))).otherwise(F.lit(1.0))
    st = st.where(F.col("n") >= 2).withColumn("bw", F.lit(0.9) * base * F.pow(F.col("n").cast("double"), F.lit(-0.2))) \
           .withColumn("g_lo", F.col("lo") - cut * F.col("bw")).withColumn("g_hi", F.col("hi") + cut * F.col("bw")) \
           .withColumn("bin_w", F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / fine_bins).otherwise(F.lit(1.0))) \
           .select(*keys, "n", "bw", "g_lo", "g_hi", "lo", "bin_w")
    binned = _attach(df.select(*keys, x.alias("_v")).where(F.col("_v").isNotNull()), st, keys)
    at = (F.col("_v") - F.col("lo")) / F.col("bin_w")
    b = F.least(F.floor(at), F.lit(fine_bins - 1))
    group = [*keys, "n", "bw", "g_lo", "g_hi", "lo", "bin_w"]
    halves = binned.groupBy(*group, b.alias("b")).agg(F.count(F.lit(1)).alias("c"), F.sum(at - b).alias("right"))
    halves = halves.select(*group, F.inline(F.array(F.struct(F.col("b"), (F.col("c") - F.col("right")).alias("c")),
                                                    F.struct((F.col("b") + 1).alias("b"), F.col("right").alias("c")))))
    counts = halves.groupBy(*group, "b").agg(F.sum("c").alias("c"))
    center = F.col("lo") + F.col("b") * F.col("bin_w")
    one = counts.groupBy(*keys, "n", "bw", "g_lo", "g_hi").agg(
        F.array_sort(F.collect_list(F.struct(center.alias("m"), F.col("c").cast("double").alias("c")))).alias("bins"))
    pts = one.select(*keys, "n", "bw", "bins", "g_lo", "g_hi", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("i"))
    pts = pts.withColumn("x", F.col("g_lo") + F.col("i") * (F.col("g_hi") - F.col("g_lo")) / F.lit(grid - 1))
    kernel = F.aggregate("bins", F.lit(0.0), lambda s, v: s + v["c"] * F.exp(
        -0.5 * ((F.col("x") - v["m"]) / F.col("bw")) * ((F.col("x") - v["m"]) / F.col("bw"))))
    return pts.select(*keys, "i", "x", (kernel / (F.col("n") * F.col("bw") * F.lit(math.sqrt(2 * math.pi)))).alias("density"))


# Fixed parameters of the key-based sampling rule (a modular linear map of
# the key onto [0, 1), small enough to never overflow a long).
_SAMPLE_MOD, _SAMPLE_MUL, _SAMPLE_ADD = 1000003, 7919, 104729


def scatter_sample(df: DataFrame, x: str, y: str, color: str | None = None, fraction: float | None = None,
                   seed: int = 42, key: str | None = None) -> DataFrame:
    """The points of a scatter plot: all of them, or, if a ``fraction`` is given,
    that share: a deterministic Bernoulli sample, the same rule at every size,
    without a count, a shuffle or a sort.  The uniform draw is a hash of the whole
    row, or, with ``key`` (an integer column), a modular linear map of the
    key that plain SQL can reproduce.  ``scatter_bins`` counts all points of
    data too large to draw."""
    cols = ([key] if key else []) + [x, y] + ([color] if color else [])
    if fraction is None:
        return df.select(*cols)
    if key is not None:
        k = F.pmod(F.col(key).cast("long"), F.lit(_SAMPLE_MOD))
        u = F.pmod(k * _SAMPLE_MUL + (_SAMPLE_ADD + seed), F.lit(_SAMPLE_MOD)) / float(_SAMPLE_MOD)
    else:
        u = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in df.columns]), F.lit(1_000_000)) / 1_000_000.0
    return df.where(u < fraction).select(*cols)


def scatter_bins(df: DataFrame, x: str, y: str, bins: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """Exact counts of all points on a grid of ``bins`` x ``bins`` cells over
    the ranges of both variables (cells right-open, the last closed); rows
    without x or y are left out, as a plot leaves them out."""
    by = list(by)
    d = df.select(*by, _x(x).alias("_x"), _x(y).alias("_y")).where(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    r = d.agg(F.min("_x").alias("x0"), F.max("_x").alias("x1"), F.min("_y").alias("y0"), F.max("_y").alias("y1")).first()

    def cell(c, lo, hi):
        width = (hi - lo) / bins if lo is not None and hi > lo else 1.0
        return F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return d.groupBy(*by, cell("_x", r["x0"], r["x1"]).alias("x_bin"), cell("_y", r["y0"], r["y1"]).alias("y_bin")) \
            .agg(F.count(F.lit(1)).alias("n"))


def top_category(df: DataFrame, col: str) -> DataFrame:
    """Most frequent label (ties: smallest) with its count."""
    from pansift.operators.profile import column_mode
    return column_mode(df, col)


def insight(df: DataFrame, x: str, y: str | None = None, plot: str = "Histogram") -> DataFrame:
    """One-row insight: correlation for a numeric scatter, mean and median for
    a numeric x, otherwise the top category."""
    spark = df.sparkSession
    schema = "kind string, value double, value2 double, label string"
    if plot == "Scatter" and y and _is_num(df, x) and _is_num(df, y):
        from pansift.operators.stats import corr_pair
        return corr_pair(df, x, y).select(F.lit("correlation").alias("kind"), F.col("r").alias("value"),
                                          F.lit(None).cast("double").alias("value2"), F.lit(None).cast("string").alias("label"))
    if _is_num(df, x):
        median = (quantile_fit(df, {x: _x(x)}, [0.5])[x] or [None])[0]
        return df.agg(F.lit("mean_median").alias("kind"), F.avg(_x(x)).alias("value"),
                      F.lit(median).cast("double").alias("value2"), F.lit(None).cast("string").alias("label"))
    if x in df.columns:
        t = top_category(df, x)
        return t.select(F.lit("top_category").alias("kind"), F.col("n").cast("double").alias("value"),
                        F.lit(None).cast("double").alias("value2"), F.col(x).cast("string").alias("label"))
    return spark.createDataFrame([("unavailable", None, None, None)], schema)


# The view names for the kinds of x and y ("-": none); any other pair gets a histogram.
VIEW_FOR = {
    ("number", "number"): ("Scatter", "both axes are measured"),
    ("group", "number"): ("Boxplot", "one spread per group of x"),
    ("number", "-"): ("Histogram / Density", "how x is spread"),
    ("group", "-"): ("Bar Chart", "how often each x occurs"),
}


def recommend_view(df: DataFrame, x: str, y: str | None = None, max_unique: int = FEW) -> DataFrame:
    """The view that ``VIEW_FOR`` names.  Text, and numbers with at most
    ``max_unique`` values, count as groups on the x side."""
    from pansift.operators.columns import distinct_counts
    few = _is_num(df, x) and distinct_counts(df, [x], cap=max_unique)[x] <= max_unique
    kinds = ("number" if _is_num(df, x) and not few else "group",
             "-" if not y else "number" if _is_num(df, y) else "group")
    view, reason = VIEW_FOR.get(kinds, ("Histogram", "no other view fits"))
    return df.sparkSession.createDataFrame([(x, y, view, reason)], "x string, y string, recommendation string, reason string")


def before_after_stats(df: DataFrame, original: str, engineered: str, digits: int = 4) -> DataFrame:
    """Mean, SD, min, median, max of both variables over finite values."""
    rows, aggs = [], []
    medians = quantile_fit(df, {"original": _x(original), "engineered": _x(engineered)}, [0.5])
    for i, (label, c) in enumerate([("original", original), ("engineered", engineered)]):
        x = _x(c)
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"a{i}"),
                 F.lit((medians[label] or [None])[0]).cast("double").alias(f"d{i}"), F.max(x).alias(f"b{i}")]
        rows.append(F.struct(F.lit(label).alias("variable"), F.lit(c).alias("column"),
                             *[F.round(F.col(f"{k}{i}"), digits).alias(nm) for k, nm in
                               [("m", "mean"), ("s", "sd"), ("a", "min"), ("d", "median"), ("b", "max")]]))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))
