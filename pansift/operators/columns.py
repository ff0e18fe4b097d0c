"""Projections, filters, predicates and column hygiene (blueprint 2.2)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pansift.functions.numeric import finite_or_null, numeric_types
from pansift.functions.text import safe_name, strip_all
from pansift.operators._fit import fit_row


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case and strip every column name (all whitespace)."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def select_cols(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.select(*cols)


def drop_cols(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop the listed columns that exist; absent names are ignored."""
    present = [c for c in cols if c in df.columns]
    return df.drop(*present)


def rename_first_match(df: DataFrame, candidates: Iterable[str], target: str) -> DataFrame:
    """First present alias becomes ``target`` (no-op when ``target`` exists)."""
    if target in df.columns:
        return df
    for c in candidates:
        if c in df.columns:
            return df.withColumnRenamed(c, target)
    return df


def safe_column_names(values: Iterable[str], prefix: str = "topk_", suffix: str = "_cnt") -> dict:
    """Label value -> safe column name."""
    return {v: safe_name(v, prefix, suffix) for v in values}


def standardize_text(df: DataFrame, cols: Iterable[str], case: str = "upper") -> DataFrame:
    """Strip all whitespace and change case: ``upper`` for keys, ``lower`` for labels."""
    fn = {"upper": F.upper, "lower": F.lower, "none": lambda c: c}[case]
    cols = list(cols)
    return df.withColumns({c: fn(strip_all(F.col(c).cast("string"))) for c in cols})


def fill_literal(df: DataFrame, cols: Iterable[str], value) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in cols})


def to_timestamp_coerce(df: DataFrame, col: str, fmt: str | None = None,
                        out: str | None = None) -> DataFrame:
    """Parse text to timestamp; unparseable values become NULL (never raise)."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        expr = F.col(col)
    elif isinstance(dtype, T.DateType):
        expr = F.col(col).cast("timestamp")
    else:
        s = strip_all(F.col(col).cast("string"))
        expr = F.try_to_timestamp(s, F.lit(fmt)) if fmt else F.try_to_timestamp(s)
    return df.withColumn(out or col, expr)


def truncate_to_date(df: DataFrame, col: str, out: str = "date", as_text: bool = False) -> DataFrame:
    """Timestamp -> calendar date, or ISO ``yyyy-MM-dd`` text."""
    d = F.to_date(F.col(col))
    return df.withColumn(out, F.date_format(d, "yyyy-MM-dd") if as_text else d)


def to_number_coerce(df: DataFrame, cols, dtype: str = "double") -> DataFrame:
    cols = [cols] if isinstance(cols, str) else list(cols)
    def conv(c):
        src = F.col(c)
        if isinstance(df.schema[c].dataType, T.StringType):
            src = strip_all(src)
        out = src.try_cast(dtype)
        return finite_or_null(out) if dtype in ("double", "float") else out
    return df.withColumns({c: conv(c) for c in cols})


def clean_currency(df: DataFrame, cols) -> DataFrame:
    """``$1,200`` -> 1200.0; numbers pass through; junk -> NULL."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    exprs = {}
    for c in cols:
        if isinstance(df.schema[c].dataType, T.StringType):
            exprs[c] = finite_or_null(F.regexp_replace(F.col(c), r"[$,]", "").try_cast("double"))
        else:
            exprs[c] = finite_or_null(F.col(c).cast("double"))
    return df.withColumns(exprs)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, numeric_types) and f.name not in ex]


def categorical_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BooleanType)) and f.name not in ex]


def sentinel_to_null(df: DataFrame, value, cols: Iterable[str] | None = None) -> DataFrame:
    """A sentinel such as -666666666 -> NULL in every (listed) numeric column."""
    cols = numeric_columns(df) if cols is None else list(cols)
    return df.withColumns({c: F.when(F.col(c) != F.lit(value), F.col(c)) for c in cols})


def inf_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    cols = [c for c in (cols or numeric_columns(df))
            if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: finite_or_null(c) for c in cols})


def filter_domain(df: DataFrame, col: str, values) -> DataFrame:
    """Keep allowed labels: literal ``isin`` for a list, left-semi join for a DataFrame domain."""
    if isinstance(values, DataFrame):
        dom = values.select(F.col(values.columns[0]).alias(col)).distinct()
        return df.join(dom, on=col, how="left_semi")
    return df.where(F.col(col).isin(list(values)))


def filter_multi_range(df: DataFrame, col: str, ranges: Iterable[tuple]) -> DataFrame:
    """Keep rows whose value lies in any of the closed ranges."""
    cond = None
    for lo, hi in ranges:
        part = F.col(col).between(lo, hi)
        cond = part if cond is None else (cond | part)
    return df.where(cond if cond is not None else F.lit(False))


def filter_bounds(df: DataFrame, col: str, gt=None, lt=None) -> DataFrame:
    """Open interval ``gt < col < lt`` (either side optional)."""
    cond = F.lit(True)
    if gt is not None:
        cond = cond & (F.col(col) > gt)
    if lt is not None:
        cond = cond & (F.col(col) < lt)
    return df.where(cond)


def filter_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Closed user range; a NULL value fails the predicate (SQL semantics)."""
    return df.where(F.col(col).between(lo, hi))


def filter_in_set(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """Keep chosen categories, compared as text."""
    return df.where(F.col(col).cast("string").isin([str(v) for v in values]))


def drop_missing(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=list(subset) if subset else None)


def as_group(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Treat a discrete numeric or key column as a category."""
    return df.withColumn(out or col, F.col(col).cast("string"))


def filter_flag(df: DataFrame, flag: str, keep: int = 1) -> DataFrame:
    """Keep rows whose 0/1 flag equals ``keep`` (missing flag counts as 0)."""
    return df.where(F.coalesce(F.col(flag), F.lit(0)) == keep)


def distinct_counts(df: DataFrame, cols: Iterable[str], cap: int | None = None) -> dict:
    """Exact distinct non-missing count per column: one long-form distinct
    over (column, value) for all of them, without an Expand per column.

    ``cap`` (below 64): counts above it are reported as ``cap + 1``.  First a set
    of bits per column, one for each of 64 kinds of hash, is merged in one
    aggregate: more than ``cap`` bits mean more than ``cap`` values.  Only columns
    with fewer bits, so with hardly more values than bits, are counted, and no
    column of many values is shuffled."""
    from pansift.operators.profile import distinct_counts_long
    cols = list(cols)
    if cap is None:
        return {r["column"]: r["unique_n"] for r in distinct_counts_long(df, cols).collect()} if cols else {}

    def bits(c, seed):
        kind = F.pmod(F.xxhash64(F.lit(seed), F.col(c).cast("string")), F.lit(64)).cast("int")
        return F.bit_or(F.when(F.col(c).isNotNull(), F.call_function("shiftleft", F.lit(1).cast("long"), kind)))
    seen = fit_row(df, {f"b{i}_{seed}": bits(c, seed) for i, c in enumerate(cols) for seed in (0, 1)})
    most = {c: max(bin((seen[f"b{i}_{seed}"] or 0) & ((1 << 64) - 1)).count("1") for seed in (0, 1)) for i, c in enumerate(cols)}
    few = [c for c in cols if most[c] <= cap]
    got = distinct_counts(df, few)
    return {c: min(got.get(c, cap + 1), cap + 1) for c in cols}


def is_discrete_numeric(df: DataFrame, cols: Iterable[str] | None = None, max_unique: int = 8) -> DataFrame:
    """Per numeric column: whether it has at most ``max_unique`` distinct
    non-missing values, and that count when it does (NULL above the cap:
    only candidate columns are counted exactly)."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    n = distinct_counts(df, cols, cap=max_unique)
    rows = [(c, int(n[c]) if n[c] <= max_unique else None, int(n[c] <= max_unique)) for c in cols]
    return df.sparkSession.createDataFrame(
        rows, "column string, n_distinct bigint, is_discrete int")


def column_groups(df: DataFrame, rules: Mapping[str, object]) -> dict:
    """Group column names: rule = list of names, ``('prefix', p)``, ``('suffix', s)`` or
    ``('prefix_suffix', p, s)``; the rest is ``other``.  Metadata only."""
    out: dict = {}
    taken: set = set()
    for name, rule in rules.items():
        if isinstance(rule, tuple):
            kind = rule[0]
            if kind == "prefix":
                cols = [c for c in df.columns if c.startswith(rule[1])]
            elif kind == "suffix":
                cols = [c for c in df.columns if any(c.endswith(s) for s in rule[1:])]
            else:
                cols = [c for c in df.columns if c.startswith(rule[1]) and c.endswith(rule[2])]
        else:
            cols = [c for c in rule if c in df.columns]
        out[name] = cols
        taken.update(cols)
    out["other"] = [c for c in df.columns if c not in taken]
    return out


def drop_constant_columns(df: DataFrame, cols: Iterable[str] | None = None) -> tuple[DataFrame, list]:
    """Drop columns that are all-missing or single-valued (missing ignored)."""
    cols = list(cols) if cols is not None else df.columns
    stats = fit_row(df, {**{f"mn{i}": F.min(F.col(c)) for i, c in enumerate(cols)},
                         **{f"mx{i}": F.max(F.col(c)) for i, c in enumerate(cols)}})
    const = [c for i, c in enumerate(cols)
             if stats[f"mn{i}"] is None or stats[f"mn{i}"] == stats[f"mx{i}"]]
    return df.drop(*const), const


def variance_threshold(df: DataFrame, cols: Iterable[str], threshold: float = 0.0) -> tuple[DataFrame, list]:
    """Remove numeric columns whose population variance is <= threshold."""
    cols = list(cols)
    st = fit_row(df, {f"v{i}": F.var_pop(F.col(c).cast("double")) for i, c in enumerate(cols)})
    removed = [c for i, c in enumerate(cols) if st[f"v{i}"] is None or st[f"v{i}"] <= threshold]
    return df.drop(*removed), removed


def filter_choices(df: DataFrame, col: str) -> DataFrame:
    """Control choices for a column: numeric -> one row (lo, hi) with
    floor(min) / ceil(max), widened by 1 when equal, (0, 1) when empty;
    text -> sorted distinct non-missing values."""
    if isinstance(df.schema[col].dataType, numeric_types):
        x = finite_or_null(F.col(col).cast("double"))
        mn, mx = F.min(x), F.max(x)
        return df.agg(
            F.coalesce(F.floor(F.when(mn == mx, mn - 1).otherwise(mn)), F.lit(0)).cast("double").alias("lo"),
            F.coalesce(F.ceil(F.when(mn == mx, mx + 1).otherwise(mx)), F.lit(1)).cast("double").alias("hi"))
    return (df.where(F.col(col).isNotNull()).select(F.col(col).cast("string").alias("value"))
            .distinct().orderBy("value"))


def add_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in values.items()})
