"""Exact quantiles without gathering a column in one task.

*Bracketed selection.*  One aggregate builds a mergeable rank sketch (KLL, a
built-in of Spark) of every column.  While a column, or what is left of it, has no
more values than the sketch holds, the sketch is the sorted data and the rank is
read from it.  Otherwise the sketch gives a bracket around the rank, and the next
scan counts what lies below it, what equals its ends, and sketches what lies
between; the counts tell whether the rank is in it (if not, the search goes on beside
it).  Each scan narrows a bracket some hundred times, so a trillion rows take
four.  No value is shuffled or written: a task sends one sketch per column.

*Groups.*  If no group has more values than a sketch holds, all of them are read from
one sketch per group and column.  Larger groups take the other way: values are
counted per distinct value (combined map-side), the counts are range-partitioned
and written, and only ranges that hold a wanted rank are read again.

Missing values, NULL or NaN, do not count.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pansift.session import cut_lineage

#: Values that a sketch holds exactly, as a power of two: of a whole column, of one group's column.
WHOLE, OF_GROUP = 14, 12
#: The same for brackets, and how many evenly spaced ranks are read from their sketches.
BRACKET, RANKS = 12, 1024
#: Brackets, and columns, that are counted in one scan.
AT_ONCE = 100


def _value(x: Column) -> Column:
    x = x.cast("double")
    return F.when(~F.isnan(x), x)


def _error(power: int) -> float:
    """Four times the sketch's own bound (99 %) on the error of a normalised rank."""
    return 4 * 2.3 / (1 << power) ** 0.97


def _ranks(sketch: Column, ranks: Sequence[float]) -> Column:
    """The sketch's values at normalised ranks (one constant in the plan)."""
    return F.kll_sketch_get_quantile_double(sketch, F.split(F.lit(",".join(map(repr, ranks))), ",").cast("array<double>"))


def _near(q: float, power: int) -> list[float]:
    """Ranks from which every rank near ``q`` can be read, whatever the number of
    values up to ``2 ** power``: for each size ``2 ** k`` eight neighbouring ones."""
    return [min(max((math.floor(q * (1 << k)) + d + 0.5) / (1 << k), 0.0), 1.0)
            for k in range(power + 1) for d in range(-4, 4)]


def _place(q: float, n: int, rank: int) -> int:
    """Where the value of ``rank`` (from 0) among ``n`` stands in ``_near(q)``."""
    k = max((n - 1).bit_length(), 1)
    return 8 * k + math.floor((rank + 0.5) * (1 << k) / n) - math.floor(q * (1 << k)) + 4


def _ranged(df: DataFrame, exprs: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Written counts of the distinct values, with the number of their range:
    ``by..., _cid, _v, _n, _part``."""
    long = df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(i).alias("_cid"), _value(x).alias("_v")) for i, x in enumerate(exprs.values())])).alias("_kv"))
    long = long.select(*by, "_kv._cid", "_kv._v").where(F.col("_v").isNotNull())
    counts = long.groupBy(*by, "_cid", "_v").agg(F.count(F.lit(1)).alias("_n"))
    return cut_lineage(counts.repartitionByRange(*by, "_cid", "_v").withColumn("_part", F.spark_partition_id()), "quantiles")


def _wanted(q: float, n: int, discrete: bool) -> tuple[int, int, float]:
    """Lower and upper rank (from 0) of a quantile among ``n`` values, and its place between them."""
    if discrete:
        k = max(0, math.ceil(q * n) - 1)
        return k, k, float(k)
    at = q * (n - 1)
    return math.floor(at), math.ceil(at), at


def quantile_table(df: DataFrame, cols: Mapping[str, Column] | Sequence[str], qs, by: Sequence[str] = (),
                   discrete: bool = False) -> DataFrame:
    """``by..., column, n, values``: the quantiles of each column (and group)
    in the order of ``qs``, a list for all columns or a list per column name.

    Linear interpolation between the two nearest ranks; ``discrete``: the
    smallest value whose share of rows reaches q.  Missing values do not
    count; a column or group without values has no row.
    """
    by = list(by)
    exprs = dict(cols) if isinstance(cols, Mapping) else {c: F.col(c) for c in cols}
    names = list(exprs)
    want = [list(qs[c]) if isinstance(qs, Mapping) else list(qs) for c in names]
    counts = {f"_n{i}": F.count(_value(x)) for i, x in enumerate(exprs.values())}
    most = df.groupBy(*by).agg(F.greatest(*[c for c in counts.values()], F.lit(0)).alias("_n")).agg(F.max("_n")).first()[0] or 0
    if most <= 1 << OF_GROUP:
        return _from_sketches(df, exprs, want, by, discrete)
    return _from_ranges(df, exprs, want, by, discrete)


def _from_sketches(df: DataFrame, exprs: Mapping[str, Column], want: list[list], by: list[str], discrete: bool) -> DataFrame:
    """``quantile_table`` of groups that a sketch holds in full: one aggregate."""
    sketched = df.groupBy(*by).agg(*[e for i, x in enumerate(exprs.values()) for e in (
        F.count(_value(x)).alias(f"_n{i}"), F.kll_sketch_agg_double(_value(x), 1 << OF_GROUP).alias(f"_s{i}"))])

    def values(i: int) -> Column:
        n, width = F.col(f"_n{i}"), 8 * (OF_GROUP + 1)
        found = _ranks(F.col(f"_s{i}"), [r for q in want[i] for r in _near(q, OF_GROUP)])
        k = F.length(F.bin(n - 1))
        size = F.call_function("shiftleft", F.lit(1).cast("long"), k)

        def at(j: int, q: float, rank: Column) -> Column:
            place = 8 * k + F.floor((rank + 0.5) * size / n) - F.floor(F.lit(float(q)) * size) + 4
            return F.element_at(found, (F.lit(j * width + 1) + place).cast("int"))
        out = []
        for j, q in enumerate(want[i]):
            if discrete:
                out.append(at(j, q, F.greatest(F.ceil(F.lit(float(q)) * n) - 1, F.lit(0))))
                continue
            where = F.lit(float(q)) * (n - 1)
            low, high = at(j, q, F.floor(where)), at(j, q, F.ceil(where))
            out.append(F.when(low == high, low).otherwise((F.ceil(where) - where) * low + (where - F.floor(where)) * high))
        return F.array(*out)
    rows = [F.when(F.col(f"_n{i}") > 0, F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("n"), values(i).alias("values")))
            for i, c in enumerate(exprs)]
    long = sketched.select(*by, F.explode(F.array_compact(F.array(*rows))).alias("_row"))
    return long.select(*by, "_row.column", "_row.n", "_row.values")


def _from_ranges(df: DataFrame, exprs: Mapping[str, Column], want: list[list], by: list[str], discrete: bool) -> DataFrame:
    """``quantile_table`` by ranges of the counted values."""
    names = list(exprs)
    ranged = _ranged(df, exprs, by)
    group = Window.partitionBy(*by, "_cid")
    before = F.sum("_s").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    ranges = (ranged.groupBy(*by, "_cid", "_part").agg(F.sum("_n").alias("_s"))
              .withColumn("_total", F.sum("_s").over(group)).withColumn("_before", F.coalesce(before, F.lit(0))))
    quantiles = F.array(*[F.array(*[F.lit(float(q)) for q in w]) for w in want])
    asked = ranges.select("*", F.posexplode(quantiles[F.col("_cid")]).alias("_k", "_q"))
    if discrete:
        low = F.greatest(F.ceil(F.col("_q") * F.col("_total")) - 1, F.lit(0)).cast("long")
        asked = asked.withColumns({"_low": low, "_high": low, "_at": low.cast("double")})
    else:
        at = F.col("_q") * (F.col("_total") - 1)
        asked = asked.withColumns({"_low": F.floor(at), "_high": F.ceil(at), "_at": at})

    def holds(rank, start, size):
        return (F.col(rank) >= start) & (F.col(rank) < start + size)
    asked = asked.where(holds("_low", F.col("_before"), F.col("_s")) | holds("_high", F.col("_before"), F.col("_s")))
    hit = asked.groupBy(*by, "_cid", "_part", "_before").agg(
        F.collect_list(F.struct("_k", "_low", "_high", "_at", "_total")).alias("_asked"))
    keys = [*by, "_cid", "_part"]
    hit = hit.select(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)], "_before", "_asked")
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_h{i}"))
    near = ranged.join(hit, cond).drop(*[f"_h{i}" for i in range(len(keys))])
    inside = Window.partitionBy(*by, "_cid", "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    near = near.withColumn("_start", F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    found = near.select(*by, "_cid", "_v", "_n", "_start", F.inline("_asked"))
    is_low, is_high = (holds(r, F.col("_start"), F.col("_n")) for r in ("_low", "_high"))
    found = found.where(is_low | is_high).groupBy(*by, "_cid", "_k", "_low", "_high", "_at", "_total").agg(
        F.max(F.when(is_low, F.col("_v"))).alias("_a"), F.max(F.when(is_high, F.col("_v"))).alias("_b"))
    value = F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(
        (F.col("_high") - F.col("_at")) * F.col("_a") + (F.col("_at") - F.col("_low")) * F.col("_b"))
    out = found.groupBy(*by, "_cid", F.col("_total").alias("n")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col("_k"), value.alias("_x")))), lambda s: s["_x"]).alias("values"))
    return out.select(*by, F.array(*[F.lit(c) for c in names])[F.col("_cid")].alias("column"), "n", "values")


#: Accuracy of the sketch that ``approx`` asks for.
ACCURACY = 10_000


def quantile_fit(df: DataFrame, cols: Mapping[str, Column] | Sequence[str], qs, discrete: bool = False,
                 approx: bool = False) -> dict:
    """``{column: [values in the order of qs]}``; None for a column without
    values.  One row per column is collected.  ``approx``: from a sketch, in
    one pass without a shuffle of values."""
    names = list(cols)
    if not names:
        return {}
    if approx:
        exprs = dict(cols) if isinstance(cols, Mapping) else {c: F.col(c) for c in cols}
        want = {c: list(qs[c] if isinstance(qs, Mapping) else qs) for c in names}
        row = df.agg(*[F.percentile_approx(exprs[c].cast("double"), want[c], ACCURACY).alias(f"q{i}") for i, c in enumerate(names)]).first()
        return {c: None if row[i] is None else list(row[i]) for i, c in enumerate(names)}
    exprs = dict(cols) if isinstance(cols, Mapping) else {c: F.col(c) for c in cols}
    want = [list(qs[c] if isinstance(qs, Mapping) else qs) for c in names]
    return _bracketed(df, exprs, want, discrete)


@dataclass
class _Bracket:
    """An open interval of column ``i`` that is looked into (None: no end), and the
    ranks sought there.  ``below``, ``above``: ends between which they are known to lie."""
    i: int
    ranks: list[int]
    low: float | None = None
    high: float | None = None
    below: float | None = None
    above: float | None = None
    found: dict = field(default_factory=dict)

    def inside(self, x: Column) -> Column:
        cond = x.isNotNull()
        cond = cond if self.low is None else cond & (x > self.low)
        return cond if self.high is None else cond & (x < self.high)


def _bracketed(df: DataFrame, exprs: Mapping[str, Column], want: list[list], discrete: bool) -> dict:
    """``quantile_fit`` by sketches."""
    names, values = list(exprs), [_value(x) for x in exprs.values()]
    total, found, todo = [0] * len(names), [{} for _ in names], []
    wide = _error(WHOLE)
    for at in range(0, len(names), AT_ONCE):
        part = range(at, min(at + AT_ONCE, len(names)))
        sketched = df.agg(*[e for i in part for e in (F.count(values[i]).alias(f"n{i}"),
                                                      F.kll_sketch_agg_double(values[i], 1 << WHOLE).alias(f"s{i}"))])
        row = sketched.select(*[f"n{i}" for i in part], *[F.when(F.col(f"n{i}") > 0, _ranks(F.col(f"s{i}"), [
            r for q in want[i] for r in (*_near(q, WHOLE), max(0.0, q - wide), min(1.0, q + wide))])).alias(f"v{i}")
            for i in part if want[i]]).first()
        for i in part:
            n = total[i] = row[f"n{i}"]
            for j, q in enumerate(want[i] if n else ()):
                ranks = sorted(set(_wanted(q, n, discrete)[:2]))
                got = row[f"v{i}"][j * (8 * WHOLE + 10):(j + 1) * (8 * WHOLE + 10)]
                if n <= 1 << WHOLE:
                    found[i].update({r: got[_place(q, n, r)] for r in ranks})
                else:
                    todo.append(_Bracket(i, ranks, got[-2], got[-1]))
    while todo:
        now, todo = todo[:AT_ONCE], todo[AT_ONCE:]
        todo += _narrowed(df, values, now)
        for b in now:
            found[b.i].update(b.found)

    def value(i, q):
        low, high, place = _wanted(q, total[i], discrete)
        a, b = found[i][low], found[i][high]
        return a if a == b else (high - place) * a + (place - low) * b
    return {c: [value(i, q) for q in want[i]] if total[i] else None for i, c in enumerate(names)}


def _narrowed(df: DataFrame, values: list[Column], brackets: list[_Bracket]) -> list[_Bracket]:
    """One scan: ranks that can be told go to ``found``, brackets for the others come back."""
    parts = []
    for k, b in enumerate(brackets):
        x, inside = values[b.i], b.inside(values[b.i])
        parts += [(F.lit(0) if b.low is None else F.count_if(x < b.low)).alias(f"less{k}"),
                  (F.lit(0) if b.low is None else F.count_if(x == b.low)).alias(f"low{k}"),
                  (F.lit(0) if b.high is None else F.count_if(x == b.high)).alias(f"high{k}"),
                  F.count_if(inside).alias(f"n{k}"), F.kll_sketch_agg_double(F.when(inside, x), 1 << BRACKET).alias(f"s{k}")]
    grid = [(g + 0.5) / RANKS for g in range(RANKS)]
    row = df.agg(*parts).select("*", *[F.when(F.col(f"n{k}") > 0, _ranks(F.col(f"s{k}"), grid)).alias(f"v{k}")
                                       for k in range(len(brackets))]).drop(*[f"s{k}" for k in range(len(brackets))]).first()
    rest = []
    for k, b in enumerate(brackets):
        first = row[f"less{k}"] + row[f"low{k}"]  # the rank at which the open interval begins
        n, got = row[f"n{k}"], row[f"v{k}"]
        last = first + n + (row[f"high{k}"] if b.high != b.low else 0)
        left, inner, right = [], [], []
        for r in b.ranks:
            if r < row[f"less{k}"]:
                left.append(r)
            elif r < first:
                b.found[r] = b.low
            elif r < first + n:
                if n <= RANKS:
                    b.found[r] = got[math.floor((r - first + 0.5) * RANKS / n)]
                else:
                    inner.append(r)
            elif r < last:
                b.found[r] = b.high
            else:
                right.append(r)
        if left:  # the bracket missed: on between what is known and its end
            rest.append(_Bracket(b.i, left, b.below, b.low, b.below, b.low))
        if right:
            rest.append(_Bracket(b.i, right, b.high, b.above, b.high, b.above))
        if inner:
            wide = _error(BRACKET)
            low = math.floor(((inner[0] - first) / n - wide) * RANKS - 1)
            high = math.ceil(((inner[-1] - first + 1) / n + wide) * RANKS + 1)
            rest.append(_Bracket(b.i, inner, got[low] if low >= 0 else b.low, got[high] if high < RANKS else b.high, b.low, b.high))
    return rest


def with_group_quantiles(groups: DataFrame, df: DataFrame, keys: Sequence[str], outs: Mapping[str, tuple[Column, float]],
                         approx: bool = False) -> DataFrame:
    """``groups`` (one row per key) with a quantile column per entry of
    ``outs``: name -> (value, q).  Groups without values get NULL."""
    keys = list(keys)
    if not keys:
        fit = quantile_fit(df, {o: c for o, (c, _) in outs.items()}, {o: [q] for o, (_, q) in outs.items()}, approx=approx)
        return groups.withColumns({o: F.lit(fit[o][0] if fit[o] else None).cast("double") for o in outs})
    if approx:
        wide = df.groupBy(*keys).agg(*[F.percentile_approx(c.cast("double"), q, ACCURACY).alias(o) for o, (c, q) in outs.items()])
        return _attached(groups, wide, keys, list(outs))
    table = quantile_table(df, {o: c for o, (c, _) in outs.items()}, {o: [q] for o, (_, q) in outs.items()}, keys)
    wide = table.groupBy(*keys).agg(*[F.max(F.when(F.col("column") == o, F.col("values")[0])).alias(o) for o in outs])
    return _attached(groups, wide, keys, list(outs))


def _attached(groups: DataFrame, wide: DataFrame, keys: list[str], outs: list[str]) -> DataFrame:
    right = wide.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], *outs)
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & groups[k].eqNullSafe(right[f"_g{i}"])
    return groups.join(right, cond, "left").drop(*[f"_g{i}" for i in range(len(keys))])
