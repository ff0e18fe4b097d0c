"""Exact quantiles: bracketed selection and group sketches against sorted lists."""

import math
import random

import pytest
from pyspark.sql import functions as F

from pansift.operators import quantiles as Q


def plain(values, q, discrete=False):
    v = sorted(x for x in values if x is not None and not math.isnan(x))
    if not v:
        return None
    if discrete:
        return v[max(0, math.ceil(q * len(v)) - 1)]
    at = q * (len(v) - 1)
    a, b = v[math.floor(at)], v[math.ceil(at)]
    return a if a == b else (math.ceil(at) - at) * a + (at - math.floor(at)) * b


QS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]


def columns(n, seed=1):
    rs = random.Random(seed)
    return {"spread": [rs.gauss(0, 1e3) for _ in range(n)],
            "hot": [rs.choice([0.0, 0.0, 0.0, 1.0, rs.random()]) for _ in range(n)],
            "two": [float(k % 3 == 0) for k in range(n)],
            "gaps": [rs.choice([None, float("nan"), float(rs.randint(-5, 5))]) for _ in range(n)],
            "wide": [rs.choice([float("inf"), float("-inf"), rs.random() * 10.0 ** rs.randint(-9, 9)]) for _ in range(n)],
            "none": [None] * n, "one": [7.5] + [None] * (n - 1)}


def frame(spark, cols, parts=5):
    names = list(cols)
    return spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} double" for c in names)).repartition(parts)


@pytest.fixture
def small_sketches(monkeypatch):
    """Sketches of few values, so that few rows take several scans."""
    monkeypatch.setattr(Q, "WHOLE", 5)
    monkeypatch.setattr(Q, "BRACKET", 6)
    monkeypatch.setattr(Q, "RANKS", 32)
    monkeypatch.setattr(Q, "AT_ONCE", 7)


@pytest.mark.parametrize("n", [1, 2, 3, 31, 32, 33, 3000])
def test_brackets(spark, small_sketches, n):
    cols = columns(n)
    for discrete in (False, True):
        got = Q.quantile_fit(frame(spark, cols), list(cols), QS, discrete)
        for c, v in cols.items():
            want = [plain(v, q, discrete) for q in QS]
            assert got[c] == (None if want[0] is None else pytest.approx(want, rel=1e-15, nan_ok=True)), c


def test_brackets_that_miss(spark, small_sketches, monkeypatch):
    monkeypatch.setattr(Q, "_error", lambda power: 0.0)  # brackets too narrow: the counts have to notice
    cols = {c: v for c, v in columns(2000, 2).items() if c in ("spread", "hot", "two")}
    got = Q.quantile_fit(frame(spark, cols), list(cols), QS)
    assert got == {c: pytest.approx([plain(v, q) for q in QS], rel=1e-15) for c, v in cols.items()}


def test_sketch_that_is_full(spark):
    """As many values as a sketch holds, in many partitions, and one more."""
    for n in ((1 << Q.WHOLE), (1 << Q.WHOLE) + 1, 50_000):
        df = spark.range(0, n, 1, 13).select(((F.col("id") * 7919) % n).cast("double").alias("x"))
        got = Q.quantile_fit(df, ["x"], {"x": [0.25, 0.5, 0.9]})["x"]
        assert got == pytest.approx([0.25 * (n - 1), 0.5 * (n - 1), 0.9 * (n - 1)], rel=1e-12)


def test_ranks_of_every_size():
    for q in (0.0, 0.001, 0.05, 1 / 3, 0.5, 0.75, 0.999, 1.0):
        ranks = Q._near(q, 10)
        for n in [*range(1, 200), 255, 256, 257, 511, 1000, 1023, 1024]:
            for rank in (*Q._wanted(q, n, False)[:2], Q._wanted(q, n, True)[0]):
                # the sketch gives the value whose rank is the next above
                assert max(0, math.ceil(ranks[Q._place(q, n, rank)] * n) - 1) == rank


@pytest.mark.parametrize("power", [12, 3])
def test_groups(spark, monkeypatch, power):
    """Both ways: groups within a sketch, and larger ones."""
    monkeypatch.setattr(Q, "OF_GROUP", power)
    cols = columns(400, 3)
    sizes = [0, 1, 2, 3, 7, 8, 9, 100]
    cols["g"] = [float(k) for k, s in enumerate(sizes) for _ in range(s)]
    cols["g"] += [None] * (400 - len(cols["g"]))
    df = frame(spark, cols)
    names = [c for c in cols if c != "g"]
    for discrete in (False, True):
        rows = Q.quantile_table(df, names, {c: QS if c != "hot" else [0.5] for c in names}, ["g"], discrete).collect()
        got = {(r.g, r.column): (r.n, r["values"]) for r in rows}
        assert len(got) == len(rows)
        for g in set(cols["g"]):
            for c in names:
                mine = [x for x, h in zip(cols[c], cols["g"]) if h == g]
                want = [plain(mine, q, discrete) for q in (QS if c != "hot" else [0.5])]
                if want[0] is None:
                    assert (g, c) not in got
                else:
                    n, have = got[g, c]
                    assert n == sum(x is not None and not math.isnan(x) for x in mine)
                    assert have == pytest.approx(want, rel=1e-15, nan_ok=True)


def test_no_value_is_shuffled(spark):
    """The plan of groups holds one exchange, of sketches; the fit of whole columns none by value."""
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("x"))
    plan = Q.quantile_table(df, ["x"], [0.5], ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "hashpartitioning(g" in plan
    assert plan.split("+- == Initial Plan")[0].count("Exchange") == 1
