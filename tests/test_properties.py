"""Property checks (hypothesis) on small generated frames."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pansift.operators import clean as CL
from pansift.operators import features as FE
from pansift.operators.timeseries import dedupe_keep_first

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 5), st.floats(-100, 100)),
                min_size=1, max_size=30)


@SETTINGS
@given(rows)
def test_dedupe_idempotent(spark, data):
    df = spark.createDataFrame(data, "k string, o int, v double")
    once = dedupe_keep_first(df, ["k"], ["o", "v"])
    twice = dedupe_keep_first(once, ["k"], ["o", "v"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.count() == len({r[0] for r in data})


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 50), st.integers(0, 50), st.integers(0, 50)), min_size=1, max_size=20))
def test_shares_sum_to_one(spark, data):
    df = spark.createDataFrame([(a, b, c, a + b + c) for a, b, c in data], "x_cnt long, y_cnt long, z_cnt long, total long")
    out, names, _ = FE.share_columns(df, ["x_cnt", "y_cnt", "z_cnt"], "total")
    for r in out.collect():
        assert abs(sum(r[n] for n in names) - 1.0) < 1e-12


@SETTINGS
@given(st.lists(st.floats(-1e6, 1e6), min_size=2, max_size=40))
def test_minmax_in_unit_interval_and_winsor_idempotent(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    mm = [r[0] for r in CL.scale_minmax(df, ["x"]).collect()]
    if max(xs) > min(xs):
        assert min(mm) == 0.0 and max(mm) == 1.0
    w1 = CL.winsorize_pct(df, ["x"])
    lo, hi = min(r[0] for r in w1.collect()), max(r[0] for r in w1.collect())
    # clipping again at the first fit's bounds changes nothing
    again = [r[0] for r in w1.selectExpr(f"greatest(least(x, {hi!r}), {lo!r}) AS x").collect()]
    assert again == [r[0] for r in w1.collect()]
