"""Null / type traps T1-T19 on hand-built frames (expected values by hand)."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pansift.functions.numeric import clip_guarded, safe_div
from pansift.operators import clean as CL
from pansift.operators import columns as C
from pansift.operators import features as FE
from pansift.operators import profile as P
from pansift.operators import stats as ST
from pansift.operators import timeseries as TS


def test_t1_bad_cast_becomes_null(spark):
    df = spark.createDataFrame([("2024-01-05 10:00:00",), ("not a date",), (None,)], "created string")
    out = C.to_timestamp_coerce(df, "created").collect()
    assert out[0][0] is not None and out[1][0] is None and out[2][0] is None
    n = C.to_number_coerce(spark.createDataFrame([("12",), ("x",), (" 3.5 ",)], "v string"), "v").collect()
    assert [r[0] for r in n] == [12.0, None, 3.5]


def test_t2_divide_by_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (4.0, 2.0), (0.0, 0.0)], "a double, b double")
    out = [r[0] for r in df.select(safe_div("a", "b")).collect()]
    assert out == [None, 2.0, None]


def test_t3_nan_to_null_and_inf(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (2.0,)], "x double")
    assert [r[0] for r in C.inf_to_null(df, ["x"]).collect()] == [None, None, 2.0]


def test_t4_clip_keeps_missing(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (50.0,)], "x double")
    out = [r[0] for r in df.select(clip_guarded("x", 0.0, 10.0)).collect()]
    assert out == [None, 0.0, 10.0]


def test_t5_sum_of_all_missing_group_is_zero(spark):
    from pansift.operators.aggregate import entity_attributes
    df = spark.createDataFrame([("A", None), ("A", None), ("B", 2.0)], "k string, v double")
    out = {r["k"]: r["v"] for r in entity_attributes(df, "k", {"v": "sum"}).collect()}
    assert out == {"A": 0.0, "B": 2.0}


def test_t6_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    r = {(x["x"], x["y"]): x["r"] for x in ST.corr_matrix(df, ["a", "b"]).collect()}
    assert r[("a", "b")] is None and abs(r[("a", "a")] - 1) < 1e-12


def test_t7_pairwise_correlation_skips_missing(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (4.0, 8.0)], "a double, b double")
    r = ST.corr_pair(df, "a", "b").first()
    assert r["n"] == 3 and abs(r["r"] - 1.0) < 1e-12


def test_t8_stddev_flavours(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    z1 = [r[0] for r in CL.scale_zscore(df, ["x"], ddof=1).collect()]
    z0 = [r[0] for r in CL.scale_zscore(df, ["x"], ddof=0).collect()]
    assert abs(z1[0] - (1 - 2.5) / pd.Series([1, 2, 3, 4.]).std(ddof=1)) < 1e-12
    assert abs(z0[0] - (1 - 2.5) / pd.Series([1, 2, 3, 4.]).std(ddof=0)) < 1e-12


def test_t9_adjusted_skewness_matches_pandas(spark):
    vals = [1.0, 2.0, 4.0, 10.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = ST.skewness_adj(df, ["x"]).first()["skew"]
    assert abs(got - pd.Series(vals).skew()) < 1e-9


def test_t10_mode_ties_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "s string")
    assert P.column_mode(df, "s").first()["s"] == "a"
    nums = spark.createDataFrame([(10,), (9,), (10,), (9,)], "n int")
    assert P.column_mode(nums, "n").first()["n"] == 9
    filled = CL.impute_mode(spark.createDataFrame([(10,), (9,), (None,), (10,), (9,)], "n int"), ["n"])
    assert [r[0] for r in filled.collect()][2] == 9


def test_t11_quantiles_linear(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 4.0, 10.0]], "x double")
    b = CL.iqr_fit(df, ["x"])["x"]
    s = pd.Series([1.0, 2.0, 4.0, 10.0])
    assert abs(b[0] - s.quantile(0.25)) < 1e-12 and abs(b[1] - s.quantile(0.75)) < 1e-12


def test_t12_keep_first_uses_explicit_order(spark):
    df = spark.createDataFrame([("k1", 3, "c"), ("k1", 1, "a"), ("k1", 2, "b"), ("k2", 5, "z")],
                               "k string, o int, v string")
    out = {r["k"]: r["v"] for r in TS.dedupe_keep_first(df, ["k"], ["o"]).collect()}
    assert out == {"k1": "a", "k2": "z"}


def test_t13_strip_all_whitespace(spark):
    df = spark.createDataFrame([("\t a \n",), (" Queens ",)], "s string")
    out = [r[0] for r in C.standardize_text(df, ["s"], "upper").collect()]
    assert out == ["A", "QUEENS"]


def test_t14_weekday_monday_zero_iso_week(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-07",), ("2021-01-03",)], "d string") \
        .withColumn("d", F.to_date("d"))
    rows = FE.calendar_features(df, "d").collect()
    assert [r["day_of_week"] for r in rows] == [0, 6, 6]
    assert [r["is_weekend"] for r in rows] == [0, 1, 1]
    assert rows[2]["week_of_year"] == 53


def test_t15_rolling_min_periods_matches_pandas(spark):
    vals = [1.0, None, 3.0, 4.0, None, 6.0, 7.0, 8.0, None, 10.0]
    pdf = pd.DataFrame({"e": "A", "d": pd.date_range("2024-01-01", periods=10), "x": vals})
    df = spark.createDataFrame([("A", i, v) for i, v in enumerate(vals)], "e string, d int, x double")
    got = [r["x_ma7"] for r in TS.rolling_mean(df, "e", "d", ["x"], 7, 3).orderBy("d").collect()]
    exp = pdf["x"].rolling(7, min_periods=3).mean().tolist()
    prev = [r["x_ma7_prev"] for r in TS.rolling_mean_prev(df, "e", "d", ["x"], 7, 3).orderBy("d").collect()]
    exp_prev = pdf["x"].shift(1).rolling(7, min_periods=3).mean().tolist()
    for a, b in zip(got + prev, exp + exp_prev):
        assert (a is None and math.isnan(b)) or abs(a - b) < 1e-12


def test_t16_equal_width_cut_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (2.5,), (5.0,), (7.5,), (10.0,), (None,)], "x double")
    out = [r["x_bin"] for r in FE.cut_equal_width(df, "x", 4).collect()]
    assert out == [1, 1, 2, 3, 4, None]


def test_t17_pca_scores_centred_and_uncorrelated(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    a = rng.normal(size=200)
    rows = [(float(x), float(2 * x + rng.normal() * 0.3), float(rng.normal())) for x in a]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    scores, ratios = ST.pca_2d(df, ["a", "b", "c"], 2)
    pdf = scores.toPandas()
    assert abs(pdf["pc1"].mean()) < 1e-9 and abs(pdf[["pc1", "pc2"]].corr().iloc[0, 1]) < 1e-9
    assert ratios[0] > ratios[1] > 0


def test_t18_encoding_never_drops_missing_rows(spark):
    df = spark.createDataFrame([("x",), (None,), ("y",)], "c string")
    out = CL.one_hot_full_rank(df, ["c"]).collect()
    assert len(out) == 3 and (out[1]["cx"], out[1]["cy"]) == (0, 0)


def test_t19_range_filter_drops_missing(spark):
    df = spark.createDataFrame([(1.0,), (None,), (5.0,)], "x double")
    assert C.filter_range(df, "x", 0, 2).count() == 1


def test_cut_equal_width_matches_pandas(spark):
    import numpy as np
    rng = np.random.default_rng(21)
    x = rng.normal(size=500) * 10
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    for k in (3, 4, 10):
        got = [r["x_bin"] for r in FE.cut_equal_width(df, "x", k).collect()]
        exp = (pd.cut(pd.Series(x), k, labels=False) + 1).tolist()
        assert got == exp, k
