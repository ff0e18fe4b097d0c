"""Registered queries: statistics and plot data (blueprint 2.4)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from pansift.plans import standins as S
from pansift.plans.registry import query
from pansift.operators import stats as ST
from pansift.operators import viewdata as V
from pansift.plans.pipelines import ENTITY
from pansift.plans.q_pipelines import raw_panel

CORR_COLS = ["complaints_total", "temp_mean", "precipitation_sum", "wind_speed_mean", "cloud_cover_mean",
             "snowfall_sum", "event_count", "is_weekend", "temp_mean_lag1", "airbnb_listing_count"]


@query("corr_matrix", S.with_ctes(["panel_raw"], " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r FROM panel_raw"
    for a in CORR_COLS for b in CORR_COLS)), floats=["r"])
def q_corr_matrix(spark, sf):
    return ST.corr_matrix(raw_panel(spark, sf), CORR_COLS, "pairwise")


@query("corr_matrix_complete", S.with_ctes(["panel_raw"], " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r FROM cc"
    for a in CORR_COLS[:5] for b in CORR_COLS[:5]), extra=[("cc", "SELECT * FROM panel_raw WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in CORR_COLS[:5]))]), floats=["r"])
def q_corr_matrix_complete(spark, sf):
    return ST.corr_matrix(raw_panel(spark, sf), CORR_COLS[:5], "complete")


@query("corr_pair", S.with_ctes(["wb"], """SELECT count(balance) FILTER (WHERE score IS NOT NULL) AS n,
  corr(balance, score) AS r FROM wb"""), floats=["r"])
def q_corr_pair(spark, sf):
    return ST.corr_pair(S.workbench(spark, sf), "balance", "score")


CITY = """SELECT date, sum(complaints_total) AS complaints_total_city, avg(temp_mean) AS temp_mean,
  coalesce(sum(precipitation_sum), 0) AS precipitation_sum, avg(wind_speed_mean) AS wind_speed_mean FROM panel_raw GROUP BY date"""


def _city(spark, sf):
    from pansift.operators.aggregate import citywide_daily
    return citywide_daily(raw_panel(spark, sf))


@query("pearson_test_fit", S.with_ctes(["panel_raw"], """SELECT count(*) AS n, corr(temp_mean, complaints_total_city) AS r,
  regr_slope(complaints_total_city, temp_mean) AS slope, min(temp_mean) AS x_min, max(temp_mean) AS x_max,
  regr_intercept(complaints_total_city, temp_mean) AS intercept FROM city
  WHERE temp_mean IS NOT NULL AND complaints_total_city IS NOT NULL""", extra=[("city", CITY)]),
    floats=["r", "slope", "x_min", "x_max", "intercept"])
def q_pearson_test_fit(spark, sf):
    return ST.pearson_test_fit(_city(spark, sf), "temp_mean", "complaints_total_city", with_p=False)


@query("pearson_p_value", None)
def q_pearson_p_value(spark, sf):
    return ST.pearson_test_fit(_city(spark, sf), "temp_mean", "complaints_total_city", with_p=True)


SKEW_COLS = ["precipitation_sum", "complaints_total", "temp_mean", "wind_speed_mean", "snowfall_sum"]


@query("skewness_adj", S.with_ctes(["panel_raw"], " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", skewness({c}) AS skew FROM panel_raw" for c in SKEW_COLS)), floats=["skew"])
def q_skewness_adj(spark, sf):
    return ST.skewness_adj(raw_panel(spark, sf), SKEW_COLS)


@query("acf", S.with_ctes(["panel_raw"], "SELECT 0 AS lag, 1.0 AS acf, 1.96 / sqrt((SELECT count(x) FROM lagged)) AS band UNION ALL "
    + " UNION ALL ".join(f"SELECT {k}, corr(x, l{k}), 1.96 / sqrt((SELECT count(x) FROM lagged)) FROM lagged" for k in range(1, 31)),
    extra=[("lagged", "SELECT CAST(x AS DOUBLE) AS x, " + ", ".join(f"lag(CAST(x AS DOUBLE), {k}) OVER (ORDER BY date) AS l{k}" for k in range(1, 31))
            + " FROM (SELECT date, sum(complaints_total) AS x FROM panel_raw GROUP BY date)")]), floats=["acf", "band"])
def q_acf(spark, sf):
    city = raw_panel(spark, sf).groupBy("date").agg(F.sum("complaints_total").alias("x"))
    return ST.acf(city, "date", "x", 30)


VIF_FEATURES = ["temp_mean", "precipitation_sum", "wind_speed_mean", "cloud_cover_mean",
                "census_income_borough_median", "airbnb_listing_count", "event_count", "is_weekend"]


def _inverse_ctes(xs: dict, y: str | None, where: str) -> list:
    """CTEs of a linear model in SQL: ``d`` (rows, regressors ``x0, x1, ...``), ``m`` (their
    moments and correlations ``a_i_j``) and ``g``, in which the correlation
    matrix has become its inverse: one elimination step per regressor, each one row."""
    n = range(len(xs))
    rows = ", ".join(f"CAST({e} AS DOUBLE) AS x{i}" for i, e in enumerate(xs.values()))
    moments = ["count(*) AS n", *[f"avg(x{i}) AS m{i}, stddev_pop(x{i}) AS sd{i}" for i in n],
               *[("1.0::DOUBLE" if i == j else f"corr(x{min(i, j)}, x{max(i, j)})") + f" AS a_{i}_{j}" for i in n for j in n]]
    if y:
        moments += ["avg(y) AS my", "var_pop(y) * count(*) AS syy", *[f"covar_pop(x{i}, y) AS c{i}" for i in n]]
    out = [("d", f"SELECT date, borough, {rows}{f', CAST({y} AS DOUBLE) AS y' if y else ''} FROM panel_raw WHERE {where}"),
           ("m", f"SELECT {', '.join(moments)} FROM d")]
    last = "m"
    for k in n:
        def cell(i, j):
            if i == j == k:
                return f"1 / a_{k}_{k}"
            return f"a_{k}_{j} / a_{k}_{k}" if i == k else f"-a_{i}_{k} / a_{k}_{k}" if j == k else f"a_{i}_{j} - a_{i}_{k} * a_{k}_{j} / a_{k}_{k}"
        new = f"g{k}" if k < len(xs) - 1 else "g"
        out.append((new, f"SELECT * REPLACE ({', '.join(f'{cell(i, j)} AS a_{i}_{j}' for i in n for j in n)}) FROM {last}"))
        last = new
    return out


#: One-row CTEs that are read several times.
_MODEL_ONCE = ("d", "m", "g", "fit", "h", *[f"g{k}" for k in range(12)])


def _vif_sql(features: list) -> str:
    ctes = _inverse_ctes({f: f for f in features}, None, " AND ".join(f"{f} IS NOT NULL" for f in features))
    return S.with_ctes(["panel_raw"], " UNION ALL ".join(f"SELECT '{f}' AS feature, a_{i}_{i} AS vif FROM g" for i, f in enumerate(features)),
                       extra=ctes, materialized=_MODEL_ONCE)


@query("vif", _vif_sql(VIF_FEATURES), floats=["vif"])
def q_vif(spark, sf):
    return ST.vif(raw_panel(spark, sf), VIF_FEATURES)


@query("vif_two", S.with_ctes(["panel_raw"], """SELECT f AS feature, 1.0 / (1.0 - r * r) AS vif FROM
  (SELECT corr(temp_mean, cloud_cover_mean) AS r FROM panel_raw WHERE temp_mean IS NOT NULL AND cloud_cover_mean IS NOT NULL),
  (VALUES ('temp_mean'), ('cloud_cover_mean')) t(f)"""), floats=["vif"])
def q_vif_two(spark, sf):
    return ST.vif(raw_panel(spark, sf), ["temp_mean", "cloud_cover_mean"])


OLS_NUM = ["temp_mean", "precipitation_sum", "is_weekend", "event_count", "month"]


#: Regressors of the full model: an entity's indicator (the first is the base) and the numbers.
OLS_X = {f"borough_T_{re.sub('[^0-9A-Za-z_]', '_', v)}": f"borough = '{v}'" for v in sorted(S.ENTITY_DOMAIN)[1:]} | {c: c for c in OLS_NUM}


def _model_ctes() -> list:
    """``fit``: the one row of ``g`` with coefficients ``b0, b1, ...``, intercept ``b``
    and variance ``s2``; ``d00``: variance of the intercept over ``s2``."""
    n = range(len(OLS_X))
    where = " AND ".join(f"{c} IS NOT NULL" for c in ["borough", "log_complaints_total", *OLS_NUM])
    beta = {j: "(" + " + ".join(f"a_{j}_{i} * c{i} / (sd{j} * sd{i})" for i in n) + ")" for j in n}
    both = " + ".join(f"m{i} * m{j} * a_{i}_{j} / (n * sd{i} * sd{j})" for i in n for j in n)
    return _inverse_ctes(OLS_X, "log_complaints_total", where) + [
        ("h", f"SELECT *, {', '.join(f'{beta[j]} AS b{j}' for j in n)}, 1.0 / n + {both} AS d00 FROM g"),
        ("fit", f"""SELECT *, my - ({' + '.join(f'b{j} * m{j}' for j in n)}) AS b, n - {len(OLS_X) + 1} AS dof,
  (syy - n * ({' + '.join(f'b{j} * c{j}' for j in n)})) / (n - {len(OLS_X) + 1}) AS s2,
  n * ({' + '.join(f'b{j} * c{j}' for j in n)}) / syy AS r2 FROM h""")]


def _ols_sql() -> str:
    """The table; p is the integral of cos(v) ** (dof - 1) beyond the angle of t, by Simpson's rule."""
    terms = ["SELECT 'Intercept' AS term, b AS coef, sqrt(s2 * d00) AS se, dof, r2, n FROM fit"]
    terms += [f"SELECT '{c}', b{j}, sqrt(s2 * a_{j}_{j} / n) / sd{j}, dof, r2, n FROM fit" for j, c in enumerate(OLS_X)]
    return S.with_ctes(["panel_raw"], """SELECT term, coef, se, t, least(1.0, 2 / sqrt(pi()) * exp(lgamma((dof + 1) / 2.0) - lgamma(dof / 2.0)) * w / 3
    * sum(CASE WHEN k IN (0, 2000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END * exp((dof - 1) * ln(greatest(cos(v + k * w), 1e-300))))) AS p,
  r2, 1 - (1 - r2) * (n - 1) / dof AS adj_r2, n
  FROM (SELECT *, least(pi() / 2 - v, 12 / sqrt(dof)) / 2000 AS w FROM (SELECT *, coef / se AS t, atan(abs(coef / se) / sqrt(dof)) AS v FROM terms)),
    range(0, 2001) r(k) GROUP BY term, coef, se, t, dof, v, w, r2, n""",
                       extra=_model_ctes() + [("terms", " UNION ALL ".join(terms))], materialized=_MODEL_ONCE)


@query("ols_summary", _ols_sql(), floats=["coef", "se", "t", "p", "r2", "adj_r2"])
def q_ols_summary(spark, sf):
    return ST.ols_summary(raw_panel(spark, sf), "log_complaints_total", OLS_NUM, [ENTITY])


def _influence_sql() -> str:
    n, p = range(len(OLS_X)), len(OLS_X) + 1
    ax = {j: "(" + " + ".join(f"a_{j}_{i} * z{i}" for i in n) + f") / (n * sd{j})" for j in n}
    return S.with_ctes(["panel_raw"], f"""SELECT date, borough, {', '.join(f'x{j} AS {c}' for j, c in enumerate(OLS_X))}, y AS log_complaints_total,
  h AS leverage, e AS resid, e / sqrt(s2 * (1 - h)) AS student_resid_internal, e / (si * sqrt(1 - h)) AS student_resid_external,
  power(e / sqrt(s2 * (1 - h)), 2) * h / ({p} * (1 - h)) AS cooks_d, e / (si * sqrt(1 - h)) * sqrt(h / (1 - h)) AS dffits,
  e / sqrt(s2 * (1 - h)) * sqrt(h / (1 - h)) AS dffits_internal,
  {', '.join(f'q{j} * e / ((1 - h) * si * sqrt(a_{j}_{j} / n) / sd{j}) AS dfbetas_{c}' for j, c in enumerate(OLS_X))},
  (1.0 / n - ({' + '.join(f'm{j} * q{j}' for j in n)})) * e / ((1 - h) * si * sqrt(d00)) AS "dfbetas_Intercept",
  4.0 / n AS cooks_threshold, 2.0 * {p} / n AS leverage_threshold
  FROM (SELECT *, sqrt((dof * s2 - e * e / (1 - h)) / (dof - 1)) AS si FROM q)""", extra=_model_ctes() + [
        ("z", f"SELECT d.*, fit.*, {', '.join(f'(x{j} - m{j}) / sd{j} AS z{j}' for j in n)} FROM d, fit"),
        ("w", f"SELECT *, {', '.join(f'{ax[j]} AS q{j}' for j in n)}, y - my - ({' + '.join(f'b{j} * (x{j} - m{j})' for j in n)}) AS e FROM z"),
        ("q", f"SELECT *, 1.0 / n + {' + '.join(f'q{j} * (x{j} - m{j})' for j in n)} AS h FROM w")], materialized=_MODEL_ONCE)


_FULL_FLOATS = [*OLS_X, "log_complaints_total", "leverage", "resid", "student_resid_internal", "student_resid_external", "cooks_d",
                "dffits", "dffits_internal", *[f"dfbetas_{c}" for c in OLS_X], "dfbetas_Intercept", "cooks_threshold", "leverage_threshold"]


@query("influence", _influence_sql(), floats=_FULL_FLOATS)
def q_influence(spark, sf):
    return ST.influence(raw_panel(spark, sf), "log_complaints_total", OLS_NUM, [ENTITY], keys=["date", ENTITY])


@query("top_influential", "SELECT date, borough, cooks_d, leverage, student_resid_external FROM (" + _influence_sql()
       + ") _i ORDER BY cooks_d DESC LIMIT 10", floats=["cooks_d", "leverage", "student_resid_external"])
def q_top_influential(spark, sf):
    infl = ST.influence(raw_panel(spark, sf), "log_complaints_total", OLS_NUM, [ENTITY], keys=["date", ENTITY])
    return ST.top_influential(infl, 10).select("date", ENTITY, "cooks_d", "leverage", "student_resid_external")


PCA_COLS = ["temp_mean", "precipitation_sum", "wind_speed_mean", "cloud_cover_mean", "complaints_total", "event_count"]


@query("pca_2d", None)
def q_pca_2d(spark, sf):
    scores, ratios = ST.pca_2d(raw_panel(spark, sf), PCA_COLS, 2, keys=["date", ENTITY])
    return scores.withColumns({"explained_1": F.lit(ratios[0]), "explained_2": F.lit(ratios[1])})


@query("histogram", """SELECT CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 30)), 29) AS INTEGER) AS bin,
  lo + least(floor((o_totalprice - lo) / ((hi - lo) / 30)), 29) * ((hi - lo) / 30) AS bin_lo,
  lo + (least(floor((o_totalprice - lo) / ((hi - lo) / 30)), 29) + 1) * ((hi - lo) / 30) AS bin_hi, count(*) AS count
  FROM orders, (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders) s GROUP BY 1, 2, 3""",
    floats=["bin_lo", "bin_hi"])
def q_histogram(spark, sf):
    return V.histogram(S.table(spark, sf, "orders"), "o_totalprice", 30)


@query("histogram_by", """SELECT o_orderstatus, CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 10)), 9) AS INTEGER) AS bin,
  lo + least(floor((o_totalprice - lo) / ((hi - lo) / 10)), 9) * ((hi - lo) / 10) AS bin_lo,
  lo + (least(floor((o_totalprice - lo) / ((hi - lo) / 10)), 9) + 1) * ((hi - lo) / 10) AS bin_hi, count(*) AS count
  FROM orders, (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders) s GROUP BY 1, 2, 3, 4""",
    floats=["bin_lo", "bin_hi"])
def q_histogram_by(spark, sf):
    return V.histogram(S.table(spark, sf, "orders"), "o_totalprice", 10, by=["o_orderstatus"])


@query("bar_counts", "SELECT c_mktsegment, CAST(c_nationkey % 3 AS BIGINT) AS grp, count(*) AS n FROM customer GROUP BY 1, 2")
def q_bar_counts(spark, sf):
    c = S.table(spark, sf, "customer").withColumn("grp", (F.col("c_nationkey") % 3).cast("long"))
    return V.bar_counts(c, "c_mktsegment", ["grp"])


@query("bar_counts_binned", """SELECT CAST(CASE WHEN c_acctbal <= lo THEN 1 ELSE CAST(least(greatest(ceil((c_acctbal - lo) / ((hi - lo) / 10)), 1), 10) AS INTEGER) END AS VARCHAR) AS c_acctbal,
  count(*) AS n FROM customer, (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer) s GROUP BY 1""")
def q_bar_counts_binned(spark, sf):
    return V.bar_counts(S.table(spark, sf, "customer"), "c_acctbal")


@query("box_stats", S.with_ctes(["panel_raw"], """SELECT s.*, w.whisker_low, w.whisker_high, w.n_outliers FROM
  (SELECT borough, count(complaints_total) AS n, quantile_cont(complaints_total, 0.25) AS q1, quantile_cont(complaints_total, 0.5) AS median,
   quantile_cont(complaints_total, 0.75) AS q3,
   quantile_cont(complaints_total, 0.25) - 1.5 * (quantile_cont(complaints_total, 0.75) - quantile_cont(complaints_total, 0.25)) AS lower_fence,
   quantile_cont(complaints_total, 0.75) + 1.5 * (quantile_cont(complaints_total, 0.75) - quantile_cont(complaints_total, 0.25)) AS upper_fence
   FROM panel_raw GROUP BY borough) s
  LEFT JOIN (SELECT p.borough, min(CASE WHEN p.complaints_total >= b.lf THEN p.complaints_total END) AS whisker_low,
   max(CASE WHEN p.complaints_total <= b.uf THEN p.complaints_total END) AS whisker_high,
   CAST(count_if(p.complaints_total < b.lf OR p.complaints_total > b.uf) AS BIGINT) AS n_outliers
   FROM panel_raw p JOIN (SELECT borough, quantile_cont(complaints_total, 0.25) - 1.5 * (quantile_cont(complaints_total, 0.75) - quantile_cont(complaints_total, 0.25)) AS lf,
     quantile_cont(complaints_total, 0.75) + 1.5 * (quantile_cont(complaints_total, 0.75) - quantile_cont(complaints_total, 0.25)) AS uf
     FROM panel_raw GROUP BY borough) b ON p.borough = b.borough GROUP BY p.borough) w ON s.borough = w.borough"""),
    floats=["q1", "median", "q3", "lower_fence", "upper_fence", "whisker_low", "whisker_high"])
def q_box_stats(spark, sf):
    return V.box_stats(raw_panel(spark, sf), ENTITY, "complaints_total")


KDE_SQL = S.with_ctes(["panel_raw"], """SELECT c.borough, g.i, first(c.g_lo + g.i * (c.g_hi - c.g_lo) / 511) AS x,
  sum(c.c * exp(-0.5 * power((c.g_lo + g.i * (c.g_hi - c.g_lo) / 511 - c.center) / c.bw, 2))
      / (c.n * c.bw * sqrt(2 * pi()))) AS density
  FROM cnt c CROSS JOIN (SELECT CAST(range AS INTEGER) AS i FROM range(512)) g GROUP BY c.borough, g.i""", extra=[
    ("st0", """SELECT borough, count(temp_mean) AS n, stddev_samp(temp_mean) AS sd,
       quantile_cont(temp_mean, 0.75) - quantile_cont(temp_mean, 0.25) AS iqr, min(temp_mean) AS lo, max(temp_mean) AS hi
       FROM panel_raw GROUP BY borough"""),
    ("st", """SELECT *, 0.9 * (CASE WHEN least(sd, iqr / 1.34) > 0 THEN least(sd, iqr / 1.34) WHEN sd > 0 THEN sd
       WHEN abs(lo) > 0 THEN abs(lo) ELSE 1.0 END) * power(CAST(n AS DOUBLE), -0.2) AS bw,
       CASE WHEN hi > lo THEN (hi - lo) / 4096 ELSE 1.0 END AS bin_w FROM st0 WHERE n >= 2"""),
    ("bins", """SELECT st.borough, st.n, st.bw, st.lo, st.bin_w, st.lo - 3 * st.bw AS g_lo, st.hi + 3 * st.bw AS g_hi,
       least(floor((p.temp_mean - st.lo) / st.bin_w), 4095) AS b, (p.temp_mean - st.lo) / st.bin_w AS place
       FROM panel_raw p JOIN st ON p.borough = st.borough WHERE p.temp_mean IS NOT NULL"""),
    ("cnt", """SELECT borough, n, bw, g_lo, g_hi, lo + (b + d) * bin_w AS center, sum(CASE WHEN d = 0 THEN 1 - (place - b) ELSE place - b END) AS c
       FROM bins, (VALUES (0), (1)) h(d) GROUP BY borough, n, bw, g_lo, g_hi, lo, bin_w, b + d""")])


@query("kde", KDE_SQL, floats=["x", "density"])
def q_kde(spark, sf):
    return V.kde(raw_panel(spark, sf), "temp_mean", by=ENTITY)


@query("scatter_sample", "SELECT l_orderkey, l_extendedprice, l_discount, l_returnflag FROM lineitem")
def q_scatter_points(spark, sf):
    return V.scatter_sample(S.table(spark, sf, "lineitem"), "l_extendedprice", "l_discount", "l_returnflag", key="l_orderkey")


@query("scatter_bins", """SELECT l_returnflag,
  CAST(least(floor((CAST(l_extendedprice AS DOUBLE) - x0) / ((x1 - x0) / 50)), 49) AS INTEGER) AS x_bin,
  CAST(least(floor((CAST(l_quantity AS DOUBLE) - y0) / ((y1 - y0) / 50)), 49) AS INTEGER) AS y_bin, count(*) AS n
  FROM lineitem, (SELECT CAST(min(l_extendedprice) AS DOUBLE) AS x0, CAST(max(l_extendedprice) AS DOUBLE) AS x1,
                         CAST(min(l_quantity) AS DOUBLE) AS y0, CAST(max(l_quantity) AS DOUBLE) AS y1 FROM lineitem) r
  WHERE l_extendedprice IS NOT NULL AND l_quantity IS NOT NULL GROUP BY 1, 2, 3""")
def q_scatter_bins(spark, sf):
    return V.scatter_bins(S.table(spark, sf, "lineitem"), "l_extendedprice", "l_quantity", 50, ["l_returnflag"])


@query("scatter_sample_key", "SELECT l_orderkey, l_extendedprice, l_discount, l_returnflag FROM lineitem")
def q_scatter_sample(spark, sf):
    """Every point with its key, as the reference sends all of them: no share is drawn."""
    return V.scatter_sample(S.table(spark, sf, "lineitem"), "l_extendedprice", "l_discount", "l_returnflag", key="l_orderkey")


@query("scatter_sample_hash", None)
def q_scatter_sample_hash(spark, sf):
    return V.scatter_sample(S.table(spark, sf, "lineitem"), "l_extendedprice", "l_discount", "l_returnflag", fraction=0.05)


@query("top_category", """SELECT c_mktsegment, n FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1)
  ORDER BY n DESC, c_mktsegment LIMIT 1""")
def q_top_category(spark, sf):
    return V.top_category(S.table(spark, sf, "customer"), "c_mktsegment")


@query("insight", S.with_ctes(["wb"], """SELECT 'mean_median' AS kind, avg(balance) AS value, median(balance) AS value2,
  CAST(NULL AS VARCHAR) AS label FROM wb"""), floats=["value", "value2"])
def q_insight(spark, sf):
    return V.insight(S.workbench(spark, sf), "balance")


@query("insight_scatter", S.with_ctes(["wb"], """SELECT 'correlation' AS kind, corr(balance, score) AS value,
  CAST(NULL AS DOUBLE) AS value2, CAST(NULL AS VARCHAR) AS label FROM wb"""), floats=["value"])
def q_insight_scatter(spark, sf):
    return V.insight(S.workbench(spark, sf), "balance", "score", "Scatter")


@query("recommend_view", S.with_ctes(["wb"], """SELECT 'tier' AS x, 'balance' AS y,
  CASE WHEN (SELECT count(DISTINCT tier) FROM wb) <= 8 THEN 'Boxplot' ELSE 'Scatter' END AS recommendation,
  CASE WHEN (SELECT count(DISTINCT tier) FROM wb) <= 8 THEN 'one spread per group of x' ELSE 'both axes are measured' END AS reason"""))
def q_recommend_view(spark, sf):
    return V.recommend_view(S.workbench(spark, sf), "tier", "balance")


@query("before_after_stats", S.with_ctes(["wb"], """SELECT 'original' AS variable, 'balance' AS "column", round(avg(balance), 4) AS mean,
  round(stddev_samp(balance), 4) AS sd, round(min(balance), 4) AS min, round(median(balance), 4) AS median, round(max(balance), 4) AS max FROM wb
  UNION ALL SELECT 'engineered', 'balance_sq', round(avg(balance * balance), 4), round(stddev_samp(balance * balance), 4),
  round(min(balance * balance), 4), round(median(balance * balance), 4), round(max(balance * balance), 4) FROM wb"""),
    floats={"mean": 4, "sd": 4, "min": 4, "median": 4, "max": 4})
def q_before_after_stats(spark, sf):
    from pansift.operators.features import square
    d = square(S.workbench(spark, sf), "balance")
    return V.before_after_stats(d, "balance", "balance_sq")


@query("histogram_centered", """SELECT CAST(least(greatest(ceil((o_totalprice - s0) / w) - 1, 0), 29) AS INTEGER) AS bin,
  s0 + least(greatest(ceil((o_totalprice - s0) / w) - 1, 0), 29) * w AS bin_lo,
  s0 + (least(greatest(ceil((o_totalprice - s0) / w) - 1, 0), 29) + 1) * w AS bin_hi, count(*) AS count
  FROM orders, (SELECT min(o_totalprice) - (max(o_totalprice) - min(o_totalprice)) / 29 / 2 AS s0,
                       (max(o_totalprice) - min(o_totalprice)) / 29 AS w FROM orders) s GROUP BY 1, 2, 3""",
    floats=["bin_lo", "bin_hi"])
def q_histogram_centered(spark, sf):
    return V.histogram(S.table(spark, sf, "orders"), "o_totalprice", 30, style="centered")


@query("box_stats_binned_group", """WITH b AS (SELECT CASE WHEN c_acctbal <= lo THEN 1 ELSE CAST(least(greatest(ceil((c_acctbal - lo) / ((hi - lo) / 5)), 1), 5) AS INTEGER) END AS c_acctbal,
  CAST(c_nationkey AS DOUBLE) AS v FROM customer, (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer) s),
  st AS (SELECT c_acctbal, count(v) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
         FROM b GROUP BY c_acctbal)
  SELECT st.*, st.q1 - 1.5 * (st.q3 - st.q1) AS lower_fence, st.q3 + 1.5 * (st.q3 - st.q1) AS upper_fence,
    min(CASE WHEN b.v >= st.q1 - 1.5 * (st.q3 - st.q1) THEN b.v END) AS whisker_low,
    max(CASE WHEN b.v <= st.q3 + 1.5 * (st.q3 - st.q1) THEN b.v END) AS whisker_high,
    CAST(count_if(b.v < st.q1 - 1.5 * (st.q3 - st.q1) OR b.v > st.q3 + 1.5 * (st.q3 - st.q1)) AS BIGINT) AS n_outliers
  FROM st JOIN b ON st.c_acctbal = b.c_acctbal GROUP BY ALL""",
    floats=["q1", "median", "q3", "lower_fence", "upper_fence", "whisker_low", "whisker_high"])
def q_box_stats_binned_group(spark, sf):
    return V.box_stats(S.table(spark, sf, "customer"), "c_acctbal", "c_nationkey", group_bins=5)


INFL_SQL = S.with_ctes(["panel_raw"], """SELECT date, borough, temp_mean, log_complaints_total, h AS leverage, e AS resid,
  e / sqrt(s2 * (1 - h)) AS student_resid_internal,
  e / (si * sqrt(1 - h)) AS student_resid_external,
  power(e / sqrt(s2 * (1 - h)), 2) * h / (2 * (1 - h)) AS cooks_d,
  e / (si * sqrt(1 - h)) * sqrt(h / (1 - h)) AS dffits,
  e / sqrt(s2 * (1 - h)) * sqrt(h / (1 - h)) AS dffits_internal,
  xc * e / ((1 - h) * si * sqrt(sxx)) AS dfbetas_temp_mean,
  (1.0 / n - mx * xc / sxx) * e / (1 - h) / (si * sqrt(1.0 / n + mx * mx / sxx)) AS dfbetas_Intercept,
  4.0 / n AS cooks_threshold, 4.0 / n AS leverage_threshold
  FROM (SELECT *, sqrt(((n - 2) * s2 - e * e / (1 - h)) / (n - 3)) AS si FROM r)""", extra=[
    ("d", "SELECT date, borough, temp_mean, log_complaints_total FROM panel_raw WHERE temp_mean IS NOT NULL AND log_complaints_total IS NOT NULL"),
    ("m", """SELECT count(*) AS n, avg(temp_mean) AS mx, avg(log_complaints_total) AS my,
       var_pop(temp_mean) * count(*) AS sxx, covar_pop(temp_mean, log_complaints_total) * count(*) AS sxy FROM d"""),
    ("f", "SELECT d.*, m.*, d.temp_mean - m.mx AS xc, m.sxy / m.sxx AS b, m.my - m.sxy / m.sxx * m.mx AS a FROM d, m"),
    ("g", "SELECT *, log_complaints_total - a - b * temp_mean AS e, 1.0 / n + xc * xc / sxx AS h FROM f"),
    ("r", "SELECT *, (SELECT sum(e * e) FROM g) / (n - 2) AS s2 FROM g")])
INFL_FLOATS = ["temp_mean", "log_complaints_total", "leverage", "resid", "student_resid_internal", "student_resid_external",
               "cooks_d", "dffits", "dffits_internal", "dfbetas_temp_mean", "dfbetas_Intercept", "cooks_threshold",
               "leverage_threshold"]


@query("influence_simple", INFL_SQL, floats=INFL_FLOATS)
def q_influence_simple(spark, sf):
    """Influence diagnostics of a one-regressor OLS (closed forms in SQL)."""
    return ST.influence(raw_panel(spark, sf), "log_complaints_total", ["temp_mean"], keys=["date", ENTITY])


OLS1_SQL = S.with_ctes(["panel_raw"], """SELECT term, coef, se, coef / se AS t, r2, 1 - (1 - r2) * (n - 1) / (n - 2) AS adj_r2, n
  FROM (SELECT 'Intercept' AS term, a AS coef, sqrt(s2 * (1.0 / n + mx * mx / sxx)) AS se, r2, n FROM fit
        UNION ALL SELECT 'temp_mean', b, sqrt(s2 / sxx), r2, n FROM fit)""", extra=[
    ("d", "SELECT temp_mean AS x, log_complaints_total AS y FROM panel_raw WHERE temp_mean IS NOT NULL AND log_complaints_total IS NOT NULL"),
    ("m", """SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) * count(*) AS sxx,
       covar_pop(x, y) * count(*) AS sxy, var_pop(y) * count(*) AS syy FROM d"""),
    ("fit", """SELECT n, mx, sxx, sxy / sxx AS b, my - sxy / sxx * mx AS a,
       (syy - sxy / sxx * sxy) / (n - 2) AS s2, 1 - (syy - sxy / sxx * sxy) / syy AS r2 FROM m""")])


@query("ols_summary_simple", OLS1_SQL, floats=["coef", "se", "t", "r2", "adj_r2"])
def q_ols_summary_simple(spark, sf):
    """One-regressor OLS table (p-values are checked by unit tests)."""
    return ST.ols_summary(raw_panel(spark, sf), "log_complaints_total", ["temp_mean"]).drop("p")


VIF3 = ["temp_mean", "cloud_cover_mean", "complaints_total"]


def _vif3_sql() -> str:
    a, b, c = VIF3
    parts = []
    for x, y, z in [(a, b, c), (b, a, c), (c, a, b)]:
        rxy, rxz, ryz = f"corr({x}, {y})", f"corr({x}, {z})", f"corr({y}, {z})"
        r2 = f"(power({rxy}, 2) + power({rxz}, 2) - 2 * {rxy} * {rxz} * {ryz}) / (1 - power({ryz}, 2))"
        parts.append(f"SELECT '{x}' AS feature, 1.0 / (1.0 - {r2}) AS vif FROM cc")
    return S.with_ctes(["panel_raw"], " UNION ALL ".join(parts), extra=[
        ("cc", f"SELECT CAST({a} AS DOUBLE) AS {a}, CAST({b} AS DOUBLE) AS {b}, CAST({c} AS DOUBLE) AS {c} FROM panel_raw "
               f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL AND {c} IS NOT NULL")])


@query("vif_three", _vif3_sql(), floats=["vif"])
def q_vif_three(spark, sf):
    """VIF of three features (closed form through pairwise correlations in SQL)."""
    return ST.vif(raw_panel(spark, sf), VIF3)


@query("top_influential_simple", "SELECT date, borough, cooks_d, leverage, student_resid_external FROM ("
       + INFL_SQL + ") _i ORDER BY cooks_d DESC LIMIT 10",
       floats=["cooks_d", "leverage", "student_resid_external"])
def q_top_influential_simple(spark, sf):
    """The ten largest Cook's distances of the one-regressor model (a top-k report)."""
    infl = ST.influence(raw_panel(spark, sf), "log_complaints_total", ["temp_mean"], keys=["date", ENTITY])
    return ST.top_influential(infl, 10).select("date", ENTITY, "cooks_d", "leverage", "student_resid_external")
