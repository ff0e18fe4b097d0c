"""Registered queries: composed pipelines (blueprint 2.10) and the shared stage tables."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from pansift.plans import standins as S
from pansift.plans.registry import query
from pansift.plans.pipelines import PanelInputs, build_panel


def panel_inputs(spark, sf, top_k=8) -> PanelInputs:
    return PanelInputs(requests=S.requests(spark, sf), hourly=S.hourly_weather(spark, sf),
                       events=S.public_events(spark, sf), census=S.census(spark, sf),
                       listings=S.listings(spark, sf), zip_rows=S.requests(spark, sf, labels=False),
                       lines=S.request_lines(spark, sf), lookups=S.request_lookups(spark, sf), domain=S.ENTITY_DOMAIN,
                       dedupe_order=S.DEDUPE_ORDER, weather_spec=S.WEATHER_SPEC,
                       entire_token=S.LISTING_ENTIRE_TOKEN, top_k=top_k, topk_naming="rank")


_STAGE_TABLES: dict = {}


def input_state(spark, sf) -> str:
    """What the input files are: a hash over their paths, lengths and
    modification times, listed by their file system (one call per folder, no job)."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(sf)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    todo, state = [top], hashlib.sha256()
    while todo:
        listed = fs.listStatus(todo.pop())
        # reading a file changes its access time
        text = jvm.org.apache.commons.lang3.ArrayUtils.toString(listed)
        state.update(re.sub(r"access_time=\d+", "", text).encode())
        todo += [s.getPath() for s in listed if s.isDirectory()] if "isDirectory=true" in text else []
    return state.hexdigest()


def stage_table(spark, sf, name: str, build):
    """A pipeline stage as a table: the first call of an application writes
    ``build()`` to the shared checkpoint folder (reliable, survives executor
    loss), later calls with the same input files read it; a rewritten input
    is built anew.  Used for the reference's own hand-off points: the stage-1
    panel, the feature view and the processed views."""
    from pansift.session import write_stage
    key = (spark.sparkContext.applicationId, sf, name, input_state(spark, sf))
    if key not in _STAGE_TABLES:
        _STAGE_TABLES[key] = write_stage(build(), name)
    return spark.read.parquet(_STAGE_TABLES[key])


def forget_stages() -> None:
    """Let every stage be built anew (a cold benchmark)."""
    _STAGE_TABLES.clear()


def raw_panel(spark, sf):
    """Stage-1 panel before the quality step (natural gaps kept); stage-2
    queries read it as a table, as the reference's second script reads the
    panel the first one wrote."""
    return stage_table(spark, sf, "stage1_panel", lambda: build_panel(panel_inputs(spark, sf), quality=False))


def clean_panel(spark, sf):
    return build_panel(panel_inputs(spark, sf), quality=True)


@query("build_panel", S.with_ctes(["panel_clean"], "SELECT * FROM panel_clean"), floats=S.PANEL_FLOATS)
def q_build_panel(spark, sf):
    return clean_panel(spark, sf)


@query("panel_features", S.with_ctes(["panel_feat"], "SELECT * FROM panel_feat"), floats=S.PANEL_FLOATS)
def q_panel_features(spark, sf):
    return build_panel(panel_inputs(spark, sf), upto="features")
from pansift.plans.pipelines import (CleanConfig, clean_table, cleaning_audit, engineer_feature, feature_view,
                                     filtered_view, model_matrix, skew_transforms, weather_effects, SKEW_LOG, SKEW_WINS)

SHARES = [c.replace("_cnt", "_share") for c in S.TOPK_COLS]
SHARES_NO_OTHER = [s for s in SHARES if "OTHER" not in s.upper()]
COMP = SHARES_NO_OTHER + ["complaint_entropy", "complaint_hhi", "complaint_top_share", "heat_hot_water_share"]
NAMED_SHARE = ("heat_hot_water_share", "top1_cnt")


def features_of(spark, sf):
    """The stage-2 feature view over the stage-1 panel (the reuse point of the
    imputed views, transforms and model matrices)."""
    from pansift.operators.profile import robust_z

    def build():
        p = raw_panel(spark, sf)
        return feature_view(p, S.TOPK_COLS, robust_z(p, "date", "complaints_total"), NAMED_SHARE)
    return stage_table(spark, sf, "feature_view", build)


def _fv_parts() -> tuple[list, str]:
    """CTEs and final SELECT of the feature view."""
    sh = ", ".join(f"CAST({c} AS DOUBLE) / nullif(complaints_total, 0) AS {c.replace('_cnt', '_share')}" for c in S.TOPK_COLS)
    ent = " + ".join(f"coalesce(-greatest({s}, 1e-12) * ln(greatest({s}, 1e-12)), 0)" for s in SHARES)
    hhi = " + ".join(f"coalesce({s} * {s}, 0)" for s in SHARES)
    fv1 = f"""SELECT *, CAST(coalesce(event_count, 0) > 0 AS INTEGER) AS event_day,
  CAST(date_diff('day', (SELECT min(date) FROM panel_raw), date) AS INTEGER) AS day_index,
  sin(2 * pi() * day_of_week / 7) AS dow_sin, cos(2 * pi() * day_of_week / 7) AS dow_cos,
  sin(2 * pi() * (month - 1) / 12) AS month_sin, cos(2 * pi() * (month - 1) / 12) AS month_cos,
  temp_max - temp_min AS temp_range, CAST(coalesce(temp_min <= 0, false) AS INTEGER) AS is_freezing,
  CAST(coalesce(precipitation_sum > 0, false) AS INTEGER) AS is_precip, CAST(coalesce(snowfall_sum > 0, false) AS INTEGER) AS is_snow,
  CAST(complaints_total AS DOUBLE) / nullif(census_population_borough_sum, 0) * 1000 AS complaints_per_1000_people, {sh}
  FROM panel_raw"""
    fv2 = f"""SELECT *, {ent} AS complaint_entropy, {hhi} AS complaint_hhi, greatest({', '.join(SHARES)}) AS complaint_top_share,
  CAST(top1_cnt AS DOUBLE) / nullif(CAST(complaints_total AS DOUBLE), 0) AS heat_hot_water_share FROM fv1"""
    lags = ", ".join(f"lag({c}, 1) OVER w AS {c}_lag1" for c in COMP)
    fv3 = f"""SELECT *, lag(complaints_total, 1) OVER w AS complaints_total_lag1, lag(complaints_total, 7) OVER w AS complaints_total_lag7,
  CASE WHEN count(complaints_total) OVER wp >= 3 THEN avg(complaints_total) OVER wp END AS complaints_total_ma7_prev,
  CASE WHEN count(temp_mean) OVER wp >= 3 THEN avg(temp_mean) OVER wp END AS temp_mean_ma7_prev,
  lag(complaints_total, 2) OVER w AS complaints_total_lag2, {lags}
  FROM fv2 WINDOW w AS (PARTITION BY borough ORDER BY date),
  wp AS (PARTITION BY borough ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"""
    fv4 = """SELECT *, complaints_total_lag1 - complaints_total_lag2 AS complaints_total_diff_lag1,
  CAST(complaints_total_lag1 - complaints_total_lag2 AS DOUBLE) / nullif(complaints_total_lag2, 0) AS complaints_total_pct_change_lag1,
  is_weekend * precipitation_sum AS weekend_x_precip, event_day * is_weekend AS event_x_weekend,
  event_day * temp_mean AS event_x_temp, is_freezing * heat_hot_water_share AS freezing_x_heat_share,
  CASE WHEN temp_mean IS NULL THEN NULL WHEN temp_mean <= 0 THEN '<=0C' WHEN temp_mean <= 10 THEN '0-10C'
       WHEN temp_mean <= 20 THEN '10-20C' WHEN temp_mean <= 30 THEN '20-30C' ELSE '>30C' END AS temp_bin FROM fv3"""
    body = """SELECT f.*, CAST(coalesce(q.is_outlier_citywide, 0) AS INTEGER) AS is_outlier_citywide,
  CAST(coalesce(q.is_outlier_low_citywide, 0) AS INTEGER) AS is_outlier_low_citywide,
  CAST(coalesce(q.is_outlier_high_citywide, 0) AS INTEGER) AS is_outlier_high_citywide
  FROM fv4 f LEFT JOIN quality_by_date q ON f.date = q.date"""
    return [("fv1", fv1), ("fv2", fv2), ("fv3", fv3), ("fv4", fv4)], body


def _fv_sql():
    extra, body = _fv_parts()
    return S.with_ctes(["panel_raw", "quality_by_date"], body, extra=extra)


FV_FLOATS = S.PANEL_FLOATS + SHARES + ["dow_sin", "dow_cos", "month_sin", "month_cos", "temp_range", "complaints_per_1000_people",
             "complaint_entropy", "complaint_hhi", "complaint_top_share", "heat_hot_water_share", "complaints_total_ma7_prev",
             "temp_mean_ma7_prev", "complaints_total_pct_change_lag1", "weekend_x_precip", "event_x_temp",
             "freezing_x_heat_share"] + [f"{c}_lag1" for c in COMP]


@query("feature_view", _fv_sql(), floats=FV_FLOATS)
def q_feature_view(spark, sf):
    return features_of(spark, sf)


@query("census_to_entity", S.with_ctes(["census_entity"], "SELECT * FROM census_entity"),
    floats=["census_income_borough_median", "census_population_borough_sum"])
def q_census_to_entity(spark, sf):
    from pansift.plans.pipelines import census_to_entity
    return census_to_entity(S.requests(spark, sf, labels=False), S.census(spark, sf), S.ENTITY_DOMAIN)


@query("skew_transforms", None)
def q_skew_transforms(spark, sf):
    """With lambda by maximum likelihood; the long processed views hold the SQL for a given lambda."""
    return skew_transforms(raw_panel(spark, sf))


# Fixed values from the reference: predictors of the model matrices.
MM_PREDICTORS = ["day_index", "dow_sin", "dow_cos", "month_sin", "month_cos", "is_weekend", "event_day",
                 "temp_mean", "temp_range", "wind_speed_mean", "cloud_cover_mean",
                 "precipitation_sum_wins", "log1p_precipitation_sum", "boxcox_precipitation_sum",
                 "is_freezing", "is_precip", "is_snow",
                 "complaints_total_lag1", "complaints_total_lag2", "complaints_total_lag7", "complaints_total_ma7_prev",
                 "temp_mean_ma7_prev", "complaints_total_diff_lag1", "complaints_total_pct_change_lag1"] \
    + [f"{c}_lag1" for c in COMP] + ["weekend_x_precip", "event_x_weekend", "event_x_temp"]
STRUCTURAL = S.STRUCT_COLS


#: A given Box-Cox lambda, with which SQL can follow the processed views and matrices.
LAMBDA = 0.25


def _matrices(spark, sf, lam: float | None = None):
    """Matrices over the time-safe processed view (imputed forward only, skew transforms)."""
    from pansift.operators.features import TEMP_BIN_LABELS
    return model_matrix(_processed(spark, sf, time_safe=True, lam=lam), "log_complaints_total", MM_PREDICTORS, STRUCTURAL,
                        levels={"temp_bin": TEMP_BIN_LABELS})


@query("model_matrix", None)
def q_model_matrix(spark, sf):
    return _matrices(spark, sf)["X_A_std"]


@query("model_matrix_power", None)
def q_model_matrix_power(spark, sf):
    return _matrices(spark, sf)["X_A_power"]


# -- the same in SQL, in long form: (date, borough, column, value) ----------------
# Which columns have gaps, or vary at all, depends on the data; in long form a
# column that is absent has no rows, so one statement covers every case.

def _view_ctes(time_safe: bool) -> list:
    """CTEs ``view`` (long: every numeric column of the processed view) and
    ``bins`` (the filled temperature bin)."""
    extra, body = _fv_parts()
    fwd = "last_value({c} IGNORE NULLS) OVER (PARTITION BY {p}borough ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    back = "first_value({c} IGNORE NULLS) OVER (PARTITION BY {p}borough ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    fill = fwd if time_safe else f"coalesce({back}, {fwd})"
    value = fill.format(c="value", p="col, ")
    filled = f"SELECT date, borough, col, value AS raw, {value} AS value FROM fl"
    if not time_safe:
        filled = f"""SELECT f.date, f.borough, f.col, f.raw, coalesce(f.value, m.med) AS value FROM ({filled}) f
  LEFT JOIN (SELECT col, quantile_cont(value, 0.5) AS med FROM ({filled}) GROUP BY col) m ON f.col = m.col"""
    win = """SELECT w.date, w.borough, w.col || '_wins' AS col, least(greatest(w.value, b.lo), b.hi) AS value FROM filled w
  JOIN (SELECT col, max(value) FILTER (WHERE r = CAST(floor(0.01 * n) AS BIGINT) + 1) AS lo,
               max(value) FILTER (WHERE r = n - CAST(floor(0.01 * n) AS BIGINT)) AS hi
        FROM (SELECT col, value, row_number() OVER (PARTITION BY col ORDER BY value) AS r, count(*) OVER (PARTITION BY col) AS n
              FROM filled WHERE value IS NOT NULL) GROUP BY col) b ON w.col = b.col WHERE w.value IS NOT NULL AND w.col IN ({})""".format(
        ", ".join(f"'{c}'" for c in SKEW_WINS))
    return extra + [
        ("fv", body),
        ("fl", """SELECT date, borough, col, value FROM (SELECT date, borough, CAST(COLUMNS(* EXCLUDE (date, borough, temp_bin)) AS DOUBLE) FROM fv)
  UNPIVOT INCLUDE NULLS (value FOR col IN (COLUMNS(* EXCLUDE (date, borough))))"""),
        ("filled", filled),
        ("view", f"""SELECT date, borough, col, value FROM filled WHERE value IS NOT NULL
  UNION ALL SELECT date, borough, f.col || '_missing', CAST(raw IS NULL AS DOUBLE) FROM filled f
    JOIN (SELECT col FROM fl GROUP BY col HAVING count_if(value IS NULL) > 0) g ON f.col = g.col
  UNION ALL SELECT date, borough, 'temp_bin_missing', CAST(temp_bin IS NULL AS DOUBLE) FROM fv WHERE (SELECT count_if(temp_bin IS NULL) FROM fv) > 0
  UNION ALL {win}
  UNION ALL SELECT date, borough, 'log1p_' || col, ln(1 + value) FROM filled WHERE value IS NOT NULL AND col IN ({", ".join(f"'{c}'" for c in SKEW_LOG)})
  UNION ALL SELECT date, borough, 'boxcox_precipitation_sum', (power(coalesce(value, 0.0) + 0.001, {LAMBDA}) - 1) / {LAMBDA}
    FROM filled WHERE col = 'precipitation_sum'
  UNION ALL SELECT date, borough, '_boxcox_lambda_precipitation_sum', {LAMBDA} FROM fv"""),
        ("bins", """SELECT date, borough, coalesce(temp_bin, (SELECT temp_bin FROM fv WHERE temp_bin IS NOT NULL GROUP BY 1
  ORDER BY count(*) DESC, temp_bin LIMIT 1)) AS temp_bin FROM fv""")]


#: Long CTEs that a statement reads several times.
LONG_ONCE = ("fv", "fl", "filled", "view", "ok", "bins", "x")


def _matrix_sql(kind: str) -> str:
    """vt, std or minmax (option A), or B."""
    from pansift.operators.features import TEMP_BIN_LABELS
    quoted = ", ".join(f"'{c}'" for c in MM_PREDICTORS)
    struct = ", ".join(f"'{c}'" for c in STRUCTURAL)
    n = len(MM_PREDICTORS)
    bins = " UNION ALL ".join(f"SELECT b.date, b.borough, 'temp_bin_{v}' AS col, CAST(coalesce(b.temp_bin = '{v}', false) AS DOUBLE) AS value "
                              "FROM bins b JOIN ok USING (date, borough)" for v in TEMP_BIN_LABELS[1:])
    extra = _view_ctes(True) + [
        ("dropped", "SELECT date, borough FROM view WHERE col = 'is_outlier_low_citywide' AND value <> 0"),
        ("ok", f"""SELECT date, borough FROM view WHERE col IN ('log_complaints_total', {quoted}) GROUP BY 1, 2 HAVING count(*) = {n + 1}
  EXCEPT SELECT date, borough FROM dropped"""),
        ("bin_cols", bins)]
    target = "SELECT v.date, v.borough, v.col AS \"column\", v.value FROM view v JOIN ok USING (date, borough) WHERE v.col = 'log_complaints_total'"
    if kind == "B":
        return S.with_ctes(["panel_raw", "quality_by_date"], f"""{target}
  UNION ALL SELECT v.date, v.borough, v.col, v.value FROM view v JOIN ok USING (date, borough) WHERE v.col IN ({quoted}, {struct})
  UNION ALL SELECT * FROM bin_cols""", extra=extra, materialized=LONG_ONCE)
    extra += [
        ("x", f"""SELECT v.date, v.borough, v.col, v.value FROM view v JOIN ok USING (date, borough) WHERE v.col IN ({quoted})
  UNION ALL SELECT * FROM bin_cols
  UNION ALL SELECT o.date, o.borough, 'borough_' || l.borough, CAST(o.borough = l.borough AS DOUBLE) FROM ok o,
    (SELECT DISTINCT borough FROM ok WHERE borough > (SELECT min(borough) FROM ok)) l"""),
        ("st", """SELECT col, avg(value) AS m, stddev_pop(value) AS s, min(value) AS lo, max(value) AS hi,
  count_if(round(value, 6) NOT IN (0, 1)) = 0 AS flag FROM x GROUP BY col HAVING min(value) < max(value)""")]
    scaled = {"vt": "x.value", "std": "CASE WHEN st.flag THEN x.value ELSE (x.value - st.m) / st.s END",
              "minmax": "CASE WHEN st.flag THEN x.value ELSE (x.value - st.lo) / (st.hi - st.lo) END"}[kind]
    return S.with_ctes(["panel_raw", "quality_by_date"],
                       f"{target} UNION ALL SELECT x.date, x.borough, x.col, {scaled} FROM x JOIN st ON x.col = st.col", extra=extra, materialized=LONG_ONCE)


def _long(df):
    """Numeric columns in long form, without missing values."""
    cols = [c for c in df.columns if c not in ("date", "borough", "temp_bin")]
    wide = df.select("date", "borough", *[F.col(f"`{c}`").cast("double").alias(c) for c in cols])
    return wide.unpivot(["date", "borough"], [F.col(f"`{c}`") for c in cols], "column", "value").where(F.col("value").isNotNull())


def _register_long():
    for name, kind in (("X_A_vt", "vt"), ("X_A_std", "std"), ("X_A_minmax", "minmax"), ("X_B", "B")):
        @query(f"model_matrix_long_{kind.lower()}", _matrix_sql(kind), floats=["value"])
        def q_matrix(spark, sf, name=name):
            return _long(_matrices(spark, sf, LAMBDA)[name])
    for safe in (True, False):
        sql = S.with_ctes(["panel_raw", "quality_by_date"], 'SELECT date, borough, col AS "column", value FROM view', extra=_view_ctes(safe))

        @query(f"processed_{'time_safe' if safe else 'eda'}_long", sql, floats=["value"])
        def q_view(spark, sf, safe=safe):
            return _long(_processed(spark, sf, time_safe=safe, lam=LAMBDA))


@query("weather_effects", S.with_ctes(["panel_raw"], " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r FROM d"
    for a in ["complaints_total_city", "temp_mean", "precipitation_sum", "wind_speed_mean", "event_day", "is_weekend"]
    for b in ["complaints_total_city", "temp_mean", "precipitation_sum", "wind_speed_mean", "event_day", "is_weekend"]),
    extra=[("d", """SELECT date, sum(complaints_total) AS complaints_total_city, avg(temp_mean) AS temp_mean,
  coalesce(sum(precipitation_sum), 0) AS precipitation_sum, avg(wind_speed_mean) AS wind_speed_mean,
  max(event_count) AS event_day, max(is_weekend) AS is_weekend FROM panel_raw GROUP BY date""")]), floats=["r"])
def q_weather_effects(spark, sf):
    return weather_effects(raw_panel(spark, sf))["corr"]


@query("filtered_view", S.with_ctes(["wb"], """SELECT CAST(tier AS VARCHAR) AS tier, CAST(nation % 2 AS VARCHAR) AS nation, count(*) AS n
  FROM wb WHERE balance BETWEEN 0 AND 8000 AND CAST(segment AS VARCHAR) IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')
  GROUP BY 1, 2"""))
def q_filtered_view(spark, sf):
    d = S.workbench(spark, sf).withColumn("nation", F.col("nation") % 2)
    return filtered_view(d, rng=("balance", 0, 8000), cats=("segment", ["BUILDING", "MACHINERY", "HOUSEHOLD"]),
                         group_cols=["nation"], plot="Bar Chart", x="tier")


CLEAN_CFG = CleanConfig(remove_duplicates=True, missing_strategy="median", standardize_labels=True,
                        outlier_strategy="remove_iqr", outlier_cols=["balance"], scaling="zscore",
                        scale_cols=["score"], encode_cols=["segment"])
SEGS = ["automobile", "building", "furniture", "household", "machinery"]


def _clean_sql():
    med = lambda c: f"(SELECT quantile_cont({c}, 0.5) FROM d0)"
    c1 = f"""SELECT coalesce(id, {med('id')}) AS id, lower(regexp_replace(name, '^\\s+|\\s+$', '', 'g')) AS name,
  coalesce(nation, {med('nation')}) AS nation, coalesce(balance, {med('balance')}) AS balance,
  coalesce(score, {med('score')}) AS score, coalesce(CAST(tier AS DOUBLE), {med('tier')}) AS tier,
  lower(regexp_replace(segment, '^\\s+|\\s+$', '', 'g')) AS segment FROM d0"""
    c2 = """SELECT c1.* FROM c1, (SELECT quantile_cont(balance, 0.25) AS q1, quantile_cont(balance, 0.75) AS q3 FROM c1) b
  WHERE c1.balance BETWEEN b.q1 - 1.5 * (b.q3 - b.q1) AND b.q3 + 1.5 * (b.q3 - b.q1) OR c1.balance IS NULL"""
    body = ("SELECT id, name, nation, balance, (score - (SELECT avg(score) FROM c2)) / (SELECT stddev_samp(score) FROM c2) AS score, tier, "
            + ", ".join(f"CAST(coalesce(segment = '{v}', false) AS INTEGER) AS segment{v}" for v in SEGS) + " FROM c2")
    return S.with_ctes(["wb"], body, extra=[("d0", "SELECT DISTINCT * FROM wb"), ("c1", c1), ("c2", c2)])


_VIEW_WHERE = "balance BETWEEN 0 AND 8000 AND CAST(segment AS VARCHAR) IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')"


def _view(spark, sf, **how):
    return filtered_view(S.workbench(spark, sf), rng=("balance", 0, 8000),
                         cats=("segment", ["BUILDING", "MACHINERY", "HOUSEHOLD"]), **how)


@query("filtered_view_scatter", S.with_ctes(["wb"], f"""SELECT balance, score, my - sxy / sxx * mx + sxy / sxx * balance AS fitted
  FROM f, (SELECT avg(balance) AS mx, avg(score) AS my, covar_pop(balance, score) AS sxy, var_pop(balance) AS sxx FROM f
           WHERE balance IS NOT NULL AND score IS NOT NULL) l""",
    extra=[("f", f"SELECT * FROM wb WHERE {_VIEW_WHERE}")]), floats=["balance", "score", "fitted"])
def q_filtered_view_scatter(spark, sf):
    return _view(spark, sf, plot="Scatter", x="balance", y="score", fit_line=True)


@query("filtered_view_boxplot", S.with_ctes(["wb"], f"""SELECT s.*, w.whisker_low, w.whisker_high, w.n_outliers FROM st s JOIN
  (SELECT f.g, min(CASE WHEN score >= lower_fence THEN score END) AS whisker_low, max(CASE WHEN score <= upper_fence THEN score END) AS whisker_high,
   CAST(count_if(score < lower_fence OR score > upper_fence) AS BIGINT) AS n_outliers FROM f JOIN st ON f.g = st.balance GROUP BY f.g) w
  ON s.balance = w.g""", extra=[
    ("f0", f"SELECT * FROM wb WHERE {_VIEW_WHERE}"),
    ("f", """SELECT score, CASE WHEN balance <= lo THEN 1 ELSE CAST(least(greatest(ceil((balance - lo) / ((hi - lo) / 5)), 1), 5) AS INTEGER) END AS g
  FROM f0, (SELECT min(balance) AS lo, max(balance) AS hi FROM f0) r"""),
    ("st", """SELECT g AS balance, count(score) AS n, quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.5) AS median, quantile_cont(score, 0.75) AS q3,
  quantile_cont(score, 0.25) - 1.5 * (quantile_cont(score, 0.75) - quantile_cont(score, 0.25)) AS lower_fence,
  quantile_cont(score, 0.75) + 1.5 * (quantile_cont(score, 0.75) - quantile_cont(score, 0.25)) AS upper_fence FROM f GROUP BY g""")]),
    floats=["q1", "median", "q3", "lower_fence", "upper_fence", "whisker_low", "whisker_high"])
def q_filtered_view_boxplot(spark, sf):
    return _view(spark, sf, plot="Boxplot", x="balance", y="score")


@query("filtered_view_histogram", S.with_ctes(["wb"], """SELECT CAST(least(floor((balance - lo) / ((hi - lo) / 30)), 29) AS INTEGER) AS bin,
  lo + least(floor((balance - lo) / ((hi - lo) / 30)), 29) * ((hi - lo) / 30) AS bin_lo,
  lo + (least(floor((balance - lo) / ((hi - lo) / 30)), 29) + 1) * ((hi - lo) / 30) AS bin_hi, count(*) AS count
  FROM f, (SELECT min(balance) AS lo, max(balance) AS hi FROM f) r GROUP BY 1, 2, 3""",
    extra=[("f", f"SELECT * FROM wb WHERE {_VIEW_WHERE}")]), floats=["bin_lo", "bin_hi"])
def q_filtered_view_histogram(spark, sf):
    return _view(spark, sf, plot="Histogram", x="balance")


@query("filtered_view_histogram_text", S.with_ctes(["wb"], f"SELECT CAST(segment AS VARCHAR) AS segment, count(*) AS n FROM wb WHERE {_VIEW_WHERE} GROUP BY 1"))
def q_filtered_view_histogram_text(spark, sf):
    return _view(spark, sf, plot="Histogram", x="segment")


@query("filtered_view_density", S.with_ctes(["wb"], """SELECT c.segment, g.i, first(c.g_lo + g.i * (c.g_hi - c.g_lo) / 511) AS x,
  sum(c.c * exp(-0.5 * power((c.g_lo + g.i * (c.g_hi - c.g_lo) / 511 - c.center) / c.bw, 2)) / (c.n * c.bw * sqrt(2 * pi()))) AS density
  FROM cnt c CROSS JOIN (SELECT CAST(range AS INTEGER) AS i FROM range(512)) g GROUP BY c.segment, g.i""", extra=[
    ("f", f"SELECT CAST(segment AS VARCHAR) AS segment, balance FROM wb WHERE {_VIEW_WHERE}"),
    ("s0", """SELECT segment, count(balance) AS n, stddev_samp(balance) AS sd, quantile_cont(balance, 0.75) - quantile_cont(balance, 0.25) AS iqr,
       min(balance) AS lo, max(balance) AS hi FROM f GROUP BY segment"""),
    ("st", """SELECT *, 0.9 * (CASE WHEN least(sd, iqr / 1.34) > 0 THEN least(sd, iqr / 1.34) WHEN sd > 0 THEN sd
       WHEN abs(lo) > 0 THEN abs(lo) ELSE 1.0 END) * power(CAST(n AS DOUBLE), -0.2) AS bw,
       CASE WHEN hi > lo THEN (hi - lo) / 4096 ELSE 1.0 END AS bin_w FROM s0 WHERE n >= 2"""),
    ("cnt", """SELECT st.segment, st.n, st.bw, st.lo - 3 * st.bw AS g_lo, st.hi + 3 * st.bw AS g_hi,
       st.lo + (least(floor((f.balance - st.lo) / st.bin_w), 4095) + 0.5) * st.bin_w AS center, count(*) AS c
       FROM f JOIN st ON f.segment = st.segment GROUP BY ALL""")]), floats=["x", "density"])
def q_filtered_view_density(spark, sf):
    return _view(spark, sf, plot="Density", x="balance", group_cols=["segment"])


_SOURCES = ["holiday", "parade"]


@query("event_table", S.with_ctes(["public_events"], f"""SELECT title, date, coalesce(d.borough, f.borough) AS borough, type, source FROM
  (SELECT title, date, borough, type, source FROM (SELECT *, row_number() OVER (PARTITION BY title, date ORDER BY r, borough NULLS FIRST, source NULLS FIRST, type NULLS FIRST) AS k FROM s) WHERE k = 1) f
  LEFT JOIN (SELECT unnest({S.ENTITY_DOMAIN!r}) AS borough) d ON f.borough = 'ALL'""", extra=[
    ("s", "SELECT *, 0 AS r FROM public_events WHERE type = 'holiday' UNION ALL SELECT *, 1 FROM public_events WHERE type = 'parade'"
          " UNION ALL SELECT title, date, borough, NULL, 'again', 2 FROM public_events")]))
def q_event_table(spark, sf):
    """Three sources of which the last repeats every event without its type."""
    from pansift.plans.pipelines import event_table
    e = S.public_events(spark, sf).select("title", "date", "borough", "type", "source")
    again = e.withColumn("type", F.lit(None).cast("string")).withColumn("source", F.lit("again"))
    out = event_table([*(e.where(F.col("type") == t) for t in _SOURCES), again], S.ENTITY_DOMAIN)
    return out.select("title", "date", "borough", "type", "source")


@query("cleaning_log", S.with_ctes(["wb"], """SELECT * FROM (
  SELECT 1 AS step, 'duplicates' AS name, NULL AS "column", 'rows' AS metric, (SELECT count(*) FROM wb) AS "before", (SELECT count(*) FROM d0) AS "after"
  """ + "".join(f"""UNION ALL SELECT 1, 'duplicates', '{c}', 'missing', (SELECT count_if({c} IS NULL) FROM wb), (SELECT count_if({c} IS NULL) FROM d0)
  """ for c in ("id", "name", "nation", "balance", "score", "tier", "segment"))
    + """UNION ALL SELECT 2, 'missing_median', NULL, 'rows', (SELECT count(*) FROM d0), (SELECT count(*) FROM d0)
  """ + "".join(f"""UNION ALL SELECT 2, 'missing_median', '{c}', 'missing', (SELECT count_if({c} IS NULL) FROM d0), 0
  UNION ALL SELECT 2, 'missing_median', '{c}', 'treated', NULL, NULL
  """ for c in ("id", "nation", "balance", "score", "tier"))
    + """UNION ALL SELECT 3, 'outliers_remove_iqr', NULL, 'rows', (SELECT count(*) FROM d0), (SELECT count(*) FROM c2)
  UNION ALL SELECT 3, 'outliers_remove_iqr', 'balance', 'treated', NULL, NULL
  """ + "".join(f"""UNION ALL SELECT 3, 'outliers_remove_iqr', '{c}', 'missing', (SELECT count_if({c} IS NULL) FROM b), (SELECT count_if({c} IS NULL) FROM c2)
  """ for c in ("name", "balance", "segment")) + """)
  WHERE metric <> 'missing' OR "before" <> "after" """, extra=[("d0", "SELECT DISTINCT * FROM wb"),
    ("b", "SELECT name, segment, coalesce(balance, (SELECT quantile_cont(balance, 0.5) FROM d0)) AS balance FROM d0"),
    ("c2", """SELECT name, segment, balance FROM b, (SELECT quantile_cont(balance, 0.25) AS q1, quantile_cont(balance, 0.75) AS q3 FROM b) q
  WHERE balance BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""")]))
def q_cleaning_log(spark, sf):
    cfg = CleanConfig(remove_duplicates=True, missing_strategy="median", outlier_strategy="remove_iqr", outlier_cols=["balance"])
    return clean_table(S.workbench(spark, sf), cfg)[1]


@query("weather_effects_fits", S.with_ctes(["panel_raw"], " UNION ALL ".join(
    f"""SELECT '{x}' AS x, count(*) AS n, corr({x}, complaints_total_city) AS r,
  covar_pop({x}, complaints_total_city) / var_pop({x}) AS slope,
  avg(complaints_total_city) - covar_pop({x}, complaints_total_city) / var_pop({x}) * avg({x}) AS intercept,
  CAST(min({x}) AS DOUBLE) AS x_min, CAST(max({x}) AS DOUBLE) AS x_max FROM d WHERE {x} IS NOT NULL"""
    for x in ("temp_mean", "precipitation_sum", "wind_speed_mean")), extra=[
        ("d", """SELECT date, CAST(sum(complaints_total) AS DOUBLE) AS complaints_total_city, avg(temp_mean) AS temp_mean,
  coalesce(sum(precipitation_sum), 0) AS precipitation_sum, avg(wind_speed_mean) AS wind_speed_mean FROM panel_raw GROUP BY date""")]),
    floats=["r", "slope", "intercept", "x_min", "x_max"])
def q_weather_effects_fits(spark, sf):
    """r, line and range of the three weather columns (p-values are checked by unit tests)."""
    out = None
    for x, fit in weather_effects(raw_panel(spark, sf))["fits"].items():
        row = fit.drop("p").select(F.lit(x).alias("x"), "n", "r", "slope", "intercept", "x_min", "x_max")
        out = row if out is None else out.unionByName(row)
    return out


@query("clean_table", _clean_sql(), floats=["balance", "score", "tier", "id", "nation"])
def q_clean_table(spark, sf):
    return clean_table(S.workbench(spark, sf), CLEAN_CFG)[0]


@query("cleaning_audit", S.with_ctes(["wb"], """SELECT metric, CAST(b AS BIGINT) AS "before", CAST(a AS BIGINT) AS "after",
  CAST(NULL AS VARCHAR) AS detail FROM (VALUES
  ('rows', (SELECT count(*) FROM wb), (SELECT count(*) FROM wb WHERE balance IS NOT NULL)),
  ('columns', 7, 7),
  ('missing_cells', (SELECT count_if(balance IS NULL) + count_if(segment IS NULL) + count_if(tier IS NULL) FROM wb),
   (SELECT count_if(segment IS NULL) + count_if(tier IS NULL) FROM wb WHERE balance IS NOT NULL)),
  ('duplicate_rows', (SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM wb)) FROM wb),
   (SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM wb WHERE balance IS NOT NULL)) FROM wb WHERE balance IS NOT NULL)))
  t(metric, b, a)"""))
def q_cleaning_audit(spark, sf):
    wb = S.workbench(spark, sf)
    return cleaning_audit(wb, wb.dropna(subset=["balance"]))


@query("engineer_feature", S.with_ctes(["wb"], """SELECT 'original' AS variable, 'balance' AS "column", round(avg(balance), 4) AS mean,
  round(stddev_samp(balance), 4) AS sd, round(min(balance), 4) AS min, round(median(balance), 4) AS median, round(max(balance), 4) AS max FROM wb
  UNION ALL SELECT 'engineered', 'ratio', round(avg(r), 4), round(stddev_samp(r), 4), round(min(r), 4), round(median(r), 4), round(max(r), 4)
  FROM (SELECT CASE WHEN abs(score) >= 1e-8 THEN balance / score END AS r FROM wb)"""),
    floats={"mean": 4, "sd": 4, "min": 4, "median": 4, "max": 4})
def q_engineer_feature(spark, sf):
    return engineer_feature(S.workbench(spark, sf), "ratio", "balance", "score", " ratio ")[1]


def _processed(spark, sf, time_safe: bool, lam: float | None = None):
    """The reference's two processed views, each a stage table: every gappy
    column gets an indicator and is filled (EDA view: bfill + ffill in
    entity, then median / mode; time-safe view: forward fill only), then
    the skew transforms run."""
    from pansift.operators import clean as CL
    from pansift.plans.pipelines import missing_columns
    from pansift.session import cut_lineage

    def build():
        fv = features_of(spark, sf)
        cols = missing_columns(fv.select(*[c for c in fv.columns if c not in ("date", "borough")]))
        view = CL.impute_time_safe(fv, "borough", "date", cols) if time_safe else \
            CL.impute_eda_view(fv, "borough", "date", cols)
        # the skew transforms fit several times over the view; cut its window lineage once
        return skew_transforms(cut_lineage(view, "processed_view"), lam)
    return stage_table(spark, sf, f"processed_{'time_safe' if time_safe else 'eda'}_{lam}", build)


_register_long()


@query("processed_eda_view", None)
def q_processed_eda_view(spark, sf):
    """Every gappy column: indicator, bfill + ffill within entity, then median (text: mode); then skew transforms."""
    return _processed(spark, sf, time_safe=False)


@query("processed_time_safe_view", None)
def q_processed_time_safe_view(spark, sf):
    """Every gappy column: indicator, forward fill only (leading gaps stay); then skew transforms."""
    return _processed(spark, sf, time_safe=True)


@query("write_stage2_outputs", None)
def q_write_stage2_outputs(spark, sf):
    """The reference's final save: both processed views and the four A
    matrices (each with the target), written under one output folder."""
    from pansift.session import scratch_path
    from pansift.sources.sinks import write_outputs
    mats = _matrices(spark, sf)
    frames = {"processed": _processed(spark, sf, time_safe=False),
              "processed_time_safe": _processed(spark, sf, time_safe=True),
              "model_matrix_A": mats["X_A_vt"], "model_matrix_A_standard": mats["X_A_std"],
              "model_matrix_A_minmax": mats["X_A_minmax"], "model_matrix_A_power": mats["X_A_power"]}
    paths = write_outputs(frames, scratch_path(spark, "stage2_outputs"), "parquet")
    parts = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows")
             for n, p in paths.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
