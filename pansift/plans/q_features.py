"""Registered queries: scalar functions and feature engineering (blueprint 2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pansift.plans import standins as S
from pansift.plans.registry import query
from pansift.operators import features as FE
from pansift.plans.pipelines import ENTITY
from pansift.plans.q_pipelines import raw_panel

SHARES = [c.replace("_cnt", "_share") for c in S.TOPK_COLS]


def _wb(spark, sf):
    return S.workbench(spark, sf)


@query("calendar_features", S.with_ctes(["counts"], """SELECT date, borough, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week,
  CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend, CAST(month(date) AS INTEGER) AS month,
  CAST(weekofyear(date) AS INTEGER) AS week_of_year FROM counts"""))
def q_calendar_features(spark, sf):
    from pansift.plans.q_aggregate import counts
    return FE.calendar_features(counts(spark, sf).select("date", ENTITY))


@query("day_index", S.with_ctes(["panel_raw"], """SELECT date, borough, CAST(date_diff('day', (SELECT min(date) FROM panel_raw), date) AS INTEGER)
  AS day_index FROM panel_raw"""))
def q_day_index(spark, sf):
    return FE.day_index(raw_panel(spark, sf).select("date", ENTITY))


@query("cyclical_encode", S.with_ctes(["panel_raw"], """SELECT date, borough, day_of_week, month,
  sin(2 * pi() * day_of_week / 7) AS dow_sin, cos(2 * pi() * day_of_week / 7) AS dow_cos,
  sin(2 * pi() * (month - 1) / 12) AS month_sin, cos(2 * pi() * (month - 1) / 12) AS month_cos FROM panel_raw"""),
    floats=["dow_sin", "dow_cos", "month_sin", "month_cos"])
def q_cyclical_encode(spark, sf):
    p = raw_panel(spark, sf).select("date", ENTITY, "day_of_week", "month")
    p = FE.cyclical_encode(p, "day_of_week", 7, 0, "dow")
    return FE.cyclical_encode(p, "month", 12, 1, "month")


@query("log1p", S.with_ctes(["wb"], """SELECT id, balance, CASE WHEN balance IS NOT NULL THEN ln(1 + greatest(balance, 0)) END AS log_clamp,
  CASE WHEN balance > -1 THEN ln(1 + balance) END AS log_null FROM wb"""), floats=["log_clamp", "log_null"])
def q_log1p(spark, sf):
    d = _wb(spark, sf).select("id", "balance")
    d = FE.log1p_tx(d, "balance", "log_clamp", "clamp")
    return FE.log1p_tx(d, "balance", "log_null", "null")


@query("sqrt_tx", S.with_ctes(["wb"], """SELECT id, balance, CASE WHEN balance IS NOT NULL THEN sqrt(greatest(balance, 0)) END AS sqrt_clamp,
  CASE WHEN balance >= 0 THEN sqrt(balance) END AS sqrt_null, sqrt(abs(balance)) AS sqrt_abs FROM wb"""),
    floats=["sqrt_clamp", "sqrt_null", "sqrt_abs"])
def q_sqrt_tx(spark, sf):
    d = _wb(spark, sf).select("id", "balance")
    for mode, name in [("clamp", "sqrt_clamp"), ("null", "sqrt_null"), ("abs", "sqrt_abs")]:
        d = FE.sqrt_tx(d, "balance", name, mode)
    return d


@query("square", S.with_ctes(["wb"], "SELECT id, balance, balance * balance AS balance_sq FROM wb"), floats=["balance_sq"])
def q_square(spark, sf):
    return FE.square(_wb(spark, sf).select("id", "balance"), "balance")


@query("zscore_feature", S.with_ctes(["wb"], """SELECT id, balance, (balance - (SELECT avg(balance) FROM wb))
  / (SELECT stddev_samp(balance) FROM wb) AS balance_z FROM wb"""), floats=["balance_z"])
def q_zscore_feature(spark, sf):
    return FE.zscore_feature(_wb(spark, sf).select("id", "balance"), "balance")


@query("cut_equal_width", S.with_ctes(["wb"], """SELECT id, balance, CASE WHEN balance IS NULL THEN NULL
  WHEN balance <= lo THEN 1 ELSE CAST(least(greatest(ceil((balance - lo) / ((hi - lo) / 4)), 1), 4) AS INTEGER) END AS balance_bin
  FROM wb CROSS JOIN (SELECT min(balance) AS lo, max(balance) AS hi FROM wb) s"""))
def q_cut_equal_width(spark, sf):
    return FE.cut_equal_width(_wb(spark, sf).select("id", "balance"), "balance", 4)


@query("cut_fixed", S.with_ctes(["panel_raw"], """SELECT date, borough, temp_mean, CASE WHEN temp_mean IS NULL THEN NULL
  WHEN temp_mean <= 0 THEN '<=0C' WHEN temp_mean <= 10 THEN '0-10C' WHEN temp_mean <= 20 THEN '10-20C'
  WHEN temp_mean <= 30 THEN '20-30C' ELSE '>30C' END AS temp_bin FROM panel_raw"""), floats=["temp_mean"])
def q_cut_fixed(spark, sf):
    return FE.cut_fixed(raw_panel(spark, sf).select("date", ENTITY, "temp_mean"), "temp_mean", out="temp_bin")


@query("interaction", S.with_ctes(["panel_raw"], """SELECT date, borough, is_weekend * precipitation_sum AS weekend_x_precip
  FROM panel_raw"""), floats=["weekend_x_precip"])
def q_interaction(spark, sf):
    p = raw_panel(spark, sf).select("date", ENTITY, "is_weekend", "precipitation_sum")
    return FE.interaction(p, "is_weekend", "precipitation_sum", "weekend_x_precip").select("date", ENTITY, "weekend_x_precip")


@query("safe_ratio", S.with_ctes(["wb"], """SELECT id, CASE WHEN abs(score) >= 1e-8 THEN balance / score END AS ratio FROM wb"""),
    floats=["ratio"])
def q_safe_ratio(spark, sf):
    return FE.safe_ratio(_wb(spark, sf).select("id", "balance", "score"), "balance", "score", "ratio").select("id", "ratio")


@query("per_capita", S.with_ctes(["panel_raw"], """SELECT date, borough, CAST(complaints_total AS DOUBLE)
  / nullif(census_population_borough_sum, 0) * 1000 AS complaints_per_1000_people FROM panel_raw"""),
    floats=["complaints_per_1000_people"])
def q_per_capita(spark, sf):
    p = raw_panel(spark, sf)
    return FE.per_capita(p, "complaints_total", "census_population_borough_sum", "complaints_per_1000_people") \
        .select("date", ENTITY, "complaints_per_1000_people")


@query("range_and_flags", S.with_ctes(["panel_raw"], """SELECT date, borough, temp_max - temp_min AS temp_range,
  CAST(coalesce(temp_min <= 0, false) AS INTEGER) AS is_freezing, CAST(coalesce(precipitation_sum > 0, false) AS INTEGER) AS is_precip,
  CAST(coalesce(snowfall_sum > 0, false) AS INTEGER) AS is_snow FROM panel_raw"""), floats=["temp_range"])
def q_range_and_flags(spark, sf):
    p = FE.range_and_flags(raw_panel(spark, sf))
    return p.select("date", ENTITY, "temp_range", "is_freezing", "is_precip", "is_snow")


_SH = ", ".join(f"CAST({c} AS DOUBLE) / nullif(complaints_total, 0) AS {c.replace('_cnt', '_share')}" for c in S.TOPK_COLS)


@query("share_columns", S.with_ctes(["panel_raw"], f"SELECT date, borough, {_SH} FROM panel_raw"), floats=SHARES)
def q_share_columns(spark, sf):
    p, names, _ = FE.share_columns(raw_panel(spark, sf), S.TOPK_COLS, "complaints_total")
    return p.select("date", ENTITY, *names)


@query("composition_diversity", S.with_ctes(["panel_raw"], "SELECT date, borough, "
    + " + ".join(f"coalesce(-greatest({s}, 1e-12) * ln(greatest({s}, 1e-12)), 0)" for s in SHARES) + " AS complaint_entropy, "
    + " + ".join(f"coalesce({s} * {s}, 0)" for s in SHARES) + " AS complaint_hhi, "
    + "greatest(" + ", ".join(SHARES) + ") AS complaint_top_share"
    + f" FROM (SELECT date, borough, {_SH} FROM panel_raw)"),
    floats=["complaint_entropy", "complaint_hhi", "complaint_top_share"])
def q_composition_diversity(spark, sf):
    p, names, _ = FE.share_columns(raw_panel(spark, sf), S.TOPK_COLS, "complaints_total")
    return FE.composition_diversity(p, names).select("date", ENTITY, "complaint_entropy", "complaint_hhi", "complaint_top_share")


@query("type_flags", S.with_ctes(["public_events"], """SELECT title, CAST(coalesce(t = 'parade', false) AS INTEGER) AS is_parade,
  CAST(coalesce(t = 'holiday', false) AS INTEGER) AS is_holiday FROM (SELECT title, CASE WHEN length(title) % 3 > 0 THEN type END AS t FROM public_events)"""))
def q_type_flags(spark, sf):
    # titles of some lengths lose their type: a missing one gives 0
    e = S.public_events(spark, sf).select("title", F.when(F.length("title") % 3 > 0, F.col("type")).alias("type"))
    return FE.type_flags(e, "type", {"is_parade": "parade", "is_holiday": "holiday"}).drop("type")


@query("type_flags_contains", "SELECT c_custkey, CAST(contains(lower(c_mktsegment), 'hold') AS INTEGER) AS is_entire FROM customer")
def q_type_flags_contains(spark, sf):
    c = S.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return FE.type_flags(c, "c_mktsegment", {"is_entire": "hold"}, contains=True).drop("c_mktsegment")


@query("strip_symbols", """SELECT doc_id, regexp_replace(regexp_replace(text, '[℠®™]', '', 'g'), '^\\s+|\\s+$', '', 'g') AS title
  FROM documents""")
def q_strip_symbols(spark, sf):
    d = S.table(spark, sf, "documents").select("doc_id", F.col("text").alias("title"))
    return FE.strip_symbols(d, "title")


EVENT_LABELS = {0: "Non-event (0)", 1: "Event (1)"}


@query("label_map", S.with_ctes(["panel_raw"], """SELECT date, borough, CASE WHEN event_has_parade = 0 THEN 'Non-event (0)'
  WHEN event_has_parade = 1 THEN 'Event (1)' END AS event_day_label FROM panel_raw"""))
def q_label_map(spark, sf):
    p = raw_panel(spark, sf).select("date", ENTITY, "event_has_parade")
    return FE.label_map(p, "event_has_parade", EVENT_LABELS, "event_day_label").drop("event_has_parade")


@query("add_named_feature", S.with_ctes(["wb"], """SELECT id, balance * score AS balance_x_score,
  balance + score AS engineered_feature FROM wb"""), floats=["balance_x_score", "engineered_feature"])
def q_add_named_feature(spark, sf):
    d = _wb(spark, sf).select("id", "balance", "score")
    d = FE.add_named_feature(d, "  balance_x_score ", F.col("balance") * F.col("score"))
    d = FE.add_named_feature(d, "   ", F.col("balance") + F.col("score"))
    return d.drop("balance", "score")
