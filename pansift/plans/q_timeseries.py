"""Registered queries: windows, time series, sorts and top-k (blueprint 2.5, 2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pansift.plans import standins as S
from pansift.plans.registry import query
from pansift.operators import timeseries as TS
from pansift.operators import topk as K
from pansift.operators import aggregate as A
from pansift.plans.pipelines import ENTITY
from pansift.plans.q_pipelines import raw_panel

W = "WINDOW w AS (PARTITION BY borough ORDER BY date)"


@query("lag_features", S.with_ctes(["panel_raw"], f"""SELECT date, borough, complaints_total,
  lag(complaints_total, 1) OVER w AS complaints_total_lag1, lag(complaints_total, 2) OVER w AS complaints_total_lag2,
  lag(complaints_total, 7) OVER w AS complaints_total_lag7 FROM panel_raw {W}"""))
def q_lag_features(spark, sf):
    p = raw_panel(spark, sf).select("date", ENTITY, "complaints_total")
    return TS.lag_features(p, ENTITY, "date", ["complaints_total"], [1, 2, 7])


@query("rolling_mean", S.with_ctes(["panel_raw"], """SELECT date, borough, temp_mean,
  CASE WHEN count(temp_mean) OVER w7 >= 3 THEN avg(temp_mean) OVER w7 END AS temp_mean_ma7 FROM panel_raw
  WINDOW w7 AS (PARTITION BY borough ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""),
    floats=["temp_mean", "temp_mean_ma7"])
def q_rolling_mean(spark, sf):
    p = raw_panel(spark, sf).select("date", ENTITY, "temp_mean")
    return TS.rolling_mean(p, ENTITY, "date", ["temp_mean"], 7, 3)


@query("rolling_mean_prev", S.with_ctes(["panel_raw"], """SELECT date, borough, complaints_total, temp_mean,
  CASE WHEN count(complaints_total) OVER wp >= 3 THEN avg(complaints_total) OVER wp END AS complaints_total_ma7_prev,
  CASE WHEN count(temp_mean) OVER wp >= 3 THEN avg(temp_mean) OVER wp END AS temp_mean_ma7_prev FROM panel_raw
  WINDOW wp AS (PARTITION BY borough ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"""),
    floats=["temp_mean", "complaints_total_ma7_prev", "temp_mean_ma7_prev"])
def q_rolling_mean_prev(spark, sf):
    p = raw_panel(spark, sf).select("date", ENTITY, "complaints_total", "temp_mean")
    return TS.rolling_mean_prev(p, ENTITY, "date", ["complaints_total", "temp_mean"], 7, 3)


@query("rolling_mean_global", S.with_ctes(["panel_raw"], """SELECT date, complaints_total,
  CASE WHEN count(complaints_total) OVER w >= 1 THEN avg(complaints_total) OVER w END AS complaints_total_ma7
  FROM (SELECT date, CAST(sum(complaints_total) AS BIGINT) AS complaints_total FROM panel_raw GROUP BY date)
  WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""), floats=["complaints_total_ma7"])
def q_rolling_mean_global(spark, sf):
    city = raw_panel(spark, sf).groupBy("date").agg(F.sum("complaints_total").alias("complaints_total"))
    return TS.rolling_mean_global(city, "date", "complaints_total", 7, 1)


@query("lag_diff", S.with_ctes(["panel_raw"], f"""SELECT date, borough,
  lag(complaints_total, 1) OVER w - lag(complaints_total, 2) OVER w AS complaints_total_diff_lag1 FROM panel_raw {W}"""))
def q_lag_diff(spark, sf):
    p = TS.lag_features(raw_panel(spark, sf).select("date", ENTITY, "complaints_total"), ENTITY, "date",
                        ["complaints_total"], [1, 2])
    return TS.lag_diff(p, "complaints_total_lag1", "complaints_total_lag2", "complaints_total_diff_lag1") \
        .select("date", ENTITY, "complaints_total_diff_lag1")


@query("lag_pct_change", S.with_ctes(["panel_raw"], f"""SELECT date, borough,
  CAST(lag(complaints_total, 1) OVER w - lag(complaints_total, 2) OVER w AS DOUBLE)
    / nullif(lag(complaints_total, 2) OVER w, 0) AS complaints_total_pct_change_lag1 FROM panel_raw {W}"""),
    floats=["complaints_total_pct_change_lag1"])
def q_lag_pct_change(spark, sf):
    p = TS.lag_features(raw_panel(spark, sf).select("date", ENTITY, "complaints_total"), ENTITY, "date",
                        ["complaints_total"], [1, 2])
    return TS.lag_pct_change(p, "complaints_total_lag1", "complaints_total_lag2", "complaints_total_pct_change_lag1") \
        .select("date", ENTITY, "complaints_total_pct_change_lag1")


@query("ffill", S.with_ctes(["panel_raw"], """SELECT date, borough,
  last_value(temp_mean IGNORE NULLS) OVER (PARTITION BY borough ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS temp_mean,
  last_value(temp_mean_lag1 IGNORE NULLS) OVER (PARTITION BY borough ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS temp_mean_lag1
  FROM panel_raw"""), floats=["temp_mean", "temp_mean_lag1"])
def q_ffill(spark, sf):
    p = raw_panel(spark, sf).select("date", ENTITY, "temp_mean", "temp_mean_lag1")
    return TS.ffill(p, ENTITY, "date", ["temp_mean", "temp_mean_lag1"])


@query("bfill_ffill", S.with_ctes(["panel_raw"], """SELECT date, borough, coalesce(
  first_value(temp_mean IGNORE NULLS) OVER (PARTITION BY borough ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
  last_value(temp_mean IGNORE NULLS) OVER (PARTITION BY borough ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS temp_mean
  FROM panel_raw"""), floats=["temp_mean"])
def q_bfill_ffill(spark, sf):
    p = raw_panel(spark, sf).select("date", ENTITY, "temp_mean")
    return TS.bfill_ffill(p, ENTITY, "date", ["temp_mean"])


#: Rows of a block in the queries below: few, so that the entities' series span several.
_BLOCK = 700


@query("lag_features_blocks", S.with_ctes(["panel_raw"], f"""SELECT date, borough, complaints_total,
  lag(complaints_total, 1) OVER w AS complaints_total_lag1, lag(complaints_total, 7) OVER w AS complaints_total_lag7 FROM panel_raw {W}"""))
def q_lag_features_blocks(spark, sf):
    """Lags in blocks of consecutive rows."""
    p = raw_panel(spark, sf).select("date", ENTITY, "complaints_total")
    return TS.lag_features(p, ENTITY, "date", ["complaints_total"], [1, 7], block=_BLOCK)


@query("bfill_ffill_blocks", S.with_ctes(["panel_raw"], """SELECT date, borough, coalesce(
  first_value(temp_mean_lag1 IGNORE NULLS) OVER (PARTITION BY borough ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
  last_value(temp_mean_lag1 IGNORE NULLS) OVER (PARTITION BY borough ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS temp_mean_lag1
  FROM panel_raw"""), floats=["temp_mean_lag1"])
def q_bfill_ffill_blocks(spark, sf):
    """Fills in blocks, each with what it carries in."""
    p = raw_panel(spark, sf).select("date", ENTITY, "temp_mean_lag1")
    return TS.bfill_ffill(p, ENTITY, "date", ["temp_mean_lag1"], block=_BLOCK)


@query("dedupe_keep_first", S.with_ctes(["requests"], f"""SELECT * EXCLUDE (rn) FROM (SELECT *,
  row_number() OVER (PARTITION BY unique_key ORDER BY {', '.join(S.DEDUPE_ORDER)}) AS rn FROM requests) WHERE rn = 1"""))
def q_dedupe_keep_first(spark, sf):
    return TS.dedupe_keep_first(S.requests(spark, sf), ["unique_key"], S.DEDUPE_ORDER)


@query("rank_top_per_key", """SELECT * FROM (SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice,
  CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS INTEGER) AS rank
  FROM lineitem) WHERE rank <= 3""")
def q_rank_top_per_key(spark, sf):
    li = S.table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    return TS.rank_top_per_key(li, "l_suppkey", [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")], 3)


@query("sort_panel", S.with_ctes(["counts"], "SELECT * FROM counts ORDER BY date, borough"))
def q_sort_panel(spark, sf):
    from pansift.plans.q_aggregate import counts
    return K.sort_panel(counts(spark, sf), ["date", ENTITY])


@query("top_k_values", S.with_ctes(["fact_labeled"], """SELECT complaint_type, count(*) AS n FROM fact_labeled
  GROUP BY complaint_type ORDER BY n DESC, complaint_type LIMIT 8"""))
def q_top_k_values(spark, sf):
    from pansift.plans.q_aggregate import fact
    return K.top_k_values(A.standardize_label(fact(spark, sf), "complaint_type"), "complaint_type", 8)


@query("top_k_rows", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def q_top_k_rows(spark, sf):
    return K.top_k_rows(S.table(spark, sf, "orders"), "o_totalprice", 10, ["o_orderkey"])


@query("order_groups_by_median", S.with_ctes(["panel_raw"], """SELECT borough, quantile_cont(complaints_total, 0.5) AS median
  FROM panel_raw GROUP BY borough ORDER BY median DESC, borough"""), floats=["median"])
def q_order_groups_by_median(spark, sf):
    return K.order_groups_by_median(raw_panel(spark, sf), ENTITY, "complaints_total")
