"""Registered queries: profiling and data-quality summaries (blueprint 2.4)."""

from __future__ import annotations

from pansift.plans import standins as S
from pansift.plans.registry import query
from pansift.operators import profile as P
from pansift.plans.q_pipelines import raw_panel

NUM = S.PANEL_NUMERIC
DESCRIBE_COLS = ["complaints_total", "log_complaints_total", "temp_mean", "temp_max", "temp_min",
                 "precipitation_sum", "rain_sum", "snowfall_sum", "wind_speed_mean", "wind_gust_mean", "cloud_cover_mean"]


def _stats_sql(cols, body):
    return " UNION ALL ".join(body.format(c=c) for c in cols)


@query("describe_numeric", S.with_ctes(["panel_raw"], _stats_sql(DESCRIBE_COLS, """SELECT '{c}' AS "column",
  count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min,
  quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75,
  CAST(max({c}) AS DOUBLE) AS max FROM panel_raw""")), floats=["mean", "std", "min", "p25", "p50", "p75", "max"])
def q_describe_numeric(spark, sf):
    return P.describe_numeric(raw_panel(spark, sf), DESCRIBE_COLS)


@query("summary_mixed", S.with_ctes(["wb"], _stats_sql(["id", "nation", "balance", "score", "tier"], """SELECT '{c}' AS "column",
  'numeric' AS kind, CAST(min({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
  avg({c}) AS mean, quantile_cont({c}, 0.75) AS q3, CAST(max({c}) AS DOUBLE) AS max, CAST(count_if({c} IS NULL) AS BIGINT) AS n_missing,
  count(*) AS length FROM wb""") + " UNION ALL " + _stats_sql(["name", "segment"], """SELECT '{c}', 'text', NULL, NULL, NULL,
  NULL, NULL, NULL, CAST(count_if({c} IS NULL) AS BIGINT), count(*) FROM wb""")),
    floats=["min", "q1", "median", "mean", "q3", "max"])
def q_summary_mixed(spark, sf):
    return P.summary_mixed(S.workbench(spark, sf))


@query("level_counts", S.with_ctes(["wb"], """SELECT 'segment' AS "column", CAST(segment AS VARCHAR) AS level, count(*) AS n FROM wb WHERE segment IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'name', name, count(*) FROM wb WHERE name IS NOT NULL GROUP BY 2"""))
def q_level_counts(spark, sf):
    return P.level_counts(S.workbench(spark, sf), ["segment", "name"])


def _dd_sql():
    parts = []
    for c, t in S.PANEL_SCHEMA:
        head = f"""SELECT '{c}' AS "column", '{t}' AS dtype, CAST(count_if({c} IS NULL) AS BIGINT) AS missing_n,
  count_if({c} IS NULL) * 100.0 / count(*) AS missing_pct, count(DISTINCT {c}) AS unique_n"""
        if c in NUM:
            parts.append(head + f""", avg({c}) AS mean, stddev_pop({c}) AS std, CAST(min({c}) AS DOUBLE) AS min,
  quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS p75,
  CAST(max({c}) AS DOUBLE) AS max, CAST(NULL AS VARCHAR) AS examples FROM panel_raw""")
        else:
            parts.append(head + f""", CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std,
  CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS p25, CAST(NULL AS DOUBLE) AS median,
  CAST(NULL AS DOUBLE) AS p75, CAST(NULL AS DOUBLE) AS max, (SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM panel_raw
   WHERE {c} IS NOT NULL ORDER BY v LIMIT 5)) AS examples FROM panel_raw""")
    return " UNION ALL ".join(parts)


@query("data_dictionary", S.with_ctes(["panel_raw"], _dd_sql()),
    floats=["missing_pct", "mean", "std", "min", "p25", "median", "p75", "max"])
def q_data_dictionary(spark, sf):
    return P.data_dictionary(raw_panel(spark, sf))


@query("missing_table", S.with_ctes(["panel_raw"], "SELECT * FROM (" + _stats_sql([c for c, _ in S.PANEL_SCHEMA],
    """SELECT '{c}' AS "column", CAST(count_if({c} IS NULL) AS BIGINT) AS missing_n, count_if({c} IS NULL) * 100.0 / count(*) AS missing_pct
  FROM panel_raw""") + ") WHERE missing_n > 0"), floats=["missing_pct"])
def q_missing_table(spark, sf):
    return P.missing_table(raw_panel(spark, sf))


@query("missing_mask", S.with_ctes(["panel_raw"], "SELECT date, borough, " + ", ".join(
    f"CAST({c} IS NULL AS INTEGER) AS {c}" for c, _ in S.PANEL_SCHEMA[2:]) + " FROM panel_raw"))
def q_missing_mask(spark, sf):
    return P.missing_mask(raw_panel(spark, sf), ["date", "borough"])


@query("row_count", "SELECT count(*) AS rows FROM lineitem")
def q_row_count(spark, sf):
    return P.row_count(S.table(spark, sf, "lineitem"))


@query("duplicate_count", """SELECT CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS duplicates FROM lineitem""")
def q_duplicate_count(spark, sf):
    return P.duplicate_count(S.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("duplicate_rows", """SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM
  (SELECT l_orderkey, l_returnflag, l_linestatus FROM lineitem))) AS BIGINT) AS duplicates FROM lineitem""")
def q_duplicate_rows(spark, sf):
    return P.duplicate_count(S.table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus"))


@query("panel_balance", S.with_ctes(["panel_raw"], """SELECT count(DISTINCT date) AS n_days, count(DISTINCT borough) AS n_entities,
  count(*) AS n_rows, CAST(count(*) - count(DISTINCT (date, borough)) AS BIGINT) AS duplicate_keys, min(date) AS date_min,
  max(date) AS date_max, count(DISTINCT date) * count(DISTINCT borough) AS expected_rows,
  CAST(count(DISTINCT date) * count(DISTINCT borough) = count(*) AS INTEGER) AS balanced FROM panel_raw"""))
def q_panel_balance(spark, sf):
    return P.panel_balance(raw_panel(spark, sf))


@query("missing_panel_cells", S.with_ctes(["panel_raw"], """SELECT d.date, e.borough FROM (SELECT DISTINCT date FROM panel_raw) d
  CROSS JOIN (SELECT DISTINCT borough FROM panel_raw) e
  WHERE NOT EXISTS (SELECT 1 FROM panel_raw p WHERE p.date = d.date AND p.borough = e.borough)"""))
def q_missing_panel_cells(spark, sf):
    return P.missing_panel_cells(raw_panel(spark, sf))


@query("consistency_rate", S.with_ctes(["panel_raw"], "SELECT avg(CAST(" + " + ".join(S.TOPK_COLS)
    + " = complaints_total AS DOUBLE)) * 100.0 AS pct FROM panel_raw"), floats=["pct"])
def q_consistency_rate(spark, sf):
    return P.consistency_rate(raw_panel(spark, sf), S.TOPK_COLS, "complaints_total")


@query("domain_values", "SELECT DISTINCT o_orderpriority FROM orders")
def q_domain_values(spark, sf):
    return P.domain_values(S.table(spark, sf, "orders"), "o_orderpriority")


@query("column_mode", """SELECT p_size, n FROM (SELECT p_size, count(*) AS n FROM part GROUP BY p_size)
  ORDER BY n DESC, p_size LIMIT 1""")
def q_column_mode(spark, sf):
    return P.column_mode(S.table(spark, sf, "part"), "p_size")


IQR_COLS = ["complaints_total", "temp_mean", "precipitation_sum", "wind_speed_mean", "cloud_cover_mean", "snowfall_sum"]


@query("iqr_bounds", S.with_ctes(["panel_raw"], _stats_sql(IQR_COLS, """SELECT '{c}' AS "column", q1, q3, q3 - q1 AS iqr,
  q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper,
  (SELECT count(*) FROM panel_raw WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers
  FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM panel_raw)""")),
    floats=["q1", "q3", "iqr", "lower", "upper"])
def q_iqr_bounds(spark, sf):
    return P.iqr_bounds(raw_panel(spark, sf), IQR_COLS)


@query("robust_z", S.with_ctes(["quality_by_date"], "SELECT * FROM quality_by_date"), floats=["citywide_robust_z"])
def q_robust_z(spark, sf):
    return P.robust_z(raw_panel(spark, sf), "date", "complaints_total")
