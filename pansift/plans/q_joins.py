"""Registered queries: joins (blueprint 2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pansift.plans import standins as S
from pansift.plans.registry import query
from pansift.operators import aggregate as A
from pansift.operators import joins as J
from pansift.operators.reshape import expand_all
from pansift.plans.pipelines import ENTITY, census_to_entity
from pansift.plans.q_aggregate import counts, fact
from pansift.plans.q_pipelines import raw_panel


@query("join_on_date", S.with_ctes(["counts", "weather_daily"], """SELECT c.*, w.temp_mean, w.precipitation_sum
  FROM counts c LEFT JOIN weather_daily w ON c.date = w.date"""), floats=["temp_mean", "precipitation_sum"])
def q_join_on_date(spark, sf):
    daily = A.hourly_to_daily(S.hourly_weather(spark, sf), "timestamp_local",
                              {"temperature_2m": [("temp_mean", "mean")], "precipitation": [("precipitation_sum", "sum")]})
    return J.join_on_date(counts(spark, sf), daily)


@query("join_on_entity", S.with_ctes(["counts", "census_entity"], """SELECT c.*, e.census_income_borough_median,
  e.census_population_borough_sum FROM counts c LEFT JOIN census_entity e ON c.borough = e.borough"""),
    floats=["census_income_borough_median", "census_population_borough_sum"])
def q_join_on_entity(spark, sf):
    ce = census_to_entity(S.requests(spark, sf), S.census(spark, sf), S.ENTITY_DOMAIN)
    return J.join_on_entity(counts(spark, sf), ce, ENTITY)


@query("join_on_entity_date", S.with_ctes(["counts", "events_daily"], """SELECT c.*,
  CAST(coalesce(e.event_count, 0) AS INTEGER) AS event_count, CAST(coalesce(e.event_has_parade, 0) AS INTEGER) AS event_has_parade,
  CAST(coalesce(e.event_has_holiday, 0) AS INTEGER) AS event_has_holiday
  FROM counts c LEFT JOIN events_daily e ON c.date = e.date AND c.borough = e.borough"""))
def q_join_on_entity_date(spark, sf):
    ev = expand_all(S.public_events(spark, sf), ENTITY, S.ENTITY_DOMAIN)
    ed = A.event_indicators(ev, "date", ENTITY, "type", "title", domain=S.ENTITY_DOMAIN)
    return J.join_on_entity_date(counts(spark, sf), ed, ["date", ENTITY],
                                 ["event_count", "event_has_parade", "event_has_holiday"])


@query("join_majority_map", S.with_ctes(["census", "zip_map"], """SELECT c.*, m.borough FROM census c
  JOIN zip_map m ON c.zip_int = m.zip_int"""))
def q_join_majority_map(spark, sf):
    m = A.majority_map(S.requests(spark, sf), "incident_zip", ENTITY, S.ENTITY_DOMAIN).withColumnRenamed("incident_zip", "zip_int")
    return J.join_majority_map(S.census(spark, sf), m, "zip_int")


@query("join_quality_flags", S.with_ctes(["panel_raw", "quality_by_date"], """SELECT p.date, p.borough, p.complaints_total,
  CAST(coalesce(q.is_outlier_citywide, 0) AS INTEGER) AS is_outlier_citywide,
  CAST(coalesce(q.is_outlier_low_citywide, 0) AS INTEGER) AS is_outlier_low_citywide,
  CAST(coalesce(q.is_outlier_high_citywide, 0) AS INTEGER) AS is_outlier_high_citywide
  FROM panel_raw p LEFT JOIN quality_by_date q ON p.date = q.date"""))
def q_join_quality_flags(spark, sf):
    from pansift.operators.profile import robust_z
    p = raw_panel(spark, sf)
    flags = robust_z(p, "date", "complaints_total")
    return J.join_quality_flags(p.select("date", ENTITY, "complaints_total"), flags, "date",
                                ["is_outlier_citywide", "is_outlier_low_citywide", "is_outlier_high_citywide"])


@query("membership_bucket", S.with_ctes(["fact_labeled", "top_types"], """SELECT f.unique_key,
  coalesce(t.complaint_type, 'OTHER') AS bucket FROM fact_labeled f LEFT JOIN top_types t ON f.complaint_type = t.complaint_type"""))
def q_membership_bucket(spark, sf):
    lab = A.standardize_label(fact(spark, sf), "complaint_type")
    top = A.top_labels(lab, "complaint_type", 8)
    return J.membership_bucket(lab, "complaint_type", top).select("unique_key", "bucket")


@query("align_concat", S.with_ctes(["hourly_weather"], """SELECT coalesce(a.date, b.date) AS date, a.temp_mean, b.rain_sum FROM
  (SELECT CAST(timestamp_local AS DATE) AS date, avg(temperature_2m) AS temp_mean FROM hourly_weather GROUP BY 1) a
  FULL JOIN (SELECT CAST(timestamp_local AS DATE) AS date, sum(rain) AS rain_sum FROM hourly_weather WHERE rain > 0 GROUP BY 1) b
  ON a.date = b.date"""), floats=["temp_mean", "rain_sum"])
def q_align_concat(spark, sf):
    h = S.hourly_weather(spark, sf)
    a = A.hourly_to_daily(h, "timestamp_local", {"temperature_2m": [("temp_mean", "mean")]})
    b = A.hourly_to_daily(h.where(F.col("rain") > 0), "timestamp_local", {"rain": [("rain_sum", "sum")]})
    return J.align_concat([a, b], "date")
