"""Registered queries: panel aggregations (blueprint 2.4, first part)."""

from __future__ import annotations

from pansift.plans import standins as S
from pansift.plans.registry import query
from pansift.operators import aggregate as A
from pansift.plans.pipelines import ENTITY


def fact(spark, sf):
    """Deduped, dated, standardised, domain-filtered request stand-in."""
    return A.clean_fact(S.requests(spark, sf), "created_date", ENTITY, "unique_key",
                        S.DEDUPE_ORDER, S.ENTITY_DOMAIN, keep=["complaint_type"])


def counts(spark, sf):
    return A.daily_entity_counts(S.requests(spark, sf), "created_date", ENTITY, "unique_key",
                                 S.DEDUPE_ORDER, S.ENTITY_DOMAIN)


@query("daily_entity_counts", S.with_ctes(["counts"], "SELECT * FROM counts"))
def q_daily_entity_counts(spark, sf):
    return A.daily_entity_counts(S.requests(spark, sf, labels=False), "created_date", ENTITY, "unique_key",
                                 S.DEDUPE_ORDER, S.ENTITY_DOMAIN)


@query("topk_pivot_counts", S.with_ctes(["fact_labeled"], "SELECT f.date, f.borough, "
    + ", ".join(f"count(*) FILTER (WHERE r.k = {i}) AS top{i}_cnt" for i in range(1, 9)) + """, count(*) FILTER (WHERE r.k IS NULL) AS other_cnt
FROM fact_labeled f LEFT JOIN r ON f.complaint_type = r.complaint_type GROUP BY 1, 2""", extra=[("r", """SELECT complaint_type, k FROM (
  SELECT complaint_type, row_number() OVER (ORDER BY count(*) DESC, complaint_type) AS k FROM fact_labeled GROUP BY 1) WHERE k <= 8""")]))
def q_topk_wide_counts(spark, sf):
    lab = A.standardize_label(fact(spark, sf), "complaint_type")
    return A.topk_pivot_counts(lab, ["date", ENTITY], "complaint_type", 8, naming="rank")


@query("topk_bucket_counts", S.with_ctes(["fact_labeled", "top_types"], """
SELECT f.date, f.borough, coalesce(t.complaint_type, 'OTHER') AS bucket, count(*) AS cnt
FROM fact_labeled f LEFT JOIN top_types t ON f.complaint_type = t.complaint_type
GROUP BY 1, 2, 3"""))
def q_topk_pivot_counts(spark, sf):
    lab = A.standardize_label(fact(spark, sf), "complaint_type")
    return A.topk_bucket_counts(lab, ["date", ENTITY], "complaint_type", 8)
from pansift.plans.q_pipelines import raw_panel


@query("hourly_to_daily", """SELECT CAST(ts AS DATE) AS date, avg(value) AS value_mean, max(value) AS value_max,
  min(value) AS value_min, coalesce(sum(value), 0.0) AS value_sum FROM events WHERE ts IS NOT NULL GROUP BY 1""",
    floats=["value_mean", "value_max", "value_min", "value_sum"])
def q_hourly_to_daily(spark, sf):
    spec = {"value": [("value_mean", "mean"), ("value_max", "max"), ("value_min", "min"), ("value_sum", "sum")],
            "absent_metric": [("never", "sum")]}
    return A.hourly_to_daily(S.table(spark, sf, "events"), "ts", spec)


@query("majority_map", S.with_ctes(["zip_map"], "SELECT zip_int AS incident_zip, borough FROM zip_map"))
def q_majority_map(spark, sf):
    return A.majority_map(S.requests(spark, sf, labels=False), "incident_zip", ENTITY, S.ENTITY_DOMAIN)


@query("entity_attributes", S.with_ctes(["census_entity"], "SELECT * FROM census_entity"),
    floats=["census_income_borough_median", "census_population_borough_sum"])
def q_entity_attributes(spark, sf):
    from pansift.plans.pipelines import census_to_entity
    return census_to_entity(S.requests(spark, sf), S.census(spark, sf), S.ENTITY_DOMAIN)


@query("listing_metrics", S.with_ctes(["listing_entity"], "SELECT * FROM listing_entity"),
    floats=["airbnb_price_mean", "airbnb_price_median", "airbnb_rating_mean", "airbnb_total_reviews",
            "airbnb_entire_home_pct"])
def q_listing_metrics(spark, sf):
    return A.listing_metrics(S.listings(spark, sf), ENTITY, S.ENTITY_DOMAIN, S.LISTING_ENTIRE_TOKEN)


@query("event_indicators", S.with_ctes(["events_daily"], "SELECT * FROM events_daily"))
def q_event_indicators(spark, sf):
    from pansift.operators.reshape import expand_all
    ev = expand_all(S.public_events(spark, sf), ENTITY, S.ENTITY_DOMAIN)
    return A.event_indicators(ev, "date", ENTITY, "type", "title", domain=S.ENTITY_DOMAIN)


@query("citywide_daily", S.with_ctes(["panel_raw"], """SELECT date, CAST(sum(complaints_total) AS BIGINT) AS complaints_total_city,
  avg(temp_mean) AS temp_mean, coalesce(sum(precipitation_sum), 0) AS precipitation_sum, avg(wind_speed_mean) AS wind_speed_mean,
  max(event_count) AS event_day, max(is_weekend) AS is_weekend FROM panel_raw GROUP BY date"""),
    floats=["temp_mean", "precipitation_sum", "wind_speed_mean"])
def q_citywide_daily(spark, sf):
    return A.citywide_daily(raw_panel(spark, sf))


@query("group_summary", S.with_ctes(["panel_raw"], """SELECT borough, count(complaints_total) AS count,
  avg(complaints_total) AS mean, quantile_cont(complaints_total, 0.5) AS median, CAST(min(complaints_total) AS DOUBLE) AS min,
  CAST(max(complaints_total) AS DOUBLE) AS max, CAST(sum(complaints_total) AS DOUBLE) AS sum FROM panel_raw GROUP BY borough"""),
    floats=["mean", "median", "min", "max", "sum"])
def q_group_summary(spark, sf):
    return A.group_summary(raw_panel(spark, sf), ENTITY, "complaints_total")


@query("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def q_value_counts(spark, sf):
    return A.value_counts(S.table(spark, sf, "events"), "event_type")


@query("group_mean", S.with_ctes(["panel_raw"], """SELECT day_of_week, avg(complaints_total) AS mean FROM panel_raw
  GROUP BY day_of_week"""), floats=["mean"])
def q_group_mean(spark, sf):
    return A.group_mean(raw_panel(spark, sf), "day_of_week", "complaints_total")


@query("pivot_mean", S.with_ctes(["panel_raw"], """SELECT borough, avg(CASE WHEN is_weekend = 0 THEN complaints_total END) AS "0",
  avg(CASE WHEN is_weekend = 1 THEN complaints_total END) AS "1" FROM panel_raw GROUP BY borough"""), floats=["0", "1"])
def q_pivot_mean(spark, sf):
    return A.pivot_mean(raw_panel(spark, sf), ENTITY, "is_weekend", "complaints_total", [0, 1])


@query("pivot_effect", S.with_ctes(["panel_raw"], """SELECT borough, avg(CASE WHEN event_has_parade = 0 THEN complaints_total END) AS mean_0,
  avg(CASE WHEN event_has_parade = 1 THEN complaints_total END) AS mean_1,
  avg(CASE WHEN event_has_parade = 1 THEN complaints_total END) - avg(CASE WHEN event_has_parade = 0 THEN complaints_total END) AS effect
  FROM panel_raw GROUP BY borough"""), floats=["mean_0", "mean_1", "effect"])
def q_pivot_effect(spark, sf):
    return A.pivot_effect(raw_panel(spark, sf), ENTITY, "event_has_parade", "complaints_total")


@query("composition_shares", S.with_ctes(["panel_raw"], " UNION ALL ".join(
    f"SELECT borough, '{c}' AS bucket, avg(CAST({c} AS DOUBLE) / nullif(complaints_total, 0)) AS mean_share FROM panel_raw GROUP BY borough"
    for c in S.TOPK_COLS)), floats=["mean_share"])
def q_composition_shares(spark, sf):
    return A.composition_shares(raw_panel(spark, sf), S.TOPK_COLS, "complaints_total", by=ENTITY)


@query("composition_shares_overall", S.with_ctes(["panel_raw"], " UNION ALL ".join(
    f"SELECT '{c}' AS bucket, avg(CAST({c} AS DOUBLE) / nullif(complaints_total, 0)) AS mean_share FROM panel_raw"
    for c in S.TOPK_COLS)), floats=["mean_share"])
def q_composition_shares_overall(spark, sf):
    return A.composition_shares(raw_panel(spark, sf), S.TOPK_COLS, "complaints_total")
