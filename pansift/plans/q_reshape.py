"""Registered queries: set operations and reshaping (blueprint 2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pansift.plans import standins as S
from pansift.plans.registry import query
from pansift.operators import reshape as R
from pansift.plans.pipelines import ENTITY
from pansift.plans.q_pipelines import raw_panel


def _second_source(spark, sf):
    """Event rows from the ``events`` table: a second, differently shaped source."""
    e = S.table(spark, sf, "events")
    return e.select(F.concat(F.col("event_type"), F.lit(" "), F.col("event_id").cast("string")).alias("title"),
                    F.to_date("ts").alias("date"), F.col("event_type").alias("type"),
                    F.col("user_id").alias("location"))


@query("union_sources", S.with_ctes(["public_events"], """SELECT title, date, borough, type, source, NULL AS location
  FROM public_events UNION ALL SELECT event_type || ' ' || CAST(event_id AS VARCHAR), CAST(ts AS DATE), NULL, event_type,
  'events', user_id FROM events"""))
def q_union_sources(spark, sf):
    return R.union_sources({"orders": S.public_events(spark, sf), "events": _second_source(spark, sf)})


@query("expand_all", S.with_ctes(["events_expanded"], "SELECT * FROM events_expanded"))
def q_expand_all(spark, sf):
    return R.expand_all(S.public_events(spark, sf), ENTITY, S.ENTITY_DOMAIN)


@query("distinct_rows", "SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem")
def q_distinct_rows(spark, sf):
    return R.distinct_rows(S.table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus"))


@query("stack_long", S.with_ctes(["panel_raw"], """SELECT * FROM (SELECT 'temp_mean' AS type, temp_mean AS value FROM panel_raw
  UNION ALL SELECT 'temp_mean_lag1', temp_mean_lag1 FROM panel_raw) WHERE value IS NOT NULL AND isfinite(value)"""),
    floats=["value"])
def q_stack_long(spark, sf):
    return R.stack_long(raw_panel(spark, sf), ["temp_mean", "temp_mean_lag1"])


@query("pivot_wide", """SELECT l_returnflag, CAST(count_if(l_linestatus = 'F') AS BIGINT) AS "F", CAST(count_if(l_linestatus = 'O') AS BIGINT) AS "O"
  FROM lineitem GROUP BY l_returnflag""")
def q_pivot_wide(spark, sf):
    return R.pivot_wide(S.table(spark, sf, "lineitem"), ["l_returnflag"], "l_linestatus", ["F", "O"])
