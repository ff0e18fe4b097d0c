"""Registered queries: sources and sinks (blueprint 2.1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pansift.plans import standins as S
from pansift.plans.registry import query
from pansift.session import scratch_path
from pansift.sources import readers as RD
from pansift.sources import sinks as SK
from pansift.sources.html import extract_links_by_heading


@query("load_table", "SELECT * FROM nation")
def q_load_table(spark, sf):
    return RD.load_table(spark, f"{sf}/nation.parquet")


@query("read_csv", """SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey,
  c_acctbal, c_mktsegment FROM customer""")
def q_read_csv(spark, sf):
    c = S.table(spark, sf, "customer")
    path = scratch_path(spark, "customer_csv")
    # landed file with messy header names; the reader normalises them
    c.toDF(*[f" {x.upper()}\t" for x in c.columns]).write.option("header", True).csv(path)
    return RD.read_csv(spark, path)


@query("read_json_records", """SELECT event_id, ts, value, user_id AS meta_user_id, event_type AS meta_event_type FROM events""")
def q_read_json_records(spark, sf):
    e = S.table(spark, sf, "events")
    path = scratch_path(spark, "events_json")
    fmt = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    e.select("event_id", "ts", "value", F.struct("user_id", "event_type").alias("meta")) \
        .write.option("timestampNTZFormat", fmt).json(path)
    schema = "event_id long, ts timestamp_ntz, value double, meta struct<user_id: long, event_type: string>"
    return RD.read_json_records(spark, path, multiline=False, schema=schema, timestampNTZFormat=fmt)


def _blocks(spark, sf):
    """Hourly-style documents: events in blocks of 24 consecutive ids, each a
    JSON object of parallel arrays (a bounded group: at most 24 rows)."""
    e = S.table(spark, sf, "events")
    blk = F.floor(F.col("event_id") / 24).alias("block")
    g = e.groupBy(blk).agg(F.array_sort(F.collect_list(F.struct("event_id", "ts", "value"))).alias("r"))
    doc = F.to_json(F.struct(F.lit(40.7).alias("latitude"), F.lit("UTC").alias("timezone"),
                             F.struct(F.col("r.event_id").alias("id"), F.transform("r.ts", lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")).alias("time"),
                                      F.col("r.value").alias("value")).alias("hourly")))
    return g.select("block", doc.alias("doc"))


@query("read_json_columnar", """SELECT CAST(floor(event_id / 24) AS BIGINT) AS block, CAST(40.7 AS DOUBLE) AS latitude, 'UTC' AS timezone,
  event_id AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS time, value FROM events""")
def q_read_json_columnar(spark, sf):
    docs = _blocks(spark, sf)
    schema = "latitude double, timezone string, hourly struct<id: array<long>, time: array<string>, value: array<double>>"
    parsed = docs.select("block", F.from_json("doc", schema).alias("j")).select("block", "j.*")
    return RD.read_json_columnar(parsed, "hourly", keep=["block", "latitude", "timezone"])


@query("read_json_matrix", """SELECT CAST(floor(event_id / 24) AS BIGINT) AS block, CAST(event_id AS VARCHAR) AS event_id,
  event_type, CAST(value AS VARCHAR) AS value FROM events""")
def q_read_json_matrix(spark, sf):
    e = S.table(spark, sf, "events")
    blk = F.floor(F.col("event_id") / 24).alias("block")
    g = e.groupBy(blk).agg(F.array_sort(F.collect_list(F.struct("event_id", "event_type", "value"))).alias("r"))
    rows = F.transform("r", lambda s: F.array(s["event_id"].cast("string"), s["event_type"], s["value"].cast("string")))
    # documents of odd blocks have their columns the other way round
    rows = F.when(F.col("block") % 2 == 0, rows).otherwise(F.transform(rows, lambda r: F.reverse(r)))
    head = F.when(F.col("block") % 2 == 0, F.array(F.lit("EVENT_ID"), F.lit("event_type"), F.lit(" value"))) \
            .otherwise(F.array(F.lit("value"), F.lit("Event_Type"), F.lit("event_id ")))
    doc = F.to_json(F.concat(F.array(head), rows))
    return RD.read_json_matrix(g.select("block", doc.alias("doc")), "doc", keep=["block"])


@query("ingest_pages", """SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1996-07-01'
""")
def q_ingest_pages(spark, sf):
    return RD.ingest_pages(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice"],
                           "l_shipdate", "1996-01-01", "1996-06-30")


@query("extract_links_by_heading", """SELECT page_id, CAST(NULL AS VARCHAR) AS heading, CAST(NULL AS INTEGER) AS month,
  regexp_replace(regexp_replace(t, '[℠®™]', '', 'g'), '^\\s+|\\s+$', '', 'g') AS title, CAST(NULL AS DATE) AS date
  FROM (SELECT page_id, regexp_replace(unnest(regexp_extract_all(html, '<a [^>]*>([^<]*)</a>', 1)), '^\\s+|\\s+$', '', 'g') AS t FROM pages)
  WHERE length(t) > 5 AND NOT starts_with(t, 'http')""")
def q_extract_links_by_heading(spark, sf):
    return extract_links_by_heading(S.table(spark, sf, "pages"), heading_tag=None)


_MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July", "August"]


@query("extract_links_by_month", """SELECT page_id, heading, month, title, make_date(2024, month, 15) AS date FROM (
  SELECT page_id, ['January', 'February', 'March', 'April', 'May', 'June', 'July', 'August'][CAST(page_id % 8 AS INTEGER) + 1] || ' pages' AS heading,
  CAST(page_id % 8 + 1 AS INTEGER) AS month, regexp_replace(regexp_replace(t, '[℠®™]', '', 'g'), '^\\s+|\\s+$', '', 'g') AS title
  FROM (SELECT page_id, regexp_replace(unnest(regexp_extract_all(html, '<a [^>]*>([^<]*)</a>', 1)), '^\\s+|\\s+$', '', 'g') AS t FROM pages)
  WHERE length(t) > 5 AND NOT starts_with(t, 'http')) WHERE month <= 6""")
def q_extract_links_by_month(spark, sf):
    """Each page as a section under a month's heading; what stands outside the section does not count."""
    p = S.table(spark, sf, "pages")
    month = F.element_at(F.array(*[F.lit(m) for m in _MONTH_NAMES]), (F.col("page_id") % 8 + 1).cast("int"))
    html = F.concat(F.lit("<a>before every heading</a><section><h4>"), month, F.lit(" pages</h4><div>"), F.col("html"),
                    F.lit("</div></section><a>after the section</a>"))
    return extract_links_by_heading(p.select("page_id", html.alias("html")), heading_tag="h4")


@query("extract_links_under_titles", """SELECT CASE WHEN page_id % 7 = 0 THEN NULL ELSE page_id END AS page_id,
  'Title of ' || CAST(page_id AS VARCHAR) AS heading, CAST(NULL AS INTEGER) AS month,
  regexp_replace(regexp_replace(t, '[℠®™]', '', 'g'), '^\\s+|\\s+$', '', 'g') AS title, CAST(NULL AS DATE) AS date
  FROM (SELECT page_id, regexp_replace(unnest(regexp_extract_all(html, '<a [^>]*>([^<]*)</a>', 1)), '^\\s+|\\s+$', '', 'g') AS t FROM pages)
  WHERE length(t) > 5 AND NOT starts_with(t, 'http')""")
def q_extract_links_under_titles(spark, sf):
    """Each page as a section under a title of its own, every seventh page without an id."""
    html = F.concat(F.lit("<a>before every title</a><section><h1>Title of "), F.col("page_id").cast("string"), F.lit("</h1><div>"),
                    F.regexp_replace("html", "(?i)<(/?)h1\\b", "<$1h2"), F.lit("</div></section><a>after the section</a>"))
    p = S.table(spark, sf, "pages").select(F.when(F.col("page_id") % 7 != 0, F.col("page_id")).alias("page_id"), html.alias("html"))
    return extract_links_by_heading(p, heading_tag="h1", require_month=False)


def _api_events(spark, sf):
    e = S.table(spark, sf, "events")
    return e.select(F.concat(F.col("event_type"), F.lit(" #"), F.col("event_id").cast("string")).alias("event_name"),
                    F.when(F.col("event_id") % 17 == 0, F.lit("")).otherwise(
                        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")).alias("event_date"),
                    F.when(F.col("user_id") % 10 == 0, None).otherwise(F.col("event_type")).alias("event_borough"),
                    F.col("event_type"), F.col("user_id").cast("string").alias("event_location"))


@query("normalize_event_records", """SELECT event_type || ' #' || CAST(event_id AS VARCHAR) AS title, strftime(ts, '%Y-%m-%d') AS date,
  CASE WHEN user_id % 10 = 0 THEN 'UNKNOWN' ELSE event_type END AS borough, event_type AS type, 'events_api' AS source, 'api' AS method,
  CAST(user_id AS VARCHAR) AS location FROM events
  WHERE event_id % 17 <> 0 AND year(ts) = 2024 AND month(ts) <= 6""")
def q_normalize_event_records(spark, sf):
    return RD.normalize_event_records(_api_events(spark, sf), "event_date", 2024, 6, source="events_api")


@query("inline_table", """SELECT m.title, m.date, m.borough, m.type, count(e.event_id) AS n_events FROM (VALUES """
    + ", ".join(f"('{t}', DATE '{d}', '{b}', '{ty}')" for t, d, b, ty, _ in RD.CURATED_EVENTS)
    + """) m(title, date, borough, type) LEFT JOIN events e ON CAST(e.ts AS DATE) = m.date GROUP BY 1, 2, 3, 4""")
def q_inline_table(spark, sf):
    cur = RD.inline_table(spark)
    daily = S.table(spark, sf, "events").groupBy(F.to_date("ts").alias("date")).agg(F.count("event_id").alias("n"))
    return cur.join(F.broadcast(daily), "date", "left").select(
        "title", "date", "borough", "type", F.coalesce("n", F.lit(0)).alias("n_events"))


@query("write_csv", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
def q_write_csv(spark, sf):
    c = S.table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    base = scratch_path(spark, "listing_out")
    SK.write_csv(c, base, versioned=True)
    second = SK.write_csv(c, base, versioned=True)  # target exists -> _v2
    assert second.endswith("_v2")
    return spark.read.schema("c_custkey long, c_mktsegment string, c_acctbal double").option("header", True).csv(second)


@query("write_outputs", """SELECT 'orders_by_status' AS name, CAST(count(*) AS BIGINT) AS rows FROM orders
  UNION ALL SELECT 'customers_by_segment', count(*) FROM customer""")
def q_write_outputs(spark, sf):
    out = scratch_path(spark, "outputs")
    frames = {"orders_by_status": S.table(spark, sf, "orders"), "customers_by_segment": S.table(spark, sf, "customer")}
    paths = SK.write_outputs(frames, out, "parquet",
                             partition_by={"orders_by_status": ["o_orderstatus"], "customers_by_segment": ["c_mktsegment"]})
    parts = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows")
             for n, p in paths.items()]
    return parts[0].unionByName(parts[1])


@query("preview", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 20")
def q_preview(spark, sf):
    return SK.preview(S.table(spark, sf, "orders"), 20, 3, ["o_orderkey"])
