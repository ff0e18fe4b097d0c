"""Stand-ins for the reference inputs, derived from the driver tables.

Each stand-in has a Spark builder and an equivalent SQL CTE so the
registry can compare both engines.  Mapping (see blueprint 7.2):

* service requests -> lineitem x part x supplier x nation x region
  (key = order * 100 + line, created = ship date, borough = region, complaint
  type = brand, zip = part key)
* hourly weather -> orders (one reading per order timestamp)
* public events -> orders (type from priority, citywide ``ALL`` rows for
  status ``P``)
* census by ZIP -> part (zip = part key, income = retail price,
  population = size)
* listings -> customer (price text from account balance, room type from
  market segment)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pansift.operators.aggregate import Lookup

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Fixed values of the stand-in mapping.
ENTITY_DOMAIN = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
DEDUPE_ORDER = ["created_date", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
PARADE_PRIORITY = "1-URGENT"
HOLIDAY_PRIORITY = "2-HIGH"
CITYWIDE_STATUS = "P"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def supplier_entity(spark, sf_dir) -> DataFrame:
    """s_suppkey -> region name.  nation (25 rows) and region (5 rows) are
    fixed-size dimensions, so they are broadcast; supplier is left to AQE."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nr = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return s.join(F.broadcast(nr), s.s_nationkey == nr.n_nationkey).select("s_suppkey", "r_name")


def nation_entity(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")


def requests(spark, sf_dir, labels: bool = True) -> DataFrame:
    """Raw service-request stand-in (duplicates on unique_key included);
    without ``labels`` no complaint type, so ``part`` is not read.
    The fact meets ``supplier`` by that file's own size first, and the
    25-row map after it: a nested join would look larger than it is."""
    li = table(spark, sf_dir, "lineitem")
    li = li.select(
        # numeric order-line key (TPC-H line numbers are 1..7): cheaper to hash and shuffle than text
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("unique_key"),
        F.col("l_shipdate").alias("created_date"), "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    ne = nation_entity(spark, sf_dir)
    out = li.join(sup, li.l_suppkey == sup.s_suppkey).join(F.broadcast(ne), F.col("s_nationkey") == ne.n_nationkey)
    if not labels:
        return out.select("unique_key", "created_date", F.col("r_name").alias("borough"),
                          F.col("l_partkey").alias("incident_zip"), *DEDUPE_ORDER[1:])
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    out = out.join(part, li.l_partkey == part.p_partkey)
    return out.select("unique_key", "created_date", F.col("r_name").alias("borough"),
                      F.col("p_brand").alias("complaint_type"), F.col("l_partkey").alias("incident_zip"),
                      *DEDUPE_ORDER[1:])


def request_lines(spark, sf_dir) -> DataFrame:
    """The requests before their borough and complaint type are looked up."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("unique_key"),
        F.col("l_shipdate").alias("created_date"), F.col("l_partkey").alias("incident_zip"), *DEDUPE_ORDER[1:])


def request_lookups(spark, sf_dir) -> list[Lookup]:
    """Where a request's borough and complaint type come from: ``request_lines``
    joined with both tables are ``requests``."""
    sup = supplier_entity(spark, sf_dir).select("s_suppkey", F.col("r_name").alias("borough"))
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("complaint_type"))
    return [Lookup("l_suppkey", sup, "s_suppkey", "borough"), Lookup("l_partkey", part, "p_partkey", "complaint_type")]


def hourly_weather(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    tp = F.col("o_totalprice")
    return o.select(
        F.col("o_orderdate").alias("timestamp_local"),
        (tp / 10000.0 - 10.0).alias("temperature_2m"),
        F.when(F.col("o_orderpriority") == PARADE_PRIORITY, tp / 50000.0).otherwise(0.0).alias("precipitation"),
        F.when(F.col("o_orderpriority") == PARADE_PRIORITY, tp / 60000.0).otherwise(0.0).alias("rain"),
        F.when((F.col("o_orderpriority") == "5-LOW") & (tp < 100000.0), tp / 100000.0).otherwise(0.0).alias("snowfall"),
        ((F.col("o_custkey") % 37) * 0.5 + 2.0).alias("wind_speed_10m"),
        ((F.col("o_custkey") % 37) * 0.75 + tp / 100000.0).alias("wind_gusts_10m"),
        (F.col("o_custkey") % 101).cast("double").alias("cloud_cover"))


# Fixed values from the reference: weather columns and how each day is summed up.
WEATHER_SPEC = {
    "temperature_2m": [("temp_mean", "mean"), ("temp_max", "max"), ("temp_min", "min")],
    "precipitation": [("precipitation_sum", "sum")],
    "wind_speed_10m": [("wind_speed_mean", "mean")],
    "cloud_cover": [("cloud_cover_mean", "mean")],
    "rain": [("rain_sum", "sum")],
    "snowfall": [("snowfall_sum", "sum")],
    "wind_gusts_10m": [("wind_gust_mean", "mean")],
}


def public_events(spark, sf_dir) -> DataFrame:
    """Event records: title, date, borough (entity or ALL), type, source."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                               "o_orderpriority", "o_orderstatus")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    ne = nation_entity(spark, sf_dir)
    j = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(ne), F.col("c_nationkey") == ne.n_nationkey)
    return j.select(
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.to_date("o_orderdate").alias("date"),
        F.when(F.col("o_orderstatus") == CITYWIDE_STATUS, F.lit("ALL")).otherwise(F.col("r_name")).alias("borough"),
        F.when(F.col("o_orderpriority") == PARADE_PRIORITY, F.lit("parade"))
         .when(F.col("o_orderpriority") == HOLIDAY_PRIORITY, F.lit("holiday"))
         .otherwise(F.lit("permitted")).alias("type"),
        F.lit("orders").alias("source"))


def census(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_name").alias("area_name"),
                    F.col("p_size").cast("long").alias("total_population"),
                    F.col("p_retailprice").alias("median_household_income"),
                    F.col("p_partkey").alias("zip_int"))


def listings(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    ne = nation_entity(spark, sf_dir)
    j = c.join(F.broadcast(ne), c.c_nationkey == ne.n_nationkey)
    return j.select(F.col("c_custkey").alias("id"), F.col("r_name").alias("neighbourhood group"),
                    F.concat(F.lit("$"), F.col("c_acctbal").cast("string")).alias("price"),
                    F.col("c_nationkey").alias("number of reviews"),
                    F.col("c_mktsegment").alias("room_type"))


LISTING_ENTIRE_TOKEN = "hold"


# --------------------------------------------------------------------------
# SQL side (DuckDB dialect, also valid Spark SQL unless noted).
# --------------------------------------------------------------------------

def strip_upper(x: str) -> str:
    return f"upper(regexp_replace(CAST({x} AS VARCHAR), '^\\s+|\\s+$', '', 'g'))"


SQL_CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, sql: str, deps: list[str] | None = None) -> None:
    SQL_CTES[name] = (sql, deps or [])


cte("supplier_entity", """SELECT s.s_suppkey, r.r_name FROM supplier s
  JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""")
cte("nation_entity", """SELECT n.n_nationkey, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")
cte("requests", """SELECT l.l_orderkey * 100 + l.l_linenumber AS unique_key,
  l.l_shipdate AS created_date, se.r_name AS borough, p.p_brand AS complaint_type, l.l_partkey AS incident_zip,
  l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier_entity se ON l.l_suppkey = se.s_suppkey""",
    ["supplier_entity"])
cte("fact", f"""SELECT unique_key, created_date, CAST(created_date AS DATE) AS date,
  {strip_upper('borough')} AS borough, complaint_type, incident_zip FROM (
  SELECT *, row_number() OVER (PARTITION BY unique_key ORDER BY {', '.join(DEDUPE_ORDER)}) AS rn
  FROM requests) x WHERE rn = 1 AND created_date IS NOT NULL
  AND {strip_upper('borough')} IN ({', '.join(repr(e) for e in ENTITY_DOMAIN)})""", ["requests"])
cte("fact_labeled", f"""SELECT date, borough, unique_key,
  upper(regexp_replace(coalesce(CAST(complaint_type AS VARCHAR), 'UNKNOWN'), '^\\s+|\\s+$', '', 'g')) AS complaint_type
  FROM fact""", ["fact"])
cte("top_types", """SELECT complaint_type, count(*) AS n FROM fact_labeled GROUP BY complaint_type
  ORDER BY n DESC, complaint_type LIMIT 8""", ["fact_labeled"])
cte("counts", """SELECT date, borough, count(unique_key) AS complaints_total,
  count(DISTINCT unique_key) AS unique_complaints FROM fact GROUP BY date, borough""", ["fact"])
cte("hourly_weather", f"""SELECT o_orderdate AS timestamp_local,
  o_totalprice / 10000.0 - 10.0 AS temperature_2m,
  CASE WHEN o_orderpriority = '{PARADE_PRIORITY}' THEN o_totalprice / 50000.0 ELSE 0.0 END AS precipitation,
  CASE WHEN o_orderpriority = '{PARADE_PRIORITY}' THEN o_totalprice / 60000.0 ELSE 0.0 END AS rain,
  CASE WHEN o_orderpriority = '5-LOW' AND o_totalprice < 100000.0 THEN o_totalprice / 100000.0 ELSE 0.0 END AS snowfall,
  (o_custkey % 37) * 0.5 + 2.0 AS wind_speed_10m, (o_custkey % 37) * 0.75 + o_totalprice / 100000.0 AS wind_gusts_10m,
  CAST(o_custkey % 101 AS DOUBLE) AS cloud_cover FROM orders""")
cte("weather_daily", """SELECT CAST(timestamp_local AS DATE) AS date,
  avg(temperature_2m) AS temp_mean, max(temperature_2m) AS temp_max, min(temperature_2m) AS temp_min,
  coalesce(sum(precipitation), 0.0) AS precipitation_sum, avg(wind_speed_10m) AS wind_speed_mean,
  avg(cloud_cover) AS cloud_cover_mean, coalesce(sum(rain), 0.0) AS rain_sum,
  coalesce(sum(snowfall), 0.0) AS snowfall_sum, avg(wind_gusts_10m) AS wind_gust_mean
  FROM hourly_weather WHERE timestamp_local IS NOT NULL GROUP BY CAST(timestamp_local AS DATE)""", ["hourly_weather"])
cte("zip_map", f"""SELECT incident_zip AS zip_int, borough FROM (
  SELECT incident_zip, borough, row_number() OVER (PARTITION BY incident_zip ORDER BY n DESC, borough) AS rn
  FROM (SELECT incident_zip, {strip_upper('borough')} AS borough, count(*) AS n FROM requests
        WHERE incident_zip IS NOT NULL AND borough IS NOT NULL
          AND {strip_upper('borough')} IN ({', '.join(repr(e) for e in ENTITY_DOMAIN)})
        GROUP BY 1, 2) c) x WHERE rn = 1""", ["requests"])
cte("census", """SELECT p_name AS area_name, CAST(p_size AS BIGINT) AS total_population,
  p_retailprice AS median_household_income, p_partkey AS zip_int FROM part""")
cte("census_entity", """SELECT m.borough, quantile_cont(c.median_household_income, 0.5) AS census_income_borough_median,
  coalesce(sum(CAST(c.total_population AS DOUBLE)), 0.0) AS census_population_borough_sum
  FROM census c JOIN zip_map m ON c.zip_int = m.zip_int GROUP BY m.borough""", ["census", "zip_map"])
cte("listings", """SELECT c.c_custkey AS id, ne.r_name AS borough, c.c_acctbal AS price,
  CAST(c.c_nationkey AS DOUBLE) AS number_of_reviews, c.c_mktsegment AS room_type
  FROM customer c JOIN nation_entity ne ON c.c_nationkey = ne.n_nationkey""", ["nation_entity"])
cte("listing_entity", f"""SELECT {strip_upper('borough')} AS borough, count(id) AS airbnb_listing_count,
  avg(price) AS airbnb_price_mean, quantile_cont(price, 0.5) AS airbnb_price_median,
  avg(CAST(contains(lower(room_type), '{LISTING_ENTIRE_TOKEN}') AS INTEGER)) AS airbnb_rating_mean,
  coalesce(sum(number_of_reviews), 0.0) AS airbnb_total_reviews,
  avg(CAST(contains(lower(room_type), '{LISTING_ENTIRE_TOKEN}') AS INTEGER)) AS airbnb_entire_home_pct
  FROM listings WHERE price > 0 AND price < 10000 GROUP BY 1""", ["listings"])
cte("public_events", f"""SELECT 'order ' || CAST(o.o_orderkey AS VARCHAR) AS title, CAST(o.o_orderdate AS DATE) AS date,
  CASE WHEN o.o_orderstatus = '{CITYWIDE_STATUS}' THEN 'ALL' ELSE ne.r_name END AS borough,
  CASE WHEN o.o_orderpriority = '{PARADE_PRIORITY}' THEN 'parade' WHEN o.o_orderpriority = '{HOLIDAY_PRIORITY}' THEN 'holiday'
       ELSE 'permitted' END AS type, 'orders' AS source
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation_entity ne ON c.c_nationkey = ne.n_nationkey""",
    ["nation_entity"])
cte("events_expanded", f"""SELECT title, date, borough, type, source FROM public_events WHERE borough <> 'ALL'
  UNION ALL SELECT e.title, e.date, d.borough, e.type, e.source FROM public_events e
  CROSS JOIN (VALUES {', '.join(f"('{x}')" for x in ENTITY_DOMAIN)}) d(borough) WHERE e.borough = 'ALL'""",
    ["public_events"])
cte("events_daily", f"""SELECT date, {strip_upper('borough')} AS borough, CAST(count(title) AS INTEGER) AS event_count,
  max(CAST(type = 'parade' AS INTEGER)) AS event_has_parade, max(CAST(type = 'holiday' AS INTEGER)) AS event_has_holiday
  FROM events_expanded WHERE date IS NOT NULL GROUP BY 1, 2""", ["events_expanded"])


def with_ctes(names: list[str], body: str, extra: list[tuple[str, str]] | None = None, materialized: tuple = ()) -> str:
    """Render ``WITH`` for the named CTEs (plus their dependencies, in order),
    then ``extra`` (name, sql) CTEs local to one query, then the body.
    ``materialized``: extra CTEs that are computed once however often they are read."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in SQL_CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({SQL_CTES[n][0]})" for n in order]
    parts += [f"{n} AS {'MATERIALIZED ' if n in materialized else ''}({q})" for n, q in (extra or [])]
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body


# --------------------------------------------------------------------------
# Panel (stage 1) in SQL.  Top-K columns are rank-named.
# --------------------------------------------------------------------------

WEATHER_COLS = ["temp_mean", "temp_max", "temp_min", "precipitation_sum", "wind_speed_mean",
                "cloud_cover_mean", "rain_sum", "snowfall_sum", "wind_gust_mean"]
# Fixed values from the reference: structural columns of the panel.
STRUCT_COLS = ["census_income_borough_median", "census_population_borough_sum", "airbnb_listing_count",
               "airbnb_price_mean", "airbnb_price_median", "airbnb_rating_mean", "airbnb_total_reviews",
               "airbnb_entire_home_pct", "airbnb_per_1000_people_borough"]
TOPK_COLS = [f"top{i}_cnt" for i in range(1, 9)] + ["other_cnt"]
# Fixed values from the reference: lag and rolling columns of the panel.
LAG_COLS = ["temp_mean_lag1", "temp_mean_ma7", "precipitation_sum_lag1", "precipitation_sum_ma7",
            "complaints_total_ma7"]

cte("top_ranked", """SELECT complaint_type, row_number() OVER (ORDER BY n DESC, complaint_type) AS rk
  FROM top_types""", ["top_types"])
cte("topk_wide", "SELECT f.date, f.borough, " + ", ".join(
    [f"CAST(sum(CASE WHEN t.rk = {i} THEN 1 ELSE 0 END) AS BIGINT) AS top{i}_cnt" for i in range(1, 9)]
    + ["CAST(sum(CASE WHEN t.rk IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS other_cnt"])
    + """ FROM fact_labeled f LEFT JOIN top_ranked t ON f.complaint_type = t.complaint_type GROUP BY 1, 2""",
    ["fact_labeled", "top_ranked"])
cte("panel_base", """SELECT c.*, """ + ", ".join(f"k.{x}" for x in TOPK_COLS) + ", " + ", ".join(
    f"w.{x}" for x in WEATHER_COLS) + """, ce.census_income_borough_median, ce.census_population_borough_sum,
  l.airbnb_listing_count, l.airbnb_price_mean, l.airbnb_price_median, l.airbnb_rating_mean, l.airbnb_total_reviews,
  l.airbnb_entire_home_pct,
  CAST(l.airbnb_listing_count AS DOUBLE) / nullif(ce.census_population_borough_sum, 0) * 1000 AS airbnb_per_1000_people_borough
  FROM counts c LEFT JOIN topk_wide k ON c.date = k.date AND c.borough = k.borough
  LEFT JOIN weather_daily w ON c.date = w.date
  LEFT JOIN census_entity ce ON c.borough = ce.borough
  LEFT JOIN listing_entity l ON c.borough = l.borough""",
    ["counts", "topk_wide", "weather_daily", "census_entity", "listing_entity"])
cte("panel_feat", """SELECT *, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week,
  CAST(isodow(date) - 1 >= 5 AS INTEGER) AS is_weekend, CAST(month(date) AS INTEGER) AS month,
  CAST(weekofyear(date) AS INTEGER) AS week_of_year,
  lag(temp_mean, 1) OVER w AS temp_mean_lag1,
  CASE WHEN count(temp_mean) OVER w7 >= 3 THEN avg(temp_mean) OVER w7 END AS temp_mean_ma7,
  lag(precipitation_sum, 1) OVER w AS precipitation_sum_lag1,
  CASE WHEN count(precipitation_sum) OVER w7 >= 3 THEN avg(precipitation_sum) OVER w7 END AS precipitation_sum_ma7,
  CASE WHEN count(complaints_total) OVER w7 >= 3 THEN avg(complaints_total) OVER w7 END AS complaints_total_ma7,
  ln(1 + complaints_total) AS log_complaints_total
  FROM panel_base
  WINDOW w AS (PARTITION BY borough ORDER BY date),
         w7 AS (PARTITION BY borough ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""", ["panel_base"])
cte("panel_raw", """SELECT p.* REPLACE (coalesce(p.precipitation_sum, 0.0) AS precipitation_sum),
  CAST(coalesce(e.event_count, 0) AS INTEGER) AS event_count,
  CAST(coalesce(e.event_has_parade, 0) AS INTEGER) AS event_has_parade,
  CAST(coalesce(e.event_has_holiday, 0) AS INTEGER) AS event_has_holiday
  FROM panel_feat p LEFT JOIN events_daily e ON p.date = e.date AND p.borough = e.borough""",
    ["panel_feat", "events_daily"])
_WINSOR = ["precipitation_sum", "wind_speed_mean", "snowfall_sum"]
cte("q_bounds", "SELECT " + ", ".join(
    f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3" for c in _WINSOR)
    + " FROM panel_raw", ["panel_raw"])
cte("panel_wins", "SELECT p.* REPLACE (" + ", ".join(
    f"""CASE WHEN p.{c} IS NULL OR b.{c}_q1 IS NULL THEN p.{c}
        ELSE greatest(least(p.{c}, b.{c}_q3 + 1.5 * (b.{c}_q3 - b.{c}_q1)),
                      greatest(0.0, b.{c}_q1 - 1.5 * (b.{c}_q3 - b.{c}_q1))) END AS {c}""" for c in _WINSOR)
    + ") FROM panel_raw p CROSS JOIN q_bounds b", ["panel_raw", "q_bounds"])
cte("panel_ff", "SELECT * REPLACE (" + ", ".join(
    f"last_value({c} IGNORE NULLS) OVER (PARTITION BY borough ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
    for c in LAG_COLS) + ") FROM panel_wins", ["panel_wins"])
_REST = [c for c in WEATHER_COLS + STRUCT_COLS if c not in ("precipitation_sum", "snowfall_sum", "rain_sum")]
cte("panel_med", "SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in LAG_COLS + _REST)
    + " FROM panel_ff", ["panel_ff"])
cte("panel_clean", "SELECT p.* REPLACE (" + ", ".join(
    [f"coalesce(p.{c}, m.{c}) AS {c}" for c in LAG_COLS + _REST]
    + [f"coalesce(p.{c}, 0.0) AS {c}" for c in ("precipitation_sum", "snowfall_sum", "rain_sum")])
    + ") FROM panel_ff p CROSS JOIN panel_med m", ["panel_ff", "panel_med"])

PANEL_FLOATS = WEATHER_COLS + STRUCT_COLS + LAG_COLS + ["log_complaints_total"]


# --------------------------------------------------------------------------
# Generic workbench table: customer with deterministic gaps, padding and
# mixed case (the driver tables hold no NULLs).
# --------------------------------------------------------------------------

def workbench(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
        F.when(k % 7 == 0, None).otherwise(F.col("c_acctbal")).alias("balance"),
        (F.col("c_acctbal") / 100.0 + F.col("c_nationkey")).alias("score"),
        F.when(k % 11 == 0, None).when(k % 3 == 0, F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit("\t")))
         .otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(k % 13 == 0, None).otherwise((k % 4).cast("int")).alias("tier"))


cte("wb", """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS balance,
  c_acctbal / 100.0 + c_nationkey AS score,
  CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN '  ' || lower(c_mktsegment) || chr(9)
       ELSE c_mktsegment END AS segment,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(c_custkey % 4 AS INTEGER) END AS tier
  FROM customer""")

cte("citywide", """SELECT date, CAST(sum(complaints_total) AS BIGINT) AS citywide_complaints_total FROM panel_raw GROUP BY date""",
    ["panel_raw"])
cte("robust", """SELECT c.date, c.citywide_complaints_total,
  0.6745 * (c.citywide_complaints_total - m.med) / CASE WHEN d.mad = 0 THEN 1 ELSE d.mad END AS citywide_robust_z
  FROM citywide c CROSS JOIN (SELECT quantile_cont(citywide_complaints_total, 0.5) AS med FROM citywide) m
  CROSS JOIN (SELECT quantile_cont(abs(c2.citywide_complaints_total - m2.med), 0.5) AS mad FROM citywide c2
              CROSS JOIN (SELECT quantile_cont(citywide_complaints_total, 0.5) AS med FROM citywide) m2) d""", ["citywide"])
cte("quality_by_date", """SELECT *, CAST(abs(citywide_robust_z) > 3.5 AS INTEGER) AS is_outlier_citywide,
  CAST(citywide_robust_z < -3.5 AS INTEGER) AS is_outlier_low_citywide,
  CAST(citywide_robust_z > 3.5 AS INTEGER) AS is_outlier_high_citywide FROM robust""", ["robust"])

PANEL_SCHEMA = ([("date", "date"), ("borough", "string"), ("complaints_total", "bigint"), ("unique_complaints", "bigint")]
                + [(c, "bigint") for c in TOPK_COLS] + [(c, "double") for c in WEATHER_COLS]
                + [("census_income_borough_median", "double"), ("census_population_borough_sum", "double"),
                   ("airbnb_listing_count", "bigint"), ("airbnb_price_mean", "double"), ("airbnb_price_median", "double"),
                   ("airbnb_rating_mean", "double"), ("airbnb_total_reviews", "double"),
                   ("airbnb_entire_home_pct", "double"), ("airbnb_per_1000_people_borough", "double"),
                   ("day_of_week", "int"), ("is_weekend", "int"), ("month", "int"), ("week_of_year", "int")]
                + [(c, "double") for c in LAG_COLS] + [("log_complaints_total", "double"),
                   ("event_count", "int"), ("event_has_parade", "int"), ("event_has_holiday", "int")])
PANEL_NUMERIC = [c for c, t in PANEL_SCHEMA if t in ("bigint", "double", "int")]
