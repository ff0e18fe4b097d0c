"""Registered queries: projections, filters and column hygiene (blueprint 2.2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pansift.plans import standins as S
from pansift.plans.registry import query
from pansift.operators import columns as C
from pansift.plans.q_pipelines import raw_panel

SU = S.strip_upper


def _wb(spark, sf):
    return S.workbench(spark, sf)


@query("normalize_columns", "SELECT r_regionkey AS r_regionkey, r_name AS r_name FROM region")
def q_normalize_columns(spark, sf):
    r = S.table(spark, sf, "region").toDF(" R_RegionKey\t", "R_NAME ")
    return C.normalize_columns(r)


@query("select_cols", "SELECT l_orderkey, l_shipdate, l_extendedprice FROM lineitem")
def q_select_cols(spark, sf):
    return C.select_cols(S.table(spark, sf, "lineitem"), ["l_orderkey", "l_shipdate", "l_extendedprice"])


@query("drop_cols", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def q_drop_cols(spark, sf):
    return C.drop_cols(S.table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority", "no_such_col"])


@query("rename_first_match", "SELECT c_custkey AS id, c_mktsegment AS borough FROM customer")
def q_rename_first_match(spark, sf):
    d = S.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"),
                                               F.col("c_mktsegment").alias("neighbourhood_group"))
    return C.rename_first_match(d, ["neighbourhood group", "neighbourhood_group", "neighborhood_group"], "borough")


@query("safe_column_names", """SELECT p_brand AS label,
  'topk_' || replace(replace(replace(replace(p_brand, ' ', '_'), '/', '_'), '-', '_'), '&', 'AND') || '_cnt' AS column_name,
  count(*) AS n FROM part GROUP BY p_brand""")
def q_safe_column_names(spark, sf):
    # the mapping covers every label that the data holds; a label becomes a column name, so labels reach the driver
    labels = S.table(spark, sf, "part").groupBy(F.col("p_brand").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    names = C.safe_column_names([r["label"] for r in labels.select("label").collect()])
    return labels.join(spark.createDataFrame(list(names.items()), "label string, column_name string"), "label") \
                 .select("label", "column_name", "n")


@query("standardize_text", S.with_ctes(["wb"], f"""SELECT id, {SU('segment')} AS segment,
  lower(regexp_replace(name, '^\\s+|\\s+$', '', 'g')) AS name FROM wb"""))
def q_standardize_text(spark, sf):
    d = C.standardize_text(_wb(spark, sf).select("id", "segment", "name"), ["segment"], "upper")
    return C.standardize_text(d, ["name"], "lower")


@query("fill_literal", S.with_ctes(["wb"], "SELECT id, coalesce(segment, 'UNKNOWN') AS segment, coalesce(tier, 0) AS tier FROM wb"))
def q_fill_literal(spark, sf):
    d = _wb(spark, sf).select("id", "segment", "tier")
    return C.fill_literal(C.fill_literal(d, ["segment"], "UNKNOWN"), ["tier"], 0)


@query("to_timestamp_coerce", """SELECT event_id,
  CASE WHEN event_id % 9 = 0 THEN NULL ELSE date_trunc('second', ts) END AS created FROM events""")
def q_to_timestamp_coerce(spark, sf):
    e = S.table(spark, sf, "events")
    raw = F.when(F.col("event_id") % 9 == 0, F.lit("not a date")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return C.to_timestamp_coerce(e.select("event_id", raw.alias("created")), "created").select(
        "event_id", F.col("created").cast("timestamp_ntz").alias("created"))


@query("truncate_to_date", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date,
  strftime(o_orderdate, '%Y-%m-%d') AS date_text FROM orders""")
def q_truncate_to_date(spark, sf):
    o = S.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    o = C.truncate_to_date(o, "o_orderdate", "date")
    return C.truncate_to_date(o, "o_orderdate", "date_text", as_text=True).drop("o_orderdate")


@query("to_number_coerce", """SELECT event_id,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k
  FROM events""")
def q_to_number_coerce(spark, sf):
    e = S.table(spark, sf, "events")
    raw = F.when(F.col("event_id") % 5 == 0, F.lit("n/a")).otherwise(F.get_json_object("props", "$.k"))
    return C.to_number_coerce(e.select("event_id", raw.alias("k")), "k")


@query("clean_currency", """SELECT c_custkey AS id, c_acctbal AS price FROM customer""")
def q_clean_currency(spark, sf):
    c = S.table(spark, sf, "customer")
    txt = F.concat(F.lit("$"), F.format_number(F.col("c_acctbal"), 2))
    return C.clean_currency(c.select(F.col("c_custkey").alias("id"), txt.alias("price")), ["price"])


@query("sentinel_to_null", """SELECT p_partkey, CASE WHEN p_size = 50 THEN NULL ELSE p_size END AS p_size,
  p_retailprice FROM part""")
def q_sentinel_to_null(spark, sf):
    p = S.table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    return C.sentinel_to_null(p, 50, ["p_size", "p_retailprice"])


@query("inf_to_null", """SELECT o_orderkey,
  CASE WHEN o_totalprice < 2000 THEN NULL ELSE o_totalprice / (o_totalprice - 1999.5) END AS ratio
  FROM orders""", floats=["ratio"])
def q_inf_to_null(spark, sf):
    o = S.table(spark, sf, "orders")
    # x / 0.0 in non-ANSI double arithmetic: +inf where the divisor is zero
    den = F.when(F.col("o_totalprice") < 2000, F.lit(0.0)).otherwise(F.col("o_totalprice") - 1999.5)
    r = F.when(den == 0, F.lit(float("inf"))).otherwise(F.col("o_totalprice") / den)
    return C.inf_to_null(o.select("o_orderkey", r.alias("ratio")), ["ratio"])


@query("filter_domain", S.with_ctes(["requests"], """SELECT unique_key, borough FROM requests
  WHERE borough IN ('ASIA', 'EUROPE')"""))
def q_filter_domain(spark, sf):
    return C.filter_domain(S.requests(spark, sf).select("unique_key", "borough"), "borough", ["ASIA", "EUROPE"])


@query("filter_multi_range", """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
  WHERE l_partkey BETWEEN 10 AND 14 OR l_partkey BETWEEN 100 AND 104 OR l_partkey BETWEEN 1000 AND 1040
     OR l_partkey BETWEEN 1100 AND 1199 OR l_partkey BETWEEN 1500 AND 1500 OR l_partkey BETWEEN 1900 AND 1999""")
def q_filter_multi_range(spark, sf):
    li = S.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return C.filter_multi_range(li, "l_partkey", [(10, 14), (100, 104), (1000, 1040), (1100, 1199),
                                                  (1500, 1500), (1900, 1999)])


@query("filter_bounds", """SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0 AND c_acctbal < 5000""")
def q_filter_bounds(spark, sf):
    return C.filter_bounds(S.table(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", 0, 5000)


@query("filter_range", S.with_ctes(["wb"], "SELECT * FROM wb WHERE balance BETWEEN -100 AND 2500"))
def q_filter_range(spark, sf):
    return C.filter_range(_wb(spark, sf), "balance", -100, 2500)


@query("filter_in_set", S.with_ctes(["wb"], "SELECT * FROM wb WHERE CAST(tier AS VARCHAR) IN ('1', '3')"))
def q_filter_in_set(spark, sf):
    return C.filter_in_set(_wb(spark, sf), "tier", [1, 3])


@query("drop_missing", S.with_ctes(["wb"], "SELECT * FROM wb WHERE balance IS NOT NULL AND segment IS NOT NULL"))
def q_drop_missing(spark, sf):
    return C.drop_missing(_wb(spark, sf), ["balance", "segment"])


@query("as_group", "SELECT o_orderkey, CAST(o_custkey % 5 AS VARCHAR) AS grp FROM orders")
def q_as_group(spark, sf):
    o = S.table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 5).alias("grp"))
    return C.as_group(o, "grp")


@query("filter_flag", S.with_ctes(["panel_raw"], "SELECT date, borough, complaints_total FROM panel_raw WHERE event_has_parade = 1"))
def q_filter_flag(spark, sf):
    return C.filter_flag(raw_panel(spark, sf), "event_has_parade", 1).select("date", "borough", "complaints_total")


@query("numeric_columns", S.with_ctes(["wb"], """SELECT * FROM (VALUES
  ('id', (SELECT count(id) FROM wb)), ('nation', (SELECT count(nation) FROM wb)),
  ('balance', (SELECT count(balance) FROM wb)), ('score', (SELECT count(score) FROM wb)),
  ('tier', (SELECT count(tier) FROM wb))) t(column_name, non_missing)"""))
def q_numeric_columns(spark, sf):
    d = _wb(spark, sf)
    cols = C.numeric_columns(d)
    return d.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v")) for c in cols])).alias("s")) \
        .groupBy("s.column_name").agg(F.count("s.v").alias("non_missing"))


@query("categorical_columns", S.with_ctes(["wb"], """SELECT * FROM (VALUES
  ('name', (SELECT count(name) FROM wb)), ('segment', (SELECT count(segment) FROM wb))) t(column_name, non_missing)"""))
def q_categorical_columns(spark, sf):
    d = _wb(spark, sf)
    cols = C.categorical_columns(d)
    return d.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v")) for c in cols])).alias("s")) \
        .groupBy("s.column_name").agg(F.count("s.v").alias("non_missing"))


@query("is_discrete_numeric", S.with_ctes(["wb"], """SELECT "column", CASE WHEN n <= 8 THEN n END AS n_distinct,
  CAST(n <= 8 AS INTEGER) AS is_discrete FROM (VALUES
  ('id', (SELECT count(DISTINCT id) FROM wb)), ('nation', (SELECT count(DISTINCT nation) FROM wb)),
  ('balance', (SELECT count(DISTINCT balance) FROM wb)), ('score', (SELECT count(DISTINCT score) FROM wb)),
  ('tier', (SELECT count(DISTINCT tier) FROM wb))) t("column", n)"""))
def q_is_discrete_numeric(spark, sf):
    return C.is_discrete_numeric(_wb(spark, sf))


@query("column_groups", S.with_ctes(["panel_raw"], """SELECT 'topk' AS grp, 9 AS n_columns,
  CAST(sum(top1_cnt + top2_cnt + top3_cnt + top4_cnt + top5_cnt + top6_cnt + top7_cnt + top8_cnt + other_cnt) AS BIGINT) AS total
  FROM panel_raw
  UNION ALL SELECT 'lag', 5, CAST(count(temp_mean_lag1) + count(temp_mean_ma7) + count(precipitation_sum_lag1)
  + count(precipitation_sum_ma7) + count(complaints_total_ma7) AS BIGINT) FROM panel_raw"""))
def q_column_groups(spark, sf):
    p = raw_panel(spark, sf)
    g = C.column_groups(p, {"topk": ("prefix_suffix", "top", "_cnt"), "lag": ("suffix", "_lag1", "_ma7")})
    g["topk"] = g["topk"] + [c for c in p.columns if c == "other_cnt"]
    topk_sum = sum((F.col(c) for c in g["topk"]), F.lit(0))
    lag_cnt = sum((F.count(c) for c in g["lag"]), F.lit(0))
    a = p.agg(F.sum(topk_sum).cast("long").alias("total")).select(F.lit("topk").alias("grp"), F.lit(len(g["topk"])).alias("n_columns"), "total")
    b = p.agg(lag_cnt.cast("long").alias("total")).select(F.lit("lag").alias("grp"), F.lit(len(g["lag"])).alias("n_columns"), "total")
    return a.unionByName(b)


@query("drop_constant_columns", """SELECT o_orderkey, o_totalprice FROM orders""")
def q_drop_constant_columns(spark, sf):
    o = S.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.lit(1).alias("one"),
                                             F.lit(None).cast("double").alias("empty"))
    return C.drop_constant_columns(o)[0]


@query("variance_threshold", S.with_ctes(["panel_raw"], "SELECT date, borough, complaints_total, temp_mean FROM panel_raw"), floats=["temp_mean"])
def q_variance_threshold(spark, sf):
    p = raw_panel(spark, sf).select("date", "borough", "complaints_total", "temp_mean",
                                    F.lit(3.0).alias("flat"))
    return C.variance_threshold(p, ["complaints_total", "temp_mean", "flat"])[0]


@query("filter_choices", S.with_ctes(["wb"], """SELECT
  CAST(coalesce(floor(CASE WHEN min(balance) = max(balance) THEN min(balance) - 1 ELSE min(balance) END), 0) AS DOUBLE) AS lo,
  CAST(coalesce(ceil(CASE WHEN min(balance) = max(balance) THEN max(balance) + 1 ELSE max(balance) END), 1) AS DOUBLE) AS hi
  FROM wb"""))
def q_filter_choices(spark, sf):
    return C.filter_choices(_wb(spark, sf), "balance")


@query("filter_choices_text", "SELECT DISTINCT c_mktsegment AS value FROM customer")
def q_filter_choices_text(spark, sf):
    return C.filter_choices(S.table(spark, sf, "customer"), "c_mktsegment")


@query("add_constants", "SELECT r_regionkey, r_name, 'orders' AS source, 2024 AS year FROM region")
def q_add_constants(spark, sf):
    return C.add_constants(S.table(spark, sf, "region"), {"source": "orders", "year": 2024})
