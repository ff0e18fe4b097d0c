"""Registered queries: cleaning, imputation, scaling and encoding (blueprint 2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pansift.plans import standins as S
from pansift.plans.registry import query
from pansift.operators import clean as CL
from pansift.plans.pipelines import ENTITY, quality_report_and_fix
from pansift.plans.q_pipelines import raw_panel


def _wb(spark, sf):
    return S.workbench(spark, sf)


def _med(c, t="wb"):
    return f"(SELECT quantile_cont({c}, 0.5) FROM {t})"


@query("impute_mean", S.with_ctes(["wb"], """SELECT id, coalesce(balance, (SELECT avg(balance) FROM wb)) AS balance,
  coalesce(CAST(tier AS DOUBLE), (SELECT avg(tier) FROM wb)) AS tier FROM wb"""), floats=["balance", "tier"])
def q_impute_mean(spark, sf):
    return CL.impute_mean(_wb(spark, sf).select("id", "balance", "tier"), ["balance", "tier"])


@query("impute_median", S.with_ctes(["wb"], f"""SELECT id, coalesce(balance, {_med('balance')}) AS balance,
  coalesce(CAST(tier AS DOUBLE), {_med('tier')}) AS tier FROM wb"""), floats=["balance", "tier"])
def q_impute_median(spark, sf):
    return CL.impute_median(_wb(spark, sf).select("id", "balance", "tier"), ["balance", "tier"])


@query("impute_mode", S.with_ctes(["wb"], """SELECT id, coalesce(segment, (SELECT segment FROM wb WHERE segment IS NOT NULL
  GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 1)) AS segment,
  coalesce(tier, (SELECT tier FROM wb WHERE tier IS NOT NULL GROUP BY tier ORDER BY count(*) DESC, tier LIMIT 1)) AS tier FROM wb"""))
def q_impute_mode(spark, sf):
    return CL.impute_mode(_wb(spark, sf).select("id", "segment", "tier"), ["segment", "tier"])


LAGS = S.LAG_COLS


@query("impute_ffill_median", S.with_ctes(["panel_raw"], "SELECT date, borough, " + ", ".join(
    f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM ff)) AS {c}" for c in LAGS) + " FROM ff",
    extra=[("ff", "SELECT date, borough, " + ", ".join(
        f"last_value({c} IGNORE NULLS) OVER (PARTITION BY borough ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
        for c in LAGS) + " FROM panel_raw")]), floats=LAGS)
def q_impute_ffill_median(spark, sf):
    p = raw_panel(spark, sf).select("date", ENTITY, *LAGS)
    return CL.impute_ffill_median(p, ENTITY, "date", LAGS)


EDA_COLS = ["temp_mean", "temp_mean_lag1", "wind_speed_mean", "complaints_total_ma7"]


def _eda_sql():
    bf = ", ".join(f"""coalesce(first_value({c} IGNORE NULLS) OVER (PARTITION BY borough ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
  last_value({c} IGNORE NULLS) OVER (PARTITION BY borough ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS {c}""" for c in EDA_COLS)
    ind = ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}_missing" for c in EDA_COLS)
    body = "SELECT date, borough, " + ", ".join(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM bf)) AS {c}" for c in EDA_COLS) \
        + ", " + ", ".join(f"{c}_missing" for c in EDA_COLS) + " FROM bf"
    return S.with_ctes(["panel_raw"], body, extra=[("bf", f"SELECT date, borough, {bf}, {ind} FROM panel_raw")])


@query("impute_eda_view", _eda_sql(), floats=EDA_COLS)
def q_impute_eda_view(spark, sf):
    p = raw_panel(spark, sf).select("date", ENTITY, *EDA_COLS)
    return CL.impute_eda_view(p, ENTITY, "date", EDA_COLS)


@query("impute_time_safe", S.with_ctes(["panel_raw"], "SELECT date, borough, " + ", ".join(
    f"last_value({c} IGNORE NULLS) OVER (PARTITION BY borough ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
    for c in EDA_COLS) + ", " + ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}_missing" for c in EDA_COLS)
    + " FROM panel_raw"), floats=EDA_COLS)
def q_impute_time_safe(spark, sf):
    p = raw_panel(spark, sf).select("date", ENTITY, *EDA_COLS)
    return CL.impute_time_safe(p, ENTITY, "date", EDA_COLS)


@query("missing_indicators", S.with_ctes(["wb"], """SELECT id, CAST(balance IS NULL AS INTEGER) AS balance_missing,
  CAST(segment IS NULL AS INTEGER) AS segment_missing FROM wb"""))
def q_missing_indicators(spark, sf):
    return CL.missing_indicators(_wb(spark, sf).select("id", "balance", "segment"), ["balance", "segment"]) \
        .drop("balance", "segment")


@query("outliers_remove_iqr", S.with_ctes(["wb"], """SELECT w.* FROM w,
  (SELECT quantile_cont(balance, 0.25) AS q1, quantile_cont(balance, 0.75) AS q3 FROM w) b,
  (SELECT quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.75) AS q3 FROM w) s
  WHERE (balance BETWEEN b.q1 - 1.5 * (b.q3 - b.q1) AND b.q3 + 1.5 * (b.q3 - b.q1) OR balance IS NULL)
    AND (score BETWEEN s.q1 - 1.5 * (s.q3 - s.q1) AND s.q3 + 1.5 * (s.q3 - s.q1) OR score IS NULL)""",
    extra=[("w", "SELECT * REPLACE (CASE WHEN id % 50 = 0 THEN balance * 100 ELSE balance END AS balance) FROM wb")]), floats=["balance"])
def q_outliers_remove_iqr(spark, sf):
    # deterministic injected outliers: every 50th id scaled by 100
    d = _wb(spark, sf).withColumn("balance", F.when(F.col("id") % 50 == 0, F.col("balance") * 100).otherwise(F.col("balance")))
    return CL.outliers_remove_iqr(d, ["balance", "score"])


@query("outliers_remove_iqr_sequential", S.with_ctes(["wb"], """SELECT s1.* FROM s1,
  (SELECT quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.75) AS q3 FROM s1) s
  WHERE s1.score BETWEEN s.q1 - 1.5 * (s.q3 - s.q1) AND s.q3 + 1.5 * (s.q3 - s.q1)""",
    extra=[("s1", """SELECT wb.* FROM wb, (SELECT quantile_cont(balance, 0.25) AS q1, quantile_cont(balance, 0.75) AS q3 FROM wb) b
  WHERE wb.balance BETWEEN b.q1 - 1.5 * (b.q3 - b.q1) AND b.q3 + 1.5 * (b.q3 - b.q1)""")]))
def q_outliers_remove_iqr_sequential(spark, sf):
    return CL.outliers_remove_iqr(_wb(spark, sf), ["balance", "score"], sequential=True)


@query("winsorize_pct", S.with_ctes(["wb"], """SELECT id, CASE WHEN balance IS NULL THEN NULL
  ELSE greatest(least(balance, (SELECT quantile_cont(balance, 0.95) FROM wb)), (SELECT quantile_cont(balance, 0.05) FROM wb)) END AS balance
  FROM wb"""), floats=["balance"])
def q_winsorize_pct(spark, sf):
    return CL.winsorize_pct(_wb(spark, sf).select("id", "balance"), ["balance"])


@query("winsorize_iqr", S.with_ctes(["panel_wins"], "SELECT date, borough, precipitation_sum, wind_speed_mean, snowfall_sum FROM panel_wins"),
    floats=["precipitation_sum", "wind_speed_mean", "snowfall_sum"])
def q_winsorize_iqr(spark, sf):
    p = raw_panel(spark, sf)
    return CL.winsorize_iqr(p, ["precipitation_sum", "wind_speed_mean", "snowfall_sum"])[0] \
        .select("date", ENTITY, "precipitation_sum", "wind_speed_mean", "snowfall_sum")


WINS = ["precipitation_sum", "rain_sum", "snowfall_sum", "wind_gust_mean"]


def _wins_sql():
    extra = []
    for c in WINS:
        extra.append((f"{c}_o", f"""SELECT v, row_number() OVER (ORDER BY v) AS r, count(*) OVER () AS n
  FROM (SELECT CAST({c} AS DOUBLE) AS v FROM panel_raw WHERE {c} IS NOT NULL)"""))
        extra.append((f"{c}_b", f"""SELECT (SELECT v FROM {c}_o WHERE r = CAST(floor(0.01 * n) AS BIGINT) + 1) AS lo,
  (SELECT v FROM {c}_o WHERE r = n - CAST(floor(0.01 * n) AS BIGINT)) AS hi FROM {c}_o LIMIT 1"""))
    sel = ", ".join(f"""CASE WHEN p.{c} IS NULL THEN NULL ELSE greatest(least(CAST(p.{c} AS DOUBLE), {c}_b.hi), {c}_b.lo) END AS {c}_wins"""
                    for c in WINS)
    frm = ", ".join(f"{c}_b" for c in WINS)
    return S.with_ctes(["panel_raw"], f"SELECT p.date, p.borough, {sel} FROM panel_raw p, {frm}", extra=extra)


@query("winsorize_rank", _wins_sql(), floats=[f"{c}_wins" for c in WINS])
def q_winsorize_rank(spark, sf):
    p = raw_panel(spark, sf).select("date", ENTITY, *WINS)
    return CL.winsorize_rank(p, WINS, 0.01).select("date", ENTITY, *[f"{c}_wins" for c in WINS])


@query("scale_zscore", S.with_ctes(["wb"], """SELECT id, (balance - (SELECT avg(balance) FROM wb)) / (SELECT stddev_samp(balance) FROM wb) AS balance,
  (score - (SELECT avg(score) FROM wb)) / (SELECT stddev_pop(score) FROM wb) AS score FROM wb"""), floats=["balance", "score"])
def q_scale_zscore(spark, sf):
    d = _wb(spark, sf).select("id", "balance", "score")
    d = CL.scale_zscore(d, ["balance"], ddof=1)
    return CL.scale_zscore(d, ["score"], ddof=0)


@query("scale_minmax", S.with_ctes(["wb"], """SELECT id, (balance - (SELECT min(balance) FROM wb))
  / ((SELECT max(balance) FROM wb) - (SELECT min(balance) FROM wb)) AS balance, nation FROM wb"""), floats=["balance"])
def q_scale_minmax(spark, sf):
    d = _wb(spark, sf).select("id", "balance", "nation", F.lit(5.0).alias("flat"))
    return CL.scale_minmax(d, ["balance", "flat"]).drop("flat")


@query("box_cox", None)
def q_box_cox(spark, sf):
    p = raw_panel(spark, sf).select("date", ENTITY, "precipitation_sum")
    return CL.box_cox(p, "precipitation_sum")


@query("yeo_johnson", None)
def q_yeo_johnson(spark, sf):
    p = raw_panel(spark, sf).select("date", ENTITY, "precipitation_sum", "wind_speed_mean", "temp_mean")
    return CL.yeo_johnson(p, ["precipitation_sum", "wind_speed_mean", "temp_mean"])


@query("one_hot_full_rank", S.with_ctes(["wb"], f"""SELECT id, balance, """ + ", ".join(
    [f"CAST(coalesce(seg = '{v}', false) AS INTEGER) AS segment{v}" for v in ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]]
    + [f"CAST(coalesce(CAST(tier AS VARCHAR) = '{v}', false) AS INTEGER) AS tier{v}" for v in ["1", "2", "3"]])
    + f" FROM (SELECT *, {S.strip_upper('segment')} AS seg FROM wb)"))
def q_one_hot_full_rank(spark, sf):
    from pansift.operators.columns import standardize_text
    d = standardize_text(_wb(spark, sf).select("id", "balance", "segment", "tier"), ["segment"], "upper")
    return CL.one_hot_full_rank(d, ["segment", "tier"])


@query("dummies_drop_first", S.with_ctes(["panel_raw"], """SELECT date, """ + ", ".join(
    [f'CAST(borough = \'{v}\' AS INTEGER) AS "borough_{v}"' for v in S.ENTITY_DOMAIN[1:]]
    + [f'CAST(coalesce(temp_bin = \'{v}\', false) AS INTEGER) AS "temp_bin_{v}"' for v in ["0-10C", "10-20C", "20-30C", ">30C"]])
    + """ FROM (SELECT *, CASE WHEN temp_mean IS NULL THEN NULL WHEN temp_mean <= 0 THEN '<=0C' WHEN temp_mean <= 10 THEN '0-10C'
  WHEN temp_mean <= 20 THEN '10-20C' WHEN temp_mean <= 30 THEN '20-30C' ELSE '>30C' END AS temp_bin FROM panel_raw)"""))
def q_dummies_drop_first(spark, sf):
    from pansift.operators.features import TEMP_BIN_LABELS, cut_fixed
    p = cut_fixed(raw_panel(spark, sf).select("date", ENTITY, "temp_mean"), "temp_mean", out="temp_bin").drop("temp_mean")
    return CL.dummies_drop_first(p, [ENTITY, "temp_bin"], levels={"temp_bin": TEMP_BIN_LABELS})


@query("sparse_design", """SELECT o_orderkey, 'o_totalprice' AS "column", CAST(NULL AS VARCHAR) AS level, CAST(o_totalprice AS DOUBLE) AS value
  FROM orders WHERE o_totalprice IS NULL OR o_totalprice <> 0
  UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority, 1.0 FROM orders WHERE o_orderpriority <> (SELECT min(o_orderpriority) FROM orders)
  UNION ALL SELECT o_orderkey, 'o_custkey', CAST(o_custkey AS VARCHAR), 1.0 FROM orders
    WHERE CAST(o_custkey AS VARCHAR) <> (SELECT min(CAST(o_custkey AS VARCHAR)) FROM orders)""", floats=["value"])
def q_sparse_design(spark, sf):
    """Rows as sparse vectors; every customer is a level."""
    from pansift.operators.sparse import design_entries, sparse_design
    rows, levels = sparse_design(S.table(spark, sf, "orders"), ["o_totalprice"], ["o_orderpriority", "o_custkey"])
    return design_entries(rows, levels, ["o_orderkey"])


@query("split_binary_continuous", S.with_ctes(["panel_raw"], """SELECT * FROM (VALUES ('is_weekend', 'binary'),
  ('event_has_parade', 'binary'), ('event_has_holiday', 'binary'), ('day_of_week', 'continuous'),
  ('temp_mean', 'continuous'), ('complaints_total', 'continuous')) t("column", kind)
  WHERE (SELECT count(*) FROM panel_raw) > 0"""))
def q_split_binary_continuous(spark, sf):
    cols = ["is_weekend", "event_has_parade", "event_has_holiday", "day_of_week", "temp_mean", "complaints_total"]
    b, c = CL.split_binary_continuous(raw_panel(spark, sf), cols)
    return spark.createDataFrame([(x, "binary") for x in b] + [(x, "continuous") for x in c], "column string, kind string")


@query("quality_report_and_fix", S.with_ctes(["panel_clean"], "SELECT * FROM panel_clean"), floats=S.PANEL_FLOATS)
def q_quality_report_and_fix(spark, sf):
    return quality_report_and_fix(raw_panel(spark, sf))[0]


KNN_COLS = ["temp_mean", "wind_speed_mean", "cloud_cover_mean", "complaints_total", "temp_mean_lag1"]


def _keyed(p):
    """Rows with an integer key: day * 16 + place of the entity in its domain."""
    pos = F.array_position(F.array(*[F.lit(e) for e in S.ENTITY_DOMAIN]), F.col(ENTITY))
    return p.withColumn("row_key", F.unix_date("date").cast("long") * 16 + pos)


def _knn_ctes(block: bool) -> list:
    pos = "CASE borough " + " ".join(f"WHEN '{e}' THEN {i + 1}" for i, e in enumerate(S.ENTITY_DOMAIN)) + " END"
    cols = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in KNN_COLS)
    square = " + ".join(f"coalesce((r.{c} - d.{c}) * (r.{c} - d.{c}), 0.0)" for c in KNN_COLS)
    shared = " + ".join(f"CAST(r.{c} IS NOT NULL AND d.{c} IS NOT NULL AS INTEGER)" for c in KNN_COLS)
    one = " UNION ALL ".join(f"""SELECT r.row_key AS rid, {j} AS col, ({square}) AS square, CAST(({shared}) AS DOUBLE) AS shared,
  d.{c} AS v, d.row_key AS did FROM kb r JOIN kb d ON {'r.borough = d.borough AND ' if block else ''}r.{c} IS NULL AND d.{c} IS NOT NULL"""
                             for j, c in enumerate(KNN_COLS))
    return [("kb", f"SELECT date, borough, date_diff('day', DATE '1970-01-01', CAST(date AS DATE)) * 16 + {pos} AS row_key, {cols} FROM panel_raw"),
            ("kp", one),
            ("kd", """SELECT * FROM (SELECT rid, col, sqrt(square * (5.0::DOUBLE / shared)) AS d, v, did,
  CAST(row_number() OVER (PARTITION BY rid, col ORDER BY sqrt(square * (5.0::DOUBLE / shared)), did) AS INTEGER) AS rank
  FROM kp WHERE shared > 0) WHERE rank <= 5"""),
            ("kf", """SELECT rid, col, CASE WHEN min(d) = 0 THEN avg(v) FILTER (WHERE d = 0) ELSE sum(v / d) FILTER (WHERE d > 0) / sum(1 / d) FILTER (WHERE d > 0) END AS fill
  FROM kd GROUP BY rid, col""")]


def _knn_filled(block: bool) -> str:
    fills = ", ".join(f"""coalesce(b.{c}, (SELECT fill FROM kf WHERE kf.rid = b.row_key AND kf.col = {j}),
  (SELECT avg({c}) FROM kb)) AS {c}""" for j, c in enumerate(KNN_COLS))
    return S.with_ctes(["panel_raw"], f"SELECT b.row_key, b.date, b.borough, {fills} FROM kb b", extra=_knn_ctes(block))


@query("impute_knn", _knn_filled(False), floats=KNN_COLS)
def q_impute_knn(spark, sf):
    from pansift.operators.knn import impute_knn
    p = _keyed(raw_panel(spark, sf))
    return impute_knn(p.select("row_key", "date", ENTITY, *KNN_COLS), KNN_COLS, "row_key", k=5)


@query("impute_knn_blocked", _knn_filled(True), floats=KNN_COLS)
def q_impute_knn_blocked(spark, sf):
    """Donors of the same entity only."""
    from pansift.operators.knn import impute_knn
    p = _keyed(raw_panel(spark, sf))
    return impute_knn(p.select("row_key", "date", ENTITY, *KNN_COLS), KNN_COLS, "row_key", k=5, block_by=ENTITY)


@query("impute_knn_view", None)
def q_impute_knn_view(spark, sf):
    """Every numeric column of the feature view (unit tests hold the brute force)."""
    from pansift.operators.columns import numeric_columns
    from pansift.operators.knn import impute_knn
    from pansift.plans.q_pipelines import features_of
    view = _keyed(features_of(spark, sf))
    cols = [c for c in numeric_columns(view) if c != "row_key"]
    return impute_knn(view.select("row_key", "date", ENTITY, *cols), cols, "row_key", k=5)


@query("knn_donor_join", S.with_ctes(["panel_raw"], "SELECT rid, col, d, v, did, rank FROM kd", extra=_knn_ctes(False)), floats=["d", "v"])
def q_knn_donor_join(spark, sf):
    from pansift.operators.knn import knn_donor_join
    return knn_donor_join(_keyed(raw_panel(spark, sf)), KNN_COLS, "row_key", k=5)


@query("box_cox_fixed_lambda", S.with_ctes(["panel_raw"], """SELECT date, borough, precipitation_sum,
  (power(coalesce(precipitation_sum, 0.0) + 0.001, 0.25) - 1) / 0.25 AS boxcox_precipitation_sum,
  CAST(0.25 AS DOUBLE) AS _boxcox_lambda_precipitation_sum FROM panel_raw"""),
    floats=["precipitation_sum", "boxcox_precipitation_sum"])
def q_box_cox_fixed_lambda(spark, sf):
    p = raw_panel(spark, sf).select("date", ENTITY, "precipitation_sum")
    return CL.box_cox(p, "precipitation_sum", lam=0.25)


YJ_FIXED = {"precipitation_sum": 0.3, "temp_mean": 1.2}


def _yj_sql(c: str, lam: float) -> str:
    return (f"CASE WHEN {c} >= 0 THEN (power({c} + 1, {lam}) - 1) / {lam} "
            f"ELSE -(power(1 - {c}, {2 - lam}) - 1) / {2 - lam} END")


@query("yeo_johnson_fixed_lambda", S.with_ctes(["panel_raw"], "SELECT date, borough, " + ", ".join(
    f"(t_{c} - (SELECT avg(t_{c}) FROM yj)) / (SELECT stddev_pop(t_{c}) FROM yj) AS {c}" for c in YJ_FIXED)
    + " FROM yj", extra=[("yj", "SELECT date, borough, " + ", ".join(
        f"{_yj_sql(c, lam)} AS t_{c}" for c, lam in YJ_FIXED.items()) + " FROM panel_raw")]),
    floats=list(YJ_FIXED))
def q_yeo_johnson_fixed_lambda(spark, sf):
    p = raw_panel(spark, sf).select("date", ENTITY, *YJ_FIXED)
    return CL.yeo_johnson(p, list(YJ_FIXED), lambdas=YJ_FIXED)
