"""Plan checks: the physical plans we want at scale, read from explain()."""

import contextlib
import io

import pytest

from pansift.plans.registry import load_all

SF = "/root/testdata/sf0.001"
REG = load_all()


def plan_of(df, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


KEY_QUERIES = ["build_panel", "feature_view", "daily_entity_counts", "topk_pivot_counts", "majority_map",
               "dedupe_keep_first", "rank_top_per_key", "data_dictionary", "corr_matrix", "box_stats",
               "iqr_bounds", "missing_panel_cells", "kde", "join_quality_flags", "influence"]


@pytest.mark.parametrize("name", KEY_QUERIES)
def test_no_cartesian_or_python_udf(spark, name):
    plan = plan_of(REG[name].run(spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad}"


def test_windows_share_one_exchange(spark):
    from pansift.plans.pipelines import panel_features
    from pansift.plans.q_pipelines import raw_panel
    p = raw_panel(spark, SF).drop("temp_mean_lag1", "temp_mean_ma7", "precipitation_sum_lag1",
                                  "precipitation_sum_ma7", "complaints_total_ma7", "log_complaints_total")
    plan = plan_of(panel_features(p), "simple")
    assert plan.count("Exchange hashpartitioning(borough") == 1
    assert plan.count("Window [") == 1


def test_dimension_joins_broadcast(spark):
    plan = plan_of(REG["join_on_entity"].run(spark, SF))
    assert "BroadcastHashJoin" in plan


def test_window_filter_reaches_scan(spark):
    plan = plan_of(REG["ingest_pages"].run(spark, SF))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double,l_shipdate" in plan


def test_dedupe_is_partial_aggregate(spark):
    plan = plan_of(REG["dedupe_keep_first"].run(spark, SF))
    assert "partial_min(struct(" in plan  # map-side reduction before the shuffle
