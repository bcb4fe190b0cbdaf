"""Plan-shape checks: pushdown, partial top-k, no cartesian products, no Python UDFs."""

import pytest

from shoplens.plans import registry, stream_queries
from tests.conftest import SF_SMALL

STREAM_KEYS = {k for k in registry.queries() if k.startswith(("stream_", "report_ad_", "report_province", "report_click",
                                                         "ad_log_source"))}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - STREAM_KEYS))
def test_no_cartesian_no_python(spark, name):
    p = plan(registry.queries()[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in p, (name, bad)


def test_date_range_reaches_parquet(spark):
    df = registry.queries()["scan_actions_by_date"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in p and "LessThan(ts" in p


def test_column_pruning(spark):
    df = registry.queries()["category_click_count"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "value:" not in p and "ReadSchema: struct<event_type:string,props:string>" in p


def test_top_k_per_group_is_partial(spark):
    df = registry.queries()["area_top3"](spark, SF_SMALL)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in p


def test_global_top10_is_take_ordered(spark):
    df = registry.queries()["top10_categories"](spark, SF_SMALL)
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()


def test_stream_queries_have_no_python_rows(spark):
    stream = stream_queries.run_ad_pipeline(spark, SF_SMALL)
    p = plan(stream.user_click_counts(spark))
    assert "BatchEvalPython" not in p and "CartesianProduct" not in p
