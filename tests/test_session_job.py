"""The session job: one scan, task id and record types on every report."""

import os
import tempfile
import datetime as dt

from pyspark.sql import functions as F

from shoplens import schemas
from shoplens.functions.filters import SessionFilter
from shoplens.operators import sessions as ses
from shoplens.plans import session_job as job
from shoplens.plans.report_queries import FULL_FILTER
from shoplens.sources import tables as src
from tests.conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1, 5, 0, 0)


def test_reports_are_bound_and_tagged(spark):
    made = job.run_session_job(src.actions(spark, SF_SMALL), src.users(spark, SF_SMALL), SessionFilter(end_age=None), 1500)
    kinds = {"session_ratio": schemas.SESSION_AGGR_STAT, "random_extract": schemas.SESSION_RANDOM_EXTRACT,
             "top10_category": schemas.TOP10_CATEGORY, "top10_session": schemas.TOP10_SESSION}
    assert set(made) == set(kinds)
    ids = set()
    for name, df in made.items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schemas.of_task(kinds[name])]
        ids |= {r[0] for r in df.select("task_id").distinct().collect()}
    assert len(ids) == 1 and len(ids.pop()) == 36


def test_filters_on_items_equal_filters_on_texts(spark):
    actions, users = src.actions(spark, SF_SMALL), src.users(spark, SF_SMALL)
    items = job.session_items(actions)
    for p in (SessionFilter(), FULL_FILTER, SessionFilter(keywords="kw1,kw4"), SessionFilter(category_ids="3,5,8,90")):
        want = {r[0] for r in ses.filtered_sessions(actions, users, p).select("session_id").collect()}
        got = job.kept_sessions(items, users, p)
        assert {r["session_id"] for r in got.collect()} == want


def test_items_spread_a_session_of_many_keywords(spark):
    rows = [(i, "hot", 1, T0 + dt.timedelta(seconds=i), f"k{i}", i % 7 - 1, None, None) for i in range(3000)]
    df = spark.createDataFrame(rows, "action_id long, session_id string, user_id long, action_time timestamp_ntz, "
                                     "search_keyword string, click_category_id long, order_category_ids string, pay_category_ids string")
    items = job.session_items(df)
    plan = items._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan and "collect_list" not in plan
    assert items.filter("kind = 'keyword'").count() == 3000
    texts = job.with_texts(df.select("session_id").distinct(), items).first()
    assert texts["search_keywords"] == ",".join(sorted(f"k{i}" for i in range(3000)))
    assert texts["click_category_ids"] == "0,1,2,3,4,5"
    assert ses.session_rollup(df).first()["search_keywords"] == texts["search_keywords"]


def test_one_scan_feeds_all_reports(spark):
    """The events are read by one stage: reading them is counted by an accumulator of the source rows."""
    folder = tempfile.mkdtemp(prefix="shoplens-scan-")
    actions = src.actions(spark, SF_SMALL).limit(500)
    actions.write.mode("overwrite").parquet(f"{folder}/actions")
    total = actions.count()
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    table = spark.read.parquet(f"{folder}/actions")
    made = job.run_session_job(table.mapInArrow(counted, table.schema), src.users(spark, SF_SMALL), SessionFilter())
    for df in made.values():
        df.collect()
    assert seen.value == total and os.listdir(folder) == ["actions"]
