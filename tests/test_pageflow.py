import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from shoplens.operators import pageflow as pf
from shoplens.plans.reports import page_conversion

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)
SCHEMA = "action_id long, session_id string, page_id long, action_time timestamp_ntz"


def _actions(spark, seq):
    return spark.createDataFrame(seq, SCHEMA)


def test_flow_pairs():
    assert pf.flow_pairs("1,2,1,2") == [(1, 1, 2), (2, 2, 1), (3, 1, 2)]
    assert pf.flow_pairs("5") == []


def test_conversion_missing_pair_repeat_and_ties(spark):
    rows = [(1, "a", 1, T0), (2, "a", 2, T0 + dt.timedelta(seconds=1)),
            (4, "a", 1, T0 + dt.timedelta(seconds=2)), (3, "a", 2, T0 + dt.timedelta(seconds=2)),
            (5, "b", 1, T0)]
    # session a in (time, id) order: 1, 2, 2(id 3), 1(id 4) -> pairs 1_2, 2_2, 2_1
    out = {r["pos"]: r for r in page_conversion(_actions(spark, rows), "1,2,1,2").collect()}
    assert [out[p]["pair_count"] for p in (1, 2, 3)] == [1, 1, 1]
    assert out[1]["ratio"] == 1 / 3                     # start views of page 1: 3
    assert out[2]["ratio"] == 1.0
    missing = {r["pos"]: r for r in page_conversion(_actions(spark, rows), "1,3,4").collect()}
    assert missing[1]["pair_count"] == 0 and missing[2]["ratio"] is None


def test_zero_start_views_gives_null(spark):
    rows = [(1, "a", 2, T0), (2, "a", 3, T0 + dt.timedelta(seconds=1))]
    out = page_conversion(_actions(spark, rows), "9,2").collect()
    assert out[0]["pair_count"] == 0 and out[0]["ratio"] is None


def _plain(df):
    """Pairs by a window over whole sessions."""
    w = Window.partitionBy("session_id").orderBy("action_time", "action_id")
    x = df.select("session_id", "page_id", F.lead("page_id").over(w).alias("next"), F.lead("action_id").over(w).alias("id"))
    return sorted((tuple(r)[:3] for r in x.filter("id IS NOT NULL").collect()), key=str)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.sampled_from([0, 1, 2, 3, None]), st.integers(0, 400)),
                min_size=1, max_size=40))
def test_chunked_pairs_equal_plain_lead(spark, items):
    rows = [(i, s, p, T0 + dt.timedelta(seconds=t)) for i, (s, p, t) in enumerate(items)]
    df = _actions(spark, rows)
    plain = _plain(df)
    for n in (None, 1, 3, 7):
        assert sorted(map(tuple, pf.page_pairs(df, n).collect()), key=str) == plain


def test_one_hot_session_instant_is_cut(spark):
    """A third of all rows in one session and one second: no chunk holds more than its share of rows."""
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 50}", i % 5, T0 + dt.timedelta(seconds=0 if i % 3 == 0 else i)) for i in range(6000)]
    df = _actions(spark, rows).repartition(6)
    sizes = [r["count"] for r in pf.ordered_chunks(df, 12).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 12 and max(sizes) < 1000                # the hot session has 2,000 rows
    assert sorted(map(tuple, pf.page_pairs(df, 12).collect()), key=str) == _plain(df)
    one = {r["pos"]: r["pair_count"] for r in pf.flow_counts(df, "0,3,1,4", 12).collect()}
    pairs = _plain(df)
    assert one == {0: 1200, **{p: sum(x[1:] == (a, b) for x in pairs) for p, a, b in pf.flow_pairs("0,3,1,4")}}


def test_empty_and_single_row(spark):
    none = _actions(spark, [])
    assert pf.page_pairs(none).count() == 0
    assert [r["pair_count"] for r in pf.flow_counts(none, "1,2").collect()] == [0, 0]
    one = _actions(spark, [(1, "a", 1, T0)])
    assert pf.page_pairs(one).count() == 0 and [r["pair_count"] for r in pf.flow_counts(one, "1,2").collect()] == [1, 0]


def test_text_form(spark):
    rows = [(1, "a", 1, T0), (2, "a", 2, T0 + dt.timedelta(seconds=1)), (3, "b", 1, T0)]
    assert pf.render_ratios(page_conversion(_actions(spark, rows), "1,2,3,4")).first()[0] == "1_2=0.5|2_3=0.0|3_4"


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 3), st.integers(0, 300)), min_size=1, max_size=30),
       st.sampled_from(["0,1,2,3", "1,1,1", "2,0", "3,2,1,0,1"]))
def test_flow_counts_equal_pair_and_start_counts(spark, items, flow):
    rows = [(i, f"s{s}", p, T0 + dt.timedelta(seconds=t)) for i, (s, p, t) in enumerate(items)]
    df = _actions(spark, rows)
    one_pass = {r["pos"]: r["pair_count"] for r in pf.flow_counts(df, flow, 3).collect()}
    pairs = {r["pos"]: r["pair_count"] for r in pf.page_pair_count(pf.page_pairs(df),
                                                                     pf.flow_table(spark, flow)).collect()}
    start = pf.start_page_count(df, int(flow.split(",")[0])).first()[0]
    assert one_pass == {0: start, **pairs}


def test_one_page_flow_has_no_ratios(spark):
    rows = [(1, "a", 5, T0), (2, "a", 6, T0 + dt.timedelta(seconds=1))]
    assert page_conversion(_actions(spark, rows), "5").count() == 0
