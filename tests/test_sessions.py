import datetime as dt

from pyspark.sql import functions as F

from shoplens.operators import sampling
from shoplens.operators import sessions as ses

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)
ACTION_SCHEMA = ("action_id long, session_id string, user_id long, action_time timestamp_ntz, "
                 "search_keyword string, click_category_id long, page_id long")


def actions(spark, rows):
    return spark.createDataFrame(rows, ACTION_SCHEMA)


def test_visit_length_buckets_edges(spark):
    lengths = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
    df = spark.createDataFrame([(x,) for x in lengths], "visit_length long")
    got = [r[0] for r in df.select(ses.visit_length_bucket("visit_length")).collect()]
    assert got == [None, "1s_3s", "1s_3s", "4s_6s", "4s_6s", "7s_9s", "7s_9s", "10s_30s", "10s_30s",
                   "30s_60s", "30s_60s", "1m_3m", "1m_3m", "3m_10m", "3m_10m", "10m_30m", "10m_30m", "30m"]


def test_step_buckets_edges(spark):
    steps = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61]
    df = spark.createDataFrame([(x,) for x in steps], "step_length long")
    got = [r[0] for r in df.select(ses.step_length_bucket("step_length")).collect()]
    assert got == ["1_3", "1_3", "4_6", "4_6", "7_9", "7_9", "10_30", "10_30", "30_60", "30_60", "60"]


def test_rollup_exact_distinct_sorted_lists(spark):
    rows = [
        (1, "s", 7, T0, None, 12, 1),
        (2, "s", 7, T0 + dt.timedelta(seconds=5), "kw1", None, 2),
        (3, "s", 7, T0 + dt.timedelta(seconds=9), "kw11", 1, 3),
        (4, "s", 7, T0 + dt.timedelta(seconds=2), "", 2, 4),
        (5, "s", 7, T0 + dt.timedelta(seconds=3), "kw1", 12, 5),
        (6, "t", 8, T0, None, None, 1),
    ]
    s = {r["session_id"]: r for r in ses.session_rollup(actions(spark, rows)).collect()}
    assert s["s"]["search_keywords"] == "kw1,kw11"       # 'kw1' is kept although 'kw11' contains it
    assert s["s"]["click_category_ids"] == "1,2,12"      # 1 is kept although 12 contains it
    assert (s["s"]["step_length"], s["s"]["visit_length"]) == (5, 9)
    assert s["t"]["search_keywords"] is None and s["t"]["click_category_ids"] is None
    assert s["t"]["visit_length"] == 0


def test_session_ratio_counts_zero_second_sessions(spark):
    sessions = spark.createDataFrame([(0, 1), (2, 2), (5, 4), (40, 70)], "visit_length long, step_length long")
    r = ses.session_ratio(sessions).first()
    assert r["session_count"] == 4
    assert r["visit_length_1s_3s"] == 0.25 and r["visit_length_4s_6s"] == 0.25
    assert r["visit_length_30s_60s"] == 0.25
    assert r["step_length_1_3"] == 0.5 and r["step_length_60"] == 0.25
    empty = sessions.limit(0)
    assert ses.session_ratio(empty).count() == 0


def _hourly(spark, rows):
    return spark.createDataFrame(rows, "date string, hour string, hour_count long")


def test_quota_proportional_floor_and_cap(spark):
    q = sampling.extract_quota(_hourly(spark, [("d1", "00", 30), ("d1", "01", 11), ("d2", "05", 3)]), total=40)
    got = {(r["date"], r["hour"]): r["quota"] for r in q.collect()}
    # 2 days -> 20 a day; d1: floor(30*20/41) = 14, floor(11*20/41) = 5; d2: min(20, 3) = 3
    assert got == {("d1", "00"): 14, ("d1", "01"): 5, ("d2", "05"): 3}


def test_quota_one_hour_holds_the_day_and_many_days(spark):
    q = sampling.extract_quota(_hourly(spark, [("d1", "07", 500)]), total=100)
    assert q.first()["quota"] == 100
    many = _hourly(spark, [(f"d{i:03d}", "00", 5) for i in range(150)])
    assert {r["quota"] for r in sampling.extract_quota(many, total=100).collect()} == {0}


def _sessions(spark, n_per_hour):
    rows = []
    for h, n in n_per_hour.items():
        for i in range(n):
            rows.append((f"s{h}_{i}", T0 + dt.timedelta(hours=h, seconds=i)))
    return spark.createDataFrame(rows, "session_id string, start_time timestamp_ntz")


def test_random_extract_exact_quota_reproducible(spark, monkeypatch):
    s = _sessions(spark, {0: 40, 1: 10, 2: 1})
    a = sampling.sample_sessions(s, total=20, seed="x")
    monkeypatch.setattr(sampling, "PREFIX", 1)            # wider cells, in which the cut-off has company
    b = sampling.sample_sessions(s.repartition(3), total=20, seed="x")
    got_a = sorted(r["session_id"] for r in a.collect())
    assert got_a == sorted(r["session_id"] for r in b.collect())
    per_hour = {}
    for r in a.collect():
        per_hour[r["hour"]] = per_hour.get(r["hour"], 0) + 1
    assert per_hour == {"00": 15, "01": 3}            # floor(40*20/51), floor(10*20/51), floor(1*20/51)=0
    hashed = s.withColumn("h", F.md5(F.concat(F.lit("x"), "session_id"))).filter(F.hour("start_time") == 0)
    expected = sorted(r["session_id"] for r in hashed.orderBy("h", "session_id").limit(15).collect())
    assert sorted(x for x in got_a if x.startswith("s0_")) == expected


def test_quota_equal_to_hour_count_takes_all(spark):
    s = _sessions(spark, {3: 4})
    got = sampling.sample_sessions(s, total=100).count()
    assert got == 4


def test_empty_input_gives_no_sample(spark):
    s = _sessions(spark, {3: 1}).limit(0)
    assert sampling.sample_sessions(s, total=100).count() == 0


def test_session_ratio_long_form(spark):
    sessions = spark.createDataFrame([(0, 1), (2, 2), (5, 4), (40, 70)], "visit_length long, step_length long")
    rows = {(r["measure"], r["bucket"]): r["ratio"] for r in ses.session_ratio_long(sessions).collect()}
    assert len(rows) == 15
    assert rows[("visit_length", "1s_3s")] == 0.25 and rows[("step_length", "60")] == 0.25


def test_category_universe_priority_rule(spark):
    from shoplens.operators import categories as cat
    rows = [(1, "s", 5, "6,7", None), (2, "s", None, "8", "9"), (3, "s", None, None, "9,9")]
    df = spark.createDataFrame(rows, "action_id long, session_id string, click_category_id long, "
                                     "order_category_ids string, pay_category_ids string")
    # action 1: click 5 is the universe kind, orders 6 and 7 only count; action 2: order 8 wins over pay 9;
    # action 3: pay 9 (listed twice, counted twice) puts 9 in the universe.
    got = {r["category_id"]: (r["click_count"], r["order_count"], r["pay_count"])
           for r in cat.category_funnel_counts(df).collect()}
    assert got == {5: (1, 0, 0), 8: (0, 1, 0), 9: (0, 0, 3)}
    assert sorted(r[0] for r in cat.category_universe(df).collect()) == [5, 8, 9]
    assert sorted(tuple(r) for r in cat.left_join_category_counts(df).collect()) == [
        (5, 1, 0, 0), (8, 0, 1, 0), (9, 0, 0, 3)]
