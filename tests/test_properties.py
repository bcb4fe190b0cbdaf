"""Properties from the test strategy, on the sf0.01 tables."""

from pyspark.sql import functions as F

from shoplens.functions.filters import SessionFilter
from shoplens.operators import ads, sampling
from shoplens.operators import sessions as ses
from shoplens.plans import reports as rp
from shoplens.sources import tables as src
from tests.conftest import SF_MID

ALL = SessionFilter()


def test_ratios_are_shares(spark):
    r = rp.report_session_ratio(spark, SF_MID, "2024-01-01", "2024-01-31", ALL).first().asDict()
    shares = {k: v for k, v in r.items() if k != "session_count"}
    assert all(0.0 <= v <= 1.0 for v in shares.values())
    steps = sum(v for k, v in shares.items() if k.startswith("step_length_"))
    assert abs(steps - 1.0) <= 0.005 * len([k for k in shares if k.startswith("step_length_")])


def test_sample_size_is_sum_of_quotas(spark):
    s = ses.session_rollup(src.actions(spark, SF_MID))
    quotas = sampling.extract_quota(ses.sessions_per_hour(s), 1500)
    expected = quotas.agg(F.sum("quota")).first()[0]
    got = sampling.sample_sessions(s, 1500).count()
    assert got == expected and got > 0
    assert quotas.filter(F.col("quota") > F.col("hour_count")).count() == 0


def test_semi_and_anti_partition_the_input(spark):
    a = src.actions(spark, SF_MID)
    kept = ses.filtered_sessions(a, src.users(spark, SF_MID), SessionFilter(start_age=20, end_age=50))
    semi = ses.semi_actions_in_sessions(a, kept)
    anti = a.join(kept.select("session_id"), "session_id", "left_anti")
    assert semi.count() + anti.count() == a.count()
    assert semi.join(anti, "action_id").count() == 0


def test_anti_blacklist_and_blacklisted_partition_events(spark):
    ev = ads.ad_events(ads.parse_ad_log(src.ad_log_lines(spark, SF_MID)))
    bl = ads.distinct_blacklist_users(ads.daily_user_ad_clicks(ev), 2)
    kept = ads.anti_blacklist(ev, bl)
    dropped = ev.join(bl, "user_id", "left_semi")
    assert kept.count() + dropped.count() == ev.count()
