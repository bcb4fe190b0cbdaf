"""Registered queries for the single operators (A, B, C, D, W, R rows of SURVEY §2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoplens.config import scratch_path
from shoplens.functions import filters as flt
from shoplens.functions import scalar as fn
from shoplens.operators import categories as cat
from shoplens.operators import pageflow as pf
from shoplens.operators import regions, sampling
from shoplens.operators import sessions as ses
from shoplens.plans import oracle_views as ov
from shoplens.plans import reports as rp
from shoplens.plans.registry import ORACLES, register
from shoplens.plans.report_queries import (
    _P6_CTES, _SESSIONS_SQL, _TIME, AREA_LEVEL_SQL, D40, END, FULL_FILTER, REPORT_FILTER, SAMPLE_SEED,
    SAMPLE_TOTAL, SCAN_END, SCAN_START, START, STEP_BUCKET_SQL, TARGET_FLOW, VISIT_BUCKET_SQL,
    _conversion_ctes, _extract_sql, _filtered_sql, _funnel_ctes, _quota_ctes, _session_ratio_sql,
    _top_sessions_sql)
from shoplens.sources import sinks
from shoplens.sources import tables as src

_DATE = "'%Y-%m-%d'"


def _times_out(df):
    """Report form of an action row: times and dates as text."""
    return df.select(*[fn.format_time(c).alias(c) if c == "action_time" else
                       fn.format_date(c).alias(c) if c == "date" else F.col(c) for c in df.columns])


_ACTION_SQL_COLS = ("action_id, strftime(date, " + _DATE + ") AS date, user_id, session_id, page_id, "
                    "strftime(action_time, " + _TIME + ") AS action_time, search_keyword, click_category_id, "
                    "click_product_id, order_category_ids, CAST(NULL AS VARCHAR) AS order_product_ids, "
                    "pay_category_ids, CAST(NULL AS VARCHAR) AS pay_product_ids, city_id")

# ---------------------------------------------------------------- A: sources


@register("scan_actions_by_date", ov.sql(["actions"], f"""
SELECT {_ACTION_SQL_COLS} FROM actions
WHERE date >= DATE '{SCAN_START}' AND date <= DATE '{SCAN_END}'"""))
def q_scan_actions_by_date(spark, sf):
    return _times_out(src.actions(spark, sf, 1, SCAN_START, SCAN_END))


@register("scan_clicks_by_date", ov.sql(["actions"], f"""
SELECT city_id, click_product_id FROM actions
WHERE date >= DATE '{SCAN_START}' AND date <= DATE '{SCAN_END}'
  AND click_product_id IS NOT NULL AND click_product_id <> -1"""))
def q_scan_clicks_by_date(spark, sf):
    return src.click_actions(spark, sf, SCAN_START, SCAN_END)


@register("city_dimension", ov.sql(["cities"], "SELECT * FROM cities"))
def q_city_dimension(spark, sf):
    return src.cities(spark, sf)


@register("scan_user_info", ov.sql(["users"], "SELECT * FROM users"))
def q_scan_user_info(spark, sf):
    return src.users(spark, sf)


@register("scan_product_info", ov.sql(["products"], "SELECT * FROM products"))
def q_scan_product_info(spark, sf):
    return src.products(spark, sf)


# ---------------------------------------------------------------- B: filters

@register("filter_age_between", ov.sql(["users"], "SELECT user_id, age FROM users WHERE age BETWEEN 20 AND 50"))
def q_filter_age_between(spark, sf):
    return src.users(spark, sf).filter(flt.between_or_all("age", 20, 50)).select("user_id", "age")


_OVERLAP = "1,3,5,7,11,13"


@register("filter_any_overlap", ov.sql(["actions"], f"""
SELECT session_id, click_category_ids FROM sessions
WHERE list_has_any(string_split(click_category_ids, ','), [{", ".join("'" + v + "'" for v in _OVERLAP.split(","))}])
  AND click_category_ids <> '-1'""", [("sessions", _SESSIONS_SQL)]))
def q_filter_any_overlap(spark, sf):
    s = ses.session_rollup(src.actions(spark, sf))
    return s.filter(flt.any_in("click_category_ids", _OVERLAP)).select("session_id", "click_category_ids")


@register("filter_equal", ov.sql(["users"], "SELECT user_id, sex FROM users WHERE sex = 'female'"))
def q_filter_equal(spark, sf):
    return src.users(spark, sf).filter(flt.equal_or_all("sex", "female")).select("user_id", "sex")


def _session_cols_sql(t="fs"):
    return (f"SELECT session_id, user_id, strftime(start_time, {_TIME}) AS start_time, step_length, visit_length, "
            f"search_keywords, click_category_ids, age, professional, city, sex FROM {t}")


def _session_cols(df):
    return df.select("session_id", "user_id", fn.format_time("start_time").alias("start_time"), "step_length",
                     "visit_length", "search_keywords", "click_category_ids", "age", "professional", "city", "sex")


@register("filter_sessions", ov.sql(["actions", "users"], _session_cols_sql(),
          [("sessions", _SESSIONS_SQL), ("fs", _filtered_sql(FULL_FILTER))]))
def q_filter_sessions(spark, sf):
    a = src.actions(spark, sf)
    return _session_cols(ses.filtered_sessions(a, src.users(spark, sf), FULL_FILTER))


@register("case_area_level", ov.sql(["cities"], f"SELECT city_id, area_name, {AREA_LEVEL_SQL} AS area_level FROM cities"))
def q_case_area_level(spark, sf):
    return src.cities(spark, sf).select("city_id", "area_name", flt.area_level("area_name").alias("area_level"))


@register("product_status_label", ov.sql(["products"], """
SELECT product_id, CASE WHEN json_extract_string(extend_info, '$.product_status') = '0' THEN 'Self'
                        ELSE 'Third Party' END AS product_status FROM products"""))
def q_product_status_label(spark, sf):
    return src.products(spark, sf).select("product_id", flt.product_status("extend_info").alias("product_status"))


# ---------------------------------------------------------------- C: joins

@register("join_session_user", ov.sql(["actions", "users"], _session_cols_sql(),
          [("sessions", _SESSIONS_SQL), ("fs", _filtered_sql(flt.SessionFilter()))]))
def q_join_session_user(spark, sf):
    s = ses.session_rollup(src.actions(spark, sf))
    return _session_cols(ses.join_session_user(s, src.users(spark, sf)))


@register("semi_actions_in_sessions", ov.sql(["actions", "users"], """
SELECT action_id, session_id FROM actions WHERE session_id IN (SELECT session_id FROM fs)""",
          [("sessions", _SESSIONS_SQL), ("fs", _filtered_sql(REPORT_FILTER))]))
def q_semi_actions_in_sessions(spark, sf):
    a = src.actions(spark, sf)
    s = ses.filtered_sessions(a, src.users(spark, sf), REPORT_FILTER)
    return ses.semi_actions_in_sessions(a, s).select("action_id", "session_id")


@register("left_join_category_counts", ov.sql(["actions"], "SELECT * FROM funnel", _funnel_ctes("actions")))
def q_left_join_category_counts(spark, sf):
    return cat.left_join_category_counts(src.actions(spark, sf))


_CLICKS_ALL = [("clicks", f"""
  SELECT city_id, click_product_id AS product_id FROM actions
  WHERE date >= DATE '{START}' AND date <= DATE '{END}'
    AND click_product_id IS NOT NULL AND click_product_id <> -1""")]


@register("join_click_city", ov.sql(["actions", "cities"], "SELECT * FROM click_city", _P6_CTES[:2]))
def q_join_click_city(spark, sf):
    return regions.join_click_city(src.click_actions(spark, sf, START, END), src.cities(spark, sf))


@register("join_area_product", ov.sql(["actions", "cities", "products"], "SELECT * FROM full_info", _P6_CTES))
def q_join_area_product(spark, sf):
    cc = regions.join_click_city(src.click_actions(spark, sf, START, END), src.cities(spark, sf))
    return regions.join_area_product(regions.area_product_clicks(cc), src.products(spark, sf))


@register("semi_top_categories", ov.sql(["actions"], """
SELECT action_id, session_id, click_category_id FROM actions
WHERE nullif(click_category_id, -1) IN (SELECT category_id FROM top10)""", _funnel_ctes("actions")))
def q_semi_top_categories(spark, sf):
    a = src.actions(spark, sf)
    top = cat.top_categories(cat.category_funnel_counts(a))
    return cat.semi_top_categories(a, top).select("action_id", "session_id", "click_category_id")


# ---------------------------------------------------------------- D: aggregates

def _sess_out_sql(t="sessions"):
    return (f"SELECT session_id, user_id, strftime(start_time, {_TIME}) AS start_time, "
            f"strftime(end_time, {_TIME}) AS end_time, step_length, visit_length, search_keywords, "
            f"click_category_ids FROM {t}")


@register("session_rollup", ov.sql(["actions"], _sess_out_sql(), [("sessions", _SESSIONS_SQL)], d=D40))
def q_session_rollup(spark, sf):
    s = ses.session_rollup(src.actions(spark, sf, D40))
    return s.select("session_id", "user_id", fn.format_time("start_time").alias("start_time"),
                    fn.format_time("end_time").alias("end_time"), "step_length", "visit_length",
                    "search_keywords", "click_category_ids")


@register("distinct_keywords", ov.sql(["actions"], "SELECT session_id, search_keywords FROM sessions",
                                      [("sessions", _SESSIONS_SQL)]))
def q_distinct_keywords(spark, sf):
    return ses.session_rollup(src.actions(spark, sf)).select("session_id", "search_keywords")


@register("distinct_click_categories", ov.sql(["actions"], "SELECT session_id, click_category_ids FROM sessions",
                                              [("sessions", _SESSIONS_SQL)]))
def q_distinct_click_categories(spark, sf):
    return ses.session_rollup(src.actions(spark, sf)).select("session_id", "click_category_ids")


@register("visit_length_histogram", ov.sql(["actions"], f"""
SELECT bucket, count(*) AS session_count FROM (SELECT {VISIT_BUCKET_SQL} AS bucket FROM sessions) x
WHERE bucket IS NOT NULL GROUP BY bucket""", [("sessions", _SESSIONS_SQL)], d=D40))
def q_visit_length_histogram(spark, sf):
    return ses.visit_length_histogram(ses.session_rollup(src.actions(spark, sf, D40)))


@register("step_size_histogram", ov.sql(["actions"], f"""
SELECT bucket, count(*) AS session_count FROM (SELECT {STEP_BUCKET_SQL} AS bucket FROM sessions) x
WHERE bucket IS NOT NULL GROUP BY bucket""", [("sessions", _SESSIONS_SQL)], d=D40))
def q_step_size_histogram(spark, sf):
    return ses.step_length_histogram(ses.session_rollup(src.actions(spark, sf, D40)))


@register("session_ratio", ov.sql(["actions"], _session_ratio_sql("sessions"), [("sessions", _SESSIONS_SQL)], d=D40))
def q_session_ratio(spark, sf):
    return ses.session_ratio(ses.session_rollup(src.actions(spark, sf, D40)))


@register("counter_map_merge", ov.sql(["actions"], f"""
SELECT name, count(*) AS count FROM (
  SELECT 'session_count' AS name FROM sessions
  UNION ALL SELECT {VISIT_BUCKET_SQL} FROM sessions
  UNION ALL SELECT {STEP_BUCKET_SQL} FROM sessions) x
WHERE name IS NOT NULL GROUP BY name""", [("sessions", _SESSIONS_SQL)], d=D40))
def q_counter_map_merge(spark, sf):
    return ses.counter_map(ses.session_rollup(src.actions(spark, sf, D40)))


@register("category_click_count", ov.sql(["actions"], """
SELECT nullif(click_category_id, -1) AS category_id, count(*) AS click_count FROM actions
WHERE nullif(click_category_id, -1) IS NOT NULL GROUP BY 1"""))
def q_category_click_count(spark, sf):
    return cat.category_click_count(src.actions(spark, sf))


def _exploded_sql(col, out):
    return f"""
SELECT TRY_CAST(tok AS BIGINT) AS category_id, count(*) AS {out}
FROM (SELECT unnest(string_split({col}, ',')) AS tok FROM actions) x
WHERE tok <> '' AND TRY_CAST(tok AS BIGINT) IS NOT NULL GROUP BY 1"""


@register("category_order_count", ov.sql(["actions"], _exploded_sql("order_category_ids", "order_count")))
def q_category_order_count(spark, sf):
    return cat.category_order_count(src.actions(spark, sf))


@register("category_pay_count", ov.sql(["actions"], _exploded_sql("pay_category_ids", "pay_count")))
def q_category_pay_count(spark, sf):
    return cat.category_pay_count(src.actions(spark, sf))


@register("category_funnel_counts", ov.sql(["actions"], "SELECT * FROM funnel", _funnel_ctes("actions")))
def q_category_funnel_counts(spark, sf):
    return cat.category_funnel_counts(src.actions(spark, sf))


@register("category_universe", ov.sql(["actions"], """
SELECT DISTINCT cid AS category_id FROM tagged WHERE kind = ukind AND cid IS NOT NULL""",
          _funnel_ctes("actions")[:2]))
def q_category_universe(spark, sf):
    return cat.category_universe(src.actions(spark, sf))


_HOURLY = [("sessions", _SESSIONS_SQL)] + _quota_ctes("sessions", SAMPLE_TOTAL)


@register("sessions_per_hour", ov.sql(["actions"], "SELECT date, hour, hour_count FROM hourly", _HOURLY))
def q_sessions_per_hour(spark, sf):
    return ses.sessions_per_hour(ses.session_rollup(src.actions(spark, sf)))


@register("sessions_per_day", ov.sql(["actions"], """
SELECT date, hour, hour_count, CAST(day_count AS BIGINT) AS day_count, num_days FROM daily""", _HOURLY))
def q_sessions_per_day(spark, sf):
    return ses.sessions_per_day(ses.sessions_per_hour(ses.session_rollup(src.actions(spark, sf))))


@register("session_category_clicks", ov.sql(["actions"], """
SELECT nullif(click_category_id, -1) AS category_id, session_id, count(*) AS click_count FROM actions
WHERE nullif(click_category_id, -1) IS NOT NULL GROUP BY 1, 2"""))
def q_session_category_clicks(spark, sf):
    return cat.session_category_clicks(src.actions(spark, sf))


_CONV_ALL = _conversion_ctes("actions", TARGET_FLOW)


@register("page_pair_count", ov.sql(["actions"], "SELECT pos, page_pair, pair_count FROM pair_counts", _CONV_ALL))
def q_page_pair_count(spark, sf):
    a = src.actions(spark, sf)
    return pf.page_pair_count(pf.page_pairs(a), pf.flow_table(spark, TARGET_FLOW))


@register("start_page_count", ov.sql(["actions"], "SELECT count(*) AS start_count FROM actions WHERE page_id = 1"))
def q_start_page_count(spark, sf):
    return pf.start_page_count(src.actions(spark, sf), 1)


@register("area_product_clicks", ov.sql(["actions", "cities"], "SELECT * FROM area_counts", _P6_CTES[:3]))
def q_area_product_clicks(spark, sf):
    cc = regions.join_click_city(src.click_actions(spark, sf, START, END), src.cities(spark, sf))
    return regions.area_product_clicks(cc)


# ---------------------------------------------------------------- W: windows / top-k

@register("area_top3", ov.sql(["actions", "cities"], """
SELECT area_name, product_id, click_count, rn AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY area_name ORDER BY click_count DESC, product_id) AS rn FROM area_counts
) t WHERE rn <= 3""", _P6_CTES[:3]))
def q_area_top3(spark, sf):
    cc = regions.join_click_city(src.click_actions(spark, sf, START, END), src.cities(spark, sf))
    counts = regions.area_product_clicks(cc)
    top = regions.top_n_per_group(counts, ["area_name"], [F.col("click_count").desc(), F.col("product_id")],
                                  3, rank_col="rank")
    return top.select("area_name", "product_id", "click_count", F.col("rank").cast("bigint").alias("rank"))


@register("top_sessions_per_category", ov.sql(["actions"], _top_sessions_sql("actions", None)))
def q_top_sessions_per_category(spark, sf):
    return cat.top_sessions_per_category(cat.session_category_clicks(src.actions(spark, sf)))


@register("page_pairs", ov.sql(["actions"], """
SELECT session_id, page_id, next_page_id FROM (
  SELECT session_id, page_id, lead(page_id) OVER w AS next_page_id, lead(action_id) OVER w AS next_id
  FROM actions WINDOW w AS (PARTITION BY session_id ORDER BY action_time, action_id)) x
WHERE next_id IS NOT NULL"""))
def q_page_pairs(spark, sf):
    return pf.page_pairs(src.actions(spark, sf))


_FLOW2 = "2,4,6,8,1,3"


@register("chained_ratio", ov.sql(["actions"], "SELECT * FROM ratios WHERE pos > 0",
                                  _conversion_ctes("actions", _FLOW2)))
def q_chained_ratio(spark, sf):
    return rp.page_conversion(src.actions(spark, sf), _FLOW2)


@register("top10_categories", ov.sql(["actions"], "SELECT * FROM top10", _funnel_ctes("actions")))
def q_top10_categories(spark, sf):
    return cat.top_categories(cat.category_funnel_counts(src.actions(spark, sf)))


# ---------------------------------------------------------------- R: sampling

@register("extract_quota", ov.sql(["actions"], "SELECT * FROM quotas", _HOURLY))
def q_extract_quota(spark, sf):
    hourly = ses.sessions_per_hour(ses.session_rollup(src.actions(spark, sf)))
    return sampling.extract_quota(hourly, SAMPLE_TOTAL)


@register("random_extract", ov.sql(["actions"], _extract_sql("sessions"), _HOURLY))
def q_random_extract(spark, sf):
    s = ses.session_rollup(src.actions(spark, sf))
    return ses.session_output(sampling.sample_sessions(s, SAMPLE_TOTAL, SAMPLE_SEED))


# ---------------------------------------------------------------- A: sinks and the SQL path



@register("temp_view", ORACLES["report_area_top3"])
def q_temp_view(spark, sf):
    return rp.report_area_top3_sql(spark, sf, START, END)


@register("replace_table", ORACLES["report_area_top3"])
def q_replace_table(spark, sf):
    path = scratch_path(spark, "area_top3_product")
    report = rp.report_area_top3(spark, sf, START, END)
    sinks.replace_table(report, path)
    sinks.replace_table(report, path)          # second run replaces, never appends
    return spark.read.parquet(path)
