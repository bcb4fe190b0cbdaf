"""Registered report queries P1-P6 with their DuckDB oracles, and the SQL
building blocks the operator-level oracles reuse."""

from __future__ import annotations

from shoplens.functions.filters import SessionFilter
from shoplens.plans import oracle_views as ov
from shoplens.plans import reports as rp
from shoplens.plans.registry import register
from shoplens.plans.session_job import run_session_job
from shoplens.sources import tables as src

# Task parameters used by the registered queries.
START, END = "2024-01-01", "2024-01-31"          # whole month: every report
SCAN_START, SCAN_END = "2024-01-03", "2024-01-27"  # the range scan's own check

# --------------------------------------------------------------------------
# P6 regional top 3 (the flagship)

AREA_LEVEL_SQL = ("CASE WHEN area_name IN ('AMERICA', 'EUROPE') THEN 'A' "
                  "WHEN area_name IN ('ASIA') THEN 'B' WHEN area_name IN ('AFRICA') THEN 'C' "
                  "ELSE 'D' END")

_CLICKS_SQL = f"""
  SELECT city_id, click_product_id AS product_id FROM actions
  WHERE date >= DATE '{START}' AND date <= DATE '{END}'
    AND click_product_id IS NOT NULL AND click_product_id <> -1"""
_CLICK_CITY_SQL = """
  SELECT c.city_id, c.product_id, ci.city_name, ci.area_name
  FROM clicks c JOIN cities ci ON c.city_id = ci.city_id"""
_APC_SQL = """
  SELECT area_name, product_id, count(*) AS click_count,
         nullif(array_to_string(list_sort(list_distinct(list(concat_ws(':', CAST(city_id AS VARCHAR), city_name)))), ','), '')
           AS city_infos
  FROM click_city GROUP BY area_name, product_id"""
_FULL_SQL = """
  SELECT a.area_name, a.product_id, a.click_count, a.city_infos, p.product_name,
         CASE WHEN json_extract_string(p.extend_info, '$.product_status') = '0' THEN 'Self'
              ELSE 'Third Party' END AS product_status
  FROM area_counts a JOIN products p ON a.product_id = p.product_id"""
_P6_CTES = [("clicks", _CLICKS_SQL), ("click_city", _CLICK_CITY_SQL),
            ("area_counts", _APC_SQL), ("full_info", _FULL_SQL)]


@register("report_area_top3", ov.sql(["actions", "cities", "products"], f"""
SELECT area_name AS area, {AREA_LEVEL_SQL} AS area_level, product_id, product_name,
       click_count, city_infos, product_status
FROM (SELECT *, row_number() OVER (PARTITION BY area_name ORDER BY click_count DESC, product_id) AS rn
      FROM full_info) t
WHERE rn <= 3""", _P6_CTES))
def q_report_area_top3(spark, sf):
    return rp.report_area_top3(spark, sf, START, END)



# --------------------------------------------------------------------------
# Session reports P1-P4 and their operators


# The reference task's sample filter: ages 20-50, everything else open.
REPORT_FILTER = SessionFilter(start_age=20, end_age=50)
# A filter that uses every parameter (B4's own check).
FULL_FILTER = SessionFilter(start_age=10, end_age=55, professionals="BUILDING,MACHINERY,HOUSEHOLD",
                            cities="NATION_1,NATION_2,NATION_3,NATION_5,NATION_8,NATION_13,NATION_21",
                            sex="female", keywords="kw1,kw3,kw5,kw7", category_ids="1,2,3,5,8,13,21,34,55,89")
SAMPLE_TOTAL = 1500
SAMPLE_SEED = "shoplens"
TARGET_FLOW = "1,2,3,4,5,6,7"
D40 = 40

_SESSIONS_SQL = """
  SELECT session_id, min(user_id) AS user_id, min(action_time) AS start_time, max(action_time) AS end_time,
         count(*) AS step_length,
         date_diff('second', min(action_time), max(action_time)) AS visit_length,
         nullif(array_to_string(list_sort(list_distinct(list(CASE WHEN search_keyword <> '' THEN search_keyword END))), ','), '')
           AS search_keywords,
         nullif(array_to_string(list_sort(list_distinct(list(nullif(click_category_id, -1)))), ','), '')
           AS click_category_ids
  FROM actions GROUP BY session_id"""


def _in_list(values: str) -> str:
    return ", ".join("'" + v + "'" for v in values.split(","))


def _filtered_sql(p: SessionFilter) -> str:
    conds = ["TRUE"]
    if p.start_age is not None and p.end_age is not None:
        conds.append(f"u.age BETWEEN {p.start_age} AND {p.end_age}")
    for col, vals in (("u.professional", p.professionals), ("u.city", p.cities), ("u.sex", p.sex)):
        if vals:
            conds.append(f"{col} IN ({_in_list(vals)})")
    for col, vals in (("s.search_keywords", p.keywords), ("s.click_category_ids", p.category_ids)):
        if vals:
            conds.append(f"list_has_any(string_split({col}, ','), [{_in_list(vals)}])")
    where = " AND ".join(conds)
    return f"""
  SELECT s.*, u.age, u.professional, u.city, u.sex
  FROM sessions s JOIN users u ON s.user_id = u.user_id
  WHERE {where}"""


# Written by hand from the survey's table, not from the library's constants.
VISIT_BUCKET_SQL = """CASE WHEN visit_length BETWEEN 1 AND 3 THEN '1s_3s'
  WHEN visit_length BETWEEN 4 AND 6 THEN '4s_6s' WHEN visit_length BETWEEN 7 AND 9 THEN '7s_9s'
  WHEN visit_length BETWEEN 10 AND 30 THEN '10s_30s' WHEN visit_length BETWEEN 31 AND 60 THEN '30s_60s'
  WHEN visit_length BETWEEN 61 AND 180 THEN '1m_3m' WHEN visit_length BETWEEN 181 AND 600 THEN '3m_10m'
  WHEN visit_length BETWEEN 601 AND 1800 THEN '10m_30m' WHEN visit_length >= 1801 THEN '30m' END"""
STEP_BUCKET_SQL = """CASE WHEN step_length BETWEEN 1 AND 3 THEN '1_3' WHEN step_length BETWEEN 4 AND 6 THEN '4_6'
  WHEN step_length BETWEEN 7 AND 9 THEN '7_9' WHEN step_length BETWEEN 10 AND 30 THEN '10_30'
  WHEN step_length BETWEEN 31 AND 60 THEN '30_60' WHEN step_length >= 61 THEN '60' END"""
_VISIT_NAMES = ("1s_3s", "4s_6s", "7s_9s", "10s_30s", "30s_60s", "1m_3m", "3m_10m", "10m_30m", "30m")
_STEP_NAMES = ("1_3", "4_6", "7_9", "10_30", "30_60", "60")


def _ratio_sql(n: str, d: str) -> str:
    # HALF_UP to 2 places on the exact fraction n/d (DuckDB's round differs on ties).
    return f"CAST((200 * ({n}) + ({d})) // (2 * ({d})) AS DOUBLE) / 100.0"


def _session_ratio_sql(src_table: str) -> str:
    cols = ["count(*) AS session_count"]
    for name in _VISIT_NAMES:
        cols.append(_ratio_sql(f"count(*) FILTER (WHERE vb = '{name}')", "count(*)") + f" AS visit_length_{name}")
    for name in _STEP_NAMES:
        cols.append(_ratio_sql(f"count(*) FILTER (WHERE sb = '{name}')", "count(*)") + f" AS step_length_{name}")
    return (f"SELECT {', '.join(cols)} FROM (SELECT *, {VISIT_BUCKET_SQL} AS vb, {STEP_BUCKET_SQL} AS sb "
            f"FROM {src_table}) x HAVING count(*) > 0")


def _actions_in_range(start=START, end=END):
    return f"SELECT * FROM actions WHERE date >= DATE '{start}' AND date <= DATE '{end}'"


_RANGE_CTES = [("ra", _actions_in_range())]
_SESS_OVER_RANGE = _SESSIONS_SQL.replace("FROM actions", "FROM ra")

_TIME = "'%Y-%m-%d %H:%M:%S'"


@register("report_session_ratio", ov.sql(["actions", "users"], _session_ratio_sql("fs"),
          _RANGE_CTES + [("sessions", _SESS_OVER_RANGE), ("fs", _filtered_sql(REPORT_FILTER))], d=D40))
def q_report_session_ratio(spark, sf):
    return rp.report_session_ratio(spark, sf, START, END, REPORT_FILTER)


def _quota_ctes(src_table: str, total: int):
    return [
        ("hourly", f"""
  SELECT strftime(start_time, '%Y-%m-%d') AS date, strftime(start_time, '%H') AS hour, count(*) AS hour_count
  FROM {src_table} GROUP BY 1, 2"""),
        ("daily", """
  SELECT *, sum(hour_count) OVER (PARTITION BY date) AS day_count,
         (SELECT count(DISTINCT date) FROM hourly) AS num_days
  FROM hourly"""),
        ("quotas", f"""
  SELECT date, hour, hour_count, CAST(day_count AS BIGINT) AS day_count, num_days,
         CAST({total} // num_days AS BIGINT) AS per_day,
         CAST(least((hour_count * ({total} // num_days)) // day_count, hour_count) AS BIGINT) AS quota
  FROM daily"""),
    ]


def _extract_sql(src_table: str) -> str:
    return f"""
SELECT session_id, strftime(start_time, {_TIME}) AS start_time, search_keywords, click_category_ids
FROM (
  SELECT s.*, q.quota,
         row_number() OVER (PARTITION BY q.date, q.hour ORDER BY md5('{SAMPLE_SEED}' || s.session_id), s.session_id) AS rn
  FROM {src_table} s
  JOIN quotas q ON strftime(s.start_time, '%Y-%m-%d') = q.date AND strftime(s.start_time, '%H') = q.hour
) t WHERE rn <= quota"""


@register("report_random_extract", ov.sql(["actions", "users"], _extract_sql("fs"),
          _RANGE_CTES + [("sessions", _SESS_OVER_RANGE), ("fs", _filtered_sql(REPORT_FILTER))]
          + _quota_ctes("fs", SAMPLE_TOTAL)))
def q_report_random_extract(spark, sf):
    return rp.report_random_extract(spark, sf, START, END, REPORT_FILTER, SAMPLE_TOTAL, SAMPLE_SEED)


def _funnel_ctes(src_table: str):
    return [
        ("fa", f"""
  SELECT *, CASE WHEN nullif(click_category_id, -1) IS NOT NULL THEN 0
                 WHEN order_category_ids IS NOT NULL THEN 1
                 WHEN pay_category_ids IS NOT NULL THEN 2 END AS ukind
  FROM {src_table}"""),
        ("tagged", """
  SELECT ukind, 0 AS kind, nullif(click_category_id, -1) AS cid FROM fa
  UNION ALL
  SELECT ukind, 1 AS kind, TRY_CAST(tok AS BIGINT) AS cid
  FROM (SELECT ukind, unnest(string_split(order_category_ids, ',')) AS tok FROM fa) o WHERE tok <> ''
  UNION ALL
  SELECT ukind, 2 AS kind, TRY_CAST(tok AS BIGINT) AS cid
  FROM (SELECT ukind, unnest(string_split(pay_category_ids, ',')) AS tok FROM fa) p WHERE tok <> ''"""),
        ("funnel", """
  SELECT cid AS category_id,
         count(*) FILTER (WHERE kind = 0) AS click_count,
         count(*) FILTER (WHERE kind = 1) AS order_count,
         count(*) FILTER (WHERE kind = 2) AS pay_count
  FROM tagged WHERE cid IS NOT NULL
  GROUP BY cid HAVING max(CASE WHEN kind = ukind THEN 1 ELSE 0 END) = 1"""),
        ("top10", """
  SELECT * FROM funnel ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10"""),
    ]


_P3_CTES = (_RANGE_CTES + [("sessions", _SESS_OVER_RANGE), ("fs", _filtered_sql(REPORT_FILTER)),
                           ("kept", "  SELECT * FROM ra WHERE session_id IN (SELECT session_id FROM fs)")]
            + _funnel_ctes("kept"))


@register("report_top10_category", ov.sql(["actions", "users"], "SELECT * FROM top10", _P3_CTES))
def q_report_top10_category(spark, sf):
    return rp.report_top10_category(spark, sf, START, END, REPORT_FILTER)


def _top_sessions_sql(src_table: str, top_table: str | None) -> str:
    semi = f"AND nullif(click_category_id, -1) IN (SELECT category_id FROM {top_table})" if top_table else ""
    return f"""
SELECT category_id, session_id, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS rn
  FROM (SELECT nullif(click_category_id, -1) AS category_id, session_id, count(*) AS click_count
        FROM {src_table} WHERE nullif(click_category_id, -1) IS NOT NULL {semi}
        GROUP BY 1, 2) c
) t WHERE rn <= 10"""


@register("report_top10_active_session", ov.sql(["actions", "users"], _top_sessions_sql("kept", "top10"), _P3_CTES))
def q_report_top10_active_session(spark, sf):
    return rp.report_top10_active_session(spark, sf, START, END, REPORT_FILTER)


# The flow's steps as SQL values: positions 1.. of neighbouring pages.
_FLOW_VALUES = {
    "1,2,3,4,5,6,7": "(1, 1, 2), (2, 2, 3), (3, 3, 4), (4, 4, 5), (5, 5, 6), (6, 6, 7)",
    "2,4,6,8,1,3": "(1, 2, 4), (2, 4, 6), (3, 6, 8), (4, 8, 1), (5, 1, 3)",
}


def _flow_values(flow: str) -> str:
    return f"SELECT * FROM (VALUES {_FLOW_VALUES[flow]}) v(pos, from_page, to_page)"


def _conversion_ctes(src_table: str, flow: str):
    first = int(flow.split(",")[0])
    return [
        ("pairs", f"""
  SELECT * FROM (
    SELECT page_id, lead(page_id) OVER w AS next_page_id, lead(action_id) OVER w AS next_id
    FROM {src_table} WINDOW w AS (PARTITION BY session_id ORDER BY action_time, action_id)
  ) x WHERE next_id IS NOT NULL"""),
        ("flow", _flow_values(flow)),
        ("pair_counts", """
  SELECT f.pos, CAST(f.from_page AS VARCHAR) || '_' || CAST(f.to_page AS VARCHAR) AS page_pair,
         (SELECT count(*) FROM pairs p WHERE p.page_id = f.from_page AND p.next_page_id = f.to_page) AS pair_count
  FROM flow f"""),
        ("with_start", f"""
  SELECT 0 AS pos, CAST(NULL AS VARCHAR) AS page_pair,
         (SELECT count(*) FROM {src_table} WHERE page_id = {first}) AS pair_count
  UNION ALL SELECT * FROM pair_counts"""),
        ("ratios", """
  SELECT pos, page_pair, pair_count,
         CAST(pair_count AS DOUBLE) / nullif(lag(pair_count) OVER (ORDER BY pos), 0) AS ratio
  FROM with_start"""),
    ]


@register("report_page_conversion", ov.sql(["actions"], "SELECT * FROM ratios WHERE pos > 0",
          _RANGE_CTES + _conversion_ctes("ra", TARGET_FLOW)))
def q_report_page_conversion(spark, sf):
    return rp.report_page_conversion(spark, sf, START, END, TARGET_FLOW)


@register("page_conversion_text", ov.sql(["actions"], """
SELECT string_agg(concat_ws('=', page_pair, CAST(ratio AS VARCHAR)), '|' ORDER BY pos) AS convert_ratio FROM ratios WHERE pos > 0""",
          _RANGE_CTES + _conversion_ctes("ra", TARGET_FLOW)))
def q_page_conversion_text(spark, sf):
    return rp.report_page_conversion_text(spark, sf, START, END, TARGET_FLOW)


# --------------------------------------------------------------------------
# P1-P4 as one job (A6, A13): one run per session and input

TASK_ID = "run-1"
_JOBS: dict = {}


def _session_job(spark, sf: str, name: str):
    key = (spark.sparkContext.applicationId, sf, src.version(spark, sf, "events"))
    if key not in _JOBS:
        _JOBS[key] = run_session_job(src.actions(spark, sf, D40, START, END), src.users(spark, sf), REPORT_FILTER,
                                     SAMPLE_TOTAL, SAMPLE_SEED, TASK_ID)
    return _JOBS[key][name]


def _job_sql(body: str, ctes) -> str:
    return ov.sql(["actions", "users"], f"SELECT '{TASK_ID}' AS task_id, r.* FROM ({body}) r", ctes, d=D40)


_JOB_CTES = _RANGE_CTES + [("sessions", _SESS_OVER_RANGE), ("fs", _filtered_sql(REPORT_FILTER))]


@register("job_session_ratio", _job_sql(_session_ratio_sql("fs"), _JOB_CTES))
def q_job_session_ratio(spark, sf):
    return _session_job(spark, sf, "session_ratio")


@register("job_random_extract", _job_sql(_extract_sql("fs"), _JOB_CTES + _quota_ctes("fs", SAMPLE_TOTAL)))
def q_job_random_extract(spark, sf):
    return _session_job(spark, sf, "random_extract")


@register("job_top10_category", _job_sql("SELECT * FROM top10", _P3_CTES))
def q_job_top10_category(spark, sf):
    return _session_job(spark, sf, "top10_category")


@register("job_top10_session", _job_sql(_top_sessions_sql("kept", "top10"), _P3_CTES))
def q_job_top10_session(spark, sf):
    return _session_job(spark, sf, "top10_session")
