"""Registered queries of the scalar helpers (F rows): each runs the
expression over a whole derived table."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoplens.functions import scalar as fn
from shoplens.operators import ads
from shoplens.operators import sessions as ses
from shoplens.plans import oracle_views as ov
from shoplens.plans.registry import register
from shoplens.plans.report_queries import _SESSIONS_SQL, _TIME
from shoplens.sources import tables as src

_SESS = [("sessions", _SESSIONS_SQL)]
# Start / end times as text with the hour not zero-padded (as the click log writes it).
_UNPADDED_SQL = ("strftime(start_time, '%Y-%m-%d ') || CAST(hour(start_time) AS VARCHAR) || strftime(start_time, ':%M:%S')",
                 "strftime(end_time, '%Y-%m-%d ') || CAST(hour(end_time) AS VARCHAR) || strftime(end_time, ':%M:%S')")


def _texts(spark, sf):
    s = ses.session_rollup(src.actions(spark, sf))
    fmt = "yyyy-MM-dd H:mm:ss"
    return s.select("session_id", F.date_format("start_time", fmt).alias("a"),
                    F.date_format("end_time", fmt).alias("b"))


@register("fn_time_before", ov.sql(["actions"], f"""
SELECT session_id, strptime(a, '%Y-%m-%d %H:%M:%S') < strptime(b, '%Y-%m-%d %H:%M:%S') AS before
FROM (SELECT session_id, {_UNPADDED_SQL[0]} AS a, {_UNPADDED_SQL[1]} AS b FROM sessions) t""", _SESS))
def q_fn_time_before(spark, sf):
    return _texts(spark, sf).select("session_id", fn.time_before("a", "b").alias("before"))


@register("fn_time_after", ov.sql(["actions"], f"""
SELECT session_id, strptime(b, '%Y-%m-%d %H:%M:%S') > strptime(a, '%Y-%m-%d %H:%M:%S') AS after
FROM (SELECT session_id, {_UNPADDED_SQL[0]} AS a, {_UNPADDED_SQL[1]} AS b FROM sessions) t""", _SESS))
def q_fn_time_after(spark, sf):
    return _texts(spark, sf).select("session_id", fn.time_after("b", "a").alias("after"))


@register("fn_time_minus", ov.sql(["actions"],
          "SELECT session_id, date_diff('second', start_time, end_time) AS seconds FROM sessions", _SESS))
def q_fn_time_minus(spark, sf):
    return _texts(spark, sf).select("session_id", fn.time_minus("b", "a").alias("seconds"))


@register("fn_parse_time", ov.sql(["actions"], f"""
SELECT session_id, {_UNPADDED_SQL[0]} AS text,
       strftime(strptime({_UNPADDED_SQL[0]}, '%Y-%m-%d %H:%M:%S'), {_TIME}) AS parsed
FROM sessions""", _SESS))
def q_fn_parse_time(spark, sf):
    t = _texts(spark, sf)
    return t.select("session_id", F.col("a").alias("text"), fn.format_time(fn.parse_time("a")).alias("parsed"))


@register("fn_date_hour", ov.sql(["actions"], "SELECT action_id, strftime(action_time, '%Y-%m-%d_%H') AS date_hour FROM actions"))
def q_fn_date_hour(spark, sf):
    return src.actions(spark, sf).select("action_id", fn.date_hour("action_time").alias("date_hour"))


def _ev(spark, sf):
    return src.table(spark, sf, "events")


@register("fn_format_date", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS date FROM events")
def q_fn_format_date(spark, sf):
    return _ev(spark, sf).select("event_id", fn.format_date("ts").alias("date"))


@register("fn_format_time", f"SELECT event_id, strftime(ts, {_TIME}) AS time FROM events")
def q_fn_format_time(spark, sf):
    return _ev(spark, sf).select("event_id", fn.format_time("ts").alias("time"))


@register("fn_format_date_key", "SELECT event_id, strftime(ts, '%Y%m%d') AS date_key FROM events")
def q_fn_format_date_key(spark, sf):
    return _ev(spark, sf).select("event_id", fn.format_date_key("ts").alias("date_key"))


@register("fn_parse_date_key", """
SELECT event_id, strftime(strptime(strftime(ts, '%Y%m%d'), '%Y%m%d'), '%Y-%m-%d') AS date FROM events""")
def q_fn_parse_date_key(spark, sf):
    return _ev(spark, sf).select("event_id", fn.format_date(fn.parse_date_key(fn.format_date_key("ts"))).alias("date"))


@register("fn_format_minute", "SELECT event_id, strftime(ts, '%Y%m%d%H%M') AS minute_key FROM events")
def q_fn_format_minute(spark, sf):
    return _ev(spark, sf).select("event_id", fn.format_minute_key("ts").alias("minute_key"))


@register("fn_round_half_up", """
SELECT user_id, CAST((200 * clicks + n) // (2 * n) AS DOUBLE) / 100.0 AS click_share
FROM (SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS clicks, count(*) AS n
      FROM events GROUP BY user_id) t""")
def q_fn_round_half_up(spark, sf):
    t = _ev(spark, sf).groupBy("user_id").agg(
        F.sum(F.when(F.col("event_type") == "click", 1).otherwise(0)).alias("clicks"), F.count(F.lit(1)).alias("n"))
    return t.select("user_id", fn.round_half_up(F.col("clicks") / F.col("n"), 2).alias("click_share"))


@register("fn_is_empty", ov.sql(["actions"], """
SELECT action_id, (search_keyword IS NULL OR search_keyword = '') AS is_empty,
       (search_keyword IS NOT NULL AND search_keyword <> '') AS is_not_empty FROM actions"""))
def q_fn_is_empty(spark, sf):
    return src.actions(spark, sf).select("action_id", fn.is_empty("search_keyword").alias("is_empty"),
                                         fn.is_not_empty("search_keyword").alias("is_not_empty"))


@register("fn_trim_comma", ov.sql(["actions"], """
SELECT action_id, regexp_replace(',' || coalesce(order_category_ids, '') || ',', '^,|,$', '', 'g') AS trimmed
FROM actions"""))
def q_fn_trim_comma(spark, sf):
    s = F.concat(F.lit(","), F.coalesce("order_category_ids", F.lit("")), F.lit(","))
    return src.actions(spark, sf).select("action_id", fn.trim_comma(s).alias("trimmed"))


@register("fn_pad2", """
SELECT event_id, CASE WHEN length(h) = 2 THEN h ELSE '0' || h END AS padded
FROM (SELECT event_id, CAST(hour(ts) AS VARCHAR) AS h FROM events) t""")
def q_fn_pad2(spark, sf):
    return _ev(spark, sf).select("event_id", fn.pad2(F.hour("ts").cast("string")).alias("padded"))


_CONCAT_SQL = ("'session_id=' || session_id || '|search_keywords=' || coalesce(search_keywords, '') "
               "|| '|click_category_ids=' || coalesce(click_category_ids, '') || '|step_length=' "
               "|| CAST(step_length AS VARCHAR)")


def _concat(spark, sf):
    s = ses.session_rollup(src.actions(spark, sf))
    return s.select("session_id", F.concat(
        F.lit("session_id="), "session_id", F.lit("|search_keywords="), F.coalesce("search_keywords", F.lit("")),
        F.lit("|click_category_ids="), F.coalesce("click_category_ids", F.lit("")),
        F.lit("|step_length="), F.col("step_length").cast("string")).alias("info"))


@register("fn_get_field", ov.sql(["actions"], f"""
SELECT session_id,
       nullif(regexp_extract(info, '(?:^|\\|)search_keywords=([^=|]+)(?:\\||$)', 1), '') AS search_keywords,
       nullif(regexp_extract(info, '(?:^|\\|)step_length=([^=|]+)(?:\\||$)', 1), '') AS step_length,
       nullif(regexp_extract(info, '(?:^|\\|)missing=([^=|]+)(?:\\||$)', 1), '') AS missing
FROM (SELECT session_id, {_CONCAT_SQL} AS info FROM sessions) t""", _SESS))
def q_fn_get_field(spark, sf):
    c = _concat(spark, sf)
    return c.select("session_id", fn.get_field("info", "search_keywords").alias("search_keywords"),
                    fn.get_field("info", "step_length").alias("step_length"),
                    fn.get_field("info", "missing").alias("missing"))


@register("fn_set_field", ov.sql(["actions"], f"""
SELECT session_id,
       array_to_string(list_transform(string_split(info, '|'),
         lambda t: CASE WHEN split_part(t, '=', 1) = 'step_length' THEN 'step_length=0' ELSE t END), '|') AS info
FROM (SELECT session_id, {_CONCAT_SQL} AS info FROM sessions) t""", _SESS))
def q_fn_set_field(spark, sf):
    c = _concat(spark, sf)
    return c.select("session_id", fn.set_field("info", "step_length", "0").alias("info"))


@register("fn_concat_id_name", ov.sql(["cities"],
          "SELECT city_id, concat_ws(':', CAST(city_id AS VARCHAR), city_name) AS city_info FROM cities"))
def q_fn_concat_id_name(spark, sf):
    return src.cities(spark, sf).select("city_id", fn.concat_id_name("city_id", "city_name").alias("city_info"))


@register("fn_json_field", ov.sql(["products"],
          "SELECT product_id, json_extract_string(extend_info, '$.product_status') AS product_status FROM products"))
def q_fn_json_field(spark, sf):
    return src.products(spark, sf).select("product_id", fn.json_field("extend_info", "product_status")
                                          .alias("product_status"))


@register("fn_csv_to_ids", ov.sql(["actions"], """
SELECT action_id, array_to_string(ids, ',') AS ids, len(ids) AS n_ids
FROM (SELECT action_id, list_transform(list_filter(string_split(order_category_ids, ','), lambda x: x <> ''),
                                        lambda x: TRY_CAST(x AS BIGINT)) AS ids
      FROM actions WHERE order_category_ids IS NOT NULL) t"""))
def q_fn_csv_to_ids(spark, sf):
    a = src.actions(spark, sf).filter(F.col("order_category_ids").isNotNull())
    ids = fn.csv_to_ids("order_category_ids")
    return a.select("action_id", F.array_join(F.transform(ids, lambda x: x.cast("string")), ",").alias("ids"),
                    F.size(ids).cast("bigint").alias("n_ids"))


@register("fn_epoch_millis", ov.sql(["ad_parsed"], """
SELECT CAST(p[1] AS BIGINT) AS time_ms, strftime(epoch_ms(CAST(p[1] AS BIGINT)), '%Y-%m-%d') AS date
FROM ad_parsed WHERE is_valid"""))
def q_fn_epoch_millis(spark, sf):
    p = ads.parse_ad_log(src.ad_log_lines(spark, sf)).filter("is_valid")
    return p.select("time_ms", fn.format_date(fn.epoch_millis_to_date("time_ms")).alias("date"))
