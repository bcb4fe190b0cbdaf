"""Report pipelines P1-P6 composed from the operators (P7-P9: ``streaming``)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.filters import SessionFilter
from shoplens.operators import categories as cat
from shoplens.operators import pageflow as pf
from shoplens.operators import regions, sampling
from shoplens.operators.joins import bounded_broadcast
from shoplens.operators import sessions as ses
from shoplens.sources import tables as src

# Time compression of the derived view used by the session-length reports.
SESSION_LENGTH_DIVISOR = 40


def filtered_sessions(spark: SparkSession, sf_dir: str, start: str, end: str,
                      params: SessionFilter, time_divisor: int = 1) -> tuple[DataFrame, DataFrame]:
    """A1 -> D1 -> C1 -> B4; returns (actions, filtered sessions)."""
    actions = src.actions(spark, sf_dir, time_divisor, start, end)
    return actions, ses.filtered_sessions(actions, src.users(spark, sf_dir), params)


def report_session_ratio(spark: SparkSession, sf_dir: str, start: str, end: str,
                         params: SessionFilter) -> DataFrame:
    """A1 -> D1 -> C1 -> B4 -> D4 + D5 + D6."""
    _, s = filtered_sessions(spark, sf_dir, start, end, params, SESSION_LENGTH_DIVISOR)
    return ses.session_ratio(s)


def report_random_extract(spark: SparkSession, sf_dir: str, start: str, end: str,
                          params: SessionFilter, total: int = 100, seed: str = "shoplens") -> DataFrame:
    """... B4 -> D13 -> R1 -> R2.

    The draw sees ids and start times; keywords and categories are gathered
    for the drawn sessions, at most ``total``, from their own actions.
    """
    actions, s = filtered_sessions(spark, sf_dir, start, end, params)
    drawn = bounded_broadcast(sampling.sample_sessions(s.select("session_id", "start_time"), total, seed)
                              .select("session_id"))
    return ses.session_output(ses.session_rollup(actions.join(drawn, "session_id", "left_semi")))


def category_sessions(spark: SparkSession, sf_dir: str, start: str, end: str, params: SessionFilter) -> DataFrame:
    """Funnel counts per (category, session) of the kept sessions.

    The actions are summed up per (category, session) first (partly before
    the shuffle), so the semi join (C2) meets those few rows, not the actions.
    """
    actions, s = filtered_sessions(spark, sf_dir, start, end, params)
    return ses.semi_actions_in_sessions(cat.category_session_funnel(actions), s)


def report_top10_category(spark: SparkSession, sf_dir: str, start: str, end: str,
                          params: SessionFilter, n: int = 10) -> DataFrame:
    """... B4 -> C2 -> D11 -> W6."""
    return cat.top_categories(cat.funnel_from_sessions(category_sessions(spark, sf_dir, start, end, params)), n)


def report_top10_active_session(spark: SparkSession, sf_dir: str, start: str, end: str,
                                params: SessionFilter, n: int = 10, per_category: int = 10) -> DataFrame:
    """P3 -> C7 -> D15 -> W2.

    The top-10 list (D11 -> W6) and the session clicks (D15) come from the
    same (category, session) counts, whose shuffle both read.
    """
    per_session = category_sessions(spark, sf_dir, start, end, params)
    top = cat.top_categories(cat.funnel_from_sessions(per_session), n)
    return cat.top_sessions_per_category(top_category_clicks(per_session, top), per_category)


def top_category_clicks(per_session: DataFrame, top: DataFrame) -> DataFrame:
    """C7 on counts: clicks per (category, session) of the top categories (``top`` is a top-n)."""
    clicks = (per_session.filter(F.col("click_count") > 0)
              .select("category_id", "session_id", F.col("click_count").cast("bigint").alias("click_count")))
    return clicks.join(bounded_broadcast(top.select("category_id")), "category_id", "left_semi")


def page_conversion(actions: DataFrame, flow: str, chunks: int | None = None) -> DataFrame:
    """W3 -> D16 + D17 -> W4 on an action table (``chunks``: see ``pageflow``)."""
    return pf.ratios_from_counts(pf.flow_counts(actions, flow, chunks))


def report_page_conversion(spark: SparkSession, sf_dir: str, start: str, end: str,
                           flow: str = "1,2,3,4,5,6,7") -> DataFrame:
    """P5: A1 -> W3 -> D16 + D17 -> W4 (long form: pos, pair, count, ratio)."""
    return page_conversion(src.actions(spark, sf_dir, 1, start, end), flow)


def report_page_conversion_text(spark: SparkSession, sf_dir: str, start: str, end: str,
                                flow: str = "1,2,3,4,5,6,7") -> DataFrame:
    """P5 in the stored form: one string ``1_2=r|2_3=r``."""
    return pf.render_ratios(report_page_conversion(spark, sf_dir, start, end, flow))


def report_area_top3(spark: SparkSession, sf_dir: str, start: str, end: str, n: int = 3) -> DataFrame:
    """A2 -> C4 -> D18 -> C5 -> B6 -> W1 -> B5."""
    clicks = src.click_actions(spark, sf_dir, start, end)
    click_city = regions.join_click_city(clicks, src.cities(spark, sf_dir))
    counts = regions.area_product_clicks(click_city)
    full = regions.join_area_product(counts, src.products(spark, sf_dir))
    return regions.area_top3(full, n)


def report_area_top3_sql(spark: SparkSession, sf_dir: str, start: str, end: str, n: int = 3) -> DataFrame:
    """P6 on the SQL path (A10): the joined counts as a temp view, ranked in SQL.

    The view lives as long as the query is being analysed; ``n`` is a bound
    parameter, never text.
    """
    clicks = regions.join_click_city(src.click_actions(spark, sf_dir, start, end), src.cities(spark, sf_dir))
    counts = regions.join_area_product(regions.area_product_clicks(clicks), src.products(spark, sf_dir))
    view = f"area_counts_{uuid.uuid4().hex}"
    counts.createOrReplaceTempView(view)
    try:
        ranked = spark.sql(f"""
            WITH placed AS (SELECT *, row_number() OVER (PARTITION BY area_name ORDER BY click_count DESC, product_id) AS place
                            FROM {view})
            SELECT * FROM placed WHERE place <= :n""", args={"n": n})
    finally:
        spark.catalog.dropTempView(view)
    return regions.graded(ranked)
