"""Session summaries and their distributions.

``session_rollup`` is one hash aggregate keyed by ``session_id``; every
aggregate in it (min, max, count, collect_set over a bounded domain) has
a partial form, so a session holding a large share of the rows is
combined map-side and never shipped to one task as raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.filters import SessionFilter, filter_sessions
from shoplens.functions.scalar import (format_date, format_time, is_not_empty,
                                       ratio, seconds_between)

# Visit-length buckets in seconds, (name, low, high) with
# ``low < x <= high`` (high None = open); the first four start at whole seconds.
VISIT_LENGTH_BUCKETS = [
    ("1s_3s", 0, 3), ("4s_6s", 3, 6), ("7s_9s", 6, 9), ("10s_30s", 9, 30),
    ("30s_60s", 30, 60), ("1m_3m", 60, 180), ("3m_10m", 180, 600),
    ("10m_30m", 600, 1800), ("30m", 1800, None),
]
# Step-count buckets, same convention.
STEP_LENGTH_BUCKETS = [
    ("1_3", 0, 3), ("4_6", 3, 6), ("7_9", 6, 9), ("10_30", 9, 30),
    ("30_60", 30, 60), ("60", 60, None),
]


def _bucket(col: Column, buckets) -> Column:
    expr = None
    for name, lo, hi in buckets:
        cond = col > lo if hi is None else (col > lo) & (col <= hi)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr


def visit_length_bucket(col) -> Column:
    """D4 bucket name of a visit length in whole seconds; 0 s is in none."""
    return _bucket(F.col(col) if isinstance(col, str) else col, VISIT_LENGTH_BUCKETS)


def step_length_bucket(col) -> Column:
    """D5 bucket name of a step count."""
    return _bucket(F.col(col) if isinstance(col, str) else col, STEP_LENGTH_BUCKETS)


def _ids_text(arr: Column) -> Column:
    return F.nullif(F.array_join(F.transform(F.array_sort(arr), lambda x: x.cast("string")), ","),
                    F.lit(""))


def session_rollup(actions: DataFrame) -> DataFrame:
    """One row per session.

    user_id (lowest), start/end time, step count, visit length in whole
    seconds, sorted distinct non-empty keywords and clicked categories
    (comma-joined; NULL when none), plus the category ids as an array.
    """
    kw = F.when(is_not_empty("search_keyword"), F.col("search_keyword"))
    cat = F.nullif(F.col("click_category_id"), F.lit(-1))
    s = actions.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        F.count(F.lit(1)).alias("step_length"),
        F.collect_set(kw).alias("_kw"),
        F.collect_set(cat).alias("_cat"),
    )
    return s.select(
        "session_id", "user_id", "start_time", "end_time", "step_length",
        seconds_between("start_time", "end_time").alias("visit_length"),
        F.nullif(F.array_join(F.array_sort("_kw"), ","), F.lit("")).alias("search_keywords"),
        _ids_text(F.col("_cat")).alias("click_category_ids"),
        F.array_sort("_cat").alias("click_category_array"),
    )


def join_session_user(summary: DataFrame, users: DataFrame) -> DataFrame:
    """Sessions with their user's columns (inner: unknown users drop).

    Both sides grow with the data, so the planner chooses the strategy;
    AQE splits a skewed user key.
    """
    u = users.select("user_id", "age", "professional", "city", "sex")
    return summary.join(u, "user_id", "inner")


def filtered_sessions(actions: DataFrame, users: DataFrame, params: SessionFilter) -> DataFrame:
    """D1 -> C1 -> B4."""
    return filter_sessions(join_session_user(session_rollup(actions), users), params)


def semi_actions_in_sessions(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Actions whose session is in ``sessions`` (left semi join)."""
    return actions.join(sessions.select("session_id"), "session_id", "left_semi")


def visit_length_histogram(sessions: DataFrame) -> DataFrame:
    """Sessions per visit-length bucket (sessions of 0 s are in none)."""
    b = visit_length_bucket("visit_length")
    return (sessions.select(b.alias("bucket")).filter(F.col("bucket").isNotNull())
            .groupBy("bucket").agg(F.count(F.lit(1)).alias("session_count")))


def step_length_histogram(sessions: DataFrame) -> DataFrame:
    """Sessions per step-count bucket."""
    b = step_length_bucket("step_length")
    return (sessions.select(b.alias("bucket")).filter(F.col("bucket").isNotNull())
            .groupBy("bucket").agg(F.count(F.lit(1)).alias("session_count")))


def session_ratio(sessions: DataFrame) -> DataFrame:
    """One row, the session count and each bucket's share (HALF_UP, 2 places).

    A single global aggregate of conditional sums (partial per task, one
    tiny final merge). Empty input gives no row.
    """
    vb, sb = visit_length_bucket("visit_length"), step_length_bucket("step_length")
    aggs = [F.count(F.lit(1)).alias("session_count")]
    aggs += [F.sum(F.when(vb == n, 1).otherwise(0)).alias(f"_v_{n}") for n, _, _ in VISIT_LENGTH_BUCKETS]
    aggs += [F.sum(F.when(sb == n, 1).otherwise(0)).alias(f"_s_{n}") for n, _, _ in STEP_LENGTH_BUCKETS]
    totals = sessions.agg(*aggs).filter(F.col("session_count") > 0)
    cols = [F.col("session_count")]
    cols += [ratio(f"_v_{n}", "session_count").alias(f"visit_length_{n}") for n, _, _ in VISIT_LENGTH_BUCKETS]
    cols += [ratio(f"_s_{n}", "session_count").alias(f"step_length_{n}") for n, _, _ in STEP_LENGTH_BUCKETS]
    return totals.select(*cols)


def session_ratio_long(sessions: DataFrame) -> DataFrame:
    """D6 long form: (measure, bucket, ratio) rows of the one-row report."""
    wide = session_ratio(sessions)
    items = [F.struct(F.lit("visit_length").alias("measure"), F.lit(n).alias("bucket"),
                      F.col(f"visit_length_{n}").alias("ratio")) for n, _, _ in VISIT_LENGTH_BUCKETS]
    items += [F.struct(F.lit("step_length").alias("measure"), F.lit(n).alias("bucket"),
                       F.col(f"step_length_{n}").alias("ratio")) for n, _, _ in STEP_LENGTH_BUCKETS]
    return wide.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def counter_map(sessions: DataFrame) -> DataFrame:
    """The name -> count map of the session accumulator, as rows.

    Names: ``session_count`` and every bucket a session falls in; merged
    across tasks by a partial + final hash aggregate.
    """
    names = F.array(F.lit("session_count"), visit_length_bucket("visit_length"),
                    step_length_bucket("step_length"))
    return (sessions.select(F.explode(names).alias("name")).filter(F.col("name").isNotNull())
            .groupBy("name").agg(F.count(F.lit(1)).alias("count")))


def sessions_per_hour(sessions: DataFrame) -> DataFrame:
    """Sessions per (date, hour) of their start time."""
    return (sessions.select(format_date("start_time").alias("date"),
                            F.date_format("start_time", "HH").alias("hour"))
            .groupBy("date", "hour").agg(F.count(F.lit(1)).alias("hour_count")))


def sessions_per_day(hourly: DataFrame) -> DataFrame:
    """Adds the day total and the number of days to the hourly counts.

    The hourly table is bounded by the date range (24 rows a day), so the
    un-partitioned window for the day count runs on a handful of rows.
    """
    by_day = Window.partitionBy("date")
    all_rows = Window.partitionBy()
    first_hour = F.row_number().over(Window.partitionBy("date").orderBy("hour")) == 1
    return (hourly.withColumn("day_count", F.sum("hour_count").over(by_day))
            .withColumn("_first", first_hour.cast("int"))
            .withColumn("num_days", F.sum("_first").over(all_rows))
            .drop("_first"))


def session_output(sessions: DataFrame) -> DataFrame:
    """Report view of a session: id, start time text, keywords, categories."""
    return sessions.select("session_id", format_time("start_time").alias("start_time"),
                           "search_keywords", "click_category_ids")
