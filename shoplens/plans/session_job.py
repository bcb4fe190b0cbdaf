"""P1-P4 as one job: one scan of the actions feeds four reports.

The scan is summed up once, at the grain (session, kind, item):

    kind "session"   one row per session: user, first and last time, actions
    kind "category"  clicks, orders and payments of a category in a session
    kind "keyword"   a keyword that the session searched for

Keywords and categories are rows, not lists inside a session's row: a
session with a million keywords is a million small groups over all tasks,
and no aggregate holds more than a fixed number of values. The table is
written once, by kind; the filtered sessions are written once more, and the
reports read those. Filters on keywords or categories are semi joins with
the item rows (D2, D3); texts are put together only for drawn sessions.

Every report carries the run's task id in its first column and is bound to
its record type.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens import schemas
from shoplens.config import store
from shoplens.functions.filters import SessionFilter, filter_sessions, filter_values
from shoplens.functions.scalar import is_not_empty, seconds_between
from shoplens.operators import categories as cat
from shoplens.operators import sampling
from shoplens.operators import sessions as ses
from shoplens.operators.joins import bounded_broadcast
from shoplens.plans.reports import top_category_clicks
from shoplens.sources.sinks import new_task_id, with_task_id


def session_items(actions: DataFrame) -> DataFrame:
    """The table above: session_id, kind, item and its sums, from one pass over the actions."""
    def row(kind: str, item: Column, **more: Column) -> Column:
        values = {"click": F.lit(0), "order": F.lit(0), "pay": F.lit(0), "named": F.lit(False)} | more
        return F.struct(F.lit(kind).alias("kind"), item.cast("string").alias("item"), *[v.alias(k) for k, v in values.items()])

    def listed(ids: Column, kind: str, code: int) -> Column:
        return F.transform(ids, lambda x: row("category", x, **{kind: F.lit(1)}, named=F.coalesce(named == code, F.lit(False))))

    named = cat.universe_kind()
    rows = F.concat(
        F.array(row("session", F.lit(None))),
        F.when(is_not_empty("search_keyword"), F.array(row("keyword", F.col("search_keyword")))).otherwise(F.array()),
        listed(cat.clicked_ids(), "click", cat.CLICK), listed(cat.listed_ids("order_category_ids"), "order", cat.ORDER),
        listed(cat.listed_ids("pay_category_ids"), "pay", cat.PAY))
    each = actions.select("session_id", "user_id", "action_time", F.inline(rows)).filter("kind = 'session' OR item IS NOT NULL")
    return each.groupBy("session_id", "kind", "item").agg(
        F.min("user_id").alias("user_id"), F.min("action_time").alias("start_time"), F.max("action_time").alias("end_time"),
        F.count(F.lit(1)).alias("step_length"),
        *[F.sum(c).cast("bigint").alias(f"{c}_count") for c in ("click", "order", "pay")],
        F.max("named").cast("int").alias("in_universe"))


def kept_sessions(items: DataFrame, users: DataFrame, params: SessionFilter) -> DataFrame:
    """C1 + B4 on the item table: sessions that satisfy every given parameter."""
    s = items.filter("kind = 'session'").select(
        "session_id", "user_id", "start_time", "end_time", "step_length",
        seconds_between("start_time", "end_time").alias("visit_length"))
    s = filter_sessions(ses.join_session_user(s, users), replace(params, keywords=None, category_ids=None))
    clicked = (F.col("kind") == "category") & (F.col("click_count") > 0) & (F.col("item") != "-1")
    searched = (F.col("kind") == "keyword") & (F.col("item") != "-1")
    for values, of_kind in ((filter_values(params.keywords), searched), (filter_values(params.category_ids), clicked)):
        if values:
            hit = items.filter(of_kind & F.col("item").isin(values)).select("session_id").distinct()
            s = s.join(hit, "session_id", "left_semi")
    return s.select("session_id", "start_time", "step_length", "visit_length")


def with_texts(drawn: DataFrame, items: DataFrame) -> DataFrame:
    """D2, D3 of a bounded number of sessions: their sorted keywords and clicked categories as text."""
    ids = bounded_broadcast(drawn.select("session_id"))
    own = items.filter("kind = 'keyword' OR (kind = 'category' AND click_count > 0)").join(ids, "session_id", "left_semi")
    words = F.collect_list(F.when(F.col("kind") == "keyword", F.col("item")))
    numbers = F.collect_list(F.when(F.col("kind") == "category", F.col("item").cast("bigint")))
    text = own.groupBy("session_id").agg(
        F.nullif(F.array_join(F.array_sort(words), ","), F.lit("")).alias("search_keywords"),
        F.nullif(F.array_join(F.transform(F.array_sort(numbers), lambda x: x.cast("string")), ","), F.lit(""))
        .alias("click_category_ids"))
    return drawn.join(text, "session_id", "left")


def run_session_job(actions: DataFrame, users: DataFrame, params: SessionFilter, total: int = 100,
                    seed: str = "shoplens", task_id: str | None = None, n: int = 10,
                    per_category: int = 10) -> dict[str, DataFrame]:
    """P1-P4 of one run: report name -> rows of its record type, task id first."""
    task_id = task_id or new_task_id()
    items = store(session_items(actions), "session_items", partition_by=["kind"])
    sessions = store(kept_sessions(items, users, params), "kept_sessions")
    drawn = sampling.sample_sessions(sessions.select("session_id", "start_time"), total, seed)
    counts = (items.filter("kind = 'category'").join(sessions.select("session_id"), "session_id", "left_semi")
              .select(F.col("item").cast("bigint").alias("category_id"), "session_id", "click_count", "order_count",
                      "pay_count", "in_universe"))
    top = cat.top_categories(cat.funnel_from_sessions(counts), n)
    reports = {
        "session_ratio": (ses.session_ratio(sessions), schemas.SESSION_AGGR_STAT),
        "random_extract": (ses.session_output(with_texts(drawn, items)), schemas.SESSION_RANDOM_EXTRACT),
        "top10_category": (top, schemas.TOP10_CATEGORY),
        "top10_session": (cat.top_sessions_per_category(top_category_clicks(counts, top), per_category),
                          schemas.TOP10_SESSION)}
    return {name: schemas.conform(with_task_id(df, task_id), schemas.of_task(schema))
            for name, (df, schema) in reports.items()}
