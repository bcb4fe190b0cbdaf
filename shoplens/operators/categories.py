"""Category funnel counts, the top-10 categories and their top sessions.

Preferred plan (D11): one ``explode`` of tagged (kind, category) pairs and
one aggregate with three conditional sums, instead of three counts and
three joins (C3 keeps that shape for comparison). The top-10 list is a
``TakeOrderedAndProject`` (partial top-k per task); its 10 ids are the
only broadcast side (bounded by ``n``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.scalar import csv_to_ids
from shoplens.operators.joins import bounded_broadcast
from shoplens.operators.regions import top_n_per_group

CLICK, ORDER, PAY = 0, 1, 2


def _empty() -> Column:
    return F.array().cast("array<bigint>")


def _click_id() -> Column:
    return F.nullif(F.col("click_category_id"), F.lit(-1))


def clicked_ids() -> Column:
    """The clicked category of an action as an array of one or none."""
    return F.when(_click_id().isNotNull(), F.array(_click_id())).otherwise(_empty())


def listed_ids(col: str) -> Column:
    """The ids of a comma list; none when absent."""
    return F.coalesce(csv_to_ids(col), _empty())


def category_click_count(actions: DataFrame) -> DataFrame:
    """Clicks per category."""
    return (actions.select(_click_id().alias("category_id")).filter(F.col("category_id").isNotNull())
            .groupBy("category_id").agg(F.count(F.lit(1)).alias("click_count")))


def _exploded_count(actions: DataFrame, col: str, out: str) -> DataFrame:
    return (actions.select(F.explode(listed_ids(col)).alias("category_id"))
            .filter(F.col("category_id").isNotNull())
            .groupBy("category_id").agg(F.count(F.lit(1)).alias(out)))


def category_order_count(actions: DataFrame) -> DataFrame:
    """Ordered categories (comma list, every token counts) per category."""
    return _exploded_count(actions, "order_category_ids", "order_count")


def category_pay_count(actions: DataFrame) -> DataFrame:
    """Paid categories per category."""
    return _exploded_count(actions, "pay_category_ids", "pay_count")


def universe_kind() -> Column:
    # The action's first kind in priority order: click, else order, else pay.
    return (F.when(_click_id().isNotNull(), CLICK)
            .when(F.col("order_category_ids").isNotNull(), ORDER)
            .when(F.col("pay_category_ids").isNotNull(), PAY))


def category_universe(actions: DataFrame) -> DataFrame:
    """Distinct categories an action names under the priority rule."""
    kind = universe_kind()
    ids = (F.when(kind == CLICK, F.array(_click_id()))
           .when(kind == ORDER, listed_ids("order_category_ids"))
           .when(kind == PAY, listed_ids("pay_category_ids")))
    return (actions.select(F.explode(ids).alias("category_id"))
            .filter(F.col("category_id").isNotNull()).distinct())


def left_join_category_counts(actions: DataFrame) -> DataFrame:
    """Universe LEFT JOIN click, order and pay counts; missing counts are 0."""
    u = category_universe(actions)
    out = (u.join(category_click_count(actions), "category_id", "left")
           .join(category_order_count(actions), "category_id", "left")
           .join(category_pay_count(actions), "category_id", "left"))
    return out.select("category_id",
                      *[F.coalesce(c, F.lit(0)).alias(c) for c in ("click_count", "order_count", "pay_count")])


def category_funnel_counts(actions: DataFrame) -> DataFrame:
    """Universe and the three counts in one pass (same result as C3)."""
    kind = universe_kind()
    tag = lambda arr, k: F.transform(arr, lambda x: F.struct(F.lit(k).alias("kind"), x.alias("cid")))
    pairs = F.concat(tag(clicked_ids(), CLICK), tag(listed_ids("order_category_ids"), ORDER),
                     tag(listed_ids("pay_category_ids"), PAY))
    e = (actions.select(kind.alias("ukind"), F.explode(pairs).alias("p"))
         .select(F.col("p.cid").alias("category_id"), F.col("p.kind").alias("kind"),
                 (F.col("p.kind") == F.col("ukind")).alias("in_universe"))
         .filter(F.col("category_id").isNotNull()))
    agg = e.groupBy("category_id").agg(
        F.sum(F.when(F.col("kind") == CLICK, 1).otherwise(0)).alias("click_count"),
        F.sum(F.when(F.col("kind") == ORDER, 1).otherwise(0)).alias("order_count"),
        F.sum(F.when(F.col("kind") == PAY, 1).otherwise(0)).alias("pay_count"),
        F.max(F.col("in_universe").cast("int")).alias("_u"))
    return agg.filter(F.col("_u") == 1).drop("_u")


def category_session_funnel(actions: DataFrame) -> DataFrame:
    """Funnel counts per (category, session): the common input of D11 and D15.

    ``in_universe`` marks pairs named by the priority kind of some action.
    """
    kind = universe_kind()
    tag = lambda arr, k: F.transform(arr, lambda x: F.struct(F.lit(k).alias("kind"), x.alias("cid")))
    pairs = F.concat(tag(clicked_ids(), CLICK), tag(listed_ids("order_category_ids"), ORDER),
                     tag(listed_ids("pay_category_ids"), PAY))
    e = (actions.select("session_id", kind.alias("ukind"), F.explode(pairs).alias("p"))
         .select("session_id", F.col("p.cid").alias("category_id"), F.col("p.kind").alias("kind"),
                 (F.col("p.kind") == F.col("ukind")).alias("in_universe"))
         .filter(F.col("category_id").isNotNull()))
    return e.groupBy("category_id", "session_id").agg(
        F.sum(F.when(F.col("kind") == CLICK, 1).otherwise(0)).alias("click_count"),
        F.sum(F.when(F.col("kind") == ORDER, 1).otherwise(0)).alias("order_count"),
        F.sum(F.when(F.col("kind") == PAY, 1).otherwise(0)).alias("pay_count"),
        F.max(F.col("in_universe").cast("int")).alias("in_universe"))


def funnel_from_sessions(per_session: DataFrame) -> DataFrame:
    """D11 from the per-(category, session) counts (same result as ``category_funnel_counts``)."""
    agg = per_session.groupBy("category_id").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("click_count", "order_count", "pay_count")],
        F.max("in_universe").alias("_u"))
    return agg.filter(F.col("_u") == 1).drop("_u")


def top_categories(funnel: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` categories by (click, order, pay) descending, ties by id."""
    return funnel.orderBy(F.col("click_count").desc(), F.col("order_count").desc(),
                          F.col("pay_count").desc(), F.col("category_id").asc()).limit(n)


def semi_top_categories(actions: DataFrame, top: DataFrame) -> DataFrame:
    """Click actions whose category is in ``top`` (broadcast: ``top`` is a top-n)."""
    ids = bounded_broadcast(top.select(F.col("category_id").alias("click_category_id")))
    return actions.join(ids, "click_category_id", "left_semi")


def session_category_clicks(actions: DataFrame) -> DataFrame:
    """Clicks per (category, session)."""
    return (actions.select(_click_id().alias("category_id"), "session_id")
            .filter(F.col("category_id").isNotNull())
            .groupBy("category_id", "session_id").agg(F.count(F.lit(1)).alias("click_count")))


def top_sessions_per_category(counts: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` sessions per category by clicks, ties by session id."""
    return top_n_per_group(counts, ["category_id"],
                           [F.col("click_count").desc(), F.col("session_id").asc()], n)
