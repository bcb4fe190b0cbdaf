"""Driver tables and the click-log views derived from them.

The test tables hold no click log, so the reports read views computed
from ``events`` and the TPC-H dimensions (mapping in FIXTURES.md §2).
Every view is a projection or a dimension join: no shuffle of the fact
table happens here, and the date filter reaches the Parquet scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.scalar import ntz_to_epoch_millis
from shoplens.operators.joins import dimension_join, shuffled

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def version(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    """Number, size and newest age of a table's files: what a kept result of it depends on."""
    files = table(spark, sf_dir, name).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    return tuple(files.agg(F.count(F.lit(1)), F.sum("file_size"), F.max("file_modification_time")).first())


def _day_after(day: str) -> str:
    return (_dt.date.fromisoformat(day) + _dt.timedelta(days=1)).isoformat()


def events_between(events: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows with ``start <= day(ts) <= end`` as a half-open range on ``ts``.

    Written on the raw column so Parquet gets ``ts >= start AND ts < end+1``.
    """
    if start is not None:
        events = events.filter(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        events = events.filter(F.col("ts") < F.lit(_day_after(end)).cast("timestamp_ntz"))
    return events


def _k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def actions_from_events(events: DataFrame, time_divisor: int = 1) -> DataFrame:
    """``user_visit_action`` rows derived from ``events``.

    ``time_divisor`` compresses the time of day (``d`` in FIXTURES.md) so
    that session lengths spread over every bucket.
    """
    k = _k()
    uid = F.col("user_id").cast("string")
    day = F.dayofmonth("ts")
    session_id = (F.when(F.col("user_id") % 5 == 0, F.concat(uid, F.lit("_m"), F.month("ts").cast("string")))
                  .when(F.col("user_id") % 5 == 1,
                        F.concat(uid, F.lit("_w"), ((day - 1) / 7).cast("int").cast("string")))
                  .otherwise(F.concat(uid, F.lit("_d"), day.cast("string"))))
    sec_of_day = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    midnight = F.col("ts").cast("date").cast("timestamp_ntz")
    action_time = F.timestamp_add("SECOND", F.floor(sec_of_day / time_divisor), midnight)
    is_ = lambda t: F.col("event_type") == t
    return events.select(
        F.col("event_id").alias("action_id"),
        F.col("ts").cast("date").alias("date"),
        F.col("user_id"),
        session_id.alias("session_id"),
        (k % 10).alias("page_id"),
        action_time.alias("action_time"),
        F.when(is_("view"), F.concat(F.lit("kw"), (k % 12).cast("string"))).alias("search_keyword"),
        F.when(is_("click"), k).alias("click_category_id"),
        F.when(is_("click"), (F.col("event_id") * 7 + k) % 200).alias("click_product_id"),
        F.when(is_("signup"), F.concat_ws(",", k.cast("string"), ((k * 7 + 1) % 100).cast("string")))
        .alias("order_category_ids"),
        F.lit(None).cast("string").alias("order_product_ids"),
        F.when(is_("purchase"), F.concat_ws(",", k.cast("string"), ((k * 3 + 2) % 100).cast("string")))
        .alias("pay_category_ids"),
        F.lit(None).cast("string").alias("pay_product_ids"),
        (F.col("event_id") % 25).alias("city_id"),
    )


def actions(spark: SparkSession, sf_dir: str, time_divisor: int = 1,
            start: str | None = None, end: str | None = None) -> DataFrame:
    """A1 over the derived view: actions with ``start <= date <= end``."""
    ev = events_between(table(spark, sf_dir, "events"), start, end)
    return actions_from_events(ev, time_divisor)


def click_actions(spark: SparkSession, sf_dir: str, start: str | None = None,
                  end: str | None = None) -> DataFrame:
    """A2: (city_id, click_product_id) of clicks in the date range."""
    a = actions(spark, sf_dir, 1, start, end)
    return (a.filter(F.col("click_product_id").isNotNull() & (F.col("click_product_id") != -1))
            .select("city_id", "click_product_id"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: ``user_info`` from customer and nation (one row per user id)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city"))
    joined = dimension_join(c, n, "c_nationkey", "left")
    rows = joined.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        (F.col("c_custkey") % 60).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.col("city"),
        F.when(F.col("c_custkey") % 2 == 0, "male").otherwise("female").alias("sex"),
    )
    # One row per user id (a duplicated id would fan out sessions in C1). The
    # smallest row wins, so the choice is the same on every run and retry.
    rest = [c for c in rows.columns if c != "user_id"]
    return (rows.groupBy("user_id").agg(F.min(F.struct(*rest)).alias("r"))
            .select("user_id", *[F.col(f"r.{c}").alias(c) for c in rest]))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: ``product_info`` from part; ``extend_info`` is a JSON text."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_status": '), (F.col("p_size") % 2).cast("string"), F.lit("}"))
        .alias("extend_info"),
    )


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 over the test tables: nation -> city, region -> area."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("area_name"))
    return dimension_join(n, r, "n_regionkey", "left").select(
        F.col("n_nationkey").cast("bigint").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("area_name"),
    )


def ad_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-click log text lines ``<epoch ms> <province> <city> <user> <ad>``.

    Click events; province = region of the user's nation, city = the
    nation. ``event_id`` is kept so the stream can be replayed in order.
    A user without a customer row yields a malformed line (kept, not dropped).
    """
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == "click")
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey"))
    nat = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey"))
    geo = dimension_join(cust, nat, "c_nationkey", "left")
    j = ev.join(shuffled(geo), "user_id", "left")
    line = F.concat_ws(" ",
                       ntz_to_epoch_millis("ts").cast("string"),
                       F.col("n_regionkey").cast("string"),
                       F.col("c_nationkey").cast("string"),
                       F.col("user_id").cast("string"),
                       (_k() % 20).cast("string"))
    return j.select("event_id", line.alias("value"))
