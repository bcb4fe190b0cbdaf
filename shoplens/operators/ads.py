"""Ad-click log operators (S1, D19, D20, C6, A12) as batch DataFrame functions.

The same functions run on every micro-batch of the stream
(``shoplens.streaming.ad_stream``) and on static tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.scalar import epoch_millis_to_ntz
from shoplens.operators.regions import top_n_per_group

AD_FIELDS = ("time_ms", "province", "city", "user_id", "ad_id")
TEXT_FIELDS = ("province", "city")
#: Epoch milliseconds of the years 1 to 9999 (UTC), the range of a date.
TIME_RANGE = (-62135596800000, 253402300799999)
DAILY_KEYS = ("date", "user_id", "ad_id")
AD_STAT_KEYS = ("date", "province", "city", "ad_id")
TREND_KEYS = ("date", "hour", "minute", "ad_id")
PROVINCE_KEYS = ("date", "province")


def parse_ad_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """Split ``<ms> <province> <city> <user> <ad>`` lines.

    Keeps every input column, adds the five fields (NULL when a number is
    not one; province and city are text) and ``is_valid``: at least five
    fields, numeric user and ad, and a time within ``TIME_RANGE``.
    """
    parts = F.split(F.col(col), " ")
    raw = {n: F.try_element_at(parts, F.lit(i + 1)) for i, n in enumerate(AD_FIELDS)}
    fields = [(raw[n] if n in TEXT_FIELDS else raw[n].try_cast("bigint")).alias(n) for n in AD_FIELDS]
    parsed = lines.select("*", *fields)
    valid = F.col("time_ms").between(*TIME_RANGE)
    for n in AD_FIELDS:
        valid = valid & F.col(n).isNotNull()
    return parsed.withColumn("is_valid", F.coalesce(valid, F.lit(False)))


def ad_time_texts(parsed: DataFrame) -> DataFrame:
    """UTC date / hour / minute texts of the valid lines; null for the others."""
    ntz = F.when(F.col("is_valid"), epoch_millis_to_ntz("time_ms"))
    return (parsed.withColumn("date", F.date_format(ntz, "yyyy-MM-dd"))
            .withColumn("hour", F.date_format(ntz, "HH"))
            .withColumn("minute", F.date_format(ntz, "mm")))


def ad_events(parsed: DataFrame) -> DataFrame:
    """Valid lines with UTC date / hour / minute texts and an event-time column."""
    return (ad_time_texts(parsed).filter("is_valid").drop("is_valid")
            .withColumn("event_time", F.timestamp_millis("time_ms")))


def malformed_lines(parsed: DataFrame) -> DataFrame:
    """S1 side output: lines that are not valid clicks."""
    return parsed.filter(~F.col("is_valid"))


def count_by(events: DataFrame, keys: Sequence[str], out: str = "click_count") -> DataFrame:
    """Clicks per key (partial aggregation before the shuffle)."""
    return events.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def daily_user_ad_clicks(events: DataFrame) -> DataFrame:
    """Clicks per (date, user, ad)."""
    return count_by(events, DAILY_KEYS)


def distinct_blacklist_users(counts: DataFrame, threshold: int = 100) -> DataFrame:
    """Users with a (date, user, ad) count at or over ``threshold`` (``>=``)."""
    return counts.filter(F.col("click_count") >= threshold).select("user_id").distinct()


def anti_blacklist(events: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Events of users not on the blacklist (left anti join on ``user_id``).

    The blacklist grows with abuse, not with a fixed bound, so no broadcast
    hint: AQE broadcasts it when its measured size is small.
    """
    return events.join(blacklist.select("user_id").distinct(), "user_id", "left_anti")


def lookup_click_count(keys: DataFrame, state: DataFrame,
                       key_cols: Sequence[str] = DAILY_KEYS, measure: str = "click_count") -> DataFrame:
    """Stored measure of each key in ``keys``; 0 when the key is absent."""
    k = keys.select(*key_cols).distinct()
    stored = state.join(k, list(key_cols), "left_semi").groupBy(*key_cols).agg(F.sum(measure).alias(measure))
    return (k.join(stored, list(key_cols), "left")
            .select(*key_cols, F.coalesce(F.col(measure), F.lit(0)).cast("bigint").alias(measure)))


def province_top_ads(ad_stat: DataFrame, n: int = 3) -> DataFrame:
    """Top ``n`` ads per (date, province) by clicks summed over cities; ties by ad id."""
    sums = ad_stat.groupBy("date", "province", "ad_id").agg(F.sum("click_count").cast("bigint").alias("click_count"))
    return top_n_per_group(sums, ["date", "province"], [F.col("click_count").desc(), F.col("ad_id")], n)
