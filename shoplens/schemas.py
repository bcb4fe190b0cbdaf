"""Record types of the click log, dimensions and report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


USER_VISIT_ACTION = _s(
    ("action_id", LongType()), ("date", DateType()), ("user_id", LongType()),
    ("session_id", StringType()), ("page_id", LongType()),
    ("action_time", TimestampNTZType()), ("search_keyword", StringType()),
    ("click_category_id", LongType()), ("click_product_id", LongType()),
    ("order_category_ids", StringType()), ("order_product_ids", StringType()),
    ("pay_category_ids", StringType()), ("pay_product_ids", StringType()),
    ("city_id", LongType()))

USER_INFO = _s(
    ("user_id", LongType()), ("username", StringType()), ("name", StringType()),
    ("age", IntegerType()), ("professional", StringType()), ("city", StringType()),
    ("sex", StringType()))

PRODUCT_INFO = _s(("product_id", LongType()), ("product_name", StringType()),
                  ("extend_info", StringType()))

CITY_INFO = _s(("city_id", LongType()), ("city_name", StringType()), ("area_name", StringType()))

AD_EVENT = _s(("time_ms", LongType()), ("province", StringType()), ("city", StringType()),
              ("user_id", LongType()), ("ad_id", LongType()))

AD_USER_CLICK_COUNT = _s(("date", StringType()), ("user_id", LongType()),
                         ("ad_id", LongType()), ("click_count", LongType()))
AD_BLACKLIST = _s(("user_id", LongType()))
AD_STAT = _s(("date", StringType()), ("province", StringType()), ("city", StringType()),
             ("ad_id", LongType()), ("click_count", LongType()))
AD_STAT_CHANGES = _s(("batch_id", LongType()), ("date", StringType()), ("province", StringType()),
                     ("city", StringType()), ("ad_id", LongType()), ("click_count", LongType()))
AD_PROVINCE_TOP3 = _s(("date", StringType()), ("province", StringType()),
                      ("ad_id", LongType()), ("click_count", LongType()))
AD_CLICK_TREND = _s(("date", StringType()), ("hour", StringType()), ("minute", StringType()),
                    ("ad_id", LongType()), ("click_count", LongType()))

SESSION_AGGR_STAT = _s(
    ("session_count", LongType()),
    *[(f"visit_length_{b}", DoubleType()) for b in
      ("1s_3s", "4s_6s", "7s_9s", "10s_30s", "30s_60s", "1m_3m", "3m_10m", "10m_30m", "30m")],
    *[(f"step_length_{b}", DoubleType()) for b in
      ("1_3", "4_6", "7_9", "10_30", "30_60", "60")])


_TASK = StructField("task_id", StringType(), True)


def of_task(schema: StructType) -> StructType:
    """A report table's schema: the run's id, then the report's columns."""
    return StructType([_TASK, *schema.fields])


SESSION_RANDOM_EXTRACT = _s(("session_id", StringType()), ("start_time", StringType()),
                            ("search_keywords", StringType()), ("click_category_ids", StringType()))
TOP10_CATEGORY = _s(("category_id", LongType()), ("click_count", LongType()), ("order_count", LongType()),
                    ("pay_count", LongType()))
TOP10_SESSION = _s(("category_id", LongType()), ("session_id", StringType()), ("click_count", LongType()))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Bind columns by name to ``schema``; a missing column is an error.

    Columns are reordered and cast as the schema says; extra columns are dropped.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing} for {schema.simpleString()}")
    return df.to(schema)
