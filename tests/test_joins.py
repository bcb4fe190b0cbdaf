"""Dimension joins drop unknown keys (inner), as the reports specify."""

from pyspark.sql import functions as F

from shoplens.operators import regions
from shoplens.operators import sessions as ses


def test_unknown_user_city_product_drop(spark):
    sessions = spark.createDataFrame([("s1", 1), ("s2", 99)], "session_id string, user_id long")
    users = spark.createDataFrame([(1, 30, "p", "c", "male")],
                                  "user_id long, age int, professional string, city string, sex string")
    assert [r[0] for r in ses.join_session_user(sessions, users).select("session_id").collect()] == ["s1"]
    clicks = spark.createDataFrame([(0, 7), (77, 7)], "city_id long, click_product_id long")
    cities = spark.createDataFrame([(0, "c0", "ASIA")], "city_id long, city_name string, area_name string")
    cc = regions.join_click_city(clicks, cities)
    assert cc.count() == 1
    counts = regions.area_product_clicks(cc)
    products = spark.createDataFrame([(8, "other", '{"product_status": 0}')],
                                     "product_id long, product_name string, extend_info string")
    assert regions.join_area_product(counts, products).count() == 0


def test_area_top3_ties_by_product_id(spark):
    full = spark.createDataFrame(
        [("ASIA", p, c, "x", f"n{p}", "Self") for p, c in [(5, 2), (3, 2), (4, 2), (1, 1), (2, 9)]],
        "area_name string, product_id long, click_count long, city_infos string, product_name string, "
        "product_status string")
    got = [r["product_id"] for r in regions.area_top3(full).orderBy(F.col("click_count").desc(), "product_id").collect()]
    assert got == [2, 3, 4]
