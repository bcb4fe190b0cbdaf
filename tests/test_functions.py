import datetime as dt

from pyspark.sql import functions as F

from shoplens.functions import scalar as fn
from shoplens.schemas import USER_INFO, conform
import pytest


def one(spark, expr, data, schema="s string"):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_round_half_up_on_fractions(spark):
    df = spark.createDataFrame([(23, 40), (57, 200), (1, 3), (0, 7), (9, 9)], "n long, d long")
    got = [r[0] for r in df.select(fn.ratio("n", "d")).collect()]
    assert got == [0.58, 0.29, 0.33, 0.0, 1.0]


def test_ratio_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(1, 0)], "n long, d long")
    assert df.select(fn.ratio("n", "d")).first()[0] is None


def test_parse_time_accepts_unpadded_hour(spark):
    got = one(spark, fn.format_time(fn.parse_time("s")), [("2019-11-15 7:05:09",), ("2019-11-15 17:05:09",), ("bad",)])
    assert got == ["2019-11-15 07:05:09", "2019-11-15 17:05:09", None]


def test_time_compare_and_minus(spark):
    df = spark.createDataFrame([("2019-11-15 7:05:09", "2019-11-15 17:05:09")], "a string, b string")
    r = df.select(fn.time_before("a", "b"), fn.time_after("a", "b"), fn.time_minus("b", "a")).first()
    assert (r[0], r[1], r[2]) == (True, False, 36000)


def test_date_formats(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 5, 7, 3, 9),)], "t timestamp_ntz")
    r = df.select(fn.format_date("t"), fn.format_time("t"), fn.format_date_key("t"), fn.format_minute_key("t"),
                  fn.date_hour("t"), fn.format_date(fn.parse_date_key(F.lit("20240105")))).first()
    assert tuple(r) == ("2024-01-05", "2024-01-05 07:03:09", "20240105", "202401050703", "2024-01-05_07",
                        "2024-01-05")


def test_epoch_millis_is_utc_and_zone_free(spark):
    df = spark.createDataFrame([(1704153599999,), (1704153600000,)], "ms long")
    assert [r[0] for r in df.select(fn.format_date(fn.epoch_millis_to_date("ms"))).collect()] == [
        "2024-01-01", "2024-01-02"]


def test_today_and_yesterday(spark):
    r = spark.range(1).select(fn.today(), fn.yesterday()).first()
    assert r[0] - r[1] == dt.timedelta(days=1)


def test_csv_to_ids(spark):
    got = one(spark, fn.csv_to_ids("s"), [("1,2",), ("1,,2",), ("1,",), (None,), ("7,x",)])
    assert got == [[1, 2], [1, 2], [1], None, [7, None]]


def test_pad2_keeps_long_text(spark):
    assert one(spark, fn.pad2("s"), [("7",), ("17",), ("123",), ("",)]) == ["07", "17", "0123", "0"]


def test_trim_comma(spark):
    assert one(spark, fn.trim_comma("s"), [(",a,b,",), ("a,b",), ("a,",), (",a",)]) == ["a,b", "a,b", "a", "a"]


def test_empty_checks(spark):
    df = spark.createDataFrame([(None,), ("",), ("x",)], "s string")
    assert [tuple(r) for r in df.select(fn.is_empty("s"), fn.is_not_empty("s")).collect()] == [
        (True, False), (True, False), (False, True)]


def test_get_field_rules(spark):
    data = [("a=1|k=2|k=3",), ("k=x=y|k=5",), ("k=|a=1",), ("a=1",), ("ak=1|k=2",), (None,)]
    assert one(spark, fn.get_field("s", "k"), data) == ["2", "5", None, None, "2", None]


def test_set_field_keeps_order(spark):
    assert one(spark, fn.set_field("s", "k", "9"), [("a=1|k=2|b=3",), ("a=1",)]) == ["a=1|k=9|b=3", "a=1"]


def test_json_field_and_status(spark):
    from shoplens.functions.filters import product_status
    data = [('{"product_status": 0}',), ('{"product_status": 1}',), ('{"other": 0}',), (None,)]
    assert one(spark, fn.json_field("s", "product_status"), data) == ["0", "1", None, None]
    assert one(spark, product_status("s"), data) == ["Self", "Third Party", "Third Party", "Third Party"]


def test_concat_id_name_and_pair_label(spark):
    df = spark.createDataFrame([(3, "x", 1, 2)], "i long, n string, a long, b long")
    r = df.select(fn.concat_id_name("i", "n"), fn.pair_label("a", "b")).first()
    assert tuple(r) == ("3:x", "1_2")


def test_conform_binds_by_name_and_rejects_missing(spark):
    df = spark.createDataFrame([("f", 3, "u", "n", 30, "p", "c")],
                               "sex string, user_id long, username string, name string, age int, "
                               "professional string, city string")
    out = conform(df, USER_INFO)
    assert out.columns == USER_INFO.names
    with pytest.raises(Exception):
        conform(df.drop("age"), USER_INFO)


def test_task_id_is_first_column(spark):
    from shoplens.sources.sinks import new_task_id, with_task_id
    tid = new_task_id()
    out = with_task_id(spark.createDataFrame([(1,)], "x long"), tid)
    assert out.columns == ["task_id", "x"] and out.first()[0] == tid


def test_epoch_millis_round_trip_in_any_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 1, 999999),), (dt.datetime(1969, 12, 31, 23, 59, 59),)],
                                       "t timestamp_ntz")
            got = [tuple(r) for r in df.select(fn.ntz_to_epoch_millis("t"),
                                               fn.epoch_millis_to_ntz(fn.ntz_to_epoch_millis("t"))).collect()]
            assert got[0][0] == 1710037801999 and got[1][0] == -1000, zone
            assert got[0][1] == dt.datetime(2024, 3, 10, 2, 30, 1, 999000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_seconds_between_cuts_both_ends(spark):
    import datetime as dt

    from shoplens.functions.scalar import seconds_between
    t = dt.datetime(2024, 1, 1, 10, 0, 0)
    ms = lambda k: t + dt.timedelta(milliseconds=k)
    rows = [(t, ms(900)), (ms(900), ms(1100)), (ms(900), ms(2800)), (ms(5000), t), (dt.datetime(1960, 1, 1, 0, 0, 0, 500000), t), (None, t)]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz").select(seconds_between("a", "b").alias("s"))
    whole = int((t - dt.datetime(1960, 1, 1)).total_seconds())
    assert [r["s"] for r in df.collect()] == [0, 1, 2, -5, whole, None]
